"""Label lines ``cls cx cy w h [more]``: the ways in which a line counts as a box."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What Python's float() reads and Spark's cast would read otherwise: no trailing letter, underscores between digits.
NUMBER = r"^[+-]?(?:[0-9](?:_?[0-9])*(?:\.(?:[0-9](?:_?[0-9])*)?)?|\.[0-9](?:_?[0-9])*)(?:[eE][+-]?[0-9](?:_?[0-9])*)?$"
CLASS_LIMIT = 2_147_483_648.0


def tokens(line: Column) -> Column:
    """The tokens of a line, split at any white space."""
    return F.filter(F.split(F.coalesce(line, F.lit("")), r"[\s\x1c-\x1f\x85\p{Z}]+"), lambda t: t != "")


def number(token: Column) -> Column:
    """A token as a double; null unless it is a finite number."""
    value = F.when(token.rlike(NUMBER), F.replace(token, F.lit("_"), F.lit("")).try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def class_id(token: Column) -> Column:
    """A class token truncated towards zero; null if it is no number, infinite or beyond an int."""
    value = number(token)
    return F.when(F.abs(value) < CLASS_LIMIT, value.cast("int"))


def parse(lines: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` with n_tokens, cls, cx, cy, w, h: null where a token is missing or no number."""
    t = tokens(F.col(line))
    out = lines.withColumn("_t", t).withColumn("n_tokens", F.size("_t")).withColumn("cls", class_id(F.get("_t", F.lit(0))))
    for k, name in enumerate(("cx", "cy", "w", "h"), 1):
        out = out.withColumn(name, number(F.get("_t", F.lit(k))))
    return out.drop("_t")


def strict() -> Column:
    """Five tokens or more, the first five of them numbers."""
    return (F.col("n_tokens") >= 5) & F.col("cls").isNotNull() & F.col("cx").isNotNull() & F.col("cy").isNotNull() & F.col("w").isNotNull() & F.col("h").isNotNull()


def class_only() -> Column:
    """Five tokens or more, the first of them a number."""
    return (F.col("n_tokens") >= 5) & F.col("cls").isNotNull()


def loose() -> Column:
    """A first token that is a number."""
    return F.col("cls").isNotNull()


def any_text(line: Column) -> Column:
    """A line that is not blank."""
    return F.size(tokens(line)) > 0


def parse_class_map(spec: str) -> dict[int, int]:
    """``0:4,1:2`` as a dict: later keys win, blank pairs are ignored, anything else malformed raises."""
    out: dict[int, int] = {}
    for pair in filter(str.strip, spec.split(",")):
        source, sign, target = pair.partition(":")
        if not sign:
            raise ValueError(f"no colon in class pair {pair!r}")
        out[int(source)] = int(target)
    return out


def remap(cls: Column, classes: dict[int, int]) -> Column:
    """``cls`` through a class map; classes that it does not name stay."""
    if not classes:
        return cls
    pairs = F.create_map(*[F.lit(x) for kv in classes.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, cls), cls)
