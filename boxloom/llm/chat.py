r"""Chat formatting by event-sourced reconstruction.

A log holds one row an event: (conv_id, turn, seq, kind, role, text). Kinds: ``message`` begins a message
of its turn with a role and a text; ``delta`` appends to the newest message of the turn; ``edit`` replaces
its text; ``regenerate`` takes the text back and drops every event of later turns before it, their own
regenerates included. The log is
partitioned by conversation and sorted by (turn, seq); a worker folds it as a stream, so it holds one
message at a time, and a conversation with a third of all rows needs no more memory than a short one.

The template is ``### role: text </turn>\n`` for each message. Control strings inside texts are broken by
a backslash: ``\`` becomes ``\\``, ``### `` becomes ``#\## ``, ``</turn>`` becomes ``<\/turn>``; a role
also escapes ``:``. Taking a backslash off each escaped character reads the text back.

Defined results: a null text or role is empty; rows of the same turn are messages each, ordered by seq,
role and text; null conv_ids are one conversation; a null seq is before all others; a delta, edit or
regenerate of a turn that has no message begins one with its own role; repeated events count as often as
they are there; an empty log gives no rows; very long texts are held one at a time; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.llm.common import table

OPEN, COLON, CLOSE = "### ", ": ", " </turn>\n"
_CONTROL = re.compile(r"\\|### |</turn>")
_ROLE_CONTROL = re.compile(r"\\|### |</turn>|:")
_BROKEN = {"\\": "\\\\", "### ": "#\\## ", "</turn>": "<\\/turn>", ":": "\\:"}
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.DOTALL)
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: _BROKEN[m[0]], text)


def escape_role(role: str) -> str:
    return _ROLE_CONTROL.sub(lambda m: _BROKEN[m[0]], role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and the span of its text, which is under the loss mask for the learned role."""
    head = OPEN + escape_role(role) + COLON
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, span of the text) of each turn of a formatted conversation."""
    at = 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        end = formatted.index(CLOSE, head.end())
        yield unescape(head[1]), unescape(formatted[head.end() : end]), head.end(), end
        at = end + len(CLOSE)


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, turn, role, text) of the messages that stand at the end; events come by (conv_id, turn, seq)."""
    group: tuple | None = None
    conv: tuple | None = None
    dropped: int | None = None  # seq of the last regenerate of this or an earlier turn of the conversation
    held: list[list] = []  # newest message of the turn: [seq, role, parts]

    for conv_id, turn, seq, kind, role, text in events:
        key = (conv_id, turn)
        if group != key:
            if held:
                yield (*group, held[0][1], "".join(held[0][2]))
                held.clear()
            if conv != (conv_id,):
                conv, dropped = (conv_id,), None
            group = key
        if dropped is not None and (seq is None or seq < dropped):
            continue
        if kind == "regenerate":
            dropped = seq if seq is not None else dropped
            role = held[0][1] if held else role
            held[:] = [[seq, role, [text]]]
        elif kind == "message" or not held:
            if held:
                yield (*group, held[0][1], "".join(held[0][2]))
            held[:] = [[seq, role, [text]]]
        elif kind == "edit":
            held[0][2] = [text]
        else:
            held[0][2].append(text)
    if held:
        yield (*group, held[0][1], "".join(held[0][2]))


def reconstruct(events: DataFrame) -> DataFrame:
    """Formatted turns of the final messages: conv_id, turn, role, formatted, mask_start, mask_end.

    Rows of a conversation stay together and in order within a partition; the mask is empty (0, 0) for
    roles that are not learned.
    """
    names = ["conv_id", "turn", "seq", "kind", "role", "text"]
    log = events.select(*names).withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("kind", "role", "text")})
    log = log.repartition("conv_id").sortWithinPartitions(*names)
    out = ["conv_id", "turn", "role", "formatted", "mask_start", "mask_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        def emit(rows_):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows_), kinds)], out)

        ready, size = [], 0
        for conv_id, turn, role, text in fold(rows()):
            whole, start, end = render_turn(role, text)
            ready.append((conv_id, turn, role, whole, *((start, end) if role == LEARNED_ROLE else (0, 0))))
            size += len(whole)
            if len(ready) >= 5000 or size > 4_000_000:
                yield emit(ready)
                ready, size = [], 0
        if ready:
            yield emit(ready)

    schema = T.StructType(
        [T.StructField("conv_id", events.schema["conv_id"].dataType), T.StructField("turn", events.schema["turn"].dataType), T.StructField("role", T.StringType()), T.StructField("formatted", T.StringType()), T.StructField("mask_start", T.LongType()), T.StructField("mask_end", T.LongType())]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in schema]
    return log.mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """A row for each conversation, parsed from what ``reconstruct`` formatted, in its order within partitions."""
    out = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = T.StructType(
        [T.StructField("conv_id", formatted.schema["conv_id"].dataType), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        n = loss_n = chars = 0
        turns = loss = None

        def row():
            return (current[0], n, turns.hexdigest(), loss_n, loss.hexdigest(), chars)

        for batch in batches:
            done = []
            for conv_id, text, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "mask_start", "mask_end"))):
                if current != (conv_id,):
                    if current:
                        done.append(row())
                    current, n, loss_n, chars = (conv_id,), 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, said, _, _ in parse(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                masked = unescape(text[start:end])
                loss_n += len(masked)
                loss.update(masked.encode())
                chars += len(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], out)
        if current:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row(), kinds)], out)

    return formatted.select("conv_id", "formatted", "mask_start", "mask_end").mapInArrow(run, schema)


def as_events(conversations: DataFrame) -> DataFrame:
    """A plain table of turns as a log in which each row is one whole message."""
    return conversations.select("conv_id", "turn", F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"), "role", "text")


TRAP = "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRAP).alias("text"))
    return read_back(reconstruct(as_events(rows.unionByName(trap))))


def _broken(col: str) -> str:
    return f"replace(replace(replace({col}, '\\', '\\\\'), '### ', '#\\## '), '</turn>', '<\\/turn>')"


QUERIES = {"op8_chat_format": op8_chat_format}
ORACLE_SQL = {
    "op8_chat_format": f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRAP}' UNION ALL SELECT -7, 1, 'assistant', '{TRAP}')
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(replace({_broken('role')}, ':', '\\:')) + 2 + length({_broken('text')}) + 9) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""
}
