"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.functions.session import _WRITTEN, Shelf, cut, discard, shared_dir, written  # noqa: F401

__all__ = ["Shelf", "ascii_lower", "bitmap", "cut", "discard", "let", "may_hold", "shared_dir", "shuffle_partitions", "small_batches", "table", "tidied", "without", "words", "written"]

#: Words are runs of anything but the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bytes of an Arrow batch for sessions that leave the setting at its default: an executor holds several at once.
ARROW_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lets batches for workers hold ARROW_BYTES, unless the session sets a size of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(ARROW_BYTES))


def _trim() -> None:
    """Gives memory that is free inside this process back, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def tidied(run):
    """``run`` for mapInArrow, which gives free memory back after the last batch: idle workers are kept for later stages."""

    def wrapped(batches):
        yield from run(batches)
        _trim()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read lazily through Spark (any file system Spark knows)."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle has in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text in order; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row, column ``map array<bigint>``: bit ``pmod(xxhash64(key), bits)`` is set for each key.

    The size depends on ``bits`` alone, however many keys there are. A clear bit proves that a key is
    absent; a set one proves nothing, so whatever passes must still be joined exactly.
    """
    n = bits // 64
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    had = (
        keys.select(F.shiftright(place, 6).alias("i"), F.pmod(place, F.lit(64)).cast("int").alias("b"))
        .groupBy("i")
        .agg(F.expr("bit_or(shiftleft(1L, b))").alias("w"))
    )
    every = keys.sparkSession.range(0, n, 1, 1).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("w"))
    rows = had.unionByName(every).groupBy("i").agg(F.expr("bit_or(w)").alias("w"))
    return rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]).alias("map"))


def may_hold(map_: Column, key: Column) -> Column:
    """False only if ``key`` is certainly not in a ``bitmap``."""
    place = F.pmod(F.xxhash64(key), F.size(map_) * F.lit(64))
    word = F.get(map_, F.shiftright(place, 6).cast("int"))
    # shiftright takes a constant or column of type int for its second argument
    return F.call_function("shiftright", word, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1


#: Bits of the map that ``without`` uses.
WITHOUT_BITS = 1 << 22


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``gone`` (one column); rows without a key stay.

    Rows that a bitmap of fixed size shows to be absent stay where they are; only the others, those to go
    and a few more, are shuffled to an exact anti-join.
    """
    # all columns of the documents travel as one, so that none can clash with those that are needed here
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(key).alias("key"), bitmap(gone, key, WITHOUT_BITS).scalar().alias("map"))
    marked = marked.select("doc", "key", F.coalesce(let(F.col("map"), lambda m: may_hold(m, F.col("key"))), F.lit(False)).alias("held"))
    keep = marked.where("NOT held OR key IS NULL").select("doc.*")
    look = marked.where("held AND key IS NOT NULL").select("doc", "key")
    return keep.unionByName(look.join(gone.select(F.col(key).alias("key")), "key", "left_anti").select("doc.*"))
