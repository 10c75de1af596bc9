"""Incremental runs: what is new in a folder, each file once, failures again at the next run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.functions.session import cut
from boxloom.operators.hash_index import HashIndex


def run_new_files(spark: SparkSession, folder: str, schema: str, checkpoint: str, job: Callable[[DataFrame, int], None], fmt: str = "parquet") -> None:
    """Gives ``job`` the rows of files that earlier runs have not seen, then stops."""
    rows = spark.readStream.format(fmt).schema(schema).load(folder)
    query = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(job).start()
    query.awaitTermination()


def _recorded(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table of earlier runs; None before the first."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def dedup_batch(batch: DataFrame, state_path: str, key: str, content: str) -> DataFrame:
    """Rows of a batch whose content neither an earlier batch nor an earlier row of this one has; they join the state.

    The state is an append-only table of contents with the keys that brought them. A batch that is run again,
    because the caller's sink failed after the state had grown, finds its own rows there and gives them again.
    Rows without content are copies of nothing, and are always given.
    """
    spark = batch.sparkSession
    hashed = batch.withColumn("sha", F.sha2(F.col(content), 256))
    none = hashed.where("sha IS NULL")
    first = hashed.where("sha IS NOT NULL").groupBy("sha").agg(F.min(key).alias("_first"))
    new = hashed.join(first, "sha").where(F.col(key) == F.col("_first")).drop("_first").dropDuplicates(["sha"])
    state = _recorded(spark, state_path, "sha string, name string")
    if state is None:
        fresh = kept = cut(new.withColumn("_own", F.lit(False)))
    else:
        owner = state.groupBy("sha").agg(F.min("name").alias("_name"))
        seen = new.join(owner, "sha", "left").withColumn("_own", F.col("_name").isNotNull())
        kept = cut(seen.where(F.col("_name").isNull() | (F.col("_name") == F.col(key).cast("string"))).drop("_name"))
        fresh = kept.where("NOT _own")
    fresh.select("sha", F.col(key).cast("string").alias("name")).write.mode("append").parquet(state_path)
    return kept.drop("_own").select(*hashed.columns).unionByName(none)


def curate_batch(batch: DataFrame, state_path: str, key: str, content: str, h: str, within: int = 6) -> DataFrame:
    """(key, reason) of a batch, exact and near duplicates of what this and all earlier batches kept; the kept join the state.

    The state is a ``HashIndex``, of which a batch reads what its own hashes may meet. A batch that is run again
    gets the decisions of its first run: a kept image is told by its name and bytes, and does not count against
    itself. A name that comes back with other bytes is another image; what the name stood for stays kept.
    """
    rows = cut(batch.select(F.col(key).alias("key"), F.sha2(F.col(content), 256).alias("sha"), F.col(h).alias("hash")))
    decided = HashIndex(batch.sparkSession, state_path, within).curate(rows)
    return decided.select(F.col("key").alias(key), "reason")


def retry_failures(done_path: str, rows: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], failed: tuple[str, ...] = ("api_fail", "size_fail"), sink: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Runs ``work`` on rows not done before; only those without a failed status are recorded, so the others come again.

    ``sink`` gets the results before they are recorded: if it fails, nothing is recorded, and the rows come
    again. Without it, the caller stores what is returned, and a failure after the record loses it.
    """
    done = _recorded(rows.sparkSession, done_path, f"{key} {rows.schema[key].dataType.simpleString()}")
    out = cut(work(rows if done is None else rows.join(done, key, "left_anti")))
    if sink is not None:
        sink(out)
    out.where(~F.col("status").isin(*failed)).select(key).write.mode("append").parquet(done_path)
    return out
