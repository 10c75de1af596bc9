"""Where intermediate tables go: the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local one only where that is unset and all runs in one process, as in tests."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        there = tempfile.mkdtemp(prefix="boxloom-")
        spark.conf.set("spark.checkpoint.dir", there)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(there)
    return there.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder; its lineage ends here."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_counted(df: DataFrame, column: str, values: tuple[str, ...]) -> tuple[DataFrame, dict[str, int]]:
    """``cut`` of ``df``, and how often each of ``values`` stands in ``column``, counted while it is computed."""
    seen = Observation(column)
    done = cut(df.observe(seen, *[F.count_if(F.col(column) == v).alias(v) for v in values]))
    return done, {v: n for v, n in seen.get.items() if n}


#: Tables that this process has written and not deleted yet, and the names of those that the catalog knows.
_WRITTEN: list[str] = []
_NAMES: dict[str, str] = {}


def _stored(df: DataFrame) -> tuple[str, DataFrame]:
    path = f"{shared_dir(df.sparkSession)}/boxloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def _bucketed(df: DataFrame, key: str) -> tuple[str, DataFrame]:
    """As ``_stored``, in a bucket of ``key`` for each shuffle partition: joins on ``key`` leave it where it is."""
    spark, label = df.sparkSession, uuid.uuid4().hex
    path, name = f"{shared_dir(spark)}/boxloom-{label}", f"spark_catalog.default.boxloom_{label}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _WRITTEN.append(path)
    _NAMES[path] = name
    df.write.format("parquet").bucketBy(parts, key).option("path", path).saveAsTable(name)
    return path, spark.table(name)


def _delete(spark: SparkSession, path: str) -> None:
    if path in _NAMES:
        spark.sql(f"DROP TABLE IF EXISTS {_NAMES.pop(path)}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: compressed, column-pruned, survives lost executors."""
    return _stored(df)[1]


def discard(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this process. Results that were not stored elsewhere cannot be read afterwards."""
    for path in list(_WRITTEN):
        _delete(spark, path)


class Shelf:
    """Intermediate tables of one operator in the shared folder, which it can delete when it needs them no more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame) -> DataFrame:
        """``df`` as ``written``."""
        path, out = _stored(df)
        self.paths[path] = out
        return out

    def put_by(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` as ``put``, for joins on ``key`` again and again; it must be dealt out by ``key`` already."""
        path, out = _bucketed(df, key)
        self.paths[path] = out
        return out

    def clear(self, *keep: DataFrame) -> None:
        """Deletes all tables but those in ``keep``; nothing may read them any more."""
        for path, df in list(self.paths.items()):
            if not any(df is k for k in keep):
                _delete(self.spark, path)
                del self.paths[path]
