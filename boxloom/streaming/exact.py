"""Exact duplicates in a stream: the first key of each content is in a state store, read and written by content.

A micro-batch costs by its own size: of what earlier batches had, only the contents that it brings are looked
up. The state is RocksDB's, with change logs in the stream's checkpoint, so a restart goes on where it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How groups of rows without content begin; digests have no colon.
_NONE = "none:"


class _FirstKey(StatefulProcessor):
    """Keeps the first key of a content: the least of the first batch that has it."""

    def __init__(self, key: str, kind: str):
        self.key, self.kind = key, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", f"first {self.kind}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  names of the interface
        def out(keys: list, kept: bool) -> pd.DataFrame:
            return pd.DataFrame({self.key: keys, "sha": [None if key[0].startswith(_NONE) else key[0]] * len(keys), "kept": [kept] * len(keys)})

        if key[0].startswith(_NONE):
            for frame in rows:
                yield out(list(frame[self.key]), True)
            return
        known = self.first.exists()
        least, times = (self.first.get()[0], 0) if known else (None, 0)
        for frame in rows:  # one pass: a key that is not the least so far cannot become it
            lost = []
            for k in frame[self.key]:
                if k == least:
                    times += 1
                elif known or least is not None and k > least:
                    lost.append(k)
                else:
                    lost += [least] * times
                    least, times = k, 1
            if lost:
                yield out(lost, False)
        if times:
            yield out([least] * times, True)
        if not known:
            self.first.update((least,))

    def close(self) -> None:
        pass


def exact_stream(rows: DataFrame, key: str, content: str) -> DataFrame:
    """(key, sha, kept) of a stream: whether a row is the first with its content.

    First is the least key of the earliest batch that has the content, so batches in the order of their keys give
    what ``dedup.exact_duplicates`` gives for all rows. The kept row that comes again is kept again. Rows without
    content are copies of nothing and leave no state; rows without a key are left out.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    kind = rows.schema[key].dataType.simpleString()
    sha = F.coalesce(F.sha2(F.col(content), 256), F.concat(F.lit(_NONE), F.col(key).cast("string")))
    named = rows.where(F.col(key).isNotNull()).select(F.col(key), sha.alias("group"))
    return named.groupBy("group").transformWithStateInPandas(_FirstKey(key, kind), f"`{key}` {kind}, sha string, kept boolean", "Append", "None")


def dedup_new_files(spark: SparkSession, folder: str, schema: str, checkpoint: str, out: str, key: str, content: str, fmt: str = "parquet", files: int | None = None) -> None:
    """Decides on the rows of files that earlier runs have not seen, appends (key, sha, kept) to ``out``, then stops."""
    source = spark.readStream.format(fmt).schema(schema)
    rows = (source.option("maxFilesPerTrigger", files) if files else source).load(folder)
    query = exact_stream(rows, key, content).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
