"""An index of the perceptual hashes of kept images that persists from run to run.

64 bits are cut into bands; two hashes at most ``within`` bits apart have a number of equal bands in common, and
each combination of that many bands is a key. The index holds a row for each key of each kept hash, in folders
by a hash of the key (``bands``), and the kept images by their hash (``entries``). A batch reads only the folders
that its own keys name, so it costs by its own size and what it meets, and no kept hash is compared with
another kept one. Both tables grow by one commit of a manifest: what a run keeps is there as a whole or not at
all, and two runs that decide at the same time cannot both commit.

Decisions fall on distinct hashes, each with its least key: rows of equal hashes are members, never pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.functions.session import cut
from boxloom.operators.dedup import decide
from boxloom.operators.near import near, probes
from boxloom.sources.manifest import Conflict, Manifest

WITHIN, BUCKETS, ATTEMPTS = 6, 64, 20
ENTRIES = "name string, sha string, hash long, bucket int"
BANDS = "key long, hash long, bucket int"


class HashIndex:
    """The kept images at ``path``. ``within`` and ``buckets`` are fixed by the first run and read from then on."""

    def __init__(self, spark: SparkSession, path: str, within: int = WITHIN, buckets: int = BUCKETS):
        self.manifest = Manifest(spark, path)
        first = next(iter(self.manifest.commits(1)), None) if self.manifest.version() else None
        self.within, self.buckets = map(int, first["note"].split(":")) if first and first["note"] else (within, buckets)
        if self.within != within:
            raise ValueError(f"the index at {path} is for a distance of {self.within}, not {within}")

    def _bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int").alias("bucket")

    def _only(self, rows: DataFrame, of: DataFrame) -> DataFrame:
        """``rows`` in the folders that ``of`` names: at most ``buckets`` numbers."""
        return rows.where(F.col("bucket").isin([r.bucket for r in of.select("bucket").distinct().collect()]))

    def entries(self, version: int | None = None) -> DataFrame:
        """(name, sha, hash, bucket) of all that is kept."""
        return self.manifest.read("entries", ENTRIES, version)

    def decide(self, rows: DataFrame, version: int | None = None) -> DataFrame:
        """What ``decide`` says of ``rows`` (key, sha, hash) after a version of the index."""
        version = self.manifest.version() if version is None else version
        if not version:
            return decide(rows, self.within)
        hashes = rows.where("hash IS NOT NULL").select("hash").distinct()
        asked = cut(probes(hashes, self.within).withColumn("bucket", self._bucket("key")))
        at = self._only(self.manifest.read("bands", BANDS, version), asked)
        hits = cut(near(asked, at, self.within, ("bucket", "key")))
        entries = self.entries(version)
        others = hits.select(F.col("other").alias("hash")).distinct().withColumn("bucket", self._bucket("hash"))
        names = self._only(entries, others).join(others, ["bucket", "hash"]).groupBy(F.col("hash").alias("other")).agg(F.min("name").alias("name"))
        own = hashes.withColumn("bucket", self._bucket("hash"))
        held = self._only(entries, own).join(own, ["bucket", "hash"], "left_semi").select("sha", "hash", "name")
        return decide(rows, self.within, hits.join(names, "other"), cut(held))

    def add(self, decided: DataFrame, version: int) -> int:
        """Commits what ``decided`` keeps, on top of the version that was decided against; raises ``Conflict``."""
        new = cut(decided.where("reason = 'ok' AND NOT own").select(F.col("key").cast("string").alias("name"), "sha", "hash").distinct())
        if new.isEmpty():
            return version
        rows = probes(new.select("hash").distinct(), self.within).select("key", "hash", self._bucket("key"))
        adds = {"bands": self.manifest.stage("bands", rows.repartition("bucket").sortWithinPartitions("bucket", "key"), "bucket")}
        adds["entries"] = self.manifest.stage("entries", new.withColumn("bucket", self._bucket("hash")).repartition("bucket").sortWithinPartitions("bucket", "hash"), "bucket")
        return self.manifest.commit(version, adds, note=f"{self.within}:{self.buckets}")

    def adopt(self, records: DataFrame) -> int:
        """Makes the kept images of ``records`` (name, sha, hash), of another tool or an older record, the first version."""
        kept = records.where("hash IS NOT NULL").select(F.col("name").alias("key"), "sha", "hash", F.lit("ok").alias("reason"), F.lit(False).alias("own"))
        return self.add(kept, 0)

    def curate(self, rows: DataFrame, attempts: int = ATTEMPTS) -> DataFrame:
        """Decides on ``rows`` and keeps what is ok; decides anew where another run has committed meanwhile."""
        for _ in range(attempts):
            version = self.manifest.version()
            decided = cut(self.decide(rows, version))
            try:
                self.add(decided, version)
                return decided
            except Conflict:
                continue
        raise Conflict(f"others have committed {attempts} times meanwhile")

    def compact(self) -> int:
        """Writes all folders of the latest version as one commit, a file to a bucket; nothing else changes."""
        version = self.manifest.version()
        adds = {}
        for part, schema in (("bands", BANDS), ("entries", ENTRIES)):
            adds[part] = self.manifest.stage(part, self.manifest.read(part, schema, version).repartition("bucket").sortWithinPartitions("bucket", "key" if part == "bands" else "hash"), "bucket")
        return self.manifest.commit(version, adds, replaces=True, note=f"{self.within}:{self.buckets}")
