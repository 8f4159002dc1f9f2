"""A store of rows by key and time in which the last write wins.

Each batch becomes a run: files bucketed by key and sorted by key and newest time first. A manifest names the
runs that count; it is written last and never changed, so readers see all of a batch or none of it, and what a
killed writer leaves behind is in no manifest. Runs of one level are merged when there are enough of them, so
a row is rewritten a few times at most, and the number of files stays bounded while the store grows.

One writer at a time (a streaming query is one); any number of readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.writers import path_exists, remove_path

#: Manifests that are kept: a reader that has just read one still finds its runs.
KEPT_MANIFESTS = 3


@dataclass(frozen=True)
class UpsertStore:
    path: str
    key: str = "maquina_id"
    ts: str = "ts"
    version: str = "version"
    buckets: int = 16
    runs_per_level: int = 4

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    # ---- manifests ----

    def _folder(self, spark: SparkSession, name: str):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at

    def manifests(self, spark: SparkSession) -> list[int]:
        """Numbers of the complete manifests, in order."""
        if not path_exists(spark, f"{self.path}/manifests"):
            return []
        fs, at = self._folder(spark, "manifests")
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def runs(self, spark: SparkSession, number: int | None = None) -> list[dict]:
        """The runs of a manifest, by default the last: folder, level, and the batches that they hold."""
        known = self.manifests(spark)
        if not known:
            return []
        path = f"{self.path}/manifests/{known[-1] if number is None else number}.json"
        return json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))

    def _commit(self, spark: SparkSession, runs: list[dict]) -> None:
        known = self.manifests(spark)
        number = known[-1] + 1 if known else 1
        fs, part = self._folder(spark, f"manifests/{number}.part")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps(runs).encode()))
        out.close()
        # a manifest appears whole: under its name only once it is written
        _, done = self._folder(spark, f"manifests/{number}.json")
        if not fs.rename(part, done):
            raise RuntimeError(f"manifest {number} of {self.path} was written by someone else")
        for old in known[: -KEPT_MANIFESTS + 1]:
            remove_path(spark, f"{self.path}/manifests/{old}.json")

    # ---- writing ----

    def _place(self, run: str) -> str:
        return f"{self.path}/runs/run={run}"

    def _write_run(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        bucketed = self.last(rows).withColumn("bucket", self._bucket(F.col(self.key)))
        ordered = bucketed.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", self.key, F.desc(self.ts))
        ordered.write.partitionBy("bucket").parquet(self._place(name))
        return name

    def last(self, rows: DataFrame) -> DataFrame:
        """One row per key and time: the highest version, of equal ones the largest row. Combines map-side."""
        rest = [c for c in rows.columns if c not in (self.key, self.ts)]
        values = [F.col(self.version), *[F.col(c) for c in rest if c != self.version]]
        best = F.max(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])).alias("r")
        names = [self.version, *[c for c in rest if c != self.version]]
        picked = rows.groupBy(self.key, self.ts).agg(best).select(self.key, self.ts, *[F.col(f"r.v{i}").alias(n) for i, n in enumerate(names)])
        return picked.select(*rows.columns)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Adds a batch; a repeated one replaces itself. Then merges levels that are full."""
        spark = batch.sparkSession
        before = self.runs(spark)
        # a batch that is in a merged run already can only be a repeat of rows that the run holds
        kept = [r for r in before if r["batches"] != [batch_id]]
        if not any(batch_id in r["batches"] for r in kept):
            kept = [*kept, {"run": self._write_run(batch), "level": 0, "batches": [batch_id]}]
            self._commit(spark, kept)
        self.merge(spark)

    def merge(self, spark: SparkSession) -> None:
        """Merges each level that has ``runs_per_level`` runs into one run of the next level, and removes
        runs that no kept manifest names."""
        level = 0
        while True:
            runs = self.runs(spark)
            full = [r for r in runs if r["level"] == level]
            if len(full) >= self.runs_per_level:
                merged = self._write_run(self._rows(spark, full))
                batches = sorted(b for r in full for b in r["batches"])
                rest = [r for r in runs if r["level"] != level]
                self._commit(spark, [*rest, {"run": merged, "level": level + 1, "batches": batches}])
            if not any(r["level"] > level for r in runs) and len(full) < self.runs_per_level:
                break
            level += 1
        self.clean(spark)

    def clean(self, spark: SparkSession) -> None:
        if not path_exists(spark, f"{self.path}/runs"):
            return
        named = {r["run"] for number in self.manifests(spark) for r in self.runs(spark, number)}
        fs, at = self._folder(spark, "runs")
        for status in fs.listStatus(at):
            name = status.getPath().getName().removeprefix("run=")
            if name not in named:
                remove_path(spark, self._place(name))

    # ---- reading ----

    def _rows(self, spark: SparkSession, runs: Sequence[dict]) -> DataFrame:
        return self._files(spark, runs).drop("run", "bucket")

    def _files(self, spark: SparkSession, runs: Sequence[dict]) -> DataFrame:
        return spark.read.option("basePath", f"{self.path}/runs").parquet(*[self._place(r["run"]) for r in runs])

    def read(self, spark: SparkSession) -> DataFrame:
        """The last write of every key and time. A store without any batch is an error."""
        return self.last(self._rows(spark, self.runs(spark)))

    def newest(self, spark: SparkSession, key: object, n: int) -> DataFrame:
        """The n newest rows of one key, newest first: reads that key's bucket only, from files in this order."""
        mine = self._files(spark, self.runs(spark)).filter((F.col("bucket") == self._bucket(F.lit(key))) & (F.col(self.key) == F.lit(key)))
        return self.last(mine.drop("run", "bucket")).orderBy(F.desc(self.ts)).limit(n)
