"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator relies on: UTC, AQE, skew join, no web page.

    ``master`` and ``conf`` are for local runs; on a cluster both come from spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a session inside one process (``local[n]``, as in tests) gets a folder of its own;
    on a cluster a folder of one machine would be lost to the others, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors and the driver share")
    own = tempfile.mkdtemp(prefix="tidemill-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, one per run."""
    return f"{shared_dir(spark).rstrip('/')}/tidemill/{label}-{uuid.uuid4().hex}"


#: Frees the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that start in here leave no shuffle files. Only for queries whose result is stored."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """Writes the rows to the shared folder and reads them back: lineage ends there, the loss of an
    executor loses nothing, later uses read only the columns they need, and plans know the size.
    Shuffle files are gone once the rows are written."""
    return stored_in_rounds([df], label)


def stored_in_rounds(parts: Sequence[DataFrame], label: str = "rounds") -> DataFrame:
    """The union of the parts, stored one after the other, so that only one part's shuffle files are there at a
    time. All parts have the columns of the first."""
    spark, paths = parts[0].sparkSession, []
    for part in parts:
        paths.append(run_dir(spark, label))
        with _shuffles_freed(spark):
            part.write.parquet(paths[-1])
    return spark.read.schema(parts[0].schema).parquet(*paths)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A stored copy (see :func:`stored`); unlike a local checkpoint it survives the loss of executors."""
    return stored(df, "cut")


def settled(df: DataFrame) -> DataFrame:
    """``df`` itself if it is no more than columns of one table, else a stored copy."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return df if all(re.match(r"[ +:-]*(Project|Relation) ", line) for line in plan) else cut_lineage(df)


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more: whatever came of them must be stored itself."""
    for df in tables:
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {unquote(f).rsplit("/", 1)[0] for f in df.inputFiles()}:
            if re.search(r"/tidemill/[^/]+-[0-9a-f]{32}$", folder):
                path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Deals rows to all cores if the scan gives fewer tasks than there are cores (one small file), so
    that costly row work does not run in a single task. Large scans are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Rows that one task of an iterative fit holds at most, before they are dealt out again.
MOST_ROWS = 500_000


@contextmanager
def packed(df: DataFrame, rows_per_task: int = 50_000, most_rows: int = MOST_ROWS) -> Iterator[DataFrame]:
    """Cached rows for an iterative fit, in as many partitions as their number deserves.

    A fit runs hundreds of jobs over the same rows; a few rows in each of hundreds of partitions would
    spend them on task starts. Large inputs keep their partitions, unless these hold more than ``most_rows``
    rows on average, as a well compressed file gives them: then the rows are dealt to more.
    """
    held = [df.persist()]
    try:
        rows, parts = held[0].count(), held[0].rdd.getNumPartitions()
        wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task))
        if rows > parts * most_rows:
            held.append(held[0].repartition(-(-rows // most_rows)).persist())
            held[1].count()
            held[0].unpersist()
            yield held[1]
        else:
            yield held[0].coalesce(wanted) if wanted < parts else held[0]
    finally:
        for cached in held:
            cached.unpersist()


def task_count(spark: SparkSession) -> int:
    """The number of reduce tasks the operator of the cluster asked for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def side_by_side(jobs: Sequence[Callable[[], T]], at_once: int = 4) -> list[T]:
    """Results of independent jobs, submitted a few at a time, in their order. Small fits that can't fill the
    cluster share it that way; the first error is raised once the jobs under way have ended."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    pool = ThreadPoolExecutor(at_once)
    try:
        return list(pool.map(lambda job: job(), [inheritable_thread_target(job) for job in jobs]))
    finally:
        pool.shutdown(cancel_futures=True)
