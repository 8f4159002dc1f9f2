"""Sinks: tables, files, documents, append-only-new and idempotent batch writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAVE_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def write_table(df: DataFrame, name: str, mode: str = "replace", partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Catalog table; with ``path`` its files live in a folder of the caller's choice."""
    writer = df.write.mode(SAVE_MODES[mode]).format("parquet")
    writer = writer.option("path", path) if path else writer
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Relational sink in batches of 5000 rows."""
    df.write.format("jdbc").mode(SAVE_MODES[mode]).options(url=url, dbtable=table, batchsize="5000", **options).save()


def write_results(results: Mapping[str, DataFrame], folder: str) -> None:
    """One headed CSV folder per result table, in as many files as the table has partitions, each with its header;
    written by Spark, not through the driver or one task."""
    for name, df in results.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_ml_csv(df: DataFrame, path: str, label: str) -> None:
    """Headerless training file, label first."""
    df.select(label, *[c for c in df.columns if c != label]).write.mode("overwrite").option("header", False).csv(path)


def write_batches(df: DataFrame, path: str, rows_per_file: int = 100) -> None:
    """Append in files of at most ``rows_per_file`` rows; the last, shorter file is written too."""
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)


def documents(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with product name and category (empty text if unknown) and dates as text."""
    joined = sales.join(products.select("product_id", "name", "category"), "product_id", "left")
    return joined.select(
        *[F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date" else F.col(c) for c, t in sales.dtypes],
        F.coalesce("name", F.lit("")).alias("product_name"),
        F.coalesce("category", F.lit("")).alias("category"),
    )


def export_documents(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").json(path)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, nulls as empty text."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def overwrite_as_text(df: DataFrame, path: str) -> None:
    as_text(df).write.mode("overwrite").option("header", True).csv(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Appends the rows whose key is not stored yet; of equal new keys one row is kept."""
    spark = df.sparkSession
    fresh = df.dropDuplicates(list(keys))
    if path_exists(spark, path):
        known = spark.read.schema(df.schema).parquet(path).select(*keys).distinct()
        fresh = fresh.join(known, list(keys), "left_anti")
    fresh.write.mode("append").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder and all in it; a folder that is not there is no error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ensure_table(spark: SparkSession, name: str, columns: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS, parquet, partitioned."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")


def store_single_row(df: DataFrame, path: str) -> None:
    """A table of at most one row that is replaced as a whole; more rows are an error, and nothing is stored."""
    if len(df.take(2)) > 1:
        raise ValueError("more than one row for a table of one row")
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_batch_once(df: DataFrame, path: str, batch_id: int) -> None:
    """Micro-batch sink that can be repeated: each batch owns a folder, which a retry overwrites."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
