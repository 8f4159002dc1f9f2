"""Typed scans: CSV, JSON, text formats, archives, tables and messages."""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str, header: bool = True, null: str | None = None) -> DataFrame:
    """One pass: the schema is given, never inferred. Paths may be local or object-store URLs."""
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    return (reader.option("nullValue", null) if null is not None else reader).csv(path)


def read_csv_named(spark: SparkSession, path: str, names: Sequence[str], null: str = "?") -> DataFrame:
    """Headerless CSV; all columns text, the marker ``null`` becomes null."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return read_csv(spark, path, schema, header=False, null=null)


def combine_csv(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str, cols: Sequence[str], subset: Mapping[str, Sequence]) -> DataFrame:
    """Many files as one scan, with column pruning and IN filters."""
    df = read_csv(spark, list(paths), schema).select(*cols)
    for col, values in subset.items():
        df = df.filter(F.col(col).isin(list(values)))
    return df


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


INTENTS_SCHEMA = "intents array<struct<tag:string,description:string,patterns:array<string>,responses:array<string>>>"


def read_intents(spark: SparkSession, path: str) -> DataFrame:
    """Nested intents document(s), one row per intent."""
    doc = spark.read.schema(INTENTS_SCHEMA).option("multiLine", True).json(path)
    return doc.select(F.inline("intents"))


def read_table(spark: SparkSession, name: str, date_cols: Sequence[str] = ()) -> DataFrame:
    df = spark.table(name)
    return df.select(*[F.col(c).cast("date").alias(c) if c in date_cols else F.col(c) for c in df.columns])


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, low: str, high: str, parts: int, **options: str) -> DataFrame:
    """Relational table in parallel range reads."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column, lowerBound=low, upperBound=high, numPartitions=parts, **options)
        .load()
    )


#: One cell of an ARFF row: quoted in either way, with backslashes before quotes, or plain up to the comma.
ARFF_CELL = r"""\s*('(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|[^,]*?)\s*(?:,|$)"""


def arff_cells(line: Column) -> Column:
    """The cells of a data line: without their quotes, ``?`` is null."""
    found = F.regexp_extract_all(line, F.lit(ARFF_CELL), F.lit(1))
    # after a last cell that is not empty, the end of the line matches once more
    cells = F.when(F.endswith(line, F.lit(",")), found).otherwise(F.slice(found, 1, F.size(found) - 1))
    bare = F.transform(cells, lambda c: F.regexp_replace(F.regexp_replace(c, r"""(?s)^(['"])(.*)\1$""", "$2"), r"\\(.)", "$1"))
    return F.zip_with(cells, bare, lambda c, plain: F.when(c != "?", plain))


def read_arff(spark: SparkSession, path: str | list[str], names: Sequence[str] | None = None) -> DataFrame:
    """ARFF: attribute names from the header lines of each file, one row per data line, all columns text.

    Files with other attributes, or the same in another order, are matched by name; an attribute that a file
    lacks is null in its rows. Only header lines, a few per file, reach the driver. A file without any header
    (a part of a larger one) takes that of the others if they have but one. ``?`` is null, quotes are cut, and
    a quoted comma parts no cells.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("value")).filter(F.col("value") != "")
    data = lines.filter(~F.col("value").startswith("@") & ~F.col("value").startswith("%")).select("file", arff_cells(F.col("value")).alias("cells"))
    if names is not None:
        return data.select(*[F.get("cells", i).alias(n) for i, n in enumerate(names)])
    marked = lines.filter(F.lower("value").startswith("@attribute")).withColumn("place", F.monotonically_increasing_id())
    heads: dict[str, list[str]] = {}
    for r in sorted(marked.collect(), key=lambda r: (r.file, r.place)):
        name = re.match(r"""@attribute\s+(?:'([^']*)'|"([^"]*)"|(\S+))""", r.value, re.IGNORECASE)
        heads.setdefault(r.file, []).append(next(g for g in name.groups() if g is not None))
    kinds = list(dict.fromkeys(map(tuple, heads.values())))
    if not kinds:
        raise ValueError(f"no @attribute line in {path}")
    if len(kinds) == 1:
        return data.select(*[F.get("cells", i).alias(n) for i, n in enumerate(kinds[0])])
    owners = spark.createDataFrame([(f, kinds.index(tuple(h))) for f, h in heads.items()], "file string, kind int")
    rows = data.join(owners, "file")
    every = list(dict.fromkeys(n for k in kinds for n in k))
    place = [F.coalesce(*[F.when(F.col("kind") == k, F.get("cells", kind.index(n))) for k, kind in enumerate(kinds) if n in kind]) for n in every]
    return rows.select(*[c.alias(n) for c, n in zip(place, every)])


ZIP_SCHEMA = "archive string, member string, cells array<string>, error string"


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _records(archive: zipfile.ZipFile, encoding: str) -> Iterator[tuple[str, list[str]]]:
    """Records of the CSV members after the first one of each, the header."""
    for member in archive.namelist():
        if member.lower().endswith(".csv"):
            with io.TextIOWrapper(archive.open(member), encoding, newline="") as text:
                for i, cells in enumerate(csv.reader(text, strict=True)):
                    if i and cells:
                        yield member, cells


def zipped_records(files: DataFrame, encoding: str = "utf-8", rows_at_once: int = 10_000) -> DataFrame:
    """Records of the CSV members of zip archives (path, content): quoted commas and line breaks stay in their
    cell, and the first record of a member is its header, wherever equal lines may follow. A bad archive gives
    one row with its error and none of its records.

    Archives are unpacked in parallel, one at a time per task. A member is read twice as a stream, first to
    the end to see that it is sound, then to pass its records on, so no member is held as a whole; the packed
    archive itself is one value (at most 2 GB).
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "member", "cells", "error"]
        kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content.as_buffer()))
                    for _ in _records(archive, encoding):
                        pass
                except (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, UnicodeDecodeError, csv.Error, NotImplementedError) as e:
                    yield batch_of([(path.as_py(), None, None, f"{type(e).__name__}: {e}")])
                    continue
                rows = []
                for member, cells in _records(archive, encoding):
                    rows.append((path.as_py(), member, cells, None))
                    if len(rows) == rows_at_once:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return files.select("path", "content").mapInArrow(unpack, ZIP_SCHEMA)


def zipped_csv(files: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows of all good members, and the table of bad archives. Cells go to columns by place; empty,
    missing and unreadable ones are null."""
    records = zipped_records(files)
    fields = T.StructType.fromDDL(schema).fields
    cells = [F.nullif(F.get("cells", i), F.lit("")).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    return records.filter("error IS NULL").select("member", *cells), records.filter("error IS NOT NULL").select("archive", "error")


def parse_messages(raw: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """JSON messages to columns; works on tables and on streams."""
    return raw.select(F.from_json(F.col(value).cast("string"), schema).alias("m")).select("m.*")


def read_kafka(spark: SparkSession, servers: str, topic: str, schema: str) -> DataFrame:
    """Keyed message stream, from the latest offsets; the key keeps the order per machine."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .load()
    )
    return raw.select(F.col("key").cast("string").alias("key"), F.from_json(F.col("value").cast("string"), schema).alias("m")).select("key", "m.*")


