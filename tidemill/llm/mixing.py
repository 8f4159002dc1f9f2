"""Mixing sources to target weights: complete epochs, then weighted sampling without replacement.

Each document draws an exponential key divided by its quality weight (Efraimidis and Spirakis); within
its source, documents are taken in the order of their keys until the prefix sum of their sizes meets what
is left of the source's budget after complete epochs.

DataFrame functions only. The prefix sum has two levels, so that no task holds a source: keys are cut into
``SLICES`` ranges of about equal weight, sums of ranges give the offsets, and rows are summed up within a
range. Only the list of sources is ordered as a whole, one row each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.llm.common import WORD, free_names, numbered, quoted, settled, text_or_empty
from tidemill.session import stored

#: A source's words are taken at most so many times.
MOST_EPOCHS = 3
SLICES = 1024
SEED = "mix"


def words(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def letter_share(text: Column) -> Column:
    """A quality weight from 0.5 (no letters) to 1.5 (nothing but letters); 0.5 for empty texts."""
    letters = F.length(F.regexp_replace(text_or_empty(text), r"[^\p{L}]+", ""))
    return F.lit(0.5) + F.coalesce(letters / F.nullif(F.length(text_or_empty(text)), F.lit(0)), F.lit(0.0))


def in_turn(rank: Column) -> Column:
    """Weights 1, 2, 3, 1, 2, 3, ... in the order of the sources."""
    return (rank - 1) % 3 + 1


def targets(sources: DataFrame, weight: Callable[[Column], Column] = in_turn, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Adds ``no`` (1 for the first source by code point, null last), ``weight`` and ``target`` to one row
    for each source with its ``source_size``.

    The sources share the sum of all sizes by weight; none gets more than ``most_epochs`` times its size,
    and the excess is shared again until none is above. That ends at one water level: sorted by size per
    weight, the first sources are full, and all others get the level times their weight.
    """
    cap = (F.col("source_size") * most_epochs).alias("cap")
    ranked = sources.withColumn("no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("weight", weight(F.col("no")).cast("double")).withColumn("cap", cap)
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = W.orderBy("ratio", "no")
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / F.sum("weight").over(rest),
    )
    level = level.withColumn("at", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "no", "level"))).over(everything))
    full = F.struct("ratio", "no") < F.struct(F.col("at.ratio"), F.col("at.no"))
    return level.select(
        "source", "source_size", "mean_weight", "no", "weight",
        F.when(full, F.col("cap").cast("double")).otherwise(F.least(F.col("at.level") * F.col("weight"), F.col("cap").cast("double"))).alias("target"),
    )


def mixed(
    docs: DataFrame,
    size: Callable[[Column], Column] = words,
    quality: Callable[[Column], Column] = letter_share,
    weight: Callable[[Column], Column] = in_turn,
    most_epochs: int = MOST_EPOCHS,
    seed: str = SEED,
    slices: int = SLICES,
) -> DataFrame:
    """One row for each row of ``docs``: ``rid, doc_id, size, source_size, target, copies, taken``.

    ``copies`` is how often the mix holds the document, ``taken`` its size times that. Null texts have
    size 0; null sources are one source, the last; qualities that are null or not above 0 count as 1e-9.
    The draw depends on ``seed`` and ``doc_id`` alone, so reruns agree; rows with equal ``doc_id`` follow
    each other by size and place. The last document is taken if that comes nearer to the target.
    """
    draw = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    rows = stored(
        numbered(docs.select("doc_id", "source", "text")).select(
            "rid", "doc_id", "source", size(F.col("text")).alias("size"), F.greatest(F.coalesce(quality(F.col("text")), F.lit(0.0)), F.lit(1e-9)).alias("quality"), draw.alias("draw")
        ),
        "sizes",
    )
    plan = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.avg("quality").alias("mean_weight")), weight, most_epochs), "targets")
    key = -F.log("draw") / F.col("quality")
    keyed = rows.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).select(
        "rid", "doc_id", "size", "source_size", "target", "no", key.alias("key"),
        F.floor(slices * (1 - F.exp(-key * F.col("mean_weight")))).alias("slice"),
    )
    sums = keyed.groupBy("no", "slice").agg(F.sum("size").alias("total"))
    offsets = sums.select("no", "slice", F.coalesce(F.sum("total").over(W.partitionBy("no").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    through = F.sum("size").over(W.partitionBy("no", "slice").orderBy("key", "doc_id", "size", "rid").rowsBetween(W.unboundedPreceding, W.currentRow))
    epochs = F.coalesce(F.least(F.lit(most_epochs), F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))), F.lit(0))
    placed = keyed.join(offsets, ["no", "slice"]).withColumn("through", through + F.col("offset")).withColumn("epochs", epochs)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    taken_once_more = (2 * F.col("through") - F.col("size") <= 2 * rest) & (F.col("epochs") < most_epochs) & (F.col("size") > 0)
    return placed.withColumn("copies", F.col("epochs") + taken_once_more.cast("long")).select(
        "rid", "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, repeated as often as they are taken."""
    docs = settled(docs)
    rid, copies, copy = free_names(docs, "rid", "copies", "copy")
    taken = mixed(docs, **options).where("copies > 0").select(F.col("rid").alias(rid), F.col("copies").cast("int").alias(copies))
    repeated = numbered(docs, rid).join(taken, rid).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.select(*map(quoted, docs.columns))
