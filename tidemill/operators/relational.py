"""Filters, recodes, joins and top-k used across the domains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.ordered import row_numbers
from tidemill.session import cut_lineage

MAX_LEVELS = 10_000


# ---- dimensions -----------------------------------------------------------------------------

def lookup(facts: DataFrame, dim: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Left join to a dimension; attributes of unknown keys take ``defaults``. Whether the
    dimension is broadcast follows from its size in bytes, which Spark knows or measures."""
    joined = facts.join(dim, key, "left")
    return joined.select(
        *[
            F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
            for c in joined.columns
        ]
    )


# ---- filters --------------------------------------------------------------------------------

def optional_filters(
    df: DataFrame,
    equals: Mapping[str, object] | None = None,
    date_col: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Applies only the filters that were given; bounds are inclusive. ``None`` means no filter
    (a zero is a value, not an absent one)."""
    for col, value in (equals or {}).items():
        if value is not None:
            df = df.filter(F.col(col) == value)
    if date_col and start is not None:
        df = df.filter(F.col(date_col) >= F.lit(start).cast("date"))
    if date_col and end is not None:
        df = df.filter(F.col(date_col) <= F.lit(end).cast("date"))
    return df


def equals_ignoring_case(col: str, value: str) -> Column:
    return F.lower(F.col(col)) == F.lower(F.lit(value))


def having_count(df: DataFrame, col: str, more_than: int) -> DataFrame:
    """Rows whose value of ``col`` occurs more than ``more_than`` times."""
    frequent = df.groupBy(col).agg(F.count("*").alias("__n")).filter(F.col("__n") > more_than)
    return df.join(frequent.select(col), col, "left_semi")


def coerce(df: DataFrame, types: Mapping[str, str], drop_bad: bool = True) -> DataFrame:
    """Casts that turn unreadable text into null, then drops the rows that became null."""
    out = df.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )
    return out.dropna(subset=list(types)) if drop_bad else out


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drops the columns that hold any null; one pass, one row to the driver."""
    nulls = null_counts(df).first().asDict()
    return df.drop(*[c for c, n in nulls.items() if n])


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def mask(df: DataFrame, cols: Sequence[str], keep) -> DataFrame:
    """Values for which ``keep(column)`` does not hold become null."""
    return df.select(*[F.when(keep(F.col(c)), F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- recodes --------------------------------------------------------------------------------

def recode(col: Column, mapping: Mapping[object, object], otherwise: Column | None = None) -> Column:
    """Dictionary lookup; unmapped values become ``otherwise`` (null if not given)."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.element_at(F.create_map(*pairs), col)
    return found if otherwise is None else F.coalesce(found, otherwise)


def levels(df: DataFrame, col: str, at_most: int = MAX_LEVELS) -> list:
    """The sorted distinct values of a category. Refuses columns that are no category."""
    found = [r[0] for r in df.select(col).filter(F.col(col).isNotNull()).distinct().limit(at_most + 1).collect()]
    if len(found) > at_most:
        raise ValueError(f"{col} has more than {at_most} levels; join it instead of encoding it")
    return sorted(found)


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    drop_first: bool = False,
    known: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """0/1 columns ``<col>_<level>``, in sorted level order, replacing the originals."""
    made, kept = [], [F.col(c) for c in df.columns if c not in cols]
    for c in cols:
        names = list(known[c]) if known and c in known else levels(df, c)
        for v in names[1:] if drop_first else names:
            made.append(F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}"))
    return df.select(*kept, *made)


def undo_one_hot(cols: Sequence[str], prefix: str) -> Column:
    """The level whose column is largest; the first one wins ties."""
    values = F.array(*[F.col(c).cast("double") for c in cols])
    names = F.array(*[F.lit(c[len(prefix):]) for c in cols])
    return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))


def cut(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed ranges; the first edge itself lies outside."""
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        test = (col > low) & (col <= high)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out


def clamp(col: Column, low: float | None = None, high: float | None = None) -> Column:
    if low is not None:
        col = F.greatest(col, F.lit(low))
    if high is not None:
        col = F.least(col, F.lit(high))
    return col


# ---- group values back on the rows ----------------------------------------------------------

def group_means(df: DataFrame, keys: Sequence[str], cols: Sequence[str], suffix: str = "_mean") -> DataFrame:
    """The group mean beside every row. Aggregated map-side and joined back, so that a group with a
    third of all rows is not gathered in one task (AQE splits the join)."""
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"{c}{suffix}") for c in cols])
    means = means.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[f"{c}{suffix}" for c in cols])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return df.join(means, on, "left").drop(*[f"__k_{k}" for k in keys])


def impute_by_group(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Nulls become the mean of their group."""
    filled = group_means(df, keys, cols, "__mean")
    return filled.select(
        *[F.coalesce(F.col(c), F.col(f"{c}__mean")).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


# ---- joins ----------------------------------------------------------------------------------

def expand_intervals(intervals: DataFrame, start: str, end: str, day: str) -> DataFrame:
    """One row per day of each interval, both ends included: turns an interval join into an
    equi-join that hashes on (key, day)."""
    return intervals.withColumn(day, F.explode(F.sequence(F.col(start), F.col(end))))


def interval_match(
    facts: DataFrame, intervals: DataFrame, keys: Sequence[str], day: str, start: str, end: str, rank: str
) -> DataFrame:
    """Left interval join; of several matching intervals the one with the lowest ``rank`` wins.

    Both sides meet on (keys, day), so one busy key spreads over its days; the winner is chosen among
    the intervals before the join, so the facts are never multiplied.
    """
    values = [c for c in intervals.columns if c not in (*keys, start, end)]
    per_day = (
        expand_intervals(intervals, start, end, day)
        .groupBy(*keys, day)
        .agg(F.min_by(F.struct(*values), F.col(rank)).alias("__v"))
        .select(*keys, day, *[F.col(f"__v.{v}").alias(v) for v in values])
    )
    return facts.join(per_day, [*keys, day], "left")


def with_daily(facts: DataFrame, daily: DataFrame, day: str, place: str, cols: Sequence[str], suffix: str,
               fact_place: str) -> DataFrame:
    """Left join of a daily (day, place) measure in a given role; its columns get ``suffix``."""
    role = daily.select(
        F.col(day).alias("__day"), F.col(place).alias("__place"), *[F.col(c).alias(f"{c}{suffix}") for c in cols]
    )
    on = (facts[day] == F.col("__day")) & (facts[fact_place] == F.col("__place"))
    return facts.join(role, on, "left").drop("__day", "__place")


# ---- top-k, paging, slices ------------------------------------------------------------------

def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Each task keeps its k best, the driver merges k rows per task (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """Best k rows per key. Spark prunes to k rows per key before the shuffle (window group limit)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def page(df: DataFrame, order: Sequence[Column], limit: int = 50, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def found(df: DataFrame, what: str) -> DataFrame:
    """The rows of a lookup; an error if there are none."""
    if df.isEmpty():
        raise LookupError(f"{what} not found")
    return df


def latest_by_key(df: DataFrame, keys: Sequence[str], ts: str, *ties: str) -> DataFrame:
    """The newest row per key, as an aggregate that combines map-side. Of rows of the same time the one
    with the largest ``ties`` is taken."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(ts, *ties)).alias("__r"))
        .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])
    )


def slice_rows(df: DataFrame, first: int, last: int, order: Sequence[Column], grain: Column) -> DataFrame:
    """Rows ``first``..``last`` (from 0, last excluded) in the given order."""
    numbered = row_numbers(df, [], order, grain, "__no")
    return numbered.filter((F.col("__no") > first) & (F.col("__no") <= last)).drop("__no")


# ---- set operations -------------------------------------------------------------------------

def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def except_keys(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not yet known."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


# ---- exact splits ---------------------------------------------------------------------------

def hash_order(key: Column, seed: int) -> Column:
    """A reproducible pseudo-random order: md5 of seed and key, as 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def rank_split(
    df: DataFrame, key: str, fractions: Sequence[float], strata: Sequence[str] = (), seed: int = 42,
    name: str = "part",
) -> DataFrame:
    """Adds a part number 0.. with exact sizes ``floor(n * cumulative fraction)`` per stratum.

    Rows are ranked by a hash of their key; the leading hex digits of the hash cut a stratum into even grains. Counts
    of the grains tell in which grain each cut lies. All other rows know their part by their grain alone and stay
    where they are; only the few rows of the cut grains are shuffled and ranked. The rows are worked out three times,
    so store what is costly.
    """
    h, grain = "__h", "__grain"
    uptos = [round(sum(fractions[: i + 1]), 10) for i in range(len(fractions) - 1)]
    if not uptos:
        return df.withColumn(name, F.lit(0))
    rows = df.withColumn(h, hash_order(F.col(key), seed)).withColumn(grain, F.coalesce(F.substring(h, 1, 4), F.lit("")))
    grains = rows.groupBy(*strata, grain).agg(F.count("*").alias("__n"))
    # one row per grain, never more than 16^4 a stratum
    before = Window.partitionBy(*strata).orderBy(grain).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*strata)
    totals = grains.select(*strata, grain, "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("__total"))
    ranks = [F.floor(F.col("__total") * F.lit(u)) for u in uptos]
    holds = [(F.col("__before") < r) & (r <= F.col("__before") + F.col("__n")) for r in ranks]
    cuts = cut_lineage(totals.groupBy(*[F.col(s).alias(f"__s_{s}") for s in strata]).agg(*[
        F.struct(F.max(r).alias("rank"), F.coalesce(F.max(F.when(x, F.col(grain))), F.lit("")).alias("grain"), F.max(F.when(x, F.col("__before"))).alias("before")).alias(f"__c{i}")
        for i, (r, x) in enumerate(zip(ranks, holds))
    ]))
    cut = [F.col(f"__c{i}") for i in range(len(uptos))]
    on = reduce(lambda a, b: a & b, [F.col(s).eqNullSafe(F.col(f"__s_{s}")) for s in strata], F.lit(True))
    placed = rows.join(cuts, on) if strata else rows.crossJoin(F.broadcast(cuts))
    # a rank of 0 has no grain: every row comes after it
    inside = reduce(lambda a, b: a | b, [(c["rank"] > 0) & (c["grain"] == F.col(grain)) for c in cut])
    sure = placed.filter(~inside).withColumn(name, reduce(lambda a, b: a + b, [((c["rank"] == 0) | (c["grain"] < F.col(grain))).cast("int") for c in cut]))
    start = F.coalesce(*[F.when((c["rank"] > 0) & (c["grain"] == F.col(grain)), c["before"]) for c in cut])
    rank = F.row_number().over(Window.partitionBy(*strata, grain).orderBy(h, key)) + start
    split = placed.filter(inside).withColumn("__rank", rank).withColumn(name, reduce(lambda a, b: a + b, [(F.col("__rank") > c["rank"]).cast("int") for c in cut]))
    return sure.select(*df.columns, name).unionByName(split.select(*df.columns, name))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A reproducible sample of n rows."""
    return df.orderBy(hash_order(F.col(key), seed), F.col(key)).limit(n)
