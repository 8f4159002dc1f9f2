"""Row numbers, running totals and row-frame windows that do not put a whole key in one task.

A plain window sorts every row of a key in one task. Here each key is cut along its order into
grains, small per-grain totals carry the offsets, and only the rows of one grain (or of one chunk
of row numbers) meet in a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import task_count

GRAIN = "__grain"
#: Accuracy of approximate quantiles, and distinct values that a bracket around a rank may hold at the end.
ACCURACY, BRACKET_VALUES = 10_000, 20_000


def with_quantile_grain(df: DataFrame, col: str, grains: int | None = None) -> DataFrame:
    """Adds a grain that cuts a numeric column into about equally many rows each.

    The edges are approximate; the grain only has to be monotone in ``col``.
    """
    n = grains or task_count(df.sparkSession)
    probs = [i / n for i in range(1, n)]
    edges = sorted(set(df.approxQuantile(col, probs, 1.0 / (4 * n)))) if probs else []
    cut = Bucketizer(
        splits=[float("-inf"), *edges, float("inf")], inputCol="__x", outputCol=GRAIN, handleInvalid="keep"
    )
    return cut.transform(df.withColumn("__x", F.col(col).cast("double"))).drop("__x")


def id_grain(df: DataFrame, col: str, width: int = 65_536) -> Column:
    """A grain along the order of an id: ranges of a number, or the leading characters of a text, all
    but the last three of the longest one."""
    kind = df.schema[col].dataType.simpleString()
    if kind == "string":
        longest = df.agg(F.max(F.length(col))).first()[0] or 0
        return F.substring(col, 1, max(longest - 3, 1))
    return F.floor(F.col(col).cast("double") / width)


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], totals: dict[str, Column], grain: Column
) -> DataFrame:
    """Adds inclusive running sums per key along ``order``.

    ``grain`` must not decrease along ``order``. Rows of one (key, grain) share a task; the offsets
    come from a table of one row per (key, grain), summed map-side first.
    """
    rows = df.withColumn(GRAIN, grain)
    group = [*keys, GRAIN]
    per_grain = rows.groupBy(*group).agg(*[F.sum(e).alias(f"__t_{n}") for n, e in totals.items()])
    before = Window.partitionBy(*keys).orderBy(GRAIN).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_grain.select(
        *group, *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in totals]
    )
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    offsets = offsets.select(*[F.col(c).alias(f"__k_{c}") for c in group], *[f"__o_{n}" for n in totals])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in group])
    joined = rows.join(offsets, on, "left")
    return joined.select(
        *df.columns, *[(F.sum(e).over(inside) + F.col(f"__o_{n}")).alias(n) for n, e in totals.items()]
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], grain: Column, name: str = "row_no"
) -> DataFrame:
    """``row_number`` per key, exact, for keys of any size."""
    return running_totals(df, keys, order, {name: F.lit(1).cast("bigint")}, grain)


def framed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    grain: Column,
    build: Callable[[Window], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    chunk: int = 100_000,
) -> DataFrame:
    """Window columns whose frames reach at most ``before`` rows back and ``after`` rows ahead.

    Rows are numbered, cut into chunks of ``chunk`` rows, and the few rows near a border are lent to
    the neighbouring chunk, so a task never holds more than ``chunk + before + after`` rows of a key.
    """
    pos = F.col("__no") - 1
    lent = F.sequence(
        F.floor(F.greatest(pos - after, F.lit(0)) / chunk), F.floor((pos + before) / chunk)
    )
    rows = (
        row_numbers(df, keys, order, grain, "__no")
        .withColumn("__home", F.floor(pos / chunk))
        .withColumn("__chunk", F.explode(lent))
    )
    window = Window.partitionBy(*keys, "__chunk").orderBy("__no")
    made = build(window)
    return (
        rows.select("*", *[c.alias(n) for n, c in made.items()])
        .filter(F.col("__home") == F.col("__chunk"))
        .select(*df.columns, *made)
    )


def exact_percentiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float]:
    """As :func:`exact_percentiles_of`, for one column."""
    return exact_percentiles_of(df, [col], probs)[col]


def exact_percentiles_of(df: DataFrame, cols: Sequence[str], probs: Sequence[float], values: int = BRACKET_VALUES) -> dict[str, list[float]]:
    """Percentiles with linear interpolation, exact, of all columns together; null and NaN are no values, and
    a column without any has null percentiles.

    Each rank is pinned in a bracket of two values. One scan gives approximate quantiles a little below and
    above every rank, the next counts what lies below and inside the brackets, and as soon as no bracket holds
    more than about ``values`` distinct values, a last scan counts these. Wider brackets are narrowed in the
    same way, by approximate quantiles of what they hold; each turn leaves a few ten thousandths of the rows.
    So the scans do not depend on the number of columns, and bounded counts are all that leaves the rows.
    """
    # null beside NaN: what is neither below nor inside any bracket
    data = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    near = 3.0 / ACCURACY
    first = data.agg(*[
        F.struct(F.count(f"c{i}").alias("n"), F.percentile_approx(f"c{i}", _around(probs, near), F.lit(ACCURACY)).alias("q")).alias(f"c{i}")
        for i in range(len(cols))
    ]).first()
    totals = [first[i]["n"] for i in range(len(cols))]
    ranks, brackets = {}, {}
    for i, total in enumerate(totals):
        for j, p in enumerate(probs):
            if total:
                h = (total - 1) * p
                ranks[i, j] = (int(h) + 1, min(int(h) + 2, total), h - int(h))
                brackets[i, j] = (first[i]["q"][2 * j], first[i]["q"][2 * j + 1])
    found = _pinned(data, totals, ranks, brackets, near, values) if ranks else {}
    return {c: [found.get((i, j)) for j in range(len(probs))] for i, c in enumerate(cols)}


def _around(probs: Sequence[float], near: float) -> list[float]:
    return [min(max(p + side, 0.0), 1.0) for p in probs for side in (-near, near)]


def _pinned(data: DataFrame, totals: list[int], ranks: dict, brackets: dict, near: float, values: int) -> dict:
    """The interpolated values of the ranks, from brackets that are first checked and narrowed."""
    below, last, targets = {}, {}, list(ranks)
    open_ = list(targets)
    while open_:
        counts = data.agg(*[
            F.struct(
                F.count_if(F.col(f"c{i}") < brackets[i, j][0]).alias("below"), F.count_if(_inside(i, brackets[i, j])).alias("inside"),
                F.approx_count_distinct(F.when(_inside(i, brackets[i, j]), F.col(f"c{i}"))).alias("distinct"),
            ).alias(f"t{k}")
            for k, (i, j) in enumerate(open_)
        ]).first()
        wide = []
        for k, t in enumerate(open_):
            below[t] = counts[k]["below"]
            low, high, _ = ranks[t]
            missed = not below[t] < low <= high <= below[t] + counts[k]["inside"]
            if missed:  # approximate quantiles err within their accuracy; should they not, take the whole range
                brackets[t] = (float("-inf"), float("inf"))
            if missed:
                wide.append((t, 0, totals[t[0]]))
            elif counts[k]["distinct"] > values and counts[k]["inside"] < last.get(t, math.inf) / 2:
                last[t] = counts[k]["inside"]
                wide.append((t, below[t], counts[k]["inside"]))
        todo = [(t, under, inside) for t, under, inside in wide if inside > values]
        if todo:
            narrowed = data.agg(*[
                F.percentile_approx(
                    F.when(_inside(t[0], brackets[t]), F.col(f"c{t[0]}")), _around([(ranks[t][0] - under) / inside], near + 2 / inside), F.lit(ACCURACY)
                ).alias(f"q{k}")
                for k, (t, under, inside) in enumerate(todo)
            ]).first()
            for k, (t, *_) in enumerate(todo):
                brackets[t] = tuple(narrowed[k])
        open_ = [t for t, *_ in wide]
    picked = F.array(*[
        F.when(_inside(i, brackets[i, j]), F.struct(F.lit(k).alias("t"), F.col(f"c{i}").alias("v"))) for k, (i, j) in enumerate(targets)
    ])
    held = data.select(F.explode(F.filter(picked, lambda x: x.isNotNull())).alias("x")).groupBy("x.t", "x.v").agg(F.count("*").alias("n"))
    rows = sorted(held.collect())
    out = {}
    for k, t in enumerate(targets):
        upto, ends = below[t], {}
        for _, v, n in (r for r in rows if r[0] == k):
            for end in (0, 1):
                if upto < ranks[t][end] <= upto + n:
                    ends[end] = v
            upto += n
        low, high, share = ends[0], ends[1], ranks[t][2]
        out[t] = low if low == high else low + share * (high - low)
    return out


def _inside(i: int, bracket: tuple[float, float]) -> Column:
    return F.col(f"c{i}").between(*bracket)
