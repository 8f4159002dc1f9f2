"""Business aggregates: KPIs, shares, pivots, profiles, histograms and calendar resampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.dates import week_end, year_month
from tidemill.operators.ordered import exact_percentiles_of
from tidemill.operators.relational import levels


def money(total: Column) -> Column:
    """An exact decimal sum, rounded half up to cents."""
    return F.round(total, 2).cast("double")


def units_and_revenue(sales: DataFrame, keys: Sequence, units: str = "total_units", revenue: str = "total_revenue") -> DataFrame:
    """Sums of units and revenue per key, combined map-side. ``revenue`` is a decimal, so the sum does
    not depend on how the rows were partitioned."""
    return sales.groupBy(*keys).agg(
        F.sum("units_sold").alias(units), money(F.sum("revenue")).alias(revenue)
    )


def top_products(sales: DataFrame, products: DataFrame, n: int = 10, store_id=None) -> DataFrame:
    """Products by revenue. Sums run per product before the join, which then sees one row each."""
    rows = sales if store_id is None else sales.filter(F.col("store_id") == store_id)
    per_product = rows.groupBy("product_id").agg(
        F.sum("units_sold").alias("u"), F.sum("revenue").alias("r")
    )
    named = per_product.join(products.select("product_id", "name", "category"), "product_id")
    return (
        named.groupBy("name", "category")
        .agg(F.sum("u").alias("total_units"), money(F.sum("r")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "name", "category")
        .limit(n)
    )


def monthly_trend(sales: DataFrame) -> DataFrame:
    return units_and_revenue(
        sales, [year_month(F.col("sale_date")).alias("year_month")], "monthly_units", "monthly_revenue"
    )


def kpis(sales: DataFrame) -> DataFrame:
    return sales.agg(
        money(F.sum("revenue")).alias("total_revenue"),
        F.sum("units_sold").alias("total_units"),
        F.countDistinct("product_id").alias("n_products"),
        F.countDistinct("store_id").alias("n_stores"),
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
    )


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias(name))


def shares(df: DataFrame, keys: Sequence[str], within: Sequence[str] = (), name: str = "share", scale: float = 1.0) -> DataFrame:
    """Counts per key as a share of the total, or of the total within ``within``. The window runs over
    the counts, not over the rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*within))
    return counts.withColumn(name, F.col("n") / total * F.lit(scale))


def relative_to_largest(counts: DataFrame, n: str = "n", name: str = "relative_pct") -> DataFrame:
    largest = counts.agg(F.max(n)).scalar()
    return counts.withColumn(name, F.col(n) / largest * 100.0)


def weekly(df: DataFrame, keys: Sequence[str], day: str, value: str, name: str = "units", horizon_keys: bool = True) -> DataFrame:
    """Sums per calendar week ending on Sunday; weeks without rows are 0.

    The gap fill starts from one row per key (first and last week), so it is never larger than
    keys x weeks.
    """
    sums = df.groupBy(*keys, week_end(F.col(day)).alias("week_end")).agg(F.sum(value).alias(name))
    spans = sums.groupBy(*keys).agg(F.min("week_end").alias("a"), F.max("week_end").alias("b"))
    grid = spans.select(
        *keys, F.explode(F.expr("sequence(a, b, interval 7 days)")).alias("week_end")
    )
    return grid.join(sums, [*keys, "week_end"], "left").fillna({name: 0})


def heatmap(df: DataFrame, day: str, value: str) -> DataFrame:
    """Mean value by weekday (Monday is 0) and month, one column per month."""
    return (
        df.groupBy(F.weekday(day).alias("dow"))
        .pivot("month", list(range(1, 13)))
        .agg(F.avg(value))
        if "month" in df.columns
        else heatmap(df.withColumn("month", F.month(day)), day, value)
    )


def category_shares(df: DataFrame, key: str, category: str, names: Sequence | None = None) -> DataFrame:
    """Per key the share of each category among its rows, one column per category, 0 if absent."""
    names = list(names) if names is not None else levels(df, category)
    # one pass with a counter per category: no second grouping by (key, category) as in a pivot
    counts = df.groupBy(key).agg(*[F.count_if(F.col(category) == n).alias(f"{n}") for n in names])
    total = sum((F.col(f"`{n}`") for n in names), F.lit(0))
    safe = F.when(total == 0, F.lit(1)).otherwise(total)
    return counts.select(key, *[(F.col(f"`{n}`") / safe).alias(f"share_{n}") for n in names])


def modes(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """The most frequent value per key; ties go to the smallest value."""
    counts = df.groupBy(*keys, col).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.min_by(F.col(col), F.struct(-F.col("n"), F.col(col))).alias(name))


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass over the rows."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    stacked = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a, b in pairs)
    return row.select(F.expr(f"stack({len(pairs)}, {stacked}) AS (col_a, col_b, corr)"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over the value range, the last one closed; empty bins count 0."""
    x = F.col(col).cast("double")
    low, high = df.agg(F.min(x), F.max(x)).first()
    width = (high - low) / bins if high > low else 1.0 / bins
    bin_no = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        grid.join(counts, "bin", "left")
        .fillna({"n": 0})
        .select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"), "n")
    )


def label_frequencies(df: DataFrame, col: str, top: int | None = 10) -> DataFrame:
    """Counts of the labels in comma-separated lists; blanks are dropped."""
    parts = F.transform(F.split(F.col(col), ","), lambda x: F.trim(x))
    counts = df.select(F.explode(parts).alias("label")).filter(F.col("label") != "").groupBy("label").agg(F.count("*").alias("n"))
    return counts if top is None else counts.orderBy(F.desc("n"), "label").limit(top)


def min_max(df: DataFrame, cols: Sequence[str], eps: float = 1e-9) -> DataFrame:
    """Scales columns to 0..1 over all rows; meant for small result tables, reads them twice. The ends of
    all columns are one row, which is broadcast."""
    ends = df.agg(F.array(*[F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")) for c in cols]).alias("__ends"))
    out = df.join(F.broadcast(ends), how="cross")
    scaled = {
        f"{c}_norm": (F.col(c) - F.col("__ends")[i]["low"]) / (F.col("__ends")[i]["high"] - F.col("__ends")[i]["low"] + F.lit(eps))
        for i, c in enumerate(cols)
    }
    return out.withColumns(scaled).drop("__ends")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    from tidemill.operators.relational import union_all

    return union_all(
        [t.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, t in tables.items()]
    )


def coverage(df: DataFrame, cols: Sequence[str], day: str) -> DataFrame:
    """Distinct values per column and the date range."""
    return df.agg(
        *[F.countDistinct(c).alias(f"n_{c}") for c in cols], F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


def cell_stats(df: DataFrame, array: str, by_position: bool = False) -> DataFrame:
    """Count, sum, minimum, maximum, mean and population deviation over all cells of an array column,
    or over the cells of each position ``pos`` (from 0). Cells are summed before the shuffle."""
    cells = df.select(F.posexplode(F.col(array).cast("array<double>")).alias("pos", "x"))
    return cells.groupBy(*(["pos"] if by_position else [])).agg(
        F.count("x").alias("n"), F.sum("x").alias("total"), F.min("x").alias("low"), F.max("x").alias("high"),
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"),
    )


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of the frame and, per column, its type, count, mean, sample deviation, minimum, exact quartiles
    and maximum. Quartiles of all columns take three scans, the rest one."""
    types = dict(df.dtypes)

    def stats(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.count("*").alias("rows"), F.count(c).alias("n"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        )

    quartiles = df.sparkSession.createDataFrame(
        [(c, *found) for c, found in exact_percentiles_of(df, cols, [0.25, 0.5, 0.75]).items()], "column string, q1 double, median double, q3 double"
    )
    listed = df.agg(F.array(*[stats(c) for c in cols]).alias("s")).select(F.inline("s"))
    return listed.join(F.broadcast(quartiles), "column").select(
        "column", "type", "rows", "n", "mean", "std", "min", "q1", "median", "q3", "max"
    )
