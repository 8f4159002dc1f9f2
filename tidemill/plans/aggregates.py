"""A*, L* and U*: aggregates, top-k, paging and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import aggregates as agg
from tidemill.operators import relational as rel
from tidemill.operators import series
from tidemill.operators.ordered import exact_percentiles
from tidemill.plans import views as v
from tidemill.plans.registry import query

MONEY = "CAST(round(sum(s.revenue), 2) AS DOUBLE)"
UNITS = "CAST(sum(s.units_sold) AS BIGINT)"


def _top_sql(n: int, where: str = "true") -> str:
    """Sums of each product first; products of one name and category are one row."""
    return f"""
WITH sold AS (SELECT product_id, {UNITS} AS units, sum(s.revenue) AS money FROM sales s WHERE {where} GROUP BY product_id),
named AS (SELECT name, category, CAST(sum(units) AS BIGINT) AS total_units, CAST(round(sum(money), 2) AS DOUBLE) AS total_revenue
          FROM products JOIN sold USING (product_id) GROUP BY ALL)
SELECT * FROM named ORDER BY total_revenue DESC, name, category LIMIT {n}"""


@query("a1_top_products", _top_sql(10), "sales products")
def a1(spark, sf):
    return agg.top_products(v.sales(spark, sf), v.products(spark, sf))


@query("a2_monthly_trend", f"""
SELECT strftime(s.sale_date, '%Y-%m') AS year_month, {MONEY} AS monthly_revenue, {UNITS} AS monthly_units
FROM sales s GROUP BY 1""", "sales")
def a2(spark, sf):
    return agg.monthly_trend(v.sales(spark, sf))


@query("a3_by_store", f"""
WITH sold AS (SELECT store_id, {UNITS} AS units, sum(s.revenue) AS money FROM sales s GROUP BY store_id)
SELECT CAST(sum(units) AS BIGINT) AS total_units, CAST(round(sum(money), 2) AS DOUBLE) AS total_revenue, city, store_name
FROM stores JOIN sold USING (store_id) GROUP BY city, store_name""", "sales stores")
def a3(spark, sf):
    per_store = v.sales(spark, sf).groupBy("store_id").agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))
    return agg.units_and_revenue(per_store.join(v.stores(spark, sf), "store_id"), ["store_name", "city"])


@query("a4_seasonality", """
WITH sold AS (SELECT product_id, CAST(month(sale_date) AS INTEGER) AS month, sum(units_sold) AS u, count(*) AS n FROM sales GROUP BY ALL)
SELECT month, category, CAST(sum(u) AS BIGINT) AS total_units, round(CAST(sum(u) AS DOUBLE) / sum(n), 2) AS avg_units
FROM products JOIN sold USING (product_id) GROUP BY month, category""", "sales products")
def a4(spark, sf):
    per = v.sales(spark, sf).groupBy("product_id", F.month("sale_date").alias("month")).agg(
        F.sum("units_sold").alias("u"), F.count("*").alias("n"))
    return per.join(v.products(spark, sf), "product_id").groupBy("category", "month").agg(
        F.round(F.sum("u").cast("double") / F.sum("n"), 2).alias("avg_units"), F.sum("u").alias("total_units"))


@query("a4_seasonality_of_category", """
SELECT CAST(month(s.sale_date) AS INTEGER) AS month, round(CAST(sum(s.units_sold) AS DOUBLE) / count(*), 2) AS avg_units
FROM sales s JOIN products p ON s.product_id = p.product_id WHERE lower(p.category) = lower('BRAND#7') GROUP BY 1""", "sales products")
def a4_filtered(spark, sf):
    wanted = v.products(spark, sf).filter(rel.equals_ignoring_case("category", "BRAND#7")).select("product_id")
    return v.sales(spark, sf).join(wanted, "product_id", "left_semi").groupBy(F.month("sale_date").alias("month")).agg(
        F.round(F.avg("units_sold"), 2).alias("avg_units"))


@query("a5_kpis", f"""
SELECT {MONEY} AS total_revenue, {UNITS} AS total_units, count(DISTINCT product_id) AS n_products,
       count(DISTINCT store_id) AS n_stores, min(sale_date) AS first_day, max(sale_date) AS last_day FROM sales s""", "sales")
def a5(spark, sf):
    return agg.kpis(v.sales(spark, sf))


@query("a6_avg_daily_ticket", """
SELECT round(avg(CAST(r AS DOUBLE)), 2) AS avg_daily_revenue
FROM (SELECT sale_date, sum(revenue) AS r FROM sales GROUP BY 1)""", "sales")
def a6(spark, sf):
    days = v.sales(spark, sf).groupBy("sale_date").agg(F.sum("revenue").cast("double").alias("r"))
    return days.agg(F.round(F.avg("r"), 2).alias("avg_daily_revenue"))


@query("a7_by_category", f"""
SELECT p.category, {MONEY} AS total_revenue FROM sales s JOIN products p ON s.product_id = p.product_id GROUP BY 1""", "sales products")
def a7(spark, sf):
    per = v.sales(spark, sf).groupBy("product_id").agg(F.sum("revenue").alias("revenue"))
    return per.join(v.products(spark, sf), "product_id").groupBy("category").agg(agg.money(F.sum("revenue")).alias("total_revenue"))


@query("a8_heatmap", """
SELECT CAST(isodow(sale_date) - 1 AS INTEGER) AS dow, dayname(sale_date) AS day_name, """ + ", ".join(
    f'round(avg(units_sold) FILTER (month(sale_date) = {m}), 4) AS m{m}' for m in range(1, 13)) + """
FROM sales GROUP BY 1, 2""", "sales")
def a8(spark, sf):
    wide = agg.heatmap(v.sales(spark, sf), "sale_date", "units_sold")
    names = F.array(*[F.lit(n) for n in agg_weekdays()])
    return wide.select(
        "dow", F.element_at(names, F.col("dow") + 1).alias("day_name"),
        *[F.round(F.col(str(m)), 4).alias(f"m{m}") for m in range(1, 13)]
    ).orderBy("dow")


def agg_weekdays():
    from tidemill.fixed_values import WEEKDAY_NAMES

    return WEEKDAY_NAMES


@query("a9_discount_effect", "SELECT discount_pct, round(avg(units_sold), 4) AS avg_units FROM sales GROUP BY 1", "sales")
def a9(spark, sf):
    return v.sales(spark, sf).groupBy("discount_pct").agg(F.round(F.avg("units_sold"), 4).alias("avg_units"))


@query("a10_weekly", """
WITH w AS (SELECT store_id, product_id, CAST(sale_date + CAST((7 - isodow(sale_date)) AS INTEGER) AS DATE) AS week_end, sum(units_sold) AS u
           FROM chain_daily GROUP BY 1, 2, 3),
g AS (SELECT store_id, product_id, unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY)) AS week_end FROM w GROUP BY 1, 2)
SELECT g.store_id, g.product_id, CAST(g.week_end AS DATE) AS week_end, CAST(coalesce(w.u, 0) AS BIGINT) AS units
FROM g LEFT JOIN w ON g.store_id = w.store_id AND g.product_id = w.product_id AND CAST(g.week_end AS DATE) = w.week_end""", "chain_daily")
def a10(spark, sf):
    return agg.weekly(v.chain_daily(spark, sf), ["store_id", "product_id"], "sale_date", "units_sold")


@query("a11_user_features", """
SELECT "user", round(avg(rating), 6) AS avg_rating, round(avg(progress), 6) AS avg_progress, CAST(sum(sessions) AS BIGINT) AS total_sessions,
       round(avg(duration), 6) AS avg_duration, round(avg(completed), 6) AS completed_ratio, count(DISTINCT item) AS n_items
FROM rating_rows GROUP BY 1""", "rating_rows")
def a11(spark, sf):
    from tidemill.operators.recommend import user_features

    f = user_features(v.rating_rows(spark, sf))
    return f.select("user", *[F.round(c, 6).alias(c) for c in ("avg_rating", "avg_progress")], "total_sessions",
                    *[F.round(c, 6).alias(c) for c in ("avg_duration", "completed_ratio")], "n_items")


@query("a12_category_shares", lambda: """
SELECT "user", """ + ", ".join(f"round(count(*) FILTER (category = 'Brand#{b}') / CAST(count(*) AS DOUBLE), 6) AS share_{b}" for b in range(1, 26)) + """
FROM interactions GROUP BY 1""", "interactions")
def a12(spark, sf):
    names = [f"Brand#{b}" for b in range(1, 26)]
    out = agg.category_shares(v.interactions(spark, sf), "user", "category", names)
    return out.select("user", *[F.round(F.col(f"`share_{n}`"), 6).alias(f"share_{n[6:]}") for n in names])


@query("a13_category_stats", """
SELECT category, round(avg(rating), 4) AS avg_rating, count(*) AS n, round(avg(progress), 4) AS avg_progress
FROM interactions GROUP BY 1""", "interactions")
def a13(spark, sf):
    return v.interactions(spark, sf).groupBy("category").agg(
        F.round(F.avg("rating"), 4).alias("avg_rating"), F.count("*").alias("n"), F.round(F.avg("progress"), 4).alias("avg_progress"))


@query("a14_cluster_summary", """
WITH x AS (SELECT c.cluster, i.* FROM interactions i JOIN user_clusters c ON i."user" = c."user"),
m AS (SELECT cluster, category, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, category) AS r FROM x GROUP BY 1, 2)
SELECT x.cluster, count(DISTINCT "user") AS n_users, round(avg(rating), 2) AS avg_rating, round(avg(progress), 2) AS avg_progress,
       any_value(m.category) AS top_category
FROM x JOIN m ON x.cluster = m.cluster AND m.r = 1 GROUP BY 1""", "interactions user_clusters")
def a14(spark, sf):
    x = v.interactions(spark, sf).join(v.user_clusters(spark, sf), "user")
    top = agg.modes(x, ["cluster"], "category", "top_category")
    return x.groupBy("cluster").agg(
        F.countDistinct("user").alias("n_users"), F.round(F.avg("rating"), 2).alias("avg_rating"),
        F.round(F.avg("progress"), 2).alias("avg_progress")).join(top, "cluster")


@query("a15_cluster_profile", """
SELECT label, count(*) AS n, """ + ", ".join(f"round(avg(CAST(embedding[{i + 1}] AS DOUBLE)), 6) AS f{i}" for i in range(64)) + """
FROM embeddings GROUP BY 1""")
def a15(spark, sf):
    e = v.table(spark, sf, "embeddings")
    return e.groupBy("label").agg(
        F.count("*").alias("n"), *[F.round(F.avg(F.col("embedding")[i].cast("double")), 6).alias(f"f{i}") for i in range(64)])


@query("a16_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def a16(spark, sf):
    return agg.value_counts(v.table(spark, sf, "events"), "event_type").orderBy(F.desc("n"))


@query("a17_category_share_of_total", """
SELECT lang, count(*) AS n, round(count(*) * CAST(100.0 AS DOUBLE) / sum(count(*)) OVER (), 4) AS pct FROM documents GROUP BY 1""")
def a17(spark, sf):
    out = agg.shares(v.table(spark, sf, "documents"), ["lang"], name="pct", scale=100.0)
    return out.withColumn("pct", F.round("pct", 4))


@query("a18_rate_by_group", """
SELECT airline, is_delay, count(*) AS n, round(count(*) * CAST(100.0 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY airline), 4) AS pct
FROM flights GROUP BY 1, 2""", "flights")
def a18(spark, sf):
    out = agg.shares(v.flights(spark, sf), ["airline", "is_delay"], ["airline"], "pct", 100.0)
    return out.withColumn("pct", F.round("pct", 4))


@query("a18_rate_by_month_and_hour", """
SELECT 'month' AS dimension, CAST(month(day) AS INTEGER) AS level, round(100 * avg(is_delay), 4) AS delay_pct FROM flights GROUP BY 2
UNION ALL SELECT 'hour', CAST(dep_time // 100 AS INTEGER), round(100 * avg(is_delay), 4) FROM flights GROUP BY 2
UNION ALL SELECT 'weekday', CAST(isodow(day) AS INTEGER), round(100 * avg(is_delay), 4) FROM flights GROUP BY 2
UNION ALL SELECT 'origin', origin, round(100 * avg(is_delay), 4) FROM flights GROUP BY 2
UNION ALL SELECT 'dest', dest, round(100 * avg(is_delay), 4) FROM flights GROUP BY 2""", "flights")
def a18_dimensions(spark, sf):
    f = v.flights(spark, sf).select(
        "is_delay",
        F.expr("stack(5, 'month', month(day), 'hour', cast(floor(dep_time / 100) as int), 'weekday', weekday(day) + 1, "
               "'origin', origin, 'dest', dest) AS (dimension, level)"))
    return f.groupBy("dimension", "level").agg(F.round(F.avg("is_delay") * 100, 4).alias("delay_pct"))


@query("a19_class_balance", """
SELECT label, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM scored GROUP BY 1""", "scored")
def a19(spark, sf):
    return agg.shares(v.scored(spark, sf), ["label"]).withColumn("share", F.round("share", 6))


@query("a20_coverage", """
SELECT count(DISTINCT airline) AS n_airline, count(DISTINCT origin) AS n_origin, count(DISTINCT dest) AS n_dest,
       min(day) AS first_day, max(day) AS last_day FROM flights""", "flights")
def a20(spark, sf):
    return agg.coverage(v.flights(spark, sf), ["airline", "origin", "dest"], "day")


CORR_COLS = ["rating", "progress", "sessions", "duration", "completed"]


@query("a21_correlations", "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM rating_rows"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]), "rating_rows")
def a21(spark, sf):
    return agg.correlations(v.rating_rows(spark, sf), CORR_COLS).withColumn("corr", F.round("corr", 6))


@query("a22_percentile", """
SELECT round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.5), 6) AS median FROM events""")
def a22(spark, sf):
    events = v.table(spark, sf, "events")
    p95, median = exact_percentiles(events, "value", [0.95, 0.5])
    return events.limit(1).select(F.round(F.lit(p95), 6).alias("p95"), F.round(F.lit(median), 6).alias("median"))


@query("a23_histogram", """
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
w AS (SELECT lo, hi, (hi - lo) / 15 AS width FROM r),
b AS (SELECT least(CAST(floor((l_extendedprice - lo) / width) AS INTEGER), 14) AS bin, count(*) AS n FROM lineitem, w GROUP BY 1)
SELECT CAST(g.i AS INTEGER) AS bin, round(lo + g.i * width, 4) AS bin_start, coalesce(n, 0) AS n
FROM range(15) g(i) CROSS JOIN w LEFT JOIN b ON b.bin = g.i""")
def a23(spark, sf):
    return agg.histogram(v.table(spark, sf, "lineitem"), "l_extendedprice", 15).withColumn("bin_start", F.round("bin_start", 4))


LABELS_SQL = "SELECT lang || ', ' || source || ',' || CASE WHEN n_chars % 3 = 0 THEN ' ' ELSE lang END AS etiquetas FROM documents"


@query("a24_label_stats", f"""
SELECT trim(u) AS label, count(*) AS n FROM (SELECT unnest(string_split(etiquetas, ',')) AS u FROM ({LABELS_SQL}))
WHERE trim(u) <> '' GROUP BY 1 ORDER BY n DESC, label LIMIT 10""")
def a24(spark, sf):
    return agg.label_frequencies(_labels(spark, sf), "etiquetas")


def _labels(spark, sf):
    last = F.when(F.col("n_chars") % 3 == 0, F.lit(" ")).otherwise(F.col("lang"))
    return v.table(spark, sf, "documents").select(F.concat("lang", F.lit(", "), "source", F.lit(","), last).alias("etiquetas"))


@query("a25_system_summary", """
SELECT count(*) FILTER (temperatura > 95) AS n_anomalies, count(DISTINCT maquina_id) AS n_machines,
       count(*) FILTER (ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY) AS n_recent FROM readings""", "readings")
def a25(spark, sf):
    from tidemill.functions.dates import since

    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return v.readings(spark, sf).agg(
        F.count_if(F.col("temperatura") > 95).alias("n_anomalies"), F.countDistinct("maquina_id").alias("n_machines"),
        F.count_if(since(F.col("ts"), "14 days", as_of)).alias("n_recent"))


@query("a26_anomaly_total", """
SELECT count(*) AS total FROM readings WHERE temperatura > 95 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""", "readings")
def a26(spark, sf):
    ts = F.col("ts")
    inside = (ts >= F.lit("2024-01-05").cast("timestamp_ntz")) & (ts < F.lit("2024-01-20").cast("timestamp_ntz"))
    return v.readings(spark, sf).filter(inside & (F.col("temperatura") > 95)).agg(F.count("*").alias("total"))


@query("a27_top_documents", f"""
SELECT s.product_id, any_value(p.name) AS product_name, {MONEY} AS total_revenue FROM sales s LEFT JOIN products p ON s.product_id = p.product_id
GROUP BY 1 ORDER BY total_revenue DESC, s.product_id LIMIT 10""", "sales products")
def a27(spark, sf):
    from tidemill.sources.writers import documents

    docs = documents(v.sales(spark, sf), v.products(spark, sf))
    grouped = docs.groupBy("product_id").agg(F.max("product_name").alias("product_name"), agg.money(F.sum("revenue")).alias("total_revenue"))
    return rel.top_k(grouped, [F.desc("total_revenue"), F.col("product_id")], 10)


@query("a28_daily_mean_price", "SELECT CAST(ts AS DATE) AS day, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
def a28(spark, sf):
    out = series.daily_mean(v.table(spark, sf, "events"), F.col("ts").cast("date"), "value")
    return out.withColumn("mean_value", F.round("mean_value", 6))


@query("a29_collect_values", """
SELECT p_brand, string_agg(k, ',' ORDER BY k) AS kinds FROM (SELECT DISTINCT p_brand, p_type AS k FROM part) GROUP BY 1""")
def a29(spark, sf):
    # a list of distinct kinds is bounded by the number of kinds, whatever the number of parts
    part = v.table(spark, sf, "part").select("p_brand", "p_type").distinct()
    return part.groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_list("p_type")), ",").alias("kinds"))


@query("a30_min_max", """
WITH c AS (SELECT label, """ + ", ".join(f"avg(CAST(embedding[{i + 1}] AS DOUBLE)) AS f{i}" for i in range(64)) + """ FROM embeddings GROUP BY 1)
SELECT label, """ + ", ".join(f"round((f{i} - min(f{i}) OVER ()) / (max(f{i}) OVER () - min(f{i}) OVER () + 1e-9), 6) AS f{i}_norm" for i in range(64)) + " FROM c")
def a30(spark, sf):
    e = v.table(spark, sf, "embeddings").groupBy("label").agg(
        *[F.avg(F.col("embedding")[i].cast("double")).alias(f"f{i}") for i in range(64)])
    out = agg.min_max(e, [f"f{i}" for i in range(64)])
    return out.select("label", *[F.round(f"f{i}_norm", 6).alias(f"f{i}_norm") for i in range(64)])


@query("a31_array_stats", """
SELECT vec_id, round(list_sum(e), 5) AS total, round(list_min(e), 6) AS low, round(list_max(e), 6) AS high,
       round(list_avg(e), 6) AS mean, round(list_stddev_pop(e), 6) AS std
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)""")
def a31(spark, sf):
    from tidemill.functions import arrays

    e = arrays.as_doubles(F.col("embedding"))
    return v.table(spark, sf, "embeddings").select(
        "vec_id", F.round(arrays.total(e), 5).alias("total"), F.round(F.array_min(e), 6).alias("low"),
        F.round(F.array_max(e), 6).alias("high"), F.round(arrays.mean(e), 6).alias("mean"), F.round(arrays.std(e), 6).alias("std"))


_CELL_STATS = """round(sum(x), 4) AS total, round(min(x), 6) AS low, round(max(x), 6) AS high, round(avg(x), 5) AS mean, round(stddev_pop(x), 5) AS std"""


@query("a31_stats_of_all_cells", f"SELECT count(x) AS n, {_CELL_STATS} FROM (SELECT unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)")
def a31_all(spark, sf):
    return _rounded_stats(agg.cell_stats(v.table(spark, sf, "embeddings"), "embedding"))


@query("a31_stats_by_position", f"""
SELECT CAST(pos AS INTEGER) AS pos, count(x) AS n, {_CELL_STATS}
FROM (SELECT unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY 1""")
def a31_positions(spark, sf):
    return _rounded_stats(agg.cell_stats(v.table(spark, sf, "embeddings"), "embedding", by_position=True))


def _rounded_stats(stats):
    digits = {"total": 4, "low": 6, "high": 6, "mean": 5, "std": 5}
    return stats.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in stats.columns])


@query("a33_categories", "SELECT DISTINCT p_brand AS category FROM part")
def a33(spark, sf):
    return v.products(spark, sf).select("category").distinct().orderBy("category")


@query("a34_forecast_totals", """
WITH d AS (SELECT store_id, product_id, sum(units_sold) / CAST(count(*) AS DOUBLE) AS mean_units, max(unit_price) AS price FROM chain_daily GROUP BY 1, 2)
SELECT round(sum(mean_units * 30), 2) AS total_units, round(sum(mean_units * 30 * price), 0) AS total_revenue FROM d""", "chain_daily")
def a34(spark, sf):
    d = v.chain_daily(spark, sf).groupBy("store_id", "product_id").agg(F.avg("units_sold").alias("m"), F.max("unit_price").alias("price"))
    days = series.future_days(d, F.lit("2001-12-01").cast("date"), 30)
    return days.agg(F.round(F.sum("m"), 2).alias("total_units"), F.round(F.sum(F.col("m") * F.col("price")), 0).alias("total_revenue"))


@query("a35_metric_comparison", """
WITH m AS (SELECT label AS model, avg(abs(x)) AS mae, sqrt(avg(x * x)) AS rmse, avg(x) AS r2, max(abs(x)) AS mape
           FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings) GROUP BY 1)
SELECT model, round(1 - mae / max(mae) OVER (), 6) AS mae_inv, round(1 - rmse / max(rmse) OVER (), 6) AS rmse_inv,
       round(1 - mape / max(mape) OVER (), 6) AS mape_inv, round(greatest(CAST(0 AS DOUBLE), r2), 6) AS r2 FROM m""")
def a35(spark, sf):
    from tidemill.operators.evaluate import compare_models

    x = F.col("x")
    cells = v.table(spark, sf, "embeddings").select(F.col("label").alias("model"), F.explode(F.col("embedding").cast("array<double>")).alias("x"))
    m = cells.groupBy("model").agg(
        F.avg(F.abs(x)).alias("mae"), F.sqrt(F.avg(x * x)).alias("rmse"), F.avg(x).alias("r2"), F.max(F.abs(x)).alias("mape"))
    out = compare_models(m)
    return out.select("model", *[F.round(c, 6).alias(c) for c in ("mae_inv", "rmse_inv", "mape_inv", "r2")])


@query("a36_relative_frequency", """
SELECT source, count(*) AS n, round(count(*) * CAST(100.0 AS DOUBLE) / max(count(*)) OVER (), 4) AS relative_pct FROM documents GROUP BY 1""")
def a36(spark, sf):
    out = agg.relative_to_largest(agg.value_counts(v.table(spark, sf, "documents"), "source"))
    return out.withColumn("relative_pct", F.round("relative_pct", 4))


COUNTED = ["customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


@query("a37_table_counts", "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in COUNTED))
def a37(spark, sf):
    return agg.table_counts({t: v.table(spark, sf, t) for t in COUNTED})


# ---- top-k, limits, paging ------------------------------------------------------------------

@query("l1_top_k", f"""
SELECT s.store_id, {UNITS} AS units FROM sales s GROUP BY 1 ORDER BY units DESC, s.store_id LIMIT 10""", "sales")
def l1(spark, sf):
    per = v.sales(spark, sf).groupBy("store_id").agg(F.sum("units_sold").alias("units"))
    return rel.top_k(per, [F.desc("units"), F.col("store_id")], 10)


@query("l2_top_products_of_store", _top_sql(25, "store_id = 7"), "sales products")
def l2(spark, sf):
    return agg.top_products(v.sales(spark, sf), v.products(spark, sf), 25, store_id=7)


@query("l3_newest_rows", "SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 200")
def l3(spark, sf):
    return rel.top_k(v.table(spark, sf, "events"), [F.desc("ts"), F.desc("event_id")], 200).select("event_id", "user_id", "event_type")


@query("l4_page", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 100")
def l4(spark, sf):
    return rel.page(v.table(spark, sf, "customer").select("c_custkey", "c_name"), [F.col("c_custkey")], 50, 100)


@query("l5_recent_anomalies", "SELECT event_id, maquina_id, temperatura FROM readings WHERE temperatura > 95 ORDER BY ts DESC, event_id LIMIT 20", "readings")
def l5(spark, sf):
    hot = v.readings(spark, sf).filter(F.col("temperatura") > 95)
    return rel.top_k(hot, [F.desc("ts"), F.col("event_id")], 20).select("event_id", "maquina_id", "temperatura")


@query("l6_rows_of_machine", "SELECT event_id, temperatura FROM readings WHERE maquina_id = 'MAQ-007' ORDER BY ts DESC, event_id LIMIT 10", "readings")
def l6(spark, sf):
    rows = v.readings(spark, sf).filter(F.col("maquina_id") == "MAQ-007")
    return rel.found(rel.top_k(rows, [F.desc("ts"), F.col("event_id")], 10).select("event_id", "temperatura"), "machine MAQ-007")


@query("l7_sorted", "SELECT s_nationkey, s_suppkey, s_acctbal FROM supplier")
def l7(spark, sf):
    s = v.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return s.orderBy("s_nationkey", F.desc("s_acctbal"), "s_suppkey").select(sorted(s.columns))


@query("l8_head_and_tail", """
SELECT 'head' AS side, * FROM (SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL SELECT 'tail', * FROM (SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def l8(spark, sf):
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    head = rel.top_k(o, [F.col("o_orderkey")], 5).select(F.lit("head").alias("side"), "*")
    return head.unionByName(rel.top_k(o, [F.desc("o_orderkey")], 5).select(F.lit("tail").alias("side"), "*"))


@query("l9_newest_documents", "SELECT doc_id, source || ', ' || lang AS etiquetas FROM documents")
def l9(spark, sf):
    d = v.table(spark, sf, "documents")
    return d.select("doc_id", F.concat("source", F.lit(", "), "lang").alias("etiquetas")).orderBy(F.desc("doc_id"))


# ---- set operations -------------------------------------------------------------------------

@query("u1_union_all", """
SELECT kind, count(*) AS n FROM (SELECT 'customer' AS kind, c_nationkey AS place FROM customer
UNION ALL SELECT 'supplier', s_nationkey FROM supplier) GROUP BY 1""")
def u1(spark, sf):
    c = v.table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("place"))
    s = v.table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("place"))
    return rel.union_all([c, s]).groupBy("kind").agg(F.count("*").alias("n"))


@query("u2_extend_train", """
WITH p AS (SELECT doc_id, quality, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor(count(*) OVER () * CAST(0.7 AS DOUBLE)) AS train FROM labels)
SELECT part, count(*) AS n, CAST(sum(quality) AS BIGINT) AS positives FROM (
  SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS part, quality FROM p
  UNION ALL SELECT 'train', 1 FROM benchmark) GROUP BY 1""")
def u2(spark, sf):
    parts = rel.rank_split(v.table(spark, sf, "labels"), "doc_id", [0.7, 0.3])
    named = parts.select(F.when(F.col("part") == 0, "train").otherwise("test").alias("part"), "quality")
    extra = v.table(spark, sf, "benchmark").select(F.lit("train").alias("part"), F.lit(1).alias("quality"))
    return named.unionByName(extra).groupBy("part").agg(F.count("*").alias("n"), F.sum("quality").alias("positives"))


@query("u3_new_keys", """
SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def u3(spark, sf):
    return rel.except_keys(v.table(spark, sf, "documents").select("doc_id", "source"), v.table(spark, sf, "labels"), ["doc_id"])


@query("u4_hits", """
WITH shown AS (SELECT item FROM ratings GROUP BY 1 ORDER BY count(*) DESC, item LIMIT 5),
h AS (SELECT "user", count(DISTINCT CASE WHEN rating >= 3.5 AND item IN (SELECT item FROM shown) THEN item END) AS hits FROM ratings GROUP BY 1)
SELECT "user", hits, hits / CAST(5.0 AS DOUBLE) AS precision FROM h""", "ratings")
def u4(spark, sf):
    """The five items rated most are recommended to everybody; hits are those that a user finds relevant."""
    r = v.ratings(spark, sf)
    shown = rel.top_k(r.groupBy("item").agg(F.count("*").alias("n")), [F.desc("n"), F.col("item")], 5).select("item", F.lit(True).alias("shown"))
    marked = r.join(F.broadcast(shown), "item", "left")
    hits = F.count_distinct(F.when(F.col("shown") & (F.col("rating") >= 3.5), F.col("item")))
    return marked.groupBy("user").agg(hits.alias("hits")).withColumn("precision", F.col("hits") / 5.0)


@query("u5_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def u5(spark, sf):
    return v.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()
