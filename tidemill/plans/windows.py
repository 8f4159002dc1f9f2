"""W*: lags, rolling and trailing means, rankings, running totals and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import evaluate, ordered, recommend, series
from tidemill.operators import relational as rel
from tidemill.operators.dialogue import session_history
from tidemill.plans import views as v
from tidemill.plans.registry import query
from tidemill.session import cut_lineage

SERIES = "PARTITION BY store_id, product_id ORDER BY sale_date"


@query("w1_rolling_mean_by_discount", f"""
WITH r AS (SELECT discount_pct, avg(units_sold) OVER ({SERIES} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m FROM chain_daily)
SELECT discount_pct, round(avg(m), 4) AS avg_rolling_units, count(*) AS n FROM r GROUP BY 1""", "chain_daily")
def w1(spark, sf):
    out = series.rolling_mean(v.chain_daily(spark, sf), ["store_id", "product_id"], "sale_date", "units_sold", -3, 3, "m")
    return out.groupBy("discount_pct").agg(F.round(F.avg("m"), 4).alias("avg_rolling_units"), F.count("*").alias("n"))


@query("w1_rolling_mean_of_events", """
SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 4) AS m FROM events""")
def w1_events(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = ordered.framed(
        e, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("ts").cast("date"),
        lambda w: {"m": F.avg("value").over(w.rowsBetween(-3, 3))}, 3, 3)
    return out.select("event_id", F.round("m", 4).alias("m"))


@query("w2_lags", f"""
SELECT store_id, product_id, sale_date, lag(units_sold, 7) OVER ({SERIES}) AS lag_7, lag(units_sold, 14) OVER ({SERIES}) AS lag_14,
       lag(units_sold, 30) OVER ({SERIES}) AS lag_30 FROM chain_daily""", "chain_daily")
def w2(spark, sf):
    w = series.series_window(["store_id", "product_id"], "sale_date")
    cols = series.lag_columns(w, "units_sold", [7, 14, 30])
    return v.chain_daily(spark, sf).select("store_id", "product_id", "sale_date", *[c.alias(n) for n, c in cols.items()])


@query("w3_trailing_means", f"""
SELECT store_id, product_id, sale_date,
       CASE WHEN count(units_sold) OVER ({SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7 THEN round(avg(units_sold) OVER ({SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 4) END AS roll_7,
       CASE WHEN count(units_sold) OVER ({SERIES} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) = 30 THEN round(avg(units_sold) OVER ({SERIES} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 4) END AS roll_30
FROM chain_daily""", "chain_daily")
def w3(spark, sf):
    w = series.series_window(["store_id", "product_id"], "sale_date")
    cols = series.trailing_columns(w, "units_sold", [7, 30])
    return v.chain_daily(spark, sf).select("store_id", "product_id", "sale_date", *[F.round(c, 4).alias(n) for n, c in cols.items()])


@query("w4_latest_by_key", """
SELECT maquina_id, event_id, temperatura FROM (SELECT *, row_number() OVER (PARTITION BY maquina_id ORDER BY ts DESC, event_id DESC) AS r FROM readings) WHERE r = 1""", "readings")
def w4(spark, sf):
    return rel.latest_by_key(v.readings(spark, sf).select("maquina_id", "event_id", "temperatura", "ts"), ["maquina_id"], "ts", "event_id").select(
        "maquina_id", "event_id", "temperatura")


NEAR_SQL = """
m AS (SELECT "user", avg(rating) AS mean FROM ratings GROUP BY 1),
c AS (SELECT r."user", r.item, r.rating - m.mean AS dev FROM ratings r JOIN m ON r."user" = m."user"),
n AS (SELECT "user", sqrt(sum(dev * dev)) AS norm FROM c GROUP BY 1),
sims AS (SELECT a."user" AS u, b."user" AS v, round(sum(a.dev / na.norm * (b.dev / nb.norm)), 9) AS sim
         FROM c a JOIN c b ON a.item = b.item AND a."user" <> b."user" JOIN n na ON a."user" = na."user" AND na.norm > 0
         JOIN n nb ON b."user" = nb."user" AND nb.norm > 0 GROUP BY 1, 2),
near AS (SELECT u, v, sim, rank FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS rank FROM sims WHERE sim >= 0.05) WHERE rank <= 30)"""


@query("w5_top_neighbours", f"WITH {NEAR_SQL} SELECT u, v, round(sim, 6) AS sim, rank FROM near", "ratings")
def w5(spark, sf):
    return recommend.neighbours(cut_lineage(v.ratings(spark, sf)), k=30).withColumn("sim", F.round("sim", 6))


@query("w6_top_items", """
SELECT "user", item, rank FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS rank FROM ratings) WHERE rank <= 5""", "ratings")
def w6(spark, sf):
    return rel.top_k_per_key(v.ratings(spark, sf), ["user"], [F.desc("rating"), F.col("item")], 5).select("user", "item", "rank")


@query("w7_day_index", """
SELECT day, row_number() OVER (ORDER BY day) - 1 AS day_no, round(m, 6) AS mean_value FROM (SELECT CAST(ts AS DATE) AS day, avg(value) AS m FROM events GROUP BY 1)""")
def w7(spark, sf):
    daily = series.daily_mean(v.table(spark, sf, "events"), F.col("ts").cast("date"), "value")
    return series.with_day_index(daily).withColumn("mean_value", F.round("mean_value", 6))


@query("w8_last_value", """
SELECT maquina_id, temperatura AS current FROM (SELECT *, row_number() OVER (PARTITION BY maquina_id ORDER BY ts DESC, event_id DESC) AS r FROM readings) WHERE r = 1""", "readings")
def w8(spark, sf):
    return v.readings(spark, sf).groupBy("maquina_id").agg(F.max_by("temperatura", F.struct("ts", "event_id")).alias("current"))


@query("w9_cumulative_sum", """
SELECT event_id, round(sum(CAST(value AS DECIMAL(18,4))) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS total FROM events""")
def w9(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", "ts", F.col("value").cast("decimal(18,4)").alias("value"))
    out = ordered.running_totals(e, [], [F.col("ts"), F.col("event_id")], {"total": F.col("value")}, F.col("ts").cast("date"))
    return out.select("event_id", F.round("total", 2).alias("total"))


@query("w9_cumulative_sum_by_key", """
SELECT event_id, sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS total,
       row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events""")
def w9_keyed(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", "event_type", "ts", F.col("value").cast("decimal(18,2)").alias("value"))
    out = ordered.running_totals(
        e, ["event_type"], [F.col("ts"), F.col("event_id")], {"total": F.col("value"), "n": F.lit(1).cast("bigint")}, F.col("ts").cast("date"))
    return out.select("event_id", "total", "n")


@query("w10_roc_points", """
WITH g AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS f FROM scored GROUP BY 1)
SELECT score AS threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(f) OVER w AS BIGINT) AS fp,
       round(CAST(sum(p) OVER w AS DOUBLE) / sum(p) OVER (), 6) AS tpr, round(CAST(sum(f) OVER w AS DOUBLE) / sum(f) OVER (), 6) AS fpr
FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""", "scored")
def w10(spark, sf):
    out = evaluate.roc_points(v.scored(spark, sf), "label", "score")
    return out.select("threshold", "tp", "fp", F.round("tpr", 6).alias("tpr"), F.round("fpr", 6).alias("fpr"))


SPLIT_SQL = """
ranked AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY quality) AS n FROM labels),
parts AS (SELECT doc_id, quality, CASE WHEN r <= floor(n * CAST(0.8 AS DOUBLE)) THEN 0 WHEN r <= floor(n * CAST(0.9 AS DOUBLE)) THEN 1 ELSE 2 END AS part FROM ranked)"""


@query("w11_stratified_split", f"WITH {SPLIT_SQL} SELECT doc_id, quality, part FROM parts")
def w11(spark, sf):
    return rel.rank_split(v.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", [0.8, 0.1, 0.1], ["quality"])


HOLDOUT_SQL = """
rel AS (SELECT "user", item, count(*) OVER (PARTITION BY "user") AS n,
               row_number() OVER (PARTITION BY "user" ORDER BY md5('42:' || "user" || '/' || item), item) AS r FROM ratings WHERE rating >= 3.5),
held AS (SELECT "user", item FROM rel WHERE n >= 4 AND r <= greatest(1, least(5, floor(n * CAST(0.25 AS DOUBLE)))))"""


@query("w12_holdout", f'WITH {HOLDOUT_SQL} SELECT "user", item FROM held', "ratings")
def w12(spark, sf):
    return recommend.holdout(v.ratings(spark, sf))


@query("w13_history", """
SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn_no, count(*) OVER (PARTITION BY conv_id) AS turn_count FROM conversations""")
def w13(spark, sf):
    return session_history(v.table(spark, sf, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn")


@query("w14_time_split", """
SELECT CASE WHEN sale_date < DATE '2000-07-01' THEN 'train' ELSE 'test' END AS part, count(*) AS n, CAST(sum(units_sold) AS BIGINT) AS units FROM sales GROUP BY 1""", "sales")
def w14(spark, sf):
    part = F.when(F.col("sale_date") < F.lit("2000-07-01").cast("date"), "train").otherwise("test")
    return v.sales(spark, sf).groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.sum("units_sold").alias("units"))


@query("w14_last_weeks", """
WITH w AS (SELECT store_id, product_id, CAST(sale_date + CAST((7 - isodow(sale_date)) AS INTEGER) AS DATE) AS week_end, CAST(sum(units_sold) AS BIGINT) AS units FROM chain_daily GROUP BY 1, 2, 3)
SELECT store_id, product_id, week_end, units FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY week_end DESC) AS r FROM w) WHERE r <= 8""", "chain_daily")
def w14_last(spark, sf):
    from tidemill.functions.dates import week_end

    weeks = v.chain_daily(spark, sf).groupBy("store_id", "product_id", week_end(F.col("sale_date")).alias("week_end")).agg(F.sum("units_sold").alias("units"))
    return rel.top_k_per_key(weeks, ["store_id", "product_id"], [F.desc("week_end")], 8).drop("rank")


@query("w15_change_against_last", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS m FROM events GROUP BY 1), l AS (SELECT arg_max(m, day) AS last_m FROM d)
SELECT day, round((m - last_m) / last_m * 100, 4) AS change_pct FROM d, l""")
def w15(spark, sf):
    daily = series.daily_mean(v.table(spark, sf, "events"), F.col("ts").cast("date"), "value")
    last = daily.agg(F.max_by("mean_value", "day")).scalar()
    return daily.select("day", F.round((F.col("mean_value") - last) / last * 100, 4).alias("change_pct"))
