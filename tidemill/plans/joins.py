"""J*: joins, interval matches, as-of history and alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import relational as rel
from tidemill.operators import series
from tidemill.operators.recommend import neighbours, pair_similarity
from tidemill.plans import views as v
from tidemill.plans.registry import query
from tidemill.plans.windows import NEAR_SQL
from tidemill.session import cut_lineage


@query("j1_fact_dimension", """
SELECT st.city, p.kind, count(*) AS n, CAST(sum(s.units_sold) AS BIGINT) AS units
FROM sales s JOIN stores st ON s.store_id = st.store_id JOIN products p ON s.product_id = p.product_id GROUP BY 1, 2""", "sales stores products")
def j1(spark, sf):
    # the lines are summed before they meet the dimensions
    per = v.sales(spark, sf).groupBy("store_id", "product_id").agg(F.count("*").alias("n"), F.sum("units_sold").alias("units"))
    full = per.join(v.stores(spark, sf).select("store_id", "city"), "store_id").join(v.products(spark, sf).select("product_id", "kind"), "product_id")
    return full.groupBy("city", "kind").agg(F.sum("n").alias("n"), F.sum("units").alias("units"))


@query("j2_monthly_weather", """
SELECT d.store_id, d.product_id, d.sale_date, d.units_sold, round(w.avg_temp_c, 4) AS avg_temp_c, w.rain_mm
FROM chain_daily d LEFT JOIN weather w ON d.store_id = w.store_id AND year(d.sale_date) = w.year AND month(d.sale_date) = w.month""", "chain_daily weather")
def j2(spark, sf):
    d = v.chain_daily(spark, sf).withColumns({"year": F.year("sale_date"), "month": F.month("sale_date")})
    return d.join(v.weather(spark, sf), ["store_id", "year", "month"], "left").select(
        "store_id", "product_id", "sale_date", "units_sold", F.round("avg_temp_c", 4).alias("avg_temp_c"), "rain_mm")


@query("j3_role_playing", """
SELECT f.flight_id, f.leg, f.plane, o.awnd AS awnd_o, d.awnd AS awnd_d, d.prcp AS prcp_d FROM flights f
LEFT JOIN daily_weather o ON f.day = o.day AND f.origin = o.place LEFT JOIN daily_weather d ON f.day = d.day AND f.dest = d.place""", "flights daily_weather")
def j3(spark, sf):
    w = v.daily_weather(spark, sf)
    out = rel.with_daily(v.flights(spark, sf), w, "day", "place", ["awnd"], "_o", "origin")
    out = rel.with_daily(out, w, "day", "place", ["awnd", "prcp"], "_d", "dest")
    return out.select("flight_id", "leg", "plane", "awnd_o", "awnd_d", "prcp_d")


@query("j4_group_mean_on_rows", """
SELECT o_orderkey, round(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_orderpriority), 2) AS above_mean FROM orders""")
def j4(spark, sf):
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    out = rel.group_means(o, ["o_orderpriority"], ["o_totalprice"])
    return out.select("o_orderkey", F.round(F.col("o_totalprice") - F.col("o_totalprice_mean"), 2).alias("above_mean"))


@query("j5_lookup_with_default", """
SELECT s.product_id, s.store_id, s.sale_date, s.units_sold, coalesce(p.p_name, '') AS name FROM sales s
LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON s.product_id = p.p_partkey""", "sales")
def j5(spark, sf):
    dim = v.products(spark, sf).filter(F.col("size") > 10).select("product_id", "name")
    facts = v.sales(spark, sf).select("product_id", "store_id", "sale_date", "units_sold")
    return rel.lookup(facts, dim, "product_id", {"name": ""})


# Promotions of the test domain (brand, first day, last day, percent).
PROMOTIONS = [
    (1, "1996-01-10", "1996-01-20", 10), (1, "1996-01-15", "1996-02-05", 20), (2, "1997-05-01", "1997-05-31", 15),
    (7, "1998-11-20", "1998-11-30", 30), (7, "1998-11-25", "1998-12-24", 25), (12, "1999-07-01", "1999-07-14", 5),
    (25, "2000-02-01", "2000-02-29", 12),
]
PROMO_SQL = "promo(product_id, a, b, pct) AS (VALUES " + ", ".join(f"({p}, DATE '{a}', DATE '{b}', {d})" for p, a, b, d in PROMOTIONS) + ")"


def promotions(spark):
    rows = [(i, *p) for i, p in enumerate(PROMOTIONS)]
    return spark.createDataFrame(rows, "place int, product_id int, start_date string, end_date string, pct int").withColumns(
        {"start_date": F.col("start_date").cast("date"), "end_date": F.col("end_date").cast("date")})


@query("j6_interval_join", f"""
WITH {PROMO_SQL}, n AS (SELECT *, row_number() OVER () AS place FROM promo),
m AS (SELECT d.*, n.pct, row_number() OVER (PARTITION BY d.store_id, d.product_id, d.sale_date ORDER BY n.a, n.pct) AS r
      FROM chain_daily d LEFT JOIN n ON d.product_id = n.product_id AND d.sale_date BETWEEN n.a AND n.b)
SELECT store_id, product_id, sale_date, units_sold, pct FROM m WHERE r = 1""", "chain_daily")
def j6(spark, sf):
    d = v.chain_daily(spark, sf).select("store_id", "product_id", "sale_date", "units_sold")
    out = rel.interval_match(d, promotions(spark), ["product_id"], "sale_date", "start_date", "end_date", "place")
    return out.select("store_id", "product_id", "sale_date", "units_sold", "pct")


@query("j6_interval_days", f"""
WITH {PROMO_SQL}, days AS (SELECT product_id, pct, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM promo)
SELECT days.product_id, CAST(days.d AS DATE) AS sale_date, max(1 + pct / CAST(100 AS DOUBLE) * CAST(1.5 AS DOUBLE)) AS multiplier, CAST(coalesce(sum(c.units_sold), 0) AS BIGINT) AS units
FROM (SELECT product_id, d, arg_max(pct, pct) AS pct FROM days GROUP BY 1, 2) days
LEFT JOIN chain_daily c ON c.product_id = days.product_id AND c.sale_date = days.d GROUP BY 1, 2""", "chain_daily")
def j6_days(spark, sf):
    days = rel.expand_intervals(promotions(spark), "start_date", "end_date", "sale_date").groupBy("product_id", "sale_date").agg(F.max("pct").alias("pct"))
    units = v.chain_daily(spark, sf).groupBy("product_id", "sale_date").agg(F.sum("units_sold").alias("units"))
    return days.join(units, ["product_id", "sale_date"], "left").select(
        "product_id", "sale_date", (1 + F.col("pct") / 100 * 1.5).alias("multiplier"), F.coalesce("units", F.lit(0)).alias("units"))


@query("j7_co_rating_similarity", f"""
WITH {NEAR_SQL}, pairs AS (SELECT u, v FROM near),
dots AS (SELECT p.u, p.v, sum(a.dev * b.dev) AS dot FROM pairs p JOIN c a ON a."user" = p.u JOIN c b ON b."user" = p.v AND a.item = b.item GROUP BY 1, 2)
SELECT p.u, p.v, round(round(coalesce(CASE WHEN x.norm * y.norm > 0 THEN d.dot / (x.norm * y.norm) END, 0), 9), 6) AS sim
FROM pairs p LEFT JOIN dots d ON p.u = d.u AND p.v = d.v LEFT JOIN n x ON p.u = x."user" LEFT JOIN n y ON p.v = y."user" """, "ratings")
def j7(spark, sf):
    ratings = cut_lineage(v.ratings(spark, sf))
    pairs = cut_lineage(neighbours(ratings).select("u", "v"))
    return pair_similarity(ratings, pairs).withColumn("sim", F.round("sim", 6))


@query("j8_anti_join", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def j8(spark, sf):
    urgent = v.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return v.table(spark, sf, "customer").select("c_custkey").join(urgent, "c_custkey", "left_anti")


@query("j9_semi_join", "SELECT count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS units FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#3')")
def j9(spark, sf):
    wanted = v.table(spark, sf, "part").filter(F.col("p_brand") == "Brand#3").select(F.col("p_partkey").alias("l_partkey"))
    return v.table(spark, sf, "lineitem").join(wanted, "l_partkey", "left_semi").agg(
        F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("units"))


@query("j10_entity_days_grid", """
WITH s AS (SELECT store_id, product_id, max(sale_date) AS last_day FROM chain_daily GROUP BY 1, 2)
SELECT store_id, product_id, CAST(unnest(generate_series(last_day + 1, last_day + 30, INTERVAL 1 DAY)) AS DATE) AS target_date FROM s""", "chain_daily")
def j10(spark, sf):
    s = v.chain_daily(spark, sf).groupBy("store_id", "product_id").agg(F.max("sale_date").alias("last_day"))
    return series.future_days(s, F.date_add("last_day", 1), 30).select("store_id", "product_id", "target_date")


@query("j11_full_outer", """
WITH a AS (SELECT origin AS place, day, count(*) AS n_out FROM flights GROUP BY 1, 2),
b AS (SELECT dest AS place, day, count(*) AS n_in FROM flights GROUP BY 1, 2)
SELECT coalesce(a.place, b.place) AS place, coalesce(a.day, b.day) AS day, n_out, n_in FROM a FULL JOIN b ON a.place = b.place AND a.day = b.day""", "flights")
def j11(spark, sf):
    f = v.flights(spark, sf)
    out = f.groupBy(F.col("origin").alias("place"), "day").agg(F.count("*").alias("n_out"))
    into = f.groupBy(F.col("dest").alias("place"), "day").agg(F.count("*").alias("n_in"))
    return out.join(into, ["place", "day"], "full")


@query("j12_as_of_history", """
WITH t AS (SELECT DISTINCT store_id, product_id, DATE '1996-03-01' + CAST(product_id * 40 AS INTEGER) AS target FROM chain_daily),
h AS (SELECT t.*, d.units_sold, row_number() OVER (PARTITION BY t.store_id, t.product_id ORDER BY d.sale_date DESC) AS r,
             count(*) OVER (PARTITION BY t.store_id, t.product_id) AS n, avg(d.units_sold) OVER (PARTITION BY t.store_id, t.product_id) AS mean
      FROM t JOIN chain_daily d ON t.store_id = d.store_id AND t.product_id = d.product_id AND d.sale_date < t.target),
g AS (SELECT store_id, product_id, any_value(n) AS n, any_value(mean) AS mean, max(units_sold) FILTER (r = 7) AS l7, max(units_sold) FILTER (r = 30) AS l30,
             avg(units_sold) FILTER (r <= 7) AS r7, avg(units_sold) FILTER (r <= 30) AS r30 FROM h GROUP BY 1, 2)
SELECT t.store_id, t.product_id, t.target, round(coalesce(CASE WHEN n >= 7 THEN l7 ELSE mean END, 0), 4) AS lag_7, round(coalesce(CASE WHEN n >= 30 THEN l30 ELSE mean END, 0), 4) AS lag_30,
       round(coalesce(CASE WHEN n >= 7 THEN r7 ELSE mean END, 0), 4) AS roll_7, round(coalesce(CASE WHEN n >= 30 THEN r30 ELSE mean END, 0), 4) AS roll_30
FROM t LEFT JOIN g ON t.store_id = g.store_id AND t.product_id = g.product_id""", "chain_daily")
def j12(spark, sf):
    # a stored daily table, bounded by series x days: the lines are read once for its several uses
    d = cut_lineage(v.chain_daily(spark, sf))
    target = F.date_add(F.lit("1996-03-01").cast("date"), F.col("product_id") * 40)
    targets = d.select("store_id", "product_id", target.alias("target")).distinct()
    out = series.as_of_history(targets, d, ["store_id", "product_id"], "target", "units_sold")
    return out.select("store_id", "product_id", "target", *[F.round(c, 4).alias(c) for c in ("lag_7", "lag_30", "roll_7", "roll_30")])


@query("j13_recommendation_attributes", """
WITH r AS (SELECT "user", item, row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS k FROM ratings)
SELECT r."user", r.item, p.name, p.category FROM r LEFT JOIN products p ON r.item = p.product_id WHERE k <= 5""", "ratings products")
def j13(spark, sf):
    best = rel.top_k_per_key(v.ratings(spark, sf), ["user"], [F.desc("rating"), F.col("item")], 5)
    attrs = v.products(spark, sf).select(F.col("product_id").alias("item"), "name", "category")
    return best.join(attrs, "item", "left").select("user", "item", "name", "category")


@query("j15_weather_defaults", """
SELECT d.store_id, d.product_id, d.sale_date, round(coalesce(w.avg_temp_c, 15.0), 4) AS avg_temp_c, coalesce(w.rain_mm, CAST(30.0 AS DOUBLE)) AS rain_mm
FROM chain_daily d LEFT JOIN weather w ON d.store_id = w.store_id AND year(d.sale_date) = w.year AND month(d.sale_date) = w.month""", "chain_daily weather")
def j15(spark, sf):
    d = v.chain_daily(spark, sf).withColumns({"year": F.year("sale_date"), "month": F.month("sale_date")})
    out = series.with_weather_defaults(d, v.weather(spark, sf))
    return out.select("store_id", "product_id", "sale_date", F.round("avg_temp_c", 4).alias("avg_temp_c"), "rain_mm")


@query("j16_columns_side_by_side", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS "o_orderstatus_O", CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS "o_orderstatus_P" FROM orders""")
def j16(spark, sf):
    return rel.one_hot(v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), ["o_orderstatus"], drop_first=True)
