"""M*: SQL-expressible analytics: detector baseline, scaling, similarity, recommendation, metrics, trends, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import arrays
from tidemill.functions.numbers import round_half_up
from tidemill.operators import clustering, dialogue, evaluate, flights, recommend, segments, series, textmodels
from tidemill.operators import relational as rel
from tidemill.operators.models import binarize
from tidemill.plans import views as v
from tidemill.plans.projections import BASELINE_SQL, half_up
from tidemill.plans.registry import query
from tidemill.plans.windows import HOLDOUT_SQL, NEAR_SQL, SPLIT_SQL
from tidemill.session import cut_lineage


@query("m2_baseline_detector", f"WITH {BASELINE_SQL} SELECT event_id, round(d, 6) AS distance, d > t AS ml_anomaly FROM dist, lim", "readings")
def m2(spark, sf):
    r = v.readings(spark, sf)
    out = clustering.score(r, clustering.fit_baseline_detector(r))
    return out.select("event_id", F.round("distance", 6).alias("distance"), "ml_anomaly")


@query("m3_standardize", """
SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) AS o_totalprice FROM orders""")
def m3(spark, sf):
    out = clustering.standardize(v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"])
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"))


@query("m4_single_cluster_cost", "SELECT 1 AS k, round(" + " + ".join(
    f"var_pop(CAST(embedding[{i + 1}] AS DOUBLE)) * count(*)" for i in range(64)) + ", 4) AS cost FROM embeddings")
def m4_single(spark, sf):
    e = v.table(spark, sf, "embeddings")
    cost = clustering.total_spread(e, "embedding", 64)
    return e.limit(1).select(F.lit(1).alias("k"), F.round(F.lit(cost), 4).alias("cost"))


@query("m7_silhouette", """
WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
s AS (SELECT label, count(*) AS n FROM p GROUP BY 1),
d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.x, b.x)) AS dist FROM p a, p b GROUP BY 1, 2, 3),
ab AS (SELECT d.vec_id, d.label, max(CASE WHEN d.other = d.label THEN dist / (n - 1) END) AS a, min(CASE WHEN d.other <> d.label THEN dist / n END) AS b
       FROM d JOIN s ON d.other = s.label GROUP BY 1, 2)
SELECT label, round(avg((b - a) / greatest(a, b)), 6) AS silhouette, count(*) AS n FROM ab GROUP BY 1""")
def m7(spark, sf):
    out = clustering.silhouette(v.table(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    return out.groupBy("label").agg(F.round(F.avg("silhouette"), 6).alias("silhouette"), F.count("*").alias("n"))


def dbscan_sql(points: str, key: str, eps: float, least: int = 5) -> str:
    """Labels of the points (id, x): reachable core points, border points in the first cluster, noise -1."""
    return f"""
WITH RECURSIVE {points},
nb AS (SELECT a.id AS a, b.id AS b FROM p a, p b WHERE list_distance(a.x, b.x) <= {eps}),
core AS (SELECT a AS id FROM nb GROUP BY 1 HAVING count(*) >= {least}),
reach(root, node) AS (SELECT id, id FROM core UNION SELECT r.root, nb.b FROM reach r JOIN nb ON nb.a = r.node JOIN core ON core.id = nb.b),
cl AS (SELECT node AS id, min(root) AS root FROM reach GROUP BY 1),
lab AS (SELECT id, root FROM cl UNION ALL SELECT nb.a, min(cl.root) FROM nb JOIN cl ON cl.id = nb.b WHERE nb.a NOT IN (SELECT id FROM core) GROUP BY 1),
num AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS label FROM (SELECT DISTINCT root FROM cl))
SELECT p.id AS {key}, CAST(coalesce(num.label, -1) AS INTEGER) AS label FROM p LEFT JOIN lab ON p.id = lab.id LEFT JOIN num ON lab.root = num.root"""


@query("m6_dbscan", dbscan_sql("p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)", "vec_id", 1.8))
def m6(spark, sf):
    return clustering.dbscan(v.table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding", 64)


#: Where users crowd in six standardised features of behaviour.
USER_RADIUS = 0.5


@query("m6_dbscan_of_users", dbscan_sql("""
f AS (SELECT "user", avg(rating) AS a, avg(progress) AS b, CAST(sum(sessions) AS DOUBLE) AS c, avg(duration) AS d, avg(completed) AS e, CAST(count(DISTINCT item) AS DOUBLE) AS g FROM rating_rows GROUP BY 1),
p AS (SELECT "user" AS id, [""" + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()" for c in "abcdeg") + "] AS x FROM f)", '"user"', USER_RADIUS), "rating_rows")
def m6_users(spark, sf):
    cols = ["avg_rating", "avg_progress", "total_sessions", "avg_duration", "completed_ratio", "n_items"]
    x = segments.scaled_vectors(recommend.user_features(v.rating_rows(spark, sf)), "user", cols)
    return clustering.dbscan(x, "user", "x", len(cols), eps=USER_RADIUS)


@query("m8_demand_features", """
WITH h AS (SELECT *, lag(units_sold, 7) OVER w AS lag_7, lag(units_sold, 14) OVER w AS lag_14, lag(units_sold, 30) OVER w AS lag_30,
  CASE WHEN count(*) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7 THEN avg(units_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END AS roll_7,
  CASE WHEN count(*) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) = 30 THEN avg(units_sold) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) END AS roll_30
  FROM chain_daily WINDOW w AS (PARTITION BY store_id, product_id ORDER BY sale_date))
SELECT h.store_id, h.product_id, h.sale_date, h.units_sold, h.unit_price, h.discount_pct, CAST(isodow(sale_date) - 1 AS INTEGER) AS day_of_week, CAST(weekofyear(sale_date) AS INTEGER) AS week_of_year,
       CASE WHEN isodow(sale_date) >= 6 THEN 1 ELSE 0 END AS is_weekend, CAST(quarter(sale_date) AS INTEGER) AS quarter, lag_7, lag_14, lag_30, round(roll_7, 4) AS roll_7, round(roll_30, 4) AS roll_30,
       round(avg_temp_c, 4) AS avg_temp_c, rain_mm
FROM h LEFT JOIN weather wt ON h.store_id = wt.store_id AND year(h.sale_date) = wt.year AND month(h.sale_date) = wt.month
WHERE lag_30 IS NOT NULL AND roll_30 IS NOT NULL""", "chain_daily weather")
def m8(spark, sf):
    out = series.demand_features(v.chain_daily(spark, sf), v.weather(spark, sf))
    return out.select(
        "store_id", "product_id", "sale_date", "units_sold", "unit_price", "discount_pct", "day_of_week", "week_of_year", "is_weekend", "quarter",
        "lag_7", "lag_14", "lag_30", *[F.round(c, 4).alias(c) for c in ("roll_7", "roll_30", "avg_temp_c")], "rain_mm")


TREND_SQL = """
d AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS y FROM events GROUP BY 1),
i AS (SELECT day, y, row_number() OVER (ORDER BY day) - 1 AS x FROM d),
f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, max(x) AS lx, max(day) AS ld, arg_max(y, x) AS cur, regr_r2(y, x) AS r2 FROM i)"""


@query("m13_linear_trend", f"""
WITH {TREND_SQL}, p AS (SELECT *, a + b * (lx + s) AS pred, CAST(s AS INTEGER) AS step FROM f, range(1, 8) r(s))
SELECT strftime(ld + step, '%Y-%m-%d') AS forecast_day, round(pred, 4) AS predicted, round((pred - cur) / cur * 100, 2) AS change_pct,
       CASE WHEN abs((pred - cur) / cur * 100) >= 10 THEN 'SÍ' ELSE 'NO' END AS alert FROM p""")
def m13(spark, sf):
    daily = series.daily_mean(v.table(spark, sf, "events"), F.col("ts").cast("date"), "value")
    return series.linear_trend(series.with_day_index(daily))


@query("m13_trend_fit", f"WITH {TREND_SQL} SELECT round(avg(abs(y - (a + b * x))), 6) AS mae, round(any_value(r2), 6) AS r2 FROM i, f")
def m13_fit(spark, sf):
    daily = series.daily_mean(v.table(spark, sf, "events"), F.col("ts").cast("date"), "value")
    out = series.trend_fit_metrics(series.with_day_index(daily))
    return out.select(F.round("mae", 6).alias("mae"), F.round("r2", 6).alias("r2"))


@query("m15_regression_metrics", """
WITH p AS (SELECT units_sold AS y, avg(units_sold) OVER (PARTITION BY store_id, product_id ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS f FROM chain_daily),
q AS (SELECT CAST(y AS DOUBLE) AS y, coalesce(f, 0) AS f FROM p)
SELECT round(avg(abs(y - f)), 3) AS mae, round(sqrt(avg((y - f) ** 2)), 3) AS rmse, round(1 - sum((y - f) ** 2) / (var_pop(y) * count(*)), 4) AS r2,
       round(avg(abs((y - f) / greatest(y, 1))) * 100, 2) AS mape FROM q""", "chain_daily")
def m15(spark, sf):
    d = series.rolling_mean(v.chain_daily(spark, sf), ["store_id", "product_id"], "sale_date", "units_sold", -7, -1, "f").fillna(0.0, ["f"])
    return evaluate.regression_metrics(d, "units_sold", "f")


@query("m16_user_similarity", f"WITH {NEAR_SQL} SELECT u, count(*) AS n_near, round(sum(sim), 4) AS total_sim, max(sim) AS best FROM near GROUP BY 1", "ratings")
def m16(spark, sf):
    near = recommend.neighbours(cut_lineage(v.ratings(spark, sf)))
    return near.groupBy("u").agg(F.count("*").alias("n_near"), F.round(F.sum("sim"), 4).alias("total_sim"), F.max("sim").alias("best"))


CLUSTER_NEAR_SQL = """
m AS (SELECT "user", avg(rating) AS mean FROM base GROUP BY 1),
c AS (SELECT r."user", r.item, r.rating - m.mean AS dev FROM base r JOIN m ON r."user" = m."user"),
n AS (SELECT "user", sqrt(sum(dev * dev)) AS norm FROM c GROUP BY 1),
sims AS (SELECT a."user" AS u, b."user" AS v, round(sum(a.dev / na.norm * (b.dev / nb.norm)), 9) AS sim
         FROM c a JOIN c b ON a.item = b.item AND a."user" <> b."user" JOIN n na ON a."user" = na."user" AND na.norm > 0
         JOIN n nb ON b."user" = nb."user" AND nb.norm > 0 GROUP BY 1, 2),
own AS (SELECT u, v, sim, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS rank FROM sims
        JOIN user_clusters x ON x."user" = u JOIN user_clusters y ON y."user" = v AND x.cluster = y.cluster WHERE sim >= 0.05),
n_own AS (SELECT u FROM own GROUP BY 1 HAVING count(*) >= 10),
everyone AS (SELECT u, v, sim, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS rank FROM sims WHERE sim >= 0.05),
near AS (SELECT u, v, sim FROM own WHERE rank <= 30 AND u IN (SELECT u FROM n_own)
         UNION ALL SELECT u, v, sim FROM everyone WHERE rank <= 30 AND u NOT IN (SELECT u FROM n_own))"""

PRED_SQL = """
votes AS (SELECT near.u, c.item, sum(sim * dev) / sum(abs(sim)) AS shift FROM near JOIN c ON c."user" = near.v GROUP BY 1, 2),
users AS (SELECT DISTINCT u FROM near), items AS (SELECT DISTINCT item FROM base),
cand AS (SELECT users.u, items.item, round(m.mean + coalesce(shift, 0), 9) AS score
         FROM users CROSS JOIN items JOIN m ON m."user" = users.u LEFT JOIN votes ON votes.u = users.u AND votes.item = items.item
         WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t."user" = users.u AND t.item = items.item)),
recs AS (SELECT u, item, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, item) AS rank FROM cand) WHERE rank <= 5)"""


@query("m17_recommend", f"""
WITH base AS (SELECT * FROM ratings), train AS (SELECT * FROM ratings), {CLUSTER_NEAR_SQL}, {PRED_SQL}
SELECT u AS "user", item, {half_up("score", 2)} AS predicted, rank FROM recs""", "ratings user_clusters")
def m17(spark, sf):
    r = cut_lineage(v.ratings(spark, sf))
    near = recommend.neighbours(r, v.user_clusters(spark, sf))
    return recommend.recommend(r, near).select(F.col("u").alias("user"), "item", round_half_up(F.col("score"), 2).alias("predicted"), "rank")


PRECISION_SQL = """
hits AS (SELECT h.u, count(x.item) / CAST(5.0 AS DOUBLE) AS p FROM (SELECT DISTINCT "user" AS u FROM held WHERE "user" IN (SELECT u FROM recs)) h
         LEFT JOIN (SELECT recs.u, recs.item FROM recs JOIN held ON held."user" = recs.u AND held.item = recs.item) x ON x.u = h.u GROUP BY 1)
SELECT round(avg(p), 6) AS precision_at_k, round(stddev_pop(p), 6) AS std, count(*) AS n_evaluated FROM hits"""


def _rounded(df):
    return df.select(F.round("precision_at_k", 6).alias("precision_at_k"), F.round("std", 6).alias("std"), "n_evaluated")


@query("m18_precision_at_k", f"""
WITH {HOLDOUT_SQL}, train AS (SELECT * FROM ratings r WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h."user" = r."user" AND h.item = r.item)),
base AS (SELECT * FROM train), {CLUSTER_NEAR_SQL}, {PRED_SQL}, {PRECISION_SQL}""", "ratings user_clusters")
def m18(spark, sf):
    return _rounded(recommend.evaluate(v.ratings(spark, sf), v.user_clusters(spark, sf)))


@query("m18_precision_at_k_leaky", f"""
WITH {HOLDOUT_SQL}, train AS (SELECT * FROM ratings r WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h."user" = r."user" AND h.item = r.item)),
base AS (SELECT * FROM ratings), {CLUSTER_NEAR_SQL}, {PRED_SQL}, {PRECISION_SQL}""", "ratings user_clusters")
def m18_leaky(spark, sf):
    return _rounded(recommend.evaluate(v.ratings(spark, sf), v.user_clusters(spark, sf), leaky=True))


@query("m19_raw_predictions", f"""
WITH {NEAR_SQL},
votes AS (SELECT near.u, r.item, sum(sim * r.rating) / sum(abs(sim)) AS score FROM near JOIN ratings r ON r."user" = near.v GROUP BY 1, 2)
SELECT u AS "user", count(*) AS n, round(sum(score), 3) AS total FROM votes v WHERE NOT EXISTS (SELECT 1 FROM ratings t WHERE t."user" = v.u AND t.item = v.item) GROUP BY 1""", "ratings")
def m19(spark, sf):
    r = cut_lineage(v.ratings(spark, sf))

    def totals(raw):
        return raw.groupBy(F.col("u").alias("user")).agg(F.count("*").alias("n"), F.round(F.sum("score"), 3).alias("total"))

    return recommend.raw_predictions(r, recommend.neighbours(r), totals)


@query("m21_tfidf", """
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '([\\p{L}\\p{N}_]{2,})', 1) AS w FROM documents),
g AS (SELECT doc_id, unnest(w) AS term FROM t
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM t),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2),
vocab AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1 ORDER BY total DESC, term LIMIT 8000),
raw AS (SELECT tf.doc_id, tf.term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (CAST(1 AS DOUBLE) + df)) + 1) AS w FROM tf JOIN vocab ON tf.term = vocab.term),
nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY 1)
SELECT raw.doc_id, count(*) AS n_terms, round(sum(w / norm), 4) AS total, round(max(w / norm), 6) AS top_weight FROM raw JOIN nrm ON raw.doc_id = nrm.doc_id GROUP BY 1""")
def m21(spark, sf):
    docs = v.table(spark, sf, "documents").select("doc_id", "text")
    w = textmodels.tfidf(docs, "doc_id", textmodels.word_tokens(F.col("text")))
    return w.groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.round(F.sum("weight"), 4).alias("total"), F.round(F.max("weight"), 6).alias("top_weight"))


@query("m24_classification_report", """
WITH x AS (SELECT CAST(label AS VARCHAR) AS y, CAST(CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS VARCHAR) AS p FROM scored),
k AS (SELECT DISTINCT y AS c FROM x UNION SELECT DISTINCT p FROM x),
s AS (SELECT c, count(*) FILTER (y = c) AS support, count(*) FILTER (p = c) AS said, count(*) FILTER (y = c AND p = c) AS hit FROM k, x GROUP BY 1),
r AS (SELECT c AS "class", support, CASE WHEN said > 0 THEN hit / CAST(said AS DOUBLE) ELSE 0 END AS precision, CASE WHEN support > 0 THEN hit / CAST(support AS DOUBLE) ELSE 0 END AS recall FROM s),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM r),
a AS (SELECT "class", support, precision, recall, f1 FROM f UNION ALL SELECT 'macro avg', sum(support), avg(precision), avg(recall), avg(f1) FROM f
      UNION ALL SELECT 'weighted avg', sum(support), sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support) FROM f)
SELECT "class", CAST(support AS BIGINT) AS support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM a""", "scored")
def m24(spark, sf):
    s = v.scored(spark, sf).withColumn("predicted", binarize(F.col("score"), 0.5))
    out = evaluate.classification_report(s, "label", "predicted")
    return out.select("class", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


CONF_SQL = """
cm AS (SELECT count(*) FILTER (label = 1 AND score > 0.5) AS tp, count(*) FILTER (label = 0 AND score > 0.5) AS fp,
       count(*) FILTER (label = 0 AND score <= 0.5) AS tn, count(*) FILTER (label = 1 AND score <= 0.5) AS fn FROM scored)"""


@query("m25_confusion", f"WITH {CONF_SQL} SELECT tp, fp, tn, fn FROM cm", "scored")
def m25(spark, sf):
    return evaluate.confusion(v.scored(spark, sf).withColumn("p", binarize(F.col("score"), 0.5)), "label", "p")


@query("m25_rates", f"""
WITH {CONF_SQL}, d AS (SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn, CAST(fn AS DOUBLE) AS fn FROM cm)
SELECT round(tp / (tp + fn) * 100, 6) AS sensitivity, round(tn / (tn + fp) * 100, 6) AS specificity, round(tp / (tp + fp) * 100, 6) AS precision, round(tn / (tn + fn) * 100, 6) AS npv,
       round(fp / (fp + tn) * 100, 6) AS fpr, round(fn / (tp + fn) * 100, 6) AS fnr, round(fp / (tp + fp) * 100, 6) AS fdr, round((tp + tn) / (tp + fp + fn + tn) * 100, 6) AS accuracy FROM d""", "scored")
def m25_rates(spark, sf):
    out = evaluate.rates(m25(spark, sf))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


AUC_SQL = """
SELECT round(sum(CASE WHEN a.s > b.s THEN CAST(1 AS DOUBLE) WHEN a.s = b.s THEN 0.5 ELSE 0 END) / count(*), 6) AS auc
FROM (SELECT {s} AS s FROM scored WHERE label = 1) a, (SELECT {s} AS s FROM scored WHERE label = 0) b"""


@query("m26_auc", AUC_SQL.format(s="score"), "scored")
def m26(spark, sf):
    return evaluate.roc_auc(v.scored(spark, sf), "label", "score").select(F.round("auc", 6).alias("auc"))


@query("m26_auc_of_binarized", AUC_SQL.format(s="CASE WHEN score > 0.5 THEN 1 ELSE 0 END"), "scored")
def m26_binary(spark, sf):
    s = v.scored(spark, sf).withColumn("p", binarize(F.col("score"), 0.5))
    return evaluate.roc_auc(s, "label", "p").select(F.round("auc", 6).alias("auc"))


@query("m31_split_sizes", f"WITH {SPLIT_SQL} SELECT quality, part, count(*) AS n FROM parts GROUP BY 1, 2")
def m31(spark, sf):
    parts = rel.rank_split(v.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", [0.8, 0.1, 0.1], ["quality"])
    return parts.groupBy("quality", "part").agg(F.count("*").alias("n"))


@query("m31_plain_split", """
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) <= floor(count(*) OVER () * CAST(0.7 AS DOUBLE)) THEN 0 ELSE 1 END AS part FROM orders""")
def m31_plain(spark, sf):
    return rel.rank_split(v.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", [0.7, 0.3])


FLIGHT_SQL = f"""
dw AS (SELECT day, place, awnd, prcp, coalesce(snow, CAST(0 AS DOUBLE)) AS snow, coalesce(tavg, avg(tavg) OVER (PARTITION BY month(day), place)) AS tavg FROM daily_weather)
SELECT f.flight_id, f.leg, f.plane, f.is_delay, CAST(year(f.day) AS INTEGER) AS year, CAST(quarter(f.day) AS INTEGER) AS quarter, CAST(month(f.day) AS INTEGER) AS month,
       CAST(day(f.day) AS INTEGER) AS day_of_month, CAST(isodow(f.day) AS INTEGER) AS day_of_week, f.dep_time // 100 AS dep_hour,
       CASE WHEN strftime(f.day, '%Y-%m-%d') IN ('1997-01-01', '1997-12-25') THEN 1 ELSE 0 END AS is_holiday,
       o.awnd AS awnd_o, o.prcp AS prcp_o, {half_up("o.tavg", 4)} AS tavg_o, o.snow AS snow_o, d.awnd AS awnd_d, {half_up("d.tavg", 4)} AS tavg_d
FROM flights f LEFT JOIN dw o ON f.day = o.day AND f.origin = o.place LEFT JOIN dw d ON f.day = d.day AND f.dest = d.place"""


@query("m32_flight_features", f"WITH {FLIGHT_SQL}", "flights daily_weather")
def m32(spark, sf):
    out = flights.flight_features(v.flights(spark, sf), v.daily_weather(spark, sf), ["1997-01-01", "1997-12-25"])
    return out.select(
        "flight_id", "leg", "plane", "is_delay", "year", "quarter", "month", "day_of_month", "day_of_week", "dep_hour", "is_holiday",
        "awnd_o", "prcp_o", round_half_up(F.col("tavg_o"), 4).alias("tavg_o"), "snow_o", "awnd_d", round_half_up(F.col("tavg_d"), 4).alias("tavg_d"))


@query("m32_flight_one_hot", """
SELECT flight_id, leg, plane, """ + ", ".join(f"CASE WHEN airline = {a} THEN 1 ELSE 0 END AS airline_{a}" for a in range(2, 6)) + ", " + ", ".join(
    f"CASE WHEN origin = {a} THEN 1 ELSE 0 END AS origin_{a}" for a in range(1, 25)) + " FROM flights", "flights")
def m32_one_hot(spark, sf):
    f = v.flights(spark, sf).select("flight_id", "leg", "plane", "airline", "origin")
    return rel.one_hot(f, ["airline", "origin"], drop_first=True)


@query("m33_segment_profile", """
WITH u AS (SELECT o_custkey, count(*) AS freq, avg(o_totalprice) AS ticket FROM orders GROUP BY 1),
s AS (SELECT c_mktsegment AS segment, count(*) AS n, avg(freq) AS f, avg(ticket) AS t FROM u JOIN customer ON o_custkey = c_custkey GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY t DESC, segment) AS bt, row_number() OVER (ORDER BY f DESC, segment) AS bf FROM s)
SELECT segment, n, round(f, 4) AS avg_frequency, round(t, 2) AS avg_ticket, CASE WHEN bt = 1 THEN 'vip_offers' WHEN bf = 1 THEN 'volume_promotions' ELSE 'reactivation' END AS action FROM r""")
def m33(spark, sf):
    u = v.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("freq"), F.avg("o_totalprice").alias("ticket"))
    u = u.join(v.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("segment"), "freq", "ticket")
    out = clustering.segment_profile(u, "segment", "freq", "ticket")
    return out.select("segment", "n", F.round("avg_frequency", 4).alias("avg_frequency"), F.round("avg_ticket", 2).alias("avg_ticket"), "action")


def dialogue_sql() -> str:
    from tidemill import fixed_values as fv
    from tidemill.plans.scalars import sql_list

    m = dialogue.Machine()
    yes, no = sql_list(fv.YES_WORDS), sql_list(fv.NO_WORDS)
    moves = []
    for state in m.states[1:]:
        for answer, nxt in m.options[state]:
            hit = f"answer = '{answer}'"
            if len(answer) > 4:
                hit = f"({hit} OR contains('{answer}', answer) OR contains(answer, '{answer}'))"
            moves.append(f"WHEN state = '{state}' AND {hit} THEN '{nxt or 'idle'}'")
    starts = " ".join(f"WHEN state = 'idle' AND intent = '{f}' THEN '{s}'" for f, s in m.starts.items())
    return f"""
WITH RECURSIVE t AS (SELECT conv_id, turn, message, intent, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k,
  CASE WHEN trim(lower(message)) IN ({yes}) THEN 'si' WHEN trim(lower(message)) IN ({no}) THEN 'no' ELSE trim(lower(message)) END AS answer,
  trim(lower(message)) IN ({sql_list(fv.HELP_WORDS)}) AS is_help, regexp_matches(lower(message), '{"|".join(fv.CANCEL_WORDS)}') AS is_cancel FROM turns),
run(conv_id, k, before, state) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 'idle', 'idle' FROM t
  UNION ALL
  SELECT r.conv_id, t.k, r.state, CASE WHEN is_help THEN state {starts} WHEN state = 'idle' THEN 'idle' WHEN is_cancel THEN 'idle' {' '.join(moves)} ELSE state END
  FROM run r JOIN t ON t.conv_id = r.conv_id AND t.k = r.k + 1)
SELECT t.conv_id, t.turn, run.before AS state_before, run.state AS state_after FROM run JOIN t ON t.conv_id = run.conv_id AND t.k = run.k"""


@query("st6_dialogue", dialogue_sql, "turns")
def st6(spark, sf):
    out = dialogue.dialogue(v.turns(spark, sf), "conv_id", "turn", "message", "intent")
    return out.select("conv_id", "turn", "state_before", "state_after")


@query("st6_dialogue_actions", lambda: dialogue_sql().replace(
    "SELECT t.conv_id, t.turn, run.before AS state_before, run.state AS state_after FROM",
    """SELECT CASE WHEN is_help THEN 'help' WHEN run.before = 'idle' AND run.state = 'idle' THEN 'answer' WHEN run.before = 'idle' THEN 'start' WHEN is_cancel THEN 'cancel'
       WHEN run.state = 'idle' THEN 'finish' WHEN run.before = run.state THEN 'repeat' ELSE 'advance' END AS action, count(*) AS n FROM""") + " GROUP BY 1", "turns")
def st6_actions(spark, sf):
    # a small chunk makes long sessions run in several chunks here as well
    out = dialogue.dialogue(v.turns(spark, sf), "conv_id", "turn", "message", "intent", chunk=3)
    return out.groupBy("action").agg(F.count("*").alias("n"))


@query("st7_session_history", """
WITH c AS (SELECT conv_id, max(turn) AS upto FROM conversations WHERE length(text) % 5 = 0 GROUP BY 1)
SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn_no, count(*) OVER (PARTITION BY conv_id) AS turn_count
FROM conversations LEFT JOIN c USING (conv_id) WHERE upto IS NULL OR turn > upto""")
def st7(spark, sf):
    turns = v.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    cleared = turns.filter(F.length("text") % 5 == 0)
    return dialogue.session_history(turns.select("conv_id", "turn"), "conv_id", "turn", cleared)


@query("m1_vector_distance", "SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), list_transform(range(64), lambda i: CAST(0.1 AS DOUBLE))), 6) AS distance FROM embeddings")
def m1_distance(spark, sf):
    e = arrays.as_doubles(F.col("embedding"))
    return v.table(spark, sf, "embeddings").select("vec_id", F.round(arrays.nearest_distance(e, [[0.1] * 64]), 6).alias("distance"))


@query("x5_custom_metric", """
WITH p AS (SELECT store_id, CAST(units_sold AS DOUBLE) AS y, coalesce(avg(units_sold) OVER (PARTITION BY store_id, product_id ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS f FROM chain_daily)
SELECT store_id, round(avg(abs((y - f) / greatest(y, 1))) * 100, 4) AS mape FROM p GROUP BY 1""", "chain_daily")
def x5(spark, sf):
    d = series.rolling_mean(v.chain_daily(spark, sf), ["store_id", "product_id"], "sale_date", "units_sold", -7, -1, "f").fillna(0.0, ["f"])
    y = F.col("units_sold").cast("double")
    return d.groupBy("store_id").agg(F.round(F.avg(F.abs((y - F.col("f")) / F.greatest(y, F.lit(1.0)))) * 100, 4).alias("mape"))
