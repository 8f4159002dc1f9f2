"""M* that train models, and what is read from trained models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions import text
from tidemill.functions.numbers import round_half_up
from tidemill.operators import clustering, evaluate, flights, models, recommend, segments, series, textmodels
from tidemill.operators import relational as rel
from tidemill.plans import views as v
from tidemill.plans.registry import query
from tidemill.session import cut_lineage, run_dir
from tidemill.sources import writers

CUT = "2000-07-01"


# ---- anomaly detector, clustering -----------------------------------------------------------

@query("m1_kmeans_detector")
def m1(spark, sf):
    r = v.readings(spark, sf)
    out = clustering.score(r, clustering.fit_detector(r))
    return out.select("event_id", F.round("distance", 4).alias("distance"), "ml_anomaly")


def scaled_users(spark, sf):
    """Standardised behaviour and category shares of each user as an array, and its length."""
    features, cols = segments.behaviour(v.interactions(spark, sf))
    return cut_lineage(segments.scaled_vectors(features, "user", cols)), len(cols)


def user_components(spark, sf, n):
    x, size = scaled_users(spark, sf)
    out, _ = clustering.pca(x, "x", size, n)
    return cut_lineage(out.select("user", F.col("pca").alias("x")))


@query("m4_kmeans_elbow")
def m4(spark, sf):
    points = user_components(spark, sf, 10)
    ks = range(1, 11)
    found = segments.fit_many(points, "user", ks, restarts=10)
    scores = segments.silhouettes(points, [found[k] for k in ks])
    rows = [(k, found[k].cost, s if k > 1 else None) for k, s in zip(ks, scores)]
    return spark.createDataFrame(rows, "k int, cost double, silhouette double")


@query("m4_kmeans_clusters")
def m4_clusters(spark, sf):
    points = user_components(spark, sf, 10)
    model = segments.fit_many(points, "user", [5])[5]
    return segments.assigned(points, model.centres).select("user", "cluster")


@query("m4_segments")
def m4_segments(spark, sf):
    return segments.segment_users(v.interactions(spark, sf)).users


@query("s27_segmentation_metrics")
def s27_segmentation(spark, sf):
    out = run_dir(spark, "s27")
    found = segments.segment_users(v.interactions(spark, sf))
    writers.store_single_row(spark.createDataFrame([found.metrics]), out)
    return spark.read.parquet(out)


@query("m33_segments")
def m33(spark, sf):
    users = segments.segment_users(v.interactions(spark, sf)).users
    spent = v.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("user")).agg(F.count("*").alias("freq"), F.avg("o_totalprice").alias("ticket"))
    out = clustering.segment_profile(users.join(spent, "user"), "kmeans_cluster", "freq", "ticket")
    return out.select("kmeans_cluster", "n", F.round("avg_frequency", 4).alias("avg_frequency"), F.round("avg_ticket", 2).alias("avg_ticket"), "action")


@query("m17_in_segments")
def m17(spark, sf):
    users = segments.segment_users(v.interactions(spark, sf)).users
    ratings = cut_lineage(v.ratings(spark, sf))
    near = recommend.neighbours(ratings, users.select("user", F.col("kmeans_cluster").alias("cluster")))
    return recommend.recommend(ratings, near).select(F.col("u").alias("user"), "item", round_half_up(F.col("score"), 2).alias("predicted"), "rank")


@query("m5_pca")
def m5(spark, sf):
    out, shares = clustering.pca(v.table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", 64, 8)
    return out.select("vec_id", *[F.round(F.abs(F.col("pca")[i]), 4).alias(f"pc{i + 1}") for i in range(8)], F.round(F.lit(sum(shares)), 4).alias("explained"))


@query("m6_dbscan_after_pca")
def m6(spark, sf):
    points = user_components(spark, sf, 8)
    return clustering.dbscan(points, "user", "x", 8)


# ---- demand ---------------------------------------------------------------------------------

def demand(spark, sf):
    f = series.demand_features(v.chain_daily(spark, sf), v.weather(spark, sf)).dropna(subset=fv.DEMAND_FEATURES)
    rows = models.assembled(f, fv.DEMAND_FEATURES, "units_sold", keep=["sale_date", "store_id", "product_id"])
    return models.time_split(rows, "sale_date", CUT)


def _metrics(df, name):
    return df.select(F.lit(name).alias("model"), "mae", "rmse", "r2", "mape")


@query("m9_forest")
def m9(spark, sf):
    train, test = demand(spark, sf)
    _, _, metrics = models.fit_and_score(models.forest_regressor(), train, test)
    return _metrics(metrics, "forest")


@query("m9_boosting")
def m9_boosting(spark, sf):
    train, test = demand(spark, sf)
    _, _, metrics = models.fit_and_score(models.boosting_regressor(), train, test)
    return _metrics(metrics, "boosting")


@query("m10_weekly_forecast")
def m10(spark, sf):
    out = series.forecast_series(v.chain_daily(spark, sf), ["store_id", "product_id"])
    return out.select("store_id", "product_id", "week_end", *[F.round(c, 3).alias(c) for c in ("forecast", "lower", "upper", "backtest_mae")], "status")


@query("m11_random_search")
def m11(spark, sf):
    train, test = demand(spark, sf)
    best, board = models.random_search(train, "sale_date")
    _, _, metrics = models.refit(best, train, test)
    empty = [F.lit(None).cast("double").alias(c) for c in ("rmse", "r2", "mape")]
    draws = spark.createDataFrame([("draw", str(p), e) for p, e in board], "step string, params string, mae double").select("*", *empty)
    return draws.unionByName(metrics.select(F.lit("refit").alias("step"), F.lit(str(best)).alias("params"), "mae", "rmse", "r2", "mape"))


@query("m12_demand_forecast")
def m12(spark, sf):
    daily, weather = cut_lineage(v.chain_daily(spark, sf)), v.weather(spark, sf)
    train, _ = demand(spark, sf)
    model = models.fit(models.forest_regressor(), train)
    pairs = daily.groupBy("store_id", "product_id").agg(F.max("sale_date").alias("last"), F.max("unit_price").alias("base_price"))
    grid = series.future_days(pairs, F.date_add("last", 1), 30).withColumn("discount_pct", F.lit(5))
    known = series.as_of_history(grid, daily, ["store_id", "product_id"], "target_date", "units_sold")
    dated = known.select("*", *[c.alias(n) for n, c in series.date_parts(F.col("target_date")).items()])
    full = series.with_weather_defaults(dated, weather).withColumn("unit_price", F.round(F.col("base_price") * (1 - F.col("discount_pct") / 100), 4))
    rows = models.assembled(full.withColumn("y", F.lit(0.0)), fv.DEMAND_FEATURES, "y", keep=["store_id", "product_id", "target_date", "base_price", "discount_pct"])
    scored = model.transform(rows).withColumn("units", F.greatest(F.col("prediction"), F.lit(0.0)))
    out = series.price_forecast(scored, "units", "base_price", "discount_pct")
    return out.select("store_id", "product_id", "target_date", F.round("units", 2).alias("predicted_units"), "predicted_revenue", "confidence_lower", "confidence_upper")


@query("m14_importances")
def m14(spark, sf):
    train, _ = demand(spark, sf)
    model = models.fit(models.forest_regressor(), train)
    return models.importances(spark, model, fv.DEMAND_FEATURES)


@query("l10_top_importances")
def l10(spark, sf):
    train, _ = demand(spark, sf)
    model = models.fit(models.forest_regressor(), train)
    return models.importances(spark, model, fv.DEMAND_FEATURES, 15)


@query("s23_saved_model")
def s23(spark, sf):
    train, test = demand(spark, sf)
    model, before, metrics = models.fit_and_score(models.forest_regressor(), train, test)
    out = run_dir(spark, "s23")
    models.save_model(model, out, fv.DEMAND_FEATURES, metrics)
    loaded, names, stored = models.load_model(spark, out)
    again = loaded.transform(test).withColumn("p", F.greatest(F.col("prediction"), F.lit(0.0)))
    same = evaluate.regression_metrics(again, "label", "p").exceptAll(stored).count() == 0
    return stored.select("*", F.lit(len(names)).alias("n_features"), F.lit(same).alias("same_after_reload"))


@query("x4_group_forecast")
def x4(spark, sf):
    return series.forecast_series(v.chain_daily(spark, sf), ["store_id"], horizon=4).groupBy("store_id").agg(
        F.count("*").alias("weeks"), F.round(F.sum("forecast"), 2).alias("units"))


# ---- text -----------------------------------------------------------------------------------

def labelled_documents(spark, sf):
    docs = v.texts(spark, sf).select("doc_id", "text", "lang")
    return v.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("label")).join(docs, "doc_id")


def _bayes_sql(name: str, parts: str) -> str:
    """Multinomial naive Bayes in SQL: smoothed word and class frequencies of the training parts."""
    return f"""
{name}_tok AS (SELECT doc_id, label, w FROM tok WHERE part IN ({parts})),
{name}_voc AS (SELECT DISTINCT w FROM {name}_tok),
{name}_cls AS (SELECT label, ln(count(*) + 1.0) - ln((SELECT count(*) FROM docs WHERE part IN ({parts})) + 2.0) AS prior FROM docs WHERE part IN ({parts}) GROUP BY 1),
{name}_tot AS (SELECT c.label, count(t.w) + (SELECT count(*) FROM {name}_voc) AS total FROM {name}_cls c LEFT JOIN {name}_tok t ON t.label = c.label GROUP BY 1),
{name}_cnt AS (SELECT label, w, count(*) AS n FROM {name}_tok GROUP BY 1, 2),
{name}_test AS (SELECT t.doc_id, c.label, sum(ln(coalesce(n.n, 0) + 1.0) - ln(CAST(tt.total AS DOUBLE))) AS ll
  FROM tok t JOIN {name}_voc v ON v.w = t.w CROSS JOIN {name}_cls c JOIN {name}_tot tt ON tt.label = c.label LEFT JOIN {name}_cnt n ON n.label = c.label AND n.w = t.w WHERE t.part = 2 GROUP BY 1, 2),
{name}_best AS (SELECT d.doc_id, d.label AS want, arg_max(c.label, c.prior + coalesce(x.ll, 0)) AS got FROM docs d CROSS JOIN {name}_cls c
  LEFT JOIN {name}_test x ON x.doc_id = d.doc_id AND x.label = c.label WHERE d.part = 2 GROUP BY 1, 2)"""


@query("m20_sentiment", lambda: f"""
WITH docs AS (SELECT doc_id, label, text, CASE WHEN r <= floor(n * CAST(0.6 AS DOUBLE)) THEN 0 WHEN r <= floor(n * CAST(0.7 AS DOUBLE)) THEN 1 ELSE 2 END AS part FROM (
  SELECT l.doc_id, CAST(l.quality AS VARCHAR) AS label, d.text, row_number() OVER (ORDER BY md5('42:' || l.doc_id), l.doc_id) AS r, count(*) OVER () AS n
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)),
tok AS (SELECT doc_id, label, part, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS w FROM docs),
{_bayes_sql("a", "0")}, {_bayes_sql("b", "0, 1")}
SELECT 'base' AS training, round(avg(CAST(want = got AS INTEGER)), 6) AS accuracy FROM a_best
UNION ALL SELECT 'extended', round(avg(CAST(want = got AS INTEGER)), 6) FROM b_best""")
def m20(spark, sf):
    parts = rel.rank_split(labelled_documents(spark, sf), "doc_id", [0.6, 0.1, 0.3]).select("doc_id", "text", "label", "part")
    train, extra, test = (parts.filter(F.col("part") == i).select("doc_id", "text", "label") for i in range(3))
    return textmodels.sentiment_before_and_after(train, extra, test, "doc_id").withColumn("accuracy", F.round("accuracy", 6))


def intent_rows(spark, sf):
    """Language detection stands in for intents: a message is a whole document."""
    tokens = text.keywords(F.col("text"), text.stopwords())
    docs = v.texts(spark, sf).select("doc_id", F.col("lang").alias("tag"), tokens.alias("tokens"))
    return textmodels.stemmed(docs.filter(F.size("tokens") > 0))


@query("m22_intent_model")
def m22(spark, sf):
    parts = rel.rank_split(intent_rows(spark, sf), "doc_id", [0.7, 0.3], ["tag"])
    model = textmodels.train_intent(parts.filter("part = 0").select("tag", "tokens"), max_iter=50)
    out = textmodels.predict_intent(model, parts.filter("part = 1").select("doc_id", "tag", "tokens"))
    return out.select("doc_id", "tag", "intent", F.round("confidence", 4).alias("confidence"))


@query("m23_cross_validation")
def m23(spark, sf):
    return textmodels.cross_validated_accuracy(intent_rows(spark, sf), "doc_id", folds=5, max_iter=20)


@query("m34_responses")
def m34(spark, sf):
    rows = intent_rows(spark, sf)
    model = textmodels.train_intent(rows.select("tag", "tokens"))
    out = textmodels.predict_intent(model, rows.select("doc_id", "tokens"))
    answers = out.select(F.col("intent")).distinct().withColumn("responses", F.array(F.concat(F.lit("1:"), "intent"), F.concat(F.lit("2:"), "intent")))
    return out.join(F.broadcast(answers), "intent", "left").select(
        "doc_id", "intent", textmodels.pick_response(F.col("responses"), F.col("doc_id")).alias("response"))


# ---- delays ---------------------------------------------------------------------------------

FLIGHT_COLS = ["month", "day_of_week", "dep_hour", "distance", "is_holiday", "awnd_o", "prcp_o", "tavg_o", "snow_o", "awnd_d", "prcp_d", "tavg_d", "snow_d"]


def flight_rows(spark, sf):
    f = flights.flight_features(v.flights(spark, sf), v.daily_weather(spark, sf)).fillna(0.0)
    encoded = rel.one_hot(f, ["airline"], drop_first=True)
    hot = [c for c in encoded.columns if c.startswith("airline_")]
    key = F.concat_ws("-", "flight_id", "leg", "plane")
    rows = cut_lineage(models.assembled(encoded.withColumn("key", key), [*FLIGHT_COLS, *hot], "is_delay", keep=["key"]))
    parts = rel.rank_split(rows, "key", [0.8, 0.1, 0.1], ["label"])
    return [parts.filter(F.col("part") == i).drop("part") for i in range(3)]


def _judge(scored):
    cm = evaluate.rates(evaluate.confusion(scored.withColumn("y", F.col("label").cast("int")), "y", "predicted"))
    auc = evaluate.roc_auc(scored.withColumn("y", F.col("label").cast("int")), "y", "score")
    return cm.withColumn("auc", F.round(auc.select("auc").scalar(), 4))


@query("m27_linear_classifier")
def m27(spark, sf):
    train, valid, _ = flight_rows(spark, sf)
    return _judge(models.batch_predict(models.fit(models.linear_classifier(), train), valid))


@query("m28_boosted_trees")
def m28(spark, sf):
    train, _, test = flight_rows(spark, sf)
    model = models.fit(models.boosted_classifier(), train)
    return models.batch_predict(model, test).select("key", "label", F.round("score", 4).alias("score"), "predicted")


@query("m29_tuning")
def m29(spark, sf):
    train, valid, _ = flight_rows(spark, sf)
    _, board = models.tune_boosted(train, valid)
    return spark.createDataFrame(board, "job int, params string, auc double")


@query("m30_forest_classifier")
def m30(spark, sf):
    rows = v.table(spark, sf, "part").select(
        "p_partkey", "p_size", "p_retailprice", F.length("p_name").alias("n"),
        (((F.col("p_size") < 5) & (F.col("p_retailprice") < 1500)) | (F.col("p_type") == "PROMO")).cast("int").alias("label"))
    parts = rel.rank_split(rows, "p_partkey", [0.7, 0.3]).cache()
    model = models.forest_classifier(["p_size", "p_retailprice", "n"], "label", trees=100)
    model = models.fit(model, parts.filter("part = 0"))
    scored = model.transform(parts.filter("part = 1")).withColumn("predicted", F.col("prediction").cast("int"))
    return evaluate.classification_report(scored, "label", "predicted")


LEVELS = {"year": range(1995, 2002), "quarter": range(1, 5), "month": range(1, 13), "day_of_month": range(1, 32), "day_of_week": range(1, 8),
          "airline": range(1, 6), "origin": range(25), "dest": range(25), "is_holiday": range(2)}


@query("m32_encoded_flights", lambda: """
WITH dw AS (SELECT day, place, awnd, prcp, coalesce(snow, CAST(0 AS DOUBLE)) AS snow, coalesce(tavg, avg(tavg) OVER (PARTITION BY month(day), place)) AS tavg FROM daily_weather),
f AS (SELECT f.*, year(f.day) AS year, quarter(f.day) AS quarter, month(f.day) AS month, day(f.day) AS day_of_month, isodow(f.day) AS day_of_week,
             f.dep_time // 100 AS dep_hour, 0 AS is_holiday FROM flights f)
SELECT f.flight_id, f.leg, f.plane, f.distance, f.is_delay, f.dep_hour, o.awnd AS awnd_o, d.snow AS snow_d, """ + ", ".join(
    f"CASE WHEN {c} = {x} THEN 1 ELSE 0 END AS {c}_{x}" for c, xs in LEVELS.items() for x in list(xs)[1:]) + """
FROM f LEFT JOIN dw o ON f.day = o.day AND f.origin = o.place LEFT JOIN dw d ON f.day = d.day AND f.dest = d.place""", "flights daily_weather")
def m32(spark, sf):
    f = flights.flight_features(v.flights(spark, sf), v.daily_weather(spark, sf))
    out = flights.encoded(f, LEVELS)
    return out.select("flight_id", "leg", "plane", "distance", "is_delay", "dep_hour", "awnd_o", "snow_d", *[f"{c}_{x}" for c, xs in LEVELS.items() for x in list(xs)[1:]])
