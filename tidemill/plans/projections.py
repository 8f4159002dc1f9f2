"""P*: projections, filters, recodes, imputation and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.numbers import round_half_up
from tidemill.functions.text import format_id
from tidemill.operators import aggregates as agg
from tidemill.operators import clustering, flights, sensors, series
from tidemill.operators import models as ml
from tidemill.operators import relational as rel
from tidemill.plans import views as v
from tidemill.plans.registry import query


@query("p1_select_columns", "SELECT l_returnflag, l_orderkey, l_quantity FROM lineitem")
def p1(spark, sf):
    return v.table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_quantity")


@query("p2_computed_column", "SELECT p_partkey, p_retailprice * p_size AS total FROM part")
def p2(spark, sf):
    return v.table(spark, sf, "part").withColumn("total", F.col("p_retailprice") * F.col("p_size")).select("p_partkey", "total")


@query("p3_casts", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS qty, CAST(l_shipdate AS DATE) AS day, CAST(l_partkey AS DOUBLE) AS part FROM lineitem")
def p3(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("qty"), F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_partkey").cast("double").alias("part"))


@query("p4_coercing_cast", """
SELECT p_partkey, CAST(TRY_CAST(raw AS DOUBLE) AS DOUBLE) AS raw FROM (
  SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) || '.5' END AS raw FROM part)
WHERE TRY_CAST(raw AS DOUBLE) IS NOT NULL""")
def p4(spark, sf):
    raw = F.when(F.col("p_size") % 7 == 0, "n/a").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5")))
    return rel.coerce(v.table(spark, sf, "part").select("p_partkey", raw.alias("raw")), {"raw": "double"})


@query("p5_rename_and_drop", "SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer")
def p5(spark, sf):
    return v.table(spark, sf, "customer").withColumnsRenamed({"c_custkey": "customer_id", "c_mktsegment": "segment"}).drop(
        "c_name", "c_nationkey", "c_acctbal")


@query("p6_optional_filters", """
SELECT sale_date, product_id, store_id, units_sold FROM sales WHERE store_id = 0 AND sale_date >= DATE '1996-01-01' AND sale_date <= DATE '1996-12-31'""", "sales")
def p6(spark, sf):
    out = rel.optional_filters(v.sales(spark, sf), {"product_id": None, "store_id": 0}, "sale_date", "1996-01-01", "1996-12-31")
    return out.select("sale_date", "product_id", "store_id", "units_sold")


@query("p7_equals_ignoring_case", "SELECT p_partkey FROM part WHERE lower(p_type) = lower('Economy')")
def p7(spark, sf):
    return v.table(spark, sf, "part").filter(rel.equals_ignoring_case("p_type", "Economy")).select("p_partkey")


@query("p8_date_range", "SELECT count(*) AS n, min(o_orderkey) AS first_key FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30'")
def p8(spark, sf):
    inside = F.col("o_orderdate").between(F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1997-06-30").cast("timestamp_ntz"))
    return v.table(spark, sf, "orders").filter(inside).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query("p9_in_list", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('P')")
def p9(spark, sf):
    o = v.table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_orderstatus").isin("P"))
    return o.select("o_orderkey", "o_orderpriority")


@query("p10_having_count", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 12)""")
def p10(spark, sf):
    return rel.having_count(v.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 12)


@query("p11_drop_nulls", "SELECT event_id, presion_bar FROM readings WHERE presion_bar IS NOT NULL", "readings")
def p11(spark, sf):
    return v.readings(spark, sf).dropna(subset=["presion_bar"]).select("event_id", "presion_bar")


@query("p11_drop_null_columns", "SELECT event_id, maquina_id FROM readings", "readings")
def p11_columns(spark, sf):
    return rel.drop_null_columns(v.readings(spark, sf).select("event_id", "maquina_id", "presion_bar"))


RULES_SQL = """
rules AS (
  SELECT event_id, maquina_id, 'UMBRAL_ALTO_TEMPERATURA' AS tipo_anomalia, 'temperatura' AS campo, temperatura AS valor, CAST(95.0 AS DOUBLE) AS umbral FROM readings WHERE temperatura > 95.0
  UNION ALL SELECT event_id, maquina_id, 'UMBRAL_ALTO_VIBRACION', 'vibracion', vibracion, 4.5 FROM readings WHERE vibracion > 4.5
  UNION ALL SELECT event_id, maquina_id, 'UMBRAL_ALTO_CONSUMO_KW', 'consumo_kw', consumo_kw, 70.0 FROM readings WHERE consumo_kw > 70.0
  UNION ALL SELECT event_id, maquina_id, 'UMBRAL_BAJO_PRESION_BAR', 'presion_bar', presion_bar, 2.5 FROM readings WHERE presion_bar < 2.5)"""


@query("p12_threshold_rules", f"WITH {RULES_SQL} SELECT * FROM rules", "readings")
def p12(spark, sf):
    return sensors.detect_rules(v.readings(spark, sf)).select("event_id", "maquina_id", "tipo_anomalia", "campo", "valor", "umbral")


@query("p12_threshold_rules_missing_as_zero", f"""
WITH {RULES_SQL} SELECT event_id, tipo_anomalia, valor FROM rules
UNION ALL SELECT event_id, 'UMBRAL_BAJO_PRESION_BAR', CAST(0.0 AS DOUBLE) FROM readings WHERE presion_bar IS NULL""", "readings")
def p12_zero(spark, sf):
    return sensors.detect_rules(v.readings(spark, sf), missing_as_zero=True).select("event_id", "tipo_anomalia", "valor")


BASELINE_SQL = """
filled AS (SELECT event_id, coalesce(temperatura, 75.0) AS f0, coalesce(vibracion, 2.5) AS f1, coalesce(velocidad_rpm, 1500.0) AS f2,
                  coalesce(consumo_kw, 45.0) AS f3, coalesce(presion_bar, 6.0) AS f4 FROM readings),
st AS (SELECT avg(f0) m0, avg(f1) m1, avg(f2) m2, avg(f3) m3, avg(f4) m4, stddev_pop(f0) s0, stddev_pop(f1) s1, stddev_pop(f2) s2,
              stddev_pop(f3) s3, stddev_pop(f4) s4 FROM filled),
dist AS (SELECT event_id, sqrt(((f0 - m0) / s0) ** 2 + ((f1 - m1) / s1) ** 2 + ((f2 - m2) / s2) ** 2 + ((f3 - m3) / s3) ** 2 + ((f4 - m4) / s4) ** 2) AS d
         FROM filled, st),
lim AS (SELECT quantile_cont(d, 0.95) AS t FROM dist)"""


@query("p13_combined_flag", f"""
WITH {RULES_SQL}, {BASELINE_SQL}
SELECT d.event_id, coalesce(r.n, 0) AS n_rules, d.d > lim.t AS ml_anomaly, coalesce(r.n, 0) > 0 OR d.d > lim.t AS es_anomalia,
       CASE WHEN coalesce(r.n, 0) > 0 THEN r.n WHEN d.d > lim.t THEN 1 ELSE 0 END AS n_events
FROM dist d CROSS JOIN lim LEFT JOIN (SELECT event_id, count(*) AS n FROM rules GROUP BY 1) r ON d.event_id = r.event_id""", "readings")
def p13(spark, sf):
    from tidemill.streaming.jobs import flagged

    r = v.readings(spark, sf)
    out = flagged(r, clustering.fit_baseline_detector(r))
    return out.select("event_id", "n_rules", "ml_anomaly", "es_anomalia", F.size("events").alias("n_events"))


@query("p14_machine_state", f"""
WITH {RULES_SQL}
SELECT r.event_id, CASE WHEN r.temperatura > 95.0 THEN 'critico' WHEN r.event_id IN (SELECT event_id FROM rules) THEN 'advertencia' ELSE 'normal' END AS estado
FROM readings r""", "readings")
def p14(spark, sf):
    r = v.readings(spark, sf).withColumn("es_anomalia", F.size(sensors.rule_events()) > 0)
    return r.select("event_id", sensors.machine_state().alias("estado"))


@query("p15_binarize", "SELECT doc_id, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS p50, CASE WHEN score > 0.65 THEN 1 ELSE 0 END AS p65 FROM scored", "scored")
def p15(spark, sf):
    s = v.scored(spark, sf)
    return s.select("doc_id", ml.binarize(F.col("score"), 0.5).alias("p50"), ml.binarize(F.col("score"), 0.65).alias("p65"))


@query("p16_confidence_gate", "SELECT doc_id, CASE WHEN score < 0.35 THEN 'desconocido' ELSE lang END AS intent FROM scored", "scored")
def p16(spark, sf):
    from tidemill.operators.textmodels import gate

    return v.scored(spark, sf).select("doc_id", gate(F.col("lang"), F.col("score")).alias("intent"))


@query("p17_recode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 4 ELSE 0 END AS doors,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' ELSE o_orderpriority END AS priority FROM orders""")
def p17(spark, sf):
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        rel.recode(F.col("o_orderstatus"), {"F": 2, "O": 4}, F.lit(0)).alias("doors"),
        rel.recode(F.col("o_orderpriority"), {"1-URGENT": "urgent", "2-HIGH": "high"}, F.col("o_orderpriority")).alias("priority"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("p18_one_hot_all", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS c_mktsegment_{s}" for s in SEGMENTS) + " FROM customer")
def p18(spark, sf):
    return rel.one_hot(v.table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query("p18_one_hot_drop_first", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS c_mktsegment_{s}" for s in SEGMENTS[1:]) + " FROM customer")
def p18_drop(spark, sf):
    return rel.one_hot(v.table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"], drop_first=True)


@query("p19_undo_one_hot", "SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'BUILDING' ELSE c_mktsegment END AS segment FROM customer")
def p19(spark, sf):
    encoded = p18_drop(spark, sf)
    cols = [c for c in encoded.columns if c != "c_custkey"]
    return encoded.select("c_custkey", rel.undo_one_hot(cols, "c_mktsegment_").alias("segment"))


@query("p20_cut", """
SELECT p_partkey, CASE WHEN p_size > 1 AND p_size <= 10 THEN '1-10' WHEN p_size > 10 AND p_size <= 25 THEN '10-25'
       WHEN p_size > 25 AND p_size <= 50 THEN '25-50' END AS size_range FROM part""")
def p20(spark, sf):
    return v.table(spark, sf, "part").select("p_partkey", rel.cut(F.col("p_size"), [1, 10, 25, 50], ["1-10", "10-25", "25-50"]).alias("size_range"))


@query("p21_clamp", """
SELECT c_custkey, greatest(CAST(0 AS DOUBLE), c_acctbal) AS floored, least(CAST(5000 AS DOUBLE), greatest(CAST(1 AS DOUBLE), c_acctbal)) AS clipped, abs(c_acctbal) AS size FROM customer""")
def p21(spark, sf):
    x = F.col("c_acctbal")
    return v.table(spark, sf, "customer").select(
        "c_custkey", rel.clamp(x, low=0.0).alias("floored"), rel.clamp(x, 1.0, 5000.0).alias("clipped"), F.abs(x).alias("size"))


@query("p22_rule_label", """
SELECT p_partkey, CASE WHEN (p_size < 5 AND p_retailprice < 1000) OR p_type = 'PROMO' THEN 1 ELSE 0 END AS abandono FROM part""")
def p22(spark, sf):
    rule = ((F.col("p_size") < 5) & (F.col("p_retailprice") < 1000)) | (F.col("p_type") == "PROMO")
    return v.table(spark, sf, "part").select("p_partkey", rule.cast("int").alias("abandono"))


TEST_HOLIDAYS = ["1997-01-01", "1997-07-04", "1997-12-25", "1998-12-25"]


@query("p23_holiday", "SELECT o_orderkey, CASE WHEN strftime(o_orderdate, '%Y-%m-%d') IN ({}) THEN 1 ELSE 0 END AS is_holiday FROM orders".format(
    ", ".join(f"'{d}'" for d in fv.HOLIDAYS + TEST_HOLIDAYS)))
def p23(spark, sf):
    days = [*fv.HOLIDAYS, *TEST_HOLIDAYS]
    return v.table(spark, sf, "orders").select("o_orderkey", flights.is_holiday(F.col("o_orderdate"), days).alias("is_holiday"))


@query("p24_fill_nulls", "SELECT event_id, coalesce(presion_bar, CAST(6.0 AS DOUBLE)) AS presion_bar FROM readings", "readings")
def p24(spark, sf):
    return v.readings(spark, sf).fillna(6.0, subset=["presion_bar"]).select("event_id", "presion_bar")


@query("p25_impute_by_group", """
SELECT day, place, CAST(round(CAST(coalesce(tavg, avg(tavg) OVER (PARTITION BY month(day), place)) AS DECIMAL(28,8)), 4) AS DOUBLE) AS tavg, coalesce(snow, CAST(0 AS DOUBLE)) AS snow
FROM daily_weather""", "daily_weather")
def p25(spark, sf):
    return flights.clean_weather(v.daily_weather(spark, sf)).select("day", "place", round_half_up(F.col("tavg"), 4).alias("tavg"), "snow")


@query("p26_null_counts", "SELECT count(*) FILTER (presion_bar IS NULL) AS presion_bar, count(*) FILTER (temperatura IS NULL) AS temperatura FROM readings", "readings")
def p26(spark, sf):
    return rel.null_counts(v.readings(spark, sf).select("presion_bar", "temperatura"))


@query("p27_profile", "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS n, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
       quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3,
       CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in ("l_quantity", "l_linenumber", "l_tax")))
def p27(spark, sf):
    out = agg.profile(v.table(spark, sf, "lineitem"), ["l_quantity", "l_linenumber", "l_tax"])
    return out.select("column", "rows", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "q1", "median", "q3", "max")


@query("p28_point_lookup", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey = 42")
def p28(spark, sf):
    return rel.found(v.table(spark, sf, "customer").filter(F.col("c_custkey") == 42).select("c_custkey", "c_name", "c_mktsegment").limit(1), "customer 42")


@query("p29_sample", "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50")
def p29(spark, sf):
    return rel.sample_rows(v.table(spark, sf, "documents").select("doc_id"), "doc_id", 50)


@query("p30_mask", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal FROM customer")
def p30(spark, sf):
    return rel.mask(v.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"], lambda c: c > 0)


@query("p31_alert_flag", "SELECT c_custkey, CASE WHEN abs(c_acctbal / 100) >= 10 THEN 'SÍ' ELSE 'NO' END AS alerta FROM customer")
def p31(spark, sf):
    return v.table(spark, sf, "customer").select("c_custkey", series.alert_flag(F.col("c_acctbal") / 100).alias("alerta"))


def half_up(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


@query("p32_price_forecast", f"""
WITH p AS (SELECT *, {half_up("p_retailprice * (1 - (p_size % 4 * 5) / CAST(100 AS DOUBLE))", 4)} AS price FROM part)
SELECT p_partkey, price AS forecast_price, {half_up("p_size * price", 2)} AS predicted_revenue,
       {half_up("greatest(CAST(0 AS DOUBLE), p_size * CAST(0.85 AS DOUBLE))", 2)} AS confidence_lower,
       {half_up("p_size * CAST(1.15 AS DOUBLE)", 2)} AS confidence_upper FROM p""")
def p32(spark, sf):
    part = v.table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("units"), "p_retailprice", (F.col("p_size") % 4 * 5).alias("pct"))
    out = series.price_forecast(part, "units", "p_retailprice", "pct")
    return out.select("p_partkey", "forecast_price", "predicted_revenue", "confidence_lower", "confidence_upper")


@query("p33_deviation_rule", """
WITH n(maquina_id, nominal) AS (VALUES ('MAQ-001', 1480.0), ('MAQ-002', 1520.0), ('MAQ-003', 1500.0), ('MAQ-004', 1460.0), ('MAQ-005', 1550.0))
SELECT event_id, coalesce(abs(velocidad_rpm / CAST(nominal AS DOUBLE) - 1) > 0.05, false) AS rpm_off, error_code > 0 AS error_flag
FROM readings r LEFT JOIN n ON r.maquina_id = n.maquina_id""", "readings")
def p33(spark, sf):
    out = sensors.deviation_rule(v.readings(spark, sf), F.broadcast(sensors.nominal_table(spark)), 0.05)
    return out.select("event_id", "rpm_off", "error_flag")


@query("p34_slice_by_range", "SELECT day, airline, flight_id, leg FROM flights WHERE day BETWEEN DATE '1999-03-01' AND DATE '1999-03-31'", "flights")
def p34(spark, sf):
    day = F.col("day")
    return v.flights(spark, sf).filter(day.between(F.lit("1999-03-01").cast("date"), F.lit("1999-03-31").cast("date"))).select(
        "day", "airline", "flight_id", "leg")


@query("p34_slice_rows", "SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r FROM orders) WHERE r > 1000 AND r <= 1250")
def p34_rows(spark, sf):
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    grain = F.floor(F.col("o_totalprice") / 5000)
    return rel.slice_rows(o, 1000, 1250, [F.col("o_totalprice"), F.col("o_orderkey")], grain).select("o_orderkey", "o_custkey")


@query("f27_format_ids", "SELECT c_custkey, printf('U%04d', c_custkey) AS user_id FROM customer")
def f27(spark, sf):
    return v.table(spark, sf, "customer").select("c_custkey", format_id("U", F.col("c_custkey"), 4).alias("user_id"))
