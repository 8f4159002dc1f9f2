"""S*: scans and sinks. Each query writes what it scans into a new folder below the shared one."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from tidemill.operators import sensors
from tidemill.plans import views as v
from tidemill.plans.registry import query
from tidemill.session import run_dir
from tidemill.sources import pages, readers, writers

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("s1_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s1(spark, sf):
    out = run_dir(spark, "s1")
    v.table(spark, sf, "customer").write.option("header", True).csv(out)
    return readers.read_csv(spark, out, CUSTOMER)


@query("s2_headerless_csv", """
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size > 9 THEN p_type END AS kind FROM part""")
def s2(spark, sf):
    out = run_dir(spark, "s2")
    kind = F.when(F.col("p_size") > 9, F.col("p_type")).otherwise("?")
    v.table(spark, sf, "part").select("p_partkey", kind.alias("kind")).write.option("header", False).csv(out)
    return readers.read_csv_named(spark, out, ["id", "kind"])


@query("s3_combine_csv", """
SELECT flight_id, leg, plane, origin, dest, airline, CAST(distance AS DOUBLE) AS distance FROM flights WHERE origin IN (1, 2, 3) AND dest IN (4, 5, 6) AND airline IN (1, 2)""", "flights")
def s3(spark, sf):
    out = run_dir(spark, "s3")
    f = v.flights(spark, sf).select("flight_id", "leg", "plane", "origin", "dest", "airline", "distance", "day", "dep_time")
    for y in (0, 1):
        f.filter(F.year("day") % 2 == y).write.option("header", True).csv(f"{out}/{y}")
    schema = "flight_id bigint, leg int, plane bigint, origin int, dest int, airline int, distance double, day date, dep_time int"
    combined = readers.combine_csv(
        spark, [f"{out}/0", f"{out}/1"], schema, ["flight_id", "leg", "plane", "origin", "dest", "airline", "distance"],
        {"origin": [1, 2, 3], "dest": [4, 5, 6], "airline": [1, 2]})
    writers.write_results({"combined": combined}, out)
    return readers.read_csv(spark, f"{out}/combined", "flight_id bigint, leg int, plane bigint, origin int, dest int, airline int, distance double")


@query("s4_parquet_batches", "SELECT event_id, maquina_id, temperatura FROM readings", "readings")
def s4(spark, sf):
    out = run_dir(spark, "s4")
    r = v.readings(spark, sf).select("event_id", "maquina_id", "temperatura")
    writers.write_batches(r.filter("event_id % 2 = 0"), out, 1000)
    writers.write_batches(r.filter("event_id % 2 = 1"), out, 1000)
    return spark.read.parquet(out)


INTENTS_SQL = "SELECT lower(p_type) AS tag, p_name AS pattern FROM (SELECT DISTINCT p_type, p_name FROM part)"


@query("s6_nested_intents", INTENTS_SQL)
def s6(spark, sf):
    out = run_dir(spark, "s6")
    _intents_doc(spark, sf).coalesce(1).write.json(out)
    return readers.read_intents(spark, out).select("tag", F.explode("patterns").alias("pattern"))


def _intents_doc(spark, sf):
    """One nested document; its lists hold distinct names, of which there are a few dozen."""
    names = v.table(spark, sf, "part").select("p_type", "p_name").distinct()
    per_tag = names.groupBy(F.lower("p_type").alias("tag")).agg(
        F.max("p_type").alias("description"), F.sort_array(F.collect_list("p_name")).alias("patterns"),
        F.array(F.lit("uno"), F.lit("dos")).alias("responses"))
    one = F.struct("tag", "description", "patterns", "responses")
    return per_tag.agg(F.sort_array(F.collect_list(one)).alias("intents"))


@query("s7_json_lines", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def s7(spark, sf):
    out = run_dir(spark, "s7")
    v.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").write.json(out)
    return readers.read_json_lines(spark, out, "o_orderkey bigint, o_orderstatus string, o_totalprice double")


def _name(label: str) -> str:
    return f"tidemill_{label}_{uuid.uuid4().hex[:12]}"


@query("s8_table_scan", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def s8(spark, sf):
    name = _name("s8")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    writers.write_table(v.table(spark, sf, "orders").select("o_orderkey", day), name, path=run_dir(spark, "s8"))
    return readers.read_table(spark, name, ["o_orderdate"])


@query("s9_table_write", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def s9(spark, sf):
    name, s = _name("s9"), v.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    writers.write_table(s.limit(0), name, "fail", path=run_dir(spark, "s9"))
    writers.write_table(s, name, "append")
    writers.write_table(s, name, "append")
    return spark.table(name)


@query("s10_result_files", """
SELECT category, CAST(count(*) AS BIGINT) AS n FROM products GROUP BY 1""", "products")
def s10(spark, sf):
    out = run_dir(spark, "s10")
    writers.write_results({"by_category": v.products(spark, sf).groupBy("category").agg(F.count("*").alias("n"))}, out)
    return readers.read_csv(spark, f"{out}/by_category", "category string, n bigint")


@query("s11_training_file", "SELECT quality AS label, CAST(doc_id AS DOUBLE) AS f0, CAST(toxic AS DOUBLE) AS f1 FROM labels")
def s11(spark, sf):
    out = run_dir(spark, "s11")
    rows = v.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"), "toxic")
    writers.write_ml_csv(rows, out, "label")
    return readers.read_csv(spark, out, "label int, f0 double, f1 double", header=False)


DOCS_SQL = """
SELECT strftime(s.sale_date, '%Y-%m-%d') AS sale_date, s.product_id, s.store_id, s.units_sold, coalesce(p.name, '') AS product_name, coalesce(p.category, '') AS category
FROM sales s LEFT JOIN (SELECT * FROM products WHERE size > 10) p ON s.product_id = p.product_id"""


@query("s12_documents", DOCS_SQL, "sales products")
def s12(spark, sf):
    out = run_dir(spark, "s12")
    docs = writers.documents(v.sales(spark, sf), v.products(spark, sf).filter("size > 10"))
    writers.export_documents(docs.select("sale_date", "product_id", "store_id", "units_sold", "product_name", "category"), out)
    return readers.read_json_lines(
        spark, out, "sale_date string, product_id bigint, store_id bigint, units_sold bigint, product_name string, category string")


POINTS = ["temperatura", "vibracion", "velocidad_rpm", "consumo_kw", "presion_bar", "error_code"]


@query("s15_points", "\nUNION ALL ".join(
    f"SELECT event_id, maquina_id, CASE WHEN temperatura > 95 THEN 'true' ELSE 'false' END AS es_anomalia, '{f}' AS field, CAST({f} AS DOUBLE) AS value FROM readings WHERE {f} IS NOT NULL"
    for f in POINTS) + """
UNION ALL SELECT event_id, maquina_id, CASE WHEN temperatura > 95 THEN 'true' ELSE 'false' END, 'anomalia_flag', CASE WHEN temperatura > 95 THEN CAST(1 AS DOUBLE) ELSE 0 END FROM readings""", "readings")
def s15(spark, sf):
    r = v.readings(spark, sf).withColumn("es_anomalia", F.col("temperatura") > 95)
    # the event number rides along in the machine tag, since times alone are no key
    tagged = r.withColumn("maquina_id", F.concat_ws("|", "event_id", "maquina_id"))
    tag = F.split("maquina_id", "\\|")
    return sensors.to_points(tagged).select(tag[0].cast("bigint").alias("event_id"), tag[1].alias("maquina_id"), "es_anomalia", "field", "value")


@query("s16_flush_sizes", "SELECT count(*) AS n_rows, true AS all_within_100 FROM readings", "readings")
def s16(spark, sf):
    out = run_dir(spark, "s16")
    writers.write_batches(v.readings(spark, sf).select("event_id", "temperatura"), out, 100)
    per_file = spark.read.parquet(out).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 100).alias("all_within_100"))


@query("s16_anomaly_flush", """
SELECT count(*) AS n_rows, true AS all_within_10, CAST(sum(error_code) AS BIGINT) AS codes FROM readings WHERE error_code > 0 OR temperatura > 95""", "readings")
def s16_anomalies(spark, sf):
    out = run_dir(spark, "s16")
    r = v.readings(spark, sf).filter((F.col("error_code") > 0) | (F.col("temperatura") > 95)).select("event_id", "error_code")
    writers.write_batches(r, out, 10)
    per_file = spark.read.parquet(out).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.sum("error_code").alias("codes"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 10).alias("all_within_10"), F.sum("codes").alias("codes"))


@query("s17_append_new_keys", "SELECT c_custkey, c_name FROM customer")
def s17(spark, sf):
    out, c = run_dir(spark, "s17"), v.table(spark, sf, "customer").select("c_custkey", "c_name")
    writers.append_new(c.filter("c_custkey % 3 = 0"), out, ["c_custkey"])
    writers.append_new(c, out, ["c_custkey"])
    writers.append_new(c, out, ["c_custkey"])
    return spark.read.parquet(out)


@query("s18_text_table", "SELECT CAST(event_id AS VARCHAR) AS event_id, maquina_id, CAST(error_code AS VARCHAR) AS error_code FROM readings", "readings")
def s18(spark, sf):
    out = run_dir(spark, "s18")
    writers.overwrite_as_text(v.readings(spark, sf).select("event_id", "maquina_id", "error_code"), out)
    return readers.read_csv(spark, out, "event_id string, maquina_id string, error_code string")


@query("s19_arff_scan", """
SELECT CAST(vec_id AS VARCHAR) AS id, CAST(label AS VARCHAR) AS label, CASE WHEN label % 2 = 0 THEN 'Abnormal' ELSE 'Normal' END AS "class" FROM embeddings""")
def s19(spark, sf):
    out = run_dir(spark, "s19")
    name = F.when(F.col("label") % 2 == 0, "'Abnormal'").otherwise("Normal")
    head = spark.createDataFrame(
        [(i, x) for i, x in enumerate(["@relation points", "@attribute id numeric", "@attribute 'label' numeric", "@attribute class {Abnormal,Normal}", "@data"])],
        "place int, value string").coalesce(1).orderBy("place").select("value")
    head.write.mode("append").text(out)
    v.table(spark, sf, "embeddings").select(F.concat_ws(",", "vec_id", "label", name).alias("value")).write.mode("append").text(out)
    return readers.read_arff(spark, out)


@query("s20_zipped_csv", """
SELECT c_custkey, c_name, c_nationkey FROM customer""")
def s20(spark, sf):
    good, _bad = readers.zipped_csv(_archives(spark, sf), "c_custkey bigint, c_name string, c_nationkey int")
    return good.drop("member")


@query("s20_bad_archives", "SELECT count(DISTINCT c_nationkey) AS n_bad FROM customer")
def s20_bad(spark, sf):
    _good, bad = readers.zipped_csv(_archives(spark, sf), "c_custkey bigint, c_name string, c_nationkey int")
    return bad.agg(F.count("*").alias("n_bad"))


def _archives(spark, sf):
    """Customers packed into zip archives of at most 1000 rows, and one broken archive per nation."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            z.writestr("part.csv", "c_custkey,c_name,c_nationkey\n" + "\n".join(
                f"{a},{b},{c}" for a, b, c in zip(pdf["c_custkey"], pdf["c_name"], pdf["c_nationkey"])))
        return pd.DataFrame({"path": [f"{pdf['part'].iloc[0]}.zip"], "content": [buf.getvalue()]})

    c = v.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", F.floor(F.col("c_custkey") / 1000).alias("part"))
    good = c.groupBy("part").applyInPandas(pack, "path string, content binary")
    bad = c.select(F.concat(F.lit("bad"), "c_nationkey").alias("path"), F.encode(F.lit("no archive"), "utf-8").alias("content")).distinct()
    return good.unionByName(bad)


@query("s21_object_store_csv", "SELECT s_suppkey, s_acctbal FROM supplier")
def s21(spark, sf):
    # the reader takes any URL Spark knows; the shared folder's own scheme stands in for an object store
    out = run_dir(spark, "s21")
    v.table(spark, sf, "supplier").select("s_suppkey", "s_acctbal").write.option("header", True).csv(out)
    return readers.read_csv(spark, [out], "s_suppkey bigint, s_acctbal double")


@query("s22_ensure_table", "SELECT maquina_id, event_id FROM readings", "readings")
def s22(spark, sf):
    name, out = _name("s22"), run_dir(spark, "s22")
    for _ in range(2):
        writers.ensure_table(spark, name, "maquina_id string, event_id bigint, day date", ["day"], out)
    rows = v.readings(spark, sf).select("maquina_id", "event_id", F.col("ts").cast("date").alias("day"))
    rows.repartition("day").write.insertInto(name)
    return spark.table(name).select("maquina_id", "event_id")


@query("s24_inline_rows", """
SELECT n_name, code FROM nation JOIN (VALUES (0, 'AF'), (1, 'AM'), (2, 'AS'), (3, 'EU'), (4, 'ME')) r(k, code) ON n_regionkey = k""")
def s24(spark, sf):
    r = spark.createDataFrame([(0, "AF"), (1, "AM"), (2, "AS"), (3, "EU"), (4, "ME")], "k int, code string")
    return v.table(spark, sf, "nation").join(F.broadcast(r), F.col("n_regionkey") == F.col("k")).select("n_name", "code")


def item_pages(spark, sf):
    """Catalogue pages of 20 items each, written from the parts."""
    stars = F.element_at(F.array(*[F.lit(w) for w in ("Zero", "One", "Two", "Three", "Four", "Five")]), F.col("p_size") % 6 + 1)
    item = F.concat(
        F.lit('<article class="product_pod"><p class="star-rating '), stars, F.lit('"></p><h3><a href="x" title="'), "p_name", F.lit(" "), "p_partkey",
        F.lit('">..</a></h3><p class="price_color">Â£'), F.col("p_retailprice").cast("string"),
        F.lit('</p><p class="instock availability">\n <i class="icon-ok"></i>\n  In stock\n</p></article>'))
    part = v.table(spark, sf, "part").select(F.floor(F.col("p_partkey") / 20).alias("page_id"), F.struct("p_partkey", item.alias("h")).alias("i"))
    return part.groupBy("page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("i")), lambda x: x["h"]), "\n").alias("html"))


@query("s25_page_items", """
SELECT p_partkey // 20 AS page_id, p_name || ' ' || p_partkey AS titulo, p_retailprice AS precio, p_size % 6 AS rating, 'In stock' AS disponibilidad, '2024-01-01' AS fecha_extraccion FROM part""")
def s25(spark, sf):
    return pages.extract_items(item_pages(spark, sf), stamp=F.lit("2024-01-01"))


@query("s25_page_titles", """
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<html lang="([a-z]*)"', 1) AS lang,
       len(regexp_extract_all(html, '<p>')) AS n_paragraphs FROM pages""")
def s25_titles(spark, sf):
    h = F.col("html")
    return v.table(spark, sf, "pages").select(
        "page_id", F.regexp_extract(h, "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract(h, '<html lang="([a-z]*)"', 1).alias("lang"),
        F.regexp_count(h, F.lit("<p>")).cast("bigint").alias("n_paragraphs"))


SITE = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
FOLDER = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '([^/:])/[^/]*$', '\\1')"
ABSOLUTE = f"CASE WHEN href = '' THEN NULL WHEN regexp_matches(href, '^https?://') THEN href WHEN starts_with(href, '/') THEN {SITE} || href ELSE {FOLDER} || '/' || href END"


@query("s26_next_page", f"""
SELECT page_id, {ABSOLUTE} AS next_url FROM (SELECT *, regexp_extract(html, '<li><a[^>]*\\bhref="([^"]*)"', 1) AS href FROM pages)""")
def s26(spark, sf):
    return pages.next_url(v.table(spark, sf, "pages"), pattern=r'<li><a[^>]*\bhref="([^"]*)"').select("page_id", "next_url")


@query("s26_links", f"""
WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a[^>]*\\bhref="([^"]*)"', 1)) AS href FROM pages)
SELECT page_id, coalesce({ABSOLUTE}, {FOLDER} || '/') AS link FROM l""")
def s26_links(spark, sf):
    return pages.links(v.table(spark, sf, "pages")).select("page_id", "link")


@query("s27_metrics_row", "SELECT count(*) AS n_users, round(avg(c_acctbal), 4) AS mean_balance FROM customer")
def s27(spark, sf):
    out = run_dir(spark, "s27")
    c = v.table(spark, sf, "customer")
    writers.store_single_row(c.agg(F.lit(0).cast("bigint").alias("n_users"), F.lit(0.0).alias("mean_balance")), out)
    writers.store_single_row(c.agg(F.count("*").alias("n_users"), F.round(F.avg("c_acctbal"), 4).alias("mean_balance")), out)
    return spark.read.parquet(out)
