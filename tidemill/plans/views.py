"""The domains of the library, derived from the shared tables: in Spark, and as SQL text for the twins.

Money is summed as decimals, so that sums do not depend on how rows were partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import format_id
from tidemill.operators.recommend import mean_ratings
from tidemill.operators.series import daily_series
from tidemill.session import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for costly work on each text."""
    return spread(table(spark, sf, "documents"))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order line."""
    amount = F.col("l_extendedprice").cast("decimal(12,2)")
    off = F.col("l_discount").cast("decimal(3,2)")
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("sale_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("bigint").alias("units_sold"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("unit_price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        (amount * (F.lit(1) - off)).cast("decimal(18,4)").alias("revenue"),
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("category"),
        F.col("p_type").alias("kind"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("base_price"),
    )


def stores(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    return table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), F.col("n_name").alias("city"),
        F.col("n_regionkey").alias("region_id"),
    )


def chain_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sales by brand and region, the shape of a small chain: at most brands x regions x days rows.

    The sums run map-side, so only that many rows leave each task; a part with a third of all lines is
    split by the skew join.
    """
    lines = sales(spark, sf).select("product_id", "store_id", "sale_date", "units_sold", "revenue", "discount_pct")
    brand = products(spark, sf).select("product_id", F.substring("category", 7, 5).cast("int").alias("brand"))
    region = stores(spark, sf).select("store_id", "region_id")
    rows = lines.join(brand, "product_id").join(region, "store_id").select(
        "sale_date", F.col("brand").alias("product_id"), F.col("region_id").alias("store_id"), "units_sold", "revenue", "discount_pct"
    )
    return daily_series(rows, ["store_id", "product_id"])


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """A monthly measure per region: order value and count stand in for temperature and rain."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    ).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    total = F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double")
    return orders.groupBy(
        F.col("n_regionkey").alias("store_id"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg((total / F.count("*") / 10000.0).alias("avg_temp_c"), F.count("*").cast("double").alias("rain_mm"))


def rating_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"), "l_quantity", "l_discount",
                                                "l_linenumber", "l_linestatus")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "user", "item", F.least(F.lit(5.0), F.lit(1.0) + F.col("l_quantity") / 12.5).alias("rating"),
        F.round(F.col("l_discount") * 1000).alias("progress"), F.col("l_linenumber").alias("sessions"),
        (F.col("l_quantity") * 2).alias("duration"), F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("completed"),
    )


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    return mean_ratings(rating_rows(spark, sf).select("user", "item", "rating"))


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    return rating_rows(spark, sf).join(
        products(spark, sf).select(F.col("product_id").alias("item"), "category"), "item"
    )


def user_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """The customer's market segment as a given cluster assignment."""
    segment = F.ascii("c_mktsegment") * 31 + F.length("c_mktsegment")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("user"), segment.alias("cluster"))


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor readings: five measures derived from each event's value and property."""
    return readings_of(spread(table(spark, sf, "events")))


def readings_of(events: DataFrame) -> DataFrame:
    """The same columns from any table or stream of events."""
    k = F.col("k")
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).select(
        "event_id",
        format_id("MAQ-", F.col("user_id"), 3).alias("maquina_id"),
        "ts",
        F.col("value").alias("temperatura"),
        (F.col("value") / 20.0).alias("vibracion"),
        (F.lit(1400.0) + 2 * k).alias("velocidad_rpm"),
        (F.lit(30.0) + k / 2.0).alias("consumo_kw"),
        F.when(F.col("event_type") != "error", k / 10.0).alias("presion_bar"),
        F.when(F.col("event_type") == "error", k).otherwise(0).alias("error_code"),
    )


def flights(spark: SparkSession, sf: str) -> DataFrame:
    """Each order line as a flight from the customer's nation to the supplier's."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    lines = lines.join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    day, ship = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    return lines.select(
        F.col("l_orderkey").alias("flight_id"), F.col("l_linenumber").alias("leg"), F.col("l_partkey").alias("plane"),
        day.alias("day"),
        (F.col("l_orderkey") % 24 * 100 + F.col("l_partkey") % 60).cast("int").alias("dep_time"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("airline"),
        F.col("c_nationkey").alias("origin"), F.col("s_nationkey").alias("dest"),
        F.col("l_quantity").alias("distance"),
        (F.datediff(ship, day) > 60).cast("int").alias("is_delay"),
    )


def daily_weather(spark: SparkSession, sf: str) -> DataFrame:
    """A daily measure per nation with gaps: snow and temperature are missing on some days."""
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    low = F.min("o_orderkey")
    mean = F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double") / F.count("*")
    return orders.groupBy(F.col("o_orderdate").cast("date").alias("day"), F.col("c_nationkey").alias("place")).agg(
        F.count("*").cast("double").alias("awnd"),
        F.max("o_custkey").cast("double").alias("prcp"),
        F.when(low % 5 != 0, mean).alias("tavg"),
        F.when(low % 2 != 0, (low % 10).cast("double")).alias("snow"),
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a score from their length."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "source", "lang")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        "doc_id", "source", "lang", F.col("quality").alias("label"), "toxic",
        (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("score"),
    )


# The words a derived dialogue uses, chosen by the length of each stored turn.
DIALOGUE_WORDS = ["mi wifi no va", "si", "no", "inicio", "pc lento", "ayuda", "quiero salir", "no enciende", "ok", "ni idea", "programa"]
DIALOGUE_INTENTS = {0: "problema_wifi", 4: "computadora_lenta", 7: "no_enciende"}


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Stored conversations with a message and intent derived from each turn's text."""
    return turns_of(table(spark, sf, "conversations"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """The same columns from any table or stream of conversations."""
    pick = (F.length("text") % len(DIALOGUE_WORDS)).cast("int")
    words = F.array(*[F.lit(w) for w in DIALOGUE_WORDS])
    intent = F.lit("otro")
    for i, name in DIALOGUE_INTENTS.items():
        intent = F.when(pick == i, F.lit(name)).otherwise(intent)
    return conversations.select("conv_id", "turn", "role", F.element_at(words, pick + 1).alias("message"), intent.alias("intent"))


# ---- the same views as SQL text -------------------------------------------------------------

VIEW_SQL = {
    "sales": """
        SELECT CAST(l_shipdate AS DATE) AS sale_date, l_partkey AS product_id, l_suppkey AS store_id,
               CAST(l_quantity AS BIGINT) AS units_sold,
               round(l_extendedprice / l_quantity, 2) AS unit_price,
               CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(18,4)) AS revenue
        FROM lineitem""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS name, p_brand AS category, p_type AS kind, p_size AS size,
               p_retailprice AS base_price FROM part""",
    "stores": """
        SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS city, n_regionkey AS region_id
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "chain_daily": """
        SELECT st.region_id AS store_id, CAST(substr(p.category, 7) AS INTEGER) AS product_id, s.sale_date,
               CAST(sum(s.units_sold) AS BIGINT) AS units_sold, sum(s.revenue) AS revenue,
               min(s.discount_pct) AS discount_pct,
               CAST(round(CAST(CAST(sum(s.revenue) AS DOUBLE) / sum(s.units_sold) AS DECIMAL(28,8)), 2) AS DOUBLE) AS unit_price
        FROM sales s JOIN products p ON s.product_id = p.product_id JOIN stores st ON s.store_id = st.store_id
        GROUP BY 1, 2, 3""",
    "weather": """
        SELECT n_regionkey AS store_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) / CAST(10000.0 AS DOUBLE) AS avg_temp_c,
               CAST(count(*) AS DOUBLE) AS rain_mm
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""",
    "rating_rows": """
        SELECT o_custkey AS "user", l_partkey AS item,
               least(CAST(5.0 AS DOUBLE), CAST(1.0 AS DOUBLE) + l_quantity / CAST(12.5 AS DOUBLE)) AS rating,
               round(l_discount * 1000) AS progress, l_linenumber AS sessions, l_quantity * 2 AS duration,
               CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS completed
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "ratings": """SELECT "user", item, avg(rating) AS rating FROM rating_rows GROUP BY 1, 2""",
    "interactions": """SELECT r.*, p.category FROM rating_rows r JOIN products p ON r.item = p.product_id""",
    "user_clusters": """SELECT c_custkey AS "user", ascii(c_mktsegment) * 31 + length(c_mktsegment) AS cluster FROM customer""",
    "readings": """
        SELECT event_id, printf('MAQ-%03d', user_id) AS maquina_id, ts,
               value AS temperatura, value / CAST(20.0 AS DOUBLE) AS vibracion,
               CAST(1400.0 AS DOUBLE) + 2 * k AS velocidad_rpm,
               CAST(30.0 AS DOUBLE) + k / CAST(2.0 AS DOUBLE) AS consumo_kw,
               CASE WHEN event_type <> 'error' THEN k / CAST(10.0 AS DOUBLE) END AS presion_bar,
               CASE WHEN event_type = 'error' THEN k ELSE 0 END AS error_code
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "flights": """
        SELECT l_orderkey AS flight_id, l_linenumber AS leg, l_partkey AS plane, CAST(o_orderdate AS DATE) AS day,
               CAST(l_orderkey % 24 * 100 + l_partkey % 60 AS INTEGER) AS dep_time,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS airline, c_nationkey AS origin, s_nationkey AS dest,
               l_quantity AS distance,
               CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) > 60 THEN 1 ELSE 0 END AS is_delay
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    "daily_weather": """
        SELECT CAST(o_orderdate AS DATE) AS day, c_nationkey AS place, CAST(count(*) AS DOUBLE) AS awnd,
               CAST(max(o_custkey) AS DOUBLE) AS prcp,
               CASE WHEN min(o_orderkey) % 5 <> 0 THEN CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) END AS tavg,
               CASE WHEN min(o_orderkey) % 2 <> 0 THEN CAST(min(o_orderkey) % 10 AS DOUBLE) END AS snow
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "scored": """
        SELECT doc_id, source, lang, quality AS label, toxic, n_chars / (n_chars + CAST(1000.0 AS DOUBLE)) AS score
        FROM labels JOIN documents USING (doc_id)""",
    "turns": f"""
        SELECT conv_id, turn, role, list_extract([{', '.join("'" + w + "'" for w in DIALOGUE_WORDS)}], pick + 1) AS message,
               CASE pick {' '.join(f"WHEN {i} THEN '{n}'" for i, n in DIALOGUE_INTENTS.items())} ELSE 'otro' END AS intent
        FROM (SELECT *, length(text) % {len(DIALOGUE_WORDS)} AS pick FROM conversations)""",
}
NEEDS = {
    "chain_daily": ["sales", "products", "stores"],
    "ratings": ["rating_rows"],
    "interactions": ["rating_rows", "products"],
}


def with_views(names: str, body: str) -> str:
    """``body`` after the definitions of the named views; a body that starts with ``WITH`` adds its own."""
    wanted: list[str] = []
    for n in names.split():
        for v in [*NEEDS.get(n, []), n]:
            if v not in wanted:
                wanted.append(v)
    body = body.strip()
    if not wanted:
        return body
    heads = ",\n".join(f'"{v}" AS ({VIEW_SQL[v]})' for v in wanted)
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {heads},\n{body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH"):
        return f"WITH {heads},\n{body[len('WITH'):]}"
    return f"WITH {heads}\n{body}"
