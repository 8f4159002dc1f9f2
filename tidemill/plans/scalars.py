"""F*: scalar functions, and X*: row functions as expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions import arrays, dates, numbers, text
from tidemill.plans import views as v
from tidemill.plans.registry import query


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


@query("f1_date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week, CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year,
       CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend, CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM orders""")
def f1(spark, sf):
    parts = dates.date_parts(F.col("o_orderdate"))
    return v.table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("f2_day_and_month_names", "SELECT o_orderkey, dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name FROM orders")
def f2(spark, sf):
    d = F.col("o_orderdate")
    return v.table(spark, sf, "orders").select("o_orderkey", dates.day_name(d).alias("day_name"), dates.month_name(d).alias("month_name"))


@query("f3_date_text", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def f3(spark, sf):
    d = F.col("o_orderdate")
    return v.table(spark, sf, "orders").select("o_orderkey", dates.year_month(d).alias("year_month"), F.date_format(d, "yyyy-MM-dd").alias("day"))


@query("f4_parse_time", """
SELECT event_id, strftime(strptime(strftime(ts, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%dT%H:%M:%S'), '%H:%M:%S') AS clock, CAST(ts AS DATE) AS day FROM events""")
def f4(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    back = F.to_timestamp(iso, "yyyy-MM-dd'T'HH:mm:ss")
    return v.table(spark, sf, "events").select("event_id", F.date_format(back, "HH:mm:ss").alias("clock"), F.to_date(F.substring(iso, 1, 10)).alias("day"))


@query("f5_split_part", "SELECT o_orderkey, split_part(strftime(o_orderdate, '%Y-%m-%d'), '-', 2) AS month FROM orders")
def f5(spark, sf):
    return v.table(spark, sf, "orders").select("o_orderkey", F.split(F.date_format("o_orderdate", "yyyy-MM-dd"), "-")[1].alias("month"))


@query("f6_day_sequences", """
SELECT o_orderkey, CAST(unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 2, INTERVAL 1 DAY)) AS DATE) AS day FROM orders""")
def f6(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return v.table(spark, sf, "orders").select("o_orderkey", F.explode(F.sequence(d, F.date_add(d, 2))).alias("day"))


@query("f7_hour_of_hhmm", "SELECT flight_id, leg, plane, dep_time // 100 AS hour FROM flights", "flights")
def f7(spark, sf):
    return v.flights(spark, sf).select("flight_id", "leg", "plane", dates.hour_of_hhmm(F.col("dep_time")).alias("hour"))


@query("f8_relative_time", """
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 10 MINUTE * 6""")
def f8(spark, sf):
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return v.table(spark, sf, "events").filter(dates.since(F.col("ts"), "60 minutes", as_of)).select("event_id")


@query("f9_rounding", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CAST(l_extendedprice * l_tax AS DECIMAL(28,8)), 1) AS DOUBLE) AS half_up,
       CAST(round_even(l_quantity / 2, 0) AS DOUBLE) AS half_even FROM lineitem""")
def f9(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.round_half_up(F.col("l_extendedprice") * F.col("l_tax"), 1).alias("half_up"),
        numbers.round_half_even(F.col("l_quantity") / 2, 0).alias("half_even"))


@query("f10_math", """
SELECT c_custkey, abs(c_acctbal) AS a, round(sqrt(abs(c_acctbal)), 6) AS s, round(ln(abs(c_acctbal) + 1), 6) AS l, round(power(c_acctbal / 1000, 2), 6) AS p,
       greatest(c_acctbal, CAST(c_nationkey AS DOUBLE)) AS g, least(c_acctbal, CAST(c_nationkey AS DOUBLE)) AS m FROM customer""")
def f10(spark, sf):
    x, n = F.col("c_acctbal"), F.col("c_nationkey").cast("double")
    return v.table(spark, sf, "customer").select(
        "c_custkey", F.abs(x).alias("a"), F.round(F.sqrt(F.abs(x)), 6).alias("s"), F.round(F.log(F.abs(x) + 1), 6).alias("l"),
        F.round(F.pow(x / 1000, F.lit(2)), 6).alias("p"), F.greatest(x, n).alias("g"), F.least(x, n).alias("m"))


@query("f10_norm", "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm FROM embeddings")
def f10_norm(spark, sf):
    e = arrays.as_doubles(F.col("embedding"))
    return v.table(spark, sf, "embeddings").select("vec_id", F.round(arrays.norm(e), 6).alias("norm"))


@query("f11_vector_ops", """
WITH e AS (SELECT vec_id, CAST(embedding[1:32] AS DOUBLE[]) AS a, CAST(embedding[33:64] AS DOUBLE[]) AS b FROM embeddings)
SELECT vec_id, unnest(range(32)) AS i, unnest(list_transform(list_zip(a, b), lambda x: round(x[1] + x[2], 6))) AS added, unnest(list_transform(list_zip(a, b), lambda x: round(x[1] - x[2], 6))) AS taken,
       unnest(list_transform(list_zip(a, b), lambda x: round(x[1] * x[2], 6))) AS multiplied, unnest(list_transform(list_zip(a, b), lambda x: round(x[1] / x[2], 4))) AS divided FROM e""")
def f11(spark, sf):
    a, b = (arrays.as_doubles(F.slice("embedding", s, 32)) for s in (1, 33))
    e = v.table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode(F.arrays_zip(
            arrays.add(a, b).alias("added"), arrays.subtract(a, b).alias("taken"), arrays.multiply(a, b).alias("multiplied"),
            arrays.divide(a, b).alias("divided"))).alias("i", "z"))
    return e.select("vec_id", F.col("i").cast("bigint").alias("i"), *[F.round(F.col(f"z.{c}"), 6).alias(c) for c in ("added", "taken", "multiplied")],
                    F.round("z.divided", 4).alias("divided"))


@query("f12_array_functions", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(round(x * 1000) AS INTEGER)) AS a FROM embeddings)
SELECT vec_id, array_to_string(a[2:4], ',') AS part, len(list_append(a, 7)) AS appended, len(list_concat(a, a)) AS doubled, len(flatten([a, a[1:2]])) AS flat,
       a[64] AS last_item, array_to_string(list_reverse(a)[1:2], ',') AS backwards FROM e""")
def f12(spark, sf):
    a = F.transform("embedding", lambda x: F.round(x * 1000).cast("int"))

    def joined(x):
        return F.array_join(x.cast("array<string>"), ",")

    return v.table(spark, sf, "embeddings").select(
        "vec_id", joined(arrays.take_slice(a, 2, 3)).alias("part"), F.size(arrays.append_item(a, F.lit(7))).cast("bigint").alias("appended"),
        F.size(F.concat(a, a)).cast("bigint").alias("doubled"), F.size(F.flatten(F.array(a, F.slice(a, 1, 2)))).cast("bigint").alias("flat"),
        F.element_at(a, -1).alias("last_item"), joined(F.slice(F.reverse(a), 1, 2)).alias("backwards"))


@query("f13_strings", """
SELECT p_partkey, length(p_name) AS len, length(p_name) - length(replace(p_name, 'e', '')) AS e_count, instr(p_name, 'r') AS first_r, upper(p_name) AS up, lower(p_brand) AS low,
       replace(p_name, ' ', '_') AS snake, p_brand || '/' || p_type AS joined, reverse(p_name) AS backwards, substr(p_name, 2, 3) AS piece,
       array_to_string(string_split(p_type, ''), '-') AS spaced FROM part""")
def f13(spark, sf):
    n = F.col("p_name")
    return v.table(spark, sf, "part").select(
        "p_partkey", F.length(n).cast("bigint").alias("len"), (F.length(n) - F.length(F.replace(n, F.lit("e"), F.lit("")))).cast("bigint").alias("e_count"),
        F.instr(n, "r").cast("bigint").alias("first_r"), F.upper(n).alias("up"), F.lower("p_brand").alias("low"), F.replace(n, F.lit(" "), F.lit("_")).alias("snake"),
        F.concat_ws("/", "p_brand", "p_type").alias("joined"), F.reverse(n).alias("backwards"), F.substring(n, 2, 3).alias("piece"),
        F.array_join(F.split("p_type", ""), "-").alias("spaced"))


@query("f13_title_case", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS title FROM part""")
def f13_title(spark, sf):
    return v.table(spark, sf, "part").select("p_partkey", F.initcap("p_name").alias("title"))


@query("f14_parse_price", "SELECT c_custkey, c_acctbal AS price FROM customer")
def f14(spark, sf):
    shown = F.concat(F.lit(" Â£"), F.col("c_acctbal").cast("string"), F.lit(" "))
    return v.table(spark, sf, "customer").select("c_custkey", text.parse_price(shown).alias("price"))


FOLD = f"translate(lower(trim(text, ' ')), '{fv.ACCENTS_FROM}', '{fv.ACCENTS_TO}')"
NORMAL = f"regexp_replace(regexp_replace({FOLD}, '[!-/:-@\\[-`{{-~]', '', 'g'), '\\s+', ' ', 'g')"


@query("f15_fold_accents", f"SELECT doc_id, md5({FOLD}) AS digest FROM documents")
def f15(spark, sf):
    return v.texts(spark, sf).select("doc_id", F.md5(text.fold_accents(F.col("text"))).alias("digest"))


@query("f16_strip_punctuation", f"SELECT doc_id, length({NORMAL}) AS n, md5({NORMAL}) AS digest FROM documents")
def f16(spark, sf):
    s = text.normalise(F.col("text"))
    return v.texts(spark, sf).select("doc_id", F.length(s).cast("bigint").alias("n"), F.md5(s).alias("digest"))


# The stopwords of the keyword query; applications pass ``text.stopwords()``.
QUERY_STOPWORDS = ["the", "and", "que", "der", "die", "und", "los", "las", "les", "des", "una", "con"]


@query("f17_keywords", f"""
WITH k AS (SELECT doc_id, list_filter(string_split({NORMAL}, ' '), lambda t: length(t) > 2 AND regexp_full_match(t, '\\p{{L}}+') AND NOT list_contains([{sql_list(QUERY_STOPWORDS)}], t)) AS w FROM documents)
SELECT doc_id, len(w) AS n_keywords, md5(array_to_string(w, ' ')) AS digest FROM k""")
def f17(spark, sf):
    k = text.keywords(F.col("text"), QUERY_STOPWORDS)
    return v.texts(spark, sf).select("doc_id", k.alias("k")).select(
        "doc_id", F.size("k").cast("bigint").alias("n_keywords"), F.md5(F.array_join("k", " ")).alias("digest"))


def stem_sql(words: str) -> str:
    """The Snowball rules as one step after the other over (w), a table of words; gives (w, stem)."""
    listed = sql_list

    def found(word: str, options) -> str:
        return f"regexp_extract({word}, '{text.ending(options)}')"

    def without(word: str, options, start: str) -> str:
        e = found(word, options)
        return f"CASE WHEN {e} <> '' AND length({word}) - length({e}) >= {start} THEN left({word}, length({word}) - length({e})) ELSE {word} END"

    def after(word: str, pattern: str) -> str:
        return f"coalesce(nullif(length(regexp_extract({word}, '{pattern}')), 0), length({word}))"

    std = text.STANDARD
    return f"""
words AS ({words}),
reg1 AS (SELECT w, {after("w", text.RV)} AS rv, {after("w", text.R1)} AS r1 FROM words),
reg2 AS (SELECT *, r1 + {after("substr(w, r1 + 1)", text.R1)} AS r2, {found("w", text.PRONOUNS)} AS pro FROM reg1),
p1 AS (SELECT *, left(w, length(w) - length(pro)) AS rest FROM reg2),
p2 AS (SELECT *, {found("rest", text.PRONOUN_HOSTS)} AS host FROM p1),
p3 AS (SELECT w, rv, r1, r2, CASE WHEN pro = '' OR host = '' OR length(rest) - length(host) < rv OR (host = 'yendo' AND NOT ends_with(rest, 'uyendo')) THEN w
   WHEN host IN ('iéndo', 'ándo', 'ár', 'ér', 'ír') THEN left(rest, length(rest) - length(host)) || translate(host, '{text.ACCENTS[0]}', '{text.ACCENTS[1]}') ELSE rest END AS x FROM p2),
s1 AS (SELECT *, {found("x", [e for g in std.values() for e in g])} AS e FROM p3),
s2 AS (SELECT *, left(x, length(x) - length(e)) AS y, e <> '' AND length(x) - length(e) >= CASE WHEN e = 'amente' THEN r1 ELSE r2 END AS fits FROM s1),
s3 AS (SELECT *, {without("y", ["iv"], "r2")} AS yiv FROM s2),
s4 AS (SELECT w, x, rv, CASE WHEN NOT fits THEN NULL WHEN e IN ({listed(std["plain"])}) THEN y WHEN e IN ({listed(std["ic"])}) THEN {without("y", ["ic"], "r2")}
   WHEN e IN ({listed(std["log"])}) THEN y || 'log' WHEN e IN ({listed(std["u"])}) THEN y || 'u' WHEN e IN ({listed(std["ente"])}) THEN y || 'ente'
   WHEN e = 'amente' AND yiv <> y THEN {without("yiv", ["at"], "r2")} WHEN e = 'amente' THEN {without("y", ["os", "ic", "ad"], "r2")}
   WHEN e = 'mente' THEN {without("y", ["ante", "able", "ible"], "r2")} WHEN e IN ({listed(std["idad"])}) THEN {without("y", ["abil", "ic", "iv"], "r2")}
   ELSE {without("y", ["at"], "r2")} END AS done FROM s3),
v1 AS (SELECT *, {found("substr(x, rv + 1)", text.Y_VERBS)} AS ey, {found("substr(x, rv + 1)", text.GU_VERBS + text.VERBS)} AS ev FROM s4),
v2 AS (SELECT w, rv, CASE WHEN done IS NOT NULL THEN done WHEN ey <> '' AND ends_with(left(x, length(x) - length(ey)), 'u') THEN left(x, length(x) - length(ey))
   WHEN ev IN ({listed(text.GU_VERBS)}) AND ends_with(left(x, length(x) - length(ev)), 'gu') THEN left(x, length(x) - length(ev) - 1) ELSE left(x, length(x) - length(ev)) END AS x FROM v1),
q1 AS (SELECT *, {found("x", text.RESIDUAL + text.RESIDUAL_E)} AS e FROM v2),
stems AS (SELECT w, translate(CASE WHEN e = '' OR length(x) - length(e) < rv THEN x
   WHEN e IN ({listed(text.RESIDUAL_E)}) AND ends_with(left(x, length(x) - length(e)), 'gu') AND length(x) - length(e) - 1 >= rv THEN left(x, length(x) - length(e) - 1)
   ELSE left(x, length(x) - length(e)) END, '{text.ACCENTS[0]}', '{text.ACCENTS[1]}') AS stem FROM q1)"""


@query("f18_stem", lambda: f"""
WITH k AS (SELECT unnest(list_filter(string_split({NORMAL}, ' '), lambda t: length(t) > 2 AND regexp_full_match(t, '\\p{{L}}+') AND NOT list_contains([{sql_list(QUERY_STOPWORDS)}], t))) AS w
           FROM documents WHERE lang = 'es'),
{stem_sql("SELECT DISTINCT w FROM k")}
SELECT stem, count(*) AS n FROM k JOIN stems USING (w) GROUP BY 1""")
def f18(spark, sf):
    stems = text.stem(text.keywords(F.col("text"), QUERY_STOPWORDS))
    docs = v.texts(spark, sf).filter(F.col("lang") == "es")
    return docs.select("doc_id", F.explode(stems).alias("stem")).groupBy("stem").agg(F.count("*").alias("n"))


@query("f18_stem_of_accented_words", lambda: f"""
WITH k AS (SELECT unnest(regexp_extract_all(lower(text), '[a-zñáéíóúü]+')) AS w FROM documents WHERE lang = 'es'),
{stem_sql("SELECT DISTINCT w FROM k")}
SELECT w AS word, stem FROM stems""")
def f18_accented(spark, sf):
    docs = v.texts(spark, sf).filter(F.col("lang") == "es")
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-zñáéíóúü]+"), F.lit(0))).alias("word")).distinct()
    return words.select("word", text.stem_word(F.col("word")).alias("stem"))


@query("f19_json", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS message FROM events""")
def f19(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("message"))


@query("f20_map_lookup", "SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS code FROM events")
def f20(spark, sf):
    m = F.create_map(F.lit("click"), F.lit(1), F.lit("view"), F.lit(2))
    return v.table(spark, sf, "events").select("event_id", F.element_at(m, F.col("event_type")).alias("code"))


@query("f21_faq_rows", """
WITH i AS (SELECT 'tema_' || lower(p_type) AS tag, p_type AS description, list(DISTINCT p_name ORDER BY p_name) AS patterns FROM part GROUP BY 1, 2)
SELECT 'Tema ' || upper(substr(description, 1, 1)) || lower(substr(description, 2)) AS category, tag, description, array_to_string(patterns[1:3], '|') AS examples
FROM i WHERE tag <> 'tema_promo'""")
def f21(spark, sf):
    from tidemill.operators.textmodels import faq_rows

    tag = F.concat(F.lit("tema_"), F.lower("p_type")).alias("tag")
    names = v.table(spark, sf, "part").select(tag, F.col("p_type").alias("description"), "p_name").distinct()
    # the three first names per tag suffice; a list of all would grow with the table
    from tidemill.operators.relational import top_k_per_key

    first = top_k_per_key(names, ["tag"], [F.col("p_name")], 3)
    intents = first.groupBy("tag", "description").agg(F.sort_array(F.collect_list("p_name")).alias("patterns"))
    rows = faq_rows(intents, ["tema_promo"])
    return rows.select("category", "tag", "description", F.array_join("example_questions", "|").alias("examples"))


@query("f22_answers", f"""
WITH a AS (SELECT conv_id, turn, CASE WHEN trim(lower(message)) IN ({sql_list(fv.YES_WORDS)}) THEN 'si' WHEN trim(lower(message)) IN ({sql_list(fv.NO_WORDS)}) THEN 'no'
           ELSE trim(lower(message)) END AS answer FROM turns)
SELECT conv_id, turn, answer, CASE WHEN answer IN ('inicio', 'programas') THEN answer WHEN contains('inicio', answer) OR contains(answer, 'inicio') THEN 'inicio'
       WHEN contains('programas', answer) OR contains(answer, 'programas') THEN 'programas' END AS option FROM a""", "turns")
def f22(spark, sf):
    a = text.normalise_answer(F.col("message"))
    return v.turns(spark, sf).select("conv_id", "turn", a.alias("answer"), text.match_option(a, ["inicio", "programas"]).alias("option"))


@query("f23_commands", f"""
SELECT conv_id, turn, trim(lower(message)) IN ({sql_list(fv.HELP_WORDS)}) AS is_help, regexp_matches(lower(message), '{"|".join(fv.CANCEL_WORDS)}') AS is_cancel FROM turns""", "turns")
def f23(spark, sf):
    m = F.col("message")
    return v.turns(spark, sf).select("conv_id", "turn", text.is_help(m).alias("is_help"), text.is_cancel(m).alias("is_cancel"))


@query("f24_conditional", "SELECT s_suppkey, CASE WHEN s_acctbal >= 5000 THEN 'rich' WHEN s_acctbal >= 0 THEN 'ok' ELSE 'debt' END AS band FROM supplier")
def f24(spark, sf):
    b = F.col("s_acctbal")
    return v.table(spark, sf, "supplier").select("s_suppkey", F.when(b >= 5000, "rich").when(b >= 0, "ok").otherwise("debt").alias("band"))


@query("f25_default", "SELECT event_id, coalesce(presion_bar, CAST(0.0 AS DOUBLE)) AS presion_bar FROM readings", "readings")
def f25(spark, sf):
    return v.readings(spark, sf).select("event_id", F.coalesce("presion_bar", F.lit(0.0)).alias("presion_bar"))


@query("f26_rule_code", "SELECT event_id, 'UMBRAL_ALTO_' || upper(event_type) AS high, 'UMBRAL_BAJO_' || upper(event_type) AS low FROM events")
def f26(spark, sf):
    t = F.col("event_type")
    return v.table(spark, sf, "events").select("event_id", text.rule_code(t, "max").alias("high"), text.rule_code(t, "min").alias("low"))


# ---- row and group functions as expressions -------------------------------------------------

@query("x1_row_function", "SELECT doc_id, CASE WHEN score > 0.55 THEN 1 ELSE 0 END AS flag, abs(score - 0.5) AS distance FROM scored", "scored")
def x1(spark, sf):
    from tidemill.operators.models import binarize

    s = F.col("score")
    return v.scored(spark, sf).select("doc_id", binarize(s, 0.55).alias("flag"), F.abs(s - 0.5).alias("distance"))


@query("x2_group_transform", """
SELECT user_id, event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 4) AS change FROM events""")
def x2(spark, sf):
    from tidemill.operators.ordered import framed

    e = v.table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    out = framed(e, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("ts").cast("date"),
                 lambda w: {"change": F.round(F.col("value") - F.lag("value").over(w), 4)}, before=1)
    return out.select("user_id", "event_id", "change")


@query("x3_row_to_rows", """
SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]*\\bhref="([^"]*)"', 1)) AS href FROM pages""")
def x3(spark, sf):
    from tidemill.sources.pages import ANY_LINK

    return v.table(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(ANY_LINK), F.lit(1))).alias("href"))
