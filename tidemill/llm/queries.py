"""One registered query for each operator, over its whole table, and its SQL twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    exact_dedup, license_scan, line_dedup, mixing, near_vectors, pieces, pii, ranked_search, simhash, spelling, suffix_lm, toxicity, url_filter,
)

#: Host and path of the rules that op3 judges pages by.
RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document's words."""
    return mixing.mixed(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    0.5::DOUBLE + coalesce(length(regexp_replace(coalesce(text, ''), '[^\p{L}]+', '', 'g')) / nullif(length(coalesce(text, '')), 0), 0) AS quality,
    (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS draw
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM d GROUP BY source
), w AS (
  SELECT *, ((no - 1) % 3 + 1)::DOUBLE AS weight, 3 * source_size AS cap, (3 * source_size)::DOUBLE / ((no - 1) % 3 + 1)::DOUBLE AS ratio FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (ORDER BY ratio, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER (ORDER BY ratio, no) AS place
  FROM w
), first_open AS (
  SELECT level AS at_level, place AS at_place FROM l WHERE level <= ratio ORDER BY place LIMIT 1
), t AS (
  SELECT source, source_size, no,
    CASE WHEN place < at_place THEN cap::DOUBLE ELSE least(at_level * weight, cap::DOUBLE) END AS target
  FROM l, first_open
), k AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    coalesce(least(3, CAST(floor(t.target / nullif(t.source_size, 0)) AS BIGINT)), 0) AS epochs,
    CAST(sum(d.size) OVER (PARTITION BY t.no ORDER BY -ln(d.draw) / d.quality, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS through
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, epochs + CASE WHEN epochs < 3 AND size > 0 AND 2 * through - size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END AS copies FROM k
)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies FROM c
"""


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of each vector and the smallest id that they reach."""
    return near_vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


OP2_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a, min(b) AS component_id FROM r GROUP BY a
), n AS (
  SELECT a, count(*) AS n FROM l GROUP BY a
)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of each page."""
    return url_filter.judged(_table(spark, sf_dir, "pages"), RULES)


OP3_SQL = r"""
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), parts AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS raw, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
)
SELECT p.page_id, p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
  coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY p.page_id, p.host, p.path
"""


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document: base spans by kind and as a digest, and all spans."""
    names = F.array(*(F.lit(k) for k in pii.KINDS))

    def listed(spans: str) -> Column:
        one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(one, ",")

    rows = pii.personal_data(_table(spark, sf_dir, "documents")).withColumn("base", F.filter("spans", lambda s: s["base"]))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, F.lit(i))) for i in range(len(pii.KINDS))]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{k}") for n, k in zip(counts, pii.KINDS, strict=True)]
    return rows.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts that each document is in, and which of them stays."""
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents")).drop("rid")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents
), g AS (
  SELECT doc_id, sha256(body) AS text_sha256, count(*) OVER (PARTITION BY body) AS group_size,
    first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
    row_number() OVER (PARTITION BY body ORDER BY n DESC, doc_id NULLS LAST) AS place
  FROM d
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each page, how many of them are boilerplate of its host, and a digest of the rest."""
    rows = line_dedup.without_boilerplate(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "host", "n_lines", "n_dropped", F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(coalesce(regexp_extract(url, '(?s)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    list_filter(list_transform(string_split(regexp_replace(coalesce(html, ''), '<[^>]*>', chr(10), 'g'), chr(10)),
      lambda x: regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')), lambda x: x <> '') AS lines
  FROM pages
), s AS (
  SELECT host, count(*) AS pages FROM p WHERE host <> '' GROUP BY host
), e AS (
  SELECT rid, host, unnest(list_distinct(lines)) AS line FROM p
), c AS (
  SELECT host, line FROM e JOIN s USING (host) GROUP BY host, line, pages HAVING count(*) > 0.3 * pages AND count(*) >= 2
), d AS (
  SELECT rid, list(line) AS dropped FROM e JOIN c USING (host, line) GROUP BY rid
), k AS (
  SELECT page_id, host, len(lines) AS n_lines, CASE WHEN dropped IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(dropped, x)) END AS kept
  FROM p LEFT JOIN d USING (rid)
)
SELECT page_id, host, n_lines, n_lines - len(kept) AS n_dropped, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256 FROM k
"""


def op7_suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of each document, by single words and by the suffix tree."""
    return suffix_lm.scored(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document and the smallest id that chains of close fingerprints reach."""
    groups = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "kept")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each document, from a model that never saw the labels of the held-out rows."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of each document: how many, their digest, and whether they spell the text."""
    rows = pieces.decoded(pieces.encoded(_table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.sha2(F.array_join("ids", ","), 256).alias("pieces_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word, the spelling that it is a variant of, and how many words are one edit away."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), o AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), r AS (
  SELECT id, run, hex(encode(id || ':' || run)) AS bytes, count(*) AS n FROM o WHERE length(run) >= 7 GROUP BY id, run
), h AS (
  SELECT run, n, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(length(bytes) // 2), lambda i: CAST('0x' || substr(bytes, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM r, t
), w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM h GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7
), d AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), p AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, d.n, w.word, w.n FROM d JOIN w ON d.rest = w.word
  UNION SELECT w.word, w.n, d.word, d.n FROM d JOIN w ON d.rest = w.word
), q AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM p
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM w LEFT JOIN q ON q.word = w.word AND place = 1
), c AS (
  SELECT word, word AS root, form AS ahead FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON c.ahead = f.word
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM f JOIN c ON c.word = f.word AND c.ahead IS NULL
"""


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, places of license phrases and license labels of each document."""
    rows = license_scan.scanned(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score"
    )


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked_search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), i AS (
  SELECT row_number() OVER () AS no, item_id,
    list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM benchmark
), s AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0
), e AS (
  SELECT no, item_id, unnest(terms) AS term FROM i
), o AS (
  SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM d
), f AS (
  SELECT rid, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM o SEMI JOIN e USING (term) GROUP BY rid, doc_id, n, term
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, s GROUP BY term, n_docs
), g AS (
  SELECT no, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM e JOIN f USING (term) JOIN w USING (term), s GROUP BY no, item_id, rid, doc_id
), k AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM g WHERE score > 0 AND doc_id IS NOT NULL
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_near_vectors": op2_near_vectors,
    "op3_url_filter": op3_url_filter,
    "op4_pii": op4_pii,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_suffix_lm": op7_suffix_lm,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_pieces": op10_pieces,
    "op11_spelling": op11_spelling,
    "op12_licenses": op12_licenses,
    "op13_search": op13_search,
}
#: Without a twin, since SQL has no such hash, tree, trie or sampler: tests compare with brute force.
ORACLES = {"op1_mixing": OP1_SQL, "op2_near_vectors": OP2_SQL, "op3_url_filter": OP3_SQL, "op5_exact_dedup": OP5_SQL, "op6_line_dedup": OP6_SQL}
ORACLES |= {"op11_spelling": OP11_SQL, "op13_search": OP13_SQL}
