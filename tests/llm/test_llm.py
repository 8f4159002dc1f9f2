"""The training-data operators against brute force, their SQL twins, and on awkward tables: nulls, empty and
long texts, repeated rows, ties, empty tables, columns with clashing names."""

import collections
import hashlib
import math
import pickle
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from oracle import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from tidemill.llm import common, exact_dedup, line_dedup, mixing, near_vectors, pieces, pii, queries, simhash, suffix_lm, toxicity, url_filter

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rid string, size string, _rid string, spans string"


def doc(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), "x", "y", "z", "s")


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    words = ["tide", "mill", "wheel", "Stone", "grain", "river", "ßü", "\U0001f600", "flour.", "4111 1111 1111 1111", "a@b.co", "10.0.0.1", "+1 (017) 555-7713"]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 60))) for _ in range(40)]
    out = [doc(i, t, draw.choice(["a", "b", "c", None])) for i, t in enumerate(texts)]
    out += [doc(50 + i, texts[0]) for i in range(12)]  # a group of copies
    out += [doc(70, texts[1] + " \t\n"), doc(71, texts[1].replace(" ", "")), doc(72, None), doc(73, ""), doc(74, " \n"), doc(None, texts[2]), doc(None, None, None)]
    out += [doc(75, "word " * 30_000), doc(76, "x" * 20_000), doc(1, texts[1]), doc(1, texts[1])]
    return out


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{at}/documents.parquet")
    pages = [(i, u, None) for i, u in enumerate([None, "", "no scheme", "http://Org", "http://a.ORG/x?y", "http://example.org/es/q", "http://m.example.org/en/1x#y", "http://example.org/en/2", "http://org.com/de/x", "x://com/fr/", "http://com?/de/", "http://" + "a." * 3000 + "com/de/" + "b/" * 3000])]
    spark.createDataFrame([*pages, (3, "http://Org", None), (None, "http://a.org/", None)], "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    draw = np.random.default_rng(2)
    base = draw.normal(size=(30, 16))
    near = [base[i % 5] * draw.uniform(0.5, 3) + draw.normal(scale=0.05 * (i % 4), size=16) for i in range(40)]
    vectors = [*base.tolist(), *np.array(near).tolist(), base[0].tolist(), base[0].tolist(), None, [0.0] * 16, [None] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16]
    spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    spark.createDataFrame([(i, 0, i % 2) for i in range(60)] + [(None, 0, 1), (3, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    for t, s in (("conversations", "conv_id long, turn long, role string, text string"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], s).write.parquet(f"{at}/{t}.parquet")
    return at


@pytest.fixture(scope="module")
def empty(spark, tables, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "pages", "embeddings", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{t}.parquet").where("false").write.parquet(f"{at}/{t}.parquet")
    return at


def text_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("name", sorted(k for k, sql in queries.ORACLES.items() if sql))
def test_sql_twin(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name]) == ""


@pytest.mark.parametrize("name", ["op3_url_filter", "op6_line_dedup"])
def test_sql_twin_on_awkward_rows(spark, tables, name):
    con = duck(SF)
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM read_parquet('{tables}/pages.parquet/*.parquet')")
    assert {tuple(r) for r in queries.QUERIES[name](spark, tables).collect()} == set(con.execute(queries.ORACLES[name]).fetchall())


@pytest.mark.parametrize("name", sorted(queries.QUERIES) + ["pipeline"])
def test_empty_tables(spark, empty, name):
    assert (queries.QUERIES | corpus_pipeline.QUERIES)[name](spark, empty).count() == 0


def test_mixing(spark, tables, rows):
    got = queries.op1_mixing(spark, tables).collect()
    assert sorted(map(str, got)) == sorted(map(str, queries.op1_mixing(spark, tables).collect()))
    assert len(got) == len(rows)
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(text_words(r[1]))
    taken = collections.Counter()
    for r in got:
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source_size, r.target] += r.taken
    assert math.isclose(sum(t for _, t in taken), sum(size.values()))
    for (s, target), n in taken.items():
        assert target <= 3 * s and abs(n - target) <= 30_000


def test_targets_share_the_excess_again(spark):
    sources = spark.createDataFrame([("a", 100, 1.0), ("b", 1, 1.0), ("c", 1, 1.0), (None, 500, 1.0)], "source string, source_size long, mean_weight double")
    got = {r.source: r.target for r in mixing.targets(sources).collect()}
    assert (got["b"], got["c"]) == (3, 3) and math.isclose(got["a"], 298.0) and math.isclose(got[None], 298.0)


def test_exact_dedup(spark, tables, rows):
    got = exact_dedup.duplicate_groups(spark.read.parquet(f"{tables}/documents.parquet"), block_chars=7).collect()
    groups = collections.defaultdict(list)
    for r in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        groups[hashlib.sha256(body.encode()).hexdigest()].append((-len(r[1] or ""), r[0] is None, r[0] or 0, r[0]))
    assert len(got) == len(rows)
    for r in got:
        mine = groups[r.text_sha256]
        assert r.group_size == len(mine) and r.keep_id == min(mine)[3]
    assert sum(r.kept for r in got) == len(groups)


OWN = ["_rid", "rid", "RID", "_copies", "copies", "_copy", "copy", "_spans", "spans", "ids", "decoded", "lossless", "fp", "a.b"]


def test_stages_keep_clashing_columns(spark, rows):
    """Each stage returns the values of all columns, and the rows that it returns without such columns."""
    plain = common.stored(spark.createDataFrame(rows, DOCS).select("doc_id", "text", "lang", "source", "n_chars"))
    own = [c for i, c in enumerate(OWN) if c.lower() not in [x.lower() for x in OWN[:i]]]
    docs = plain
    for c in own:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    docs = common.stored(docs)
    stages = [exact_dedup.without_duplicates, simhash.without_near_duplicates, mixing.mix, pii.redacted, lambda d: corpus_pipeline.to_pieces(spark, d, SF)]
    for stage in stages:
        out, want = stage(docs), stage(plain)
        assert out.columns[: len(docs.columns)] == docs.columns and len(out.columns) == len(want.columns) + len(own)
        got = out.collect()
        for r in got:
            for c in own:
                assert r[c] == f"{c}:{'-' if r.doc_id is None else r.doc_id}"
        assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter((r.doc_id, r.text) for r in want.collect())


def test_stages_on_the_result_of_a_shuffle(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for stage in (exact_dedup.without_duplicates, simhash.without_near_duplicates, mixing.mix, pii.redacted):
        shuffled = docs.repartition(7).groupBy(*docs.columns).count().withColumn("n", F.explode(F.sequence(F.lit(1), F.col("count").cast("int")))).drop("count", "n")
        assert len(set(shuffled.columns)) == len(docs.columns)
        rows = stage(shuffled).select("doc_id", "text").collect()
        assert collections.Counter(rows) == collections.Counter(stage(docs).select("doc_id", "text").collect())


def brute_components(prints, distance):
    ids = list(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[a] != label[b] and (prints[a] ^ prints[b]).bit_count() <= distance:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def test_simhash_fingerprints(spark, tables, rows):
    got = collections.Counter((r.doc_id, r.fingerprint) for r in queries.op8_simhash(spark, tables).collect())
    want = collections.Counter()
    for r in rows:
        w = text_words(r[1])
        shingles = [" ".join(w[j : j + 4]) for j in range(max(1, len(w) - 3))] if w else []
        bits = [0] * 64
        for s in shingles:
            h = xxhash.xxh64(s.encode(), seed=42).intdigest()
            for b in range(64):
                bits[b] += h >> b & 1
        want[r[0], f"{sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles)):016x}"] += 1
    assert got == want


@pytest.mark.parametrize("small", [8, 0])
def test_simhash_links(spark, monkeypatch, small):
    """Chains, a crowded bucket, and buckets that are cut into pieces."""
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    monkeypatch.setattr(simhash, "BUCKET_PIECE", 16)
    draw = random.Random(1)
    prints = set()
    for _ in range(12):
        at = draw.getrandbits(64)
        for _ in range(9):
            prints.add(at)
            for b in draw.sample(range(64), draw.randint(1, 6)):
                at ^= 1 << b
    centre = draw.getrandbits(64)
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(9) for b in range(9, 14)}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    got = {r.node: r.component for r in common.components(simhash.fingerprint_links(frame)).collect()}
    want = brute_components({s: s & (2**64 - 1) for s in signed.values()}, 4)
    smallest = collections.defaultdict(list)
    for s, c in want.items():
        smallest[c].append(s)
    for group in smallest.values():
        assert {got.get(s, s) for s in group} == {min(group)}


def test_components_of_a_long_path(spark):
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1000, 1000)], "a long, b long")
    got = {r.node: r.component for r in common.components(links).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


def test_near_vectors_in_rounds(spark, monkeypatch):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(60, 8))
    rows = [*base, *(base[::5] + 0.01), *base[::9]]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "vec_id long, embedding array<double>").coalesce(1)
    whole = sorted(near_vectors.near_vectors(table).collect())
    seen, kept = [], near_vectors.stored_in_rounds
    monkeypatch.setattr(near_vectors, "ROUND_SHARE", 0)
    monkeypatch.setattr(near_vectors, "ROUND_BYTES", 5000)
    monkeypatch.setattr(near_vectors, "stored_in_rounds", lambda parts, *a: seen.append(len(parts)) or kept(parts, *a))
    assert sorted(near_vectors.near_vectors(table).collect()) == whole
    assert len(seen) == 1 and seen[0] > 1 and sum(r.n_links > 0 for r in whole) >= 24


def test_near_vectors(spark, tables):
    got = {r.vec_id: r for r in queries.op2_near_vectors(spark, tables).collect()}
    table = {r.vec_id: r.embedding for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()}
    good = {i: np.array(v, dtype=float) for i, v in table.items() if v is not None and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: [j for j in good if i != j and i in good and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= 0.95] for i in table}
    for i in table:
        reached, open_ = {i}, [i]
        while open_:
            new = set(links[open_.pop()]) - reached
            reached |= new
            open_ += new
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), min(reached), i == min(reached))


def test_probes_and_codes_lose_nothing():
    draw = np.random.default_rng(8)
    rows = draw.normal(size=(600, 24))
    rows = np.concatenate([rows, rows[:300] + draw.normal(scale=0.06, size=(300, 24))])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    q = near_vectors.Quantiser(rows[:500], 20)
    at, codes, errors, square = q.encode(rows)
    probes = q.probes(at, square, math.sqrt(0.1))
    found = set()
    for c in range(20):
        mine, asking = np.flatnonzero(at == c), np.flatnonzero(probes[:, c])
        if len(mine) and len(asking):
            x, y = near_vectors.close_pairs(q, c, rows[asking], rows[mine], codes[mine], errors[mine], 0.95)
            found |= set(zip(asking[x].tolist(), mine[y].tolist(), strict=True))
    assert found == set(zip(*(a.tolist() for a in np.nonzero(rows @ rows.T >= 0.95)), strict=True))


def test_near_vectors_of_mixed_lengths(spark):
    draw = np.random.default_rng(8)
    vectors = draw.normal(size=(20, 16)).tolist()
    for n in (3, 8):
        one = draw.normal(size=n)
        vectors += [one.tolist(), (2 * one).tolist(), one.tolist(), (-one).tolist()]
    vectors += [[1.0], []]
    got = {r.vec_id: r for r in near_vectors.near_vectors(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").coalesce(1)).collect()}
    near = [{j for j, y in enumerate(vectors) if j != i and len(x) == len(y) > 0 and np.dot(x, y) >= 0.95 * np.linalg.norm(x) * np.linalg.norm(y)} for i, x in enumerate(vectors)]
    assert len(got) == len(vectors) and near[20] == {21, 22} and near[25] == {24, 26}
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {i: (len(x), min({i} | x)) for i, x in enumerate(near)}


def test_line_dedup(spark):
    page = lambda i, own, host="H.org": (i, f"http://{host}/{i}", f"<nav>Home</nav> <p>{own}</p>Home\n<b>foot</b>" if own else None)
    rows = [page(i, f"own {i}") for i in range(5)] + [page(5, None), page(6, "x", "one.org"), (7, None, "<p>Home</p>")]
    got = {r.page_id: r for r in line_dedup.without_boilerplate(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i].kept for i in range(5)] == [[f"own {i}"] for i in range(5)] and got[0].host == "h.org" and (got[0].n_lines, got[0].n_dropped) == (4, 3)
    assert got[5].kept == [] and got[6].kept == ["Home", "x", "Home", "foot"] and got[7].kept == ["Home"]


def test_line_dedup_on_small_hosts(spark):
    rows = [(f"{n}.org", i, f"<nav>Home</nav><p>own {i}</p>") for n in (1, 2, 3, 4) for i in range(n)]
    pages = spark.createDataFrame([(f"{h}/{i}", f"http://{h}/{i}", t) for h, i, t in rows], "page_id string, url string, html string")
    got = {r.page_id: r.kept for r in line_dedup.without_boilerplate(pages).collect()}
    assert got == {f"{h}/{i}": [*(["Home"] if h == "1.org" else []), f"own {i}"] for h, i, _ in rows}


def test_url_rules():
    trie = url_filter.Trie([url_filter.Rule("allow", "a.com", "/x"), url_filter.Rule("block", "com", "/x/yy/"), url_filter.Rule("block", "a.com", "/x"), url_filter.Rule("allow", "", "")])
    assert trie.match("b.a.com", "/xq") == ("a.com/x", "block")
    assert trie.match("a.com", "/x/yy/z") == ("com/x/yy/", "block")
    assert trie.match("net", "") == ("", "allow")


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for n, (kind, form) in enumerate(BASE.items()):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, digits[::-1]))) % 10 == 0
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_pii_base_spans(spark, tables, rows, tmp_path):
    draw = random.Random(3)
    parts = ["a", "b.", "@", "x@y.z", "1", "12", "4111 1111 1111 1111", "+1 (017) 555-7713", " ", "-", ".", "1.2.3.4", "255.256.1.1", "\U0001f600", "+", "ü", "\n", "0001", ")"]
    more = [doc(1000 + i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 50)))) for i in range(400)]
    at = str(tmp_path)
    spark.createDataFrame([*rows, *more], DOCS).write.parquet(f"{at}/documents.parquet")
    want = collections.Counter()
    for r in [*rows, *more]:
        want[r[0], hashlib.sha256(",".join(base_spans(r[1])).encode()).hexdigest()] += 1
    got = queries.op4_pii(spark, at).collect()
    assert collections.Counter((r.doc_id, r.base_sha256) for r in got) == want
    texts = {r[0]: r[1] for r in [*rows, *more]}
    for r in got:
        if r.doc_id is not None:
            assert set(base_spans(texts[r.doc_id])) <= set(r.spans.split(","))


def test_pii_redacts(spark):
    docs = spark.createDataFrame([(1, "é a@b.co, +1 (017) 555-7713!"), (2, None), (3, "clean")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.redacted(docs).collect()} == {1: "é [email], [phone]!", 2: None, 3: "clean"}


def test_pii_sets_the_threshold_of_a_rare_kind_on_all_spans(spark):
    ips = [f"host 77.88.{10 + i % 90}.{100 + i % 150} is up" for i in range(299)] + ["host 77.88.99.300 is up"]
    cards = [f"no {4000000000000000 + 7919 * i} end" for i in range(6000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*ips, *cards, *[cards[0]] * 6000])], "doc_id long, text string").coalesce(1)
    spans = pii.stored(pii.proposed(docs), "pii")
    got = pii.added(spans, rows=400).where(F.col("kind") == pii.KINDS.index("ip")).select("start", "end").collect()
    assert [tuple(r) for r in got] == [(5, 17)]


def test_suffix_lm(spark, tables, rows):
    got = collections.defaultdict(list)
    for r in queries.op7_suffix_lm(spark, tables).collect():
        got[r.doc_id].append(r)
    count = collections.Counter()
    for r in rows:
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2:
            count.update([*text_words(r[1]), ""])
    n, v = sum(count.values()), len(count)
    for doc_id, text in {r[0]: r[1] for r in rows if r[0] not in (None, 1)}.items():
        words = [*text_words(text), ""]
        (r,) = got[doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(count[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
        assert r.score <= 0


def test_suffix_states_are_distributions(spark):
    docs = spark.createDataFrame([(i, "a b a c b a b a b c " * 40 + "d") for i in range(20)], "doc_id long, text string")
    tree, _ = suffix_lm.learn(docs)
    ids = np.arange(len(tree.words))
    root = (tree.counts + 1) / (tree.n + tree.v + 1)
    assert len(tree.layers[0].contexts) and len(tree.layers[1].contexts)
    for a in range(len(ids)):
        for b in range(len(ids)):
            whole = tree.probabilities(suffix_lm.Words(ids, np.full(len(ids), a), np.full(len(ids), b), ids), root)
            unknown = tree.probabilities(suffix_lm.Words(np.array([-1]), np.array([a]), np.array([b]), ids[:1]), np.array([1 - root.sum()]))
            assert math.isclose(whole.sum() + unknown[0], 1.0, rel_tol=1e-9)


def test_suffix_lm_beats_single_words_on_held_out_texts(spark):
    rows = [r for r in queries.op7_suffix_lm(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def brute_suffix_scores(texts):
    """Log10 probabilities of texts by a suffix tree of them, from its definition."""
    lists = [[*text_words(t), ""] for t in texts]
    grams = [collections.Counter(tuple(ws[i : i + k]) for ws in lists for i in range(len(ws) - k + 1)) for k in (1, 2, 3)]
    n, v = sum(grams[0].values()), len(grams[0])
    after = collections.defaultdict(dict)
    for g in grams[1:]:
        for k, c in g.items():
            if c >= 2:
                after[k[:-1]][k[-1]] = c
    states = {}

    def p(context, word):
        if not context:
            return (grams[0][word,] + 1) / (n + v + 1)
        if context not in states:
            return p(context[1:], word)
        total, back, seen = states[context]
        return (seen.get(word, 0) + back * p(context[1:], word)) / total

    for depth in (1, 2):
        for context, held in grams[depth - 1].items():
            seen = after[context]
            if held < 2 or context[-1] == "" or not seen:
                continue
            likely = {w: p(context[1:], w) for w in seen}
            rest, kinds = held - sum(seen.values()), len(seen)
            ratio = sum(2 * c * math.log(c / (held * likely[w])) for w, c in seen.items())
            if rest:
                ratio += 2 * rest * math.log(rest / (held * max(1 - sum(likely.values()), 1e-12)))
            if ratio > kinds + 4 * math.sqrt(2 * kinds):
                states[context] = (held + kinds, kinds + rest, seen)
    return [sum(math.log10(p(tuple(ws[max(0, i - 2) : i]), w)) for i, w in enumerate(ws)) for ws in lists], len(states)


@pytest.mark.parametrize("word,follows", [(1e-6, 2.5e-7), (2e-3, 2e-3), (0.5, 0.5)])
def test_suffix_lm_equals_brute_force(spark, monkeypatch, word, follows):
    """Whether words, pairs and triples are held by tasks or met in joins."""
    rng = np.random.default_rng(5)
    passage = "Un passage répété of several words"
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 60) if x < 300) + (f" {passage} " if i % 9 == 0 else " ") + "the end" for i in range(100)]
    monkeypatch.setattr(suffix_lm, "HELD_WORD", word)
    monkeypatch.setattr(suffix_lm, "HELD_NEXT", follows)
    docs = common.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r.score for r in suffix_lm.scores(docs, suffix_lm.fitted(docs)).collect()}
    want, states = brute_suffix_scores(texts)
    assert states > 20
    assert all(math.isclose(got[i], x, rel_tol=1e-9) for i, x in enumerate(want))


def test_suffix_lm_learns_what_is_rare_in_a_large_corpus(spark):
    """A passage that occurs twice has states, however many other words there are."""
    passage = " ".join(f"passage{i}" for i in range(12))
    texts = [" ".join(f"x{(i * 7919 + j * j) % 997}" for j in range(2000)) for i in range(400)] + [passage] * 2
    docs = common.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4))
    rows = {r.doc_id: r for r in suffix_lm.scores(docs, suffix_lm.fitted(docs)).where("doc_id >= 400").collect()}
    assert len(rows) == 2 and all(r.score > r.base_score / 3 for r in rows.values())


def test_suffix_names_are_those_of_spark(spark):
    a, b = (np.array(x, dtype=np.int64) for x in ([0, 1, -1, 2**62, -(2**63)], [5, -7, 0, 2**40, 2**63 - 1]))
    got = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long").select("a", F.xxhash64("a", "b").alias("h"))
    assert dict(zip(a.tolist(), suffix_lm.names(a, b).tolist())) == {r.a: r.h for r in got.collect()}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_levenshtein_automaton():
    terms, stems = {"idiot": 1.0, "worthless": 1.0, "scum": 1.0, "trash": 0.1}, {"lowe": 1.0}
    automaton = toxicity.Automaton(terms, stems)
    draw = random.Random(5)
    words = list(terms) + ["lowe", "lowei", "low"]
    for _ in range(3000):
        w = list(draw.choice(words))
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(w) + 1)
            w[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "e", "s"])
        w = "".join(w)
        fuzzy = any(edits(w, t) <= toxicity.errors_allowed(t, s) for t, s in terms.items())
        want = 0 if w in terms else 1 if w.startswith("lowe") else 2 if fuzzy else -1
        assert automaton.kind(w) == want, w


def test_toxicity_quotes_and_misspellings():
    model = toxicity.Model({"idiot": 1.0}, {}, frozenset(), np.array([-4.0, 4.0, 4.0, 0.0, 0.0]))
    score = lambda t: toxicity.probability(model, t)
    assert score("you idiot") > score("an idiot") > score('the word "idiot" is rude') > score(None) == score("")
    assert score("you idoit, you idiiot") > 0.7


def test_toxicity_on_held_out_rows(spark):
    at = "/root/testdata/sf0.1"
    got = queries.op9_toxicity(spark, at).join(spark.read.parquet(f"{at}/labels.parquet"), "doc_id").where("held_out")
    right = {r.toxic: r.share for r in got.groupBy("toxic").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("share")).collect()}
    assert right[1] > 0.85 and right[0] > 0.98


def test_toxicity_on_awkward_rows(spark, tables, rows):
    got = queries.op9_toxicity(spark, tables).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)


def test_pieces_are_lossless_and_repeatable(spark, tables, rows):
    got = queries.op10_pieces(spark, tables).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    again = queries.op10_pieces(spark, tables).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_pieces_round_trip_and_batching(monkeypatch):
    model = pieces.Pieces()
    texts = ["Hello  wörld\n a", "", None, "   ", "a▁b \U0001f600 漢字\x00\t\r\n", "\n\n", "x" * 9000, "ab " * 5000]
    whole = pieces.encode_texts(model, texts, list(range(8)))
    assert [pieces.decode_ids(model, i) for i in whole] == [t or "" for t in texts]
    monkeypatch.setattr(pieces, "BATCH_CHARS", 300)
    for a, b in zip(whole, pieces.encode_texts(model, texts, list(range(8))), strict=True):
        assert a.tolist() == b.tolist()


def test_pieces_go_to_workers_without_what_they_do_not_use():
    model = pieces.Pieces()
    sent = pickle.loads(pickle.dumps(model))
    texts = ["A few wörds", None, "", "日本 " * 300]
    for a, b in zip(pieces.encode_texts(model, texts, list(range(4))), pieces.encode_texts(sent, texts, list(range(4))), strict=True):
        assert a.tolist() == b.tolist()
    assert not hasattr(sent, "texts") and not hasattr(sent, "plain")


def test_batches_of_pieces_are_cut_into_slices(spark):
    """An Arrow batch of many rows is worked on in slices, each row with its own pieces."""
    assert [list(pieces._slices(n)) for n in (0, 3, 600)] == [[], [(0, 3)], [(0, 256), (256, 256), (512, 88)]]
    rows = [(i, None if i % 7 == 0 else f"row {i} ünd " * (i % 5)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    model = pieces.Pieces()
    want = pieces.encode_texts(model, [t for _, t in rows], [str(i) for i, _ in rows])
    got = {r.doc_id: r for r in pieces.decoded(pieces.encoded(docs)).collect()}
    assert all(got[i].decoded == (t or "") and got[i].ids == want[i].tolist() for i, t in rows)


def test_pieces_are_drawn_by_their_share():
    model = pieces.Pieces()
    weights = {t: (i, w) for i, t, w in model.plain}

    def ways(text):
        if not text:
            yield (), 0.0
        for k in range(1, len(text) + 1):
            if text[:k] in weights:
                for rest, w in ways(text[k:]):
                    yield (weights[text[:k]][0], *rest), w + weights[text[:k]][1]

    share = {s: math.exp(w) for s, w in ways(" there")}
    total, n = sum(share.values()), 20_000
    ids, sizes = pieces.sample(model, [" there"] * n, np.array([pieces.row_key(i) for i in range(n)], dtype=np.uint64), np.zeros(n, dtype=np.int64))
    seen = collections.Counter(tuple(x.tolist()) for x in np.split(ids, np.cumsum(sizes)[:-1]))
    for s, w in share.items():
        assert abs(seen[s] / n - w / total) < 0.02


def test_pipeline(spark):
    """Each stage's rows against the operator's decisions on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, SF))
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert set(ids) <= kept and ids
        if name in ("toxicity", "exact dedup", "SimHash near-dedup"):
            assert len(ids) == len(set(ids)) and out.columns == docs.columns
        if name == "exact dedup":
            bodies = [re.sub(r"\s", "", r.text or "") for r in out.collect()]
            assert len(bodies) == len(set(bodies)) == len({re.sub(r"\s", "", r.text or "") for r in docs.collect()})
        if name == "SimHash near-dedup":
            prints = {r.doc_id: simhash.fingerprint(r.text) & (2**64 - 1) for r in docs.collect()}
            assert set(ids) == set(brute_components(prints, 4).values())
        if name == "mixing":
            want = {r.doc_id: r.copies for r in mixing.mixed(docs).collect() if r.copies}
            assert collections.Counter(ids) == want and out.columns == docs.columns
        if name == "SentencePiece":
            texts, model = {r.doc_id: r.text for r in docs.collect()}, pieces.Pieces()
            assert all(pieces.decode_ids(model, r.ids) == (texts[r.doc_id] or "") for r in out.collect())
        docs, kept = out, set(ids)


def test_pipeline_runs_one_python_worker_a_task(spark, rows):
    """Pieces are decoded from stored rows, not by a second worker beside the encoder's."""
    docs = common.stored(spark.createDataFrame(rows, DOCS))
    plan = corpus_pipeline.to_pieces(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_pipeline_decodes_its_pieces(spark, rows, monkeypatch):
    docs = common.stored(spark.createDataFrame(rows, DOCS))
    out = corpus_pipeline.to_pieces(spark, docs, SF)
    assert out.columns == [*docs.columns, "ids", "lossless"]
    assert out.where("lossless").count() == len(rows)
    monkeypatch.setattr(corpus_pipeline.pieces, "encoder", lambda docs: F.array().cast("array<int>"))
    lost = corpus_pipeline.to_pieces(spark, docs, SF).where("not lossless").count()
    assert lost == sum(bool(r[1]) for r in rows)
