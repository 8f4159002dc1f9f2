"""Spelling variants, license scans and ranked search against brute force, on awkward tables: nulls, empty and very
long texts, repeated rows, ties, columns with clashing names."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from tidemill.llm import license_scan, ranked_search, spelling, terms

COLUMNS = "doc_id long, text string, word string, n long, block int, mark string, key string, score string, doc int, term string, tf int, candidates int"


def table(spark, texts):
    """Documents with columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "w", 1, 2, "m", "k", "s", 3, "t", 4, 5) for i, t in texts], COLUMNS).repartition(3)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- spelling variants ------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(texts):
    found = collections.Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower(text)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            found[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def brute_variants(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if one_edit(w, v) and v != w]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best and words[best] >= 10 * n else None, n, len(near))
    rows = set()
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, near, words[form] if form else None))
    return rows


def spelled(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.fixture(scope="module")
def misspelled():
    draw = random.Random(7)
    stems = ["tidemill", "tidemills", "Waterwheel", "WATERWHEELS", "grindstone", "éclusière", "abababab", "ababababa", "aaaaaaa", "aaaaaaaa", "x" * 3000, "×÷×÷×÷×", "short", "mahl\U0001f600stein"]
    texts = []
    for i in range(60):
        text = []
        for _ in range(60):
            w = draw.choice(stems[: 4 + i % 11])
            if draw.random() < 0.2:
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice("abé") + w[at:], w[:at] + draw.choice("abé") + w[at + 1 :]])
            text.append(w)
        texts.append((i, draw.choice([" ", "-", "1", "\n"]).join(text)))
    return texts + [(None, texts[0][1]), (3, texts[3][1]), (3, texts[3][1]), (70, None), (71, ""), (72, "tidemill " * 20_000), (73, "y" * 30_000 + " " + "y" * 29_999 + "z " + "y" * 30_000 + " " + "y" * 29_999 + "z")]


@pytest.mark.parametrize("block_words", [5, 20_000])
def test_spelling_variants(spark, misspelled, block_words):
    words = brute_words(misspelled)
    counted = spelling.vocabulary(table(spark, misspelled))
    assert {r.word: r.n for r in counted.collect()} == words
    assert spelled(spelling.variants(counted, block_words=block_words)) == brute_variants(words)


def test_crowded_prefix(spark):
    """Words that share a long prefix or suffix lie in several blocks, and all pairs are found."""
    draw = random.Random(3)
    words = {"waterwheel" + "".join(draw.choice("ab") for _ in range(draw.randint(3, 7))): draw.randint(2, 500) for _ in range(150)}
    words |= {w[::-1]: n for w, n in words.items()}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    assert spelled(spelling.variants(rows, block_words=8)) == brute_variants(words)


def test_roots_follow_long_chains(spark):
    chain = [("abcdefgh"[:i] + "x" * (8 - i), 2 * 10**i) for i in range(9)]
    words = dict(chain)
    got = spelled(spelling.variants(spark.createDataFrame(chain, "word string, n long")))
    assert got == brute_variants(words)
    assert {r[2] for r in got} == {"abcdefgh"}


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(table(spark, [])).count() == 0
    assert spelling.spelling_variants(table(spark, [(1, None), (2, ""), (3, "once only")])).count() == 0


@pytest.mark.parametrize("reverse", [False, True])
def test_scan_of_a_block(reverse):
    draw = random.Random(9)
    for _ in range(60):
        words = sorted({"".join(draw.choice("abé") for _ in range(draw.randint(7, 9))) for _ in range(80)})
        entries = sorted(w[::-1] if reverse else w for w in words)
        asked = entries + [draw.choice(entries)[:-1] + "q" for _ in range(5)]
        q, e = spelling.near_entries(spelling.SortedList(entries), asked, np.array([3] * len(asked)))
        got = {(asked[i], entries[j]) for i, j in zip(q.tolist(), e.tolist(), strict=True)}
        assert got == {(a, b) for a in asked for b in entries if a != b and one_edit(a, b) and a[:3] == b[:3]}


# ---- terms -------------------------------------------------------------------------------------------


def test_terms_of_long_texts(monkeypatch):
    text = "Ab c9-d\x00é\U0001f600Z. 'x'\n" * 500 + "y" * 3000
    want = [t.encode() for t in re.findall(terms.TERM, lower(text))]
    assert [t for part in terms.term_slices(text) for t in part] == want
    monkeypatch.setattr(terms, "SLICE_BYTES", 50)
    parts = list(terms.term_slices(text))
    assert len(parts) > 100 and [t for part in parts for t in part] == want
    rolled, last = [], np.zeros(0, dtype=np.uint64)
    for part in parts:
        some, last = license_scan.grams(part, last)
        rolled += some.tolist()
    assert rolled == license_scan.grams(want, np.zeros(0, dtype=np.uint64))[0].tolist()


# ---- license scans -----------------------------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_edits(template, words):
    """Fewest edits between the template and any part of the words."""
    row = [0] * (len(words) + 1)
    for t in template:
        step = [row[0] + 1]
        for j, w in enumerate(words):
            step.append(min(row[j] + (t != w), row[j + 1] + 1, step[j] + 1))
        row = step
    return min(row)


def brute_licenses(text):
    words = words_of(text)
    places, base, labels, score = [], set(), set(), 0.0
    for t in license_scan.TEMPLATES:
        own = words_of(t.text)
        if t.phrase:
            hits = [i for i in range(len(words)) if words[i : i + len(own)] == own]
            places += hits
            if hits:
                base.add(t.label)
                labels.add(t.label)
                score = 1.0
        elif (wrong := brute_edits(own, words)) <= t.edits():
            labels.add(t.label)
            score = max(score, 1 - wrong / len(own))
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(labels), score


@pytest.fixture(scope="module")
def licensed():
    draw = random.Random(5)
    filler = "the tide mill grinds grain under the old wheel of this license and by nc cc mit".split()
    texts = ["Under the MIT license", "CC BY-NC cc by nc by nc", "cc by", "under the\tmit\x00LICENSE under the mit licenses", "apache license, version 2" * 3]
    for t in license_scan.TEMPLATES:
        for changes in (0, 1, 2, len(words_of(t.text)) // 5, len(words_of(t.text)) // 5 + 1, len(words_of(t.text)) // 2):
            own = words_of(t.text)
            for _ in range(changes):
                at = draw.randrange(len(own)) if own else 0
                own = draw.choice([own[:at] + own[at + 1 :], own[:at] + ["wheel"] + own[at:], own[:at] + ["wheel"] + own[at + 1 :]])
            texts.append(" ".join([*draw.choices(filler, k=draw.randint(0, 30)), *own, *draw.choices(filler, k=draw.randint(0, 30))]))
    texts += [" ".join(draw.choices(filler, k=60)) for _ in range(20)]
    texts += [None, "", " ...", " ".join(draw.choices(filler, k=3000)) + " cc by nc", "cc by nc " * 2000, "x" * 50_000]
    rows = list(enumerate(texts))
    return rows + [(None, texts[0]), (None, None), (1, texts[1]), (1, texts[1]), (1, texts[0]), (2, texts[0])]


def test_license_scan(spark, licensed):
    got = license_scan.scanned(table(spark, licensed)).collect()
    found = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, tuple(r.base_labels), tuple(r.labels), round(r.score, 9)) for r in got)
    want = collections.Counter()
    for i, text in licensed:
        n, places, first, last, base, labels, score = brute_licenses(text)
        want[i, n, places, first, last, tuple(base), tuple(labels), round(score, 9)] += 1
    assert found == want


def test_license_scan_of_nothing(spark):
    assert license_scan.scanned(table(spark, [])).count() == 0


def test_short_templates_are_an_error():
    with pytest.raises(ValueError, match="3 words"):
        license_scan.template_grams((license_scan.Template("x", "two words"),))


# ---- ranked search -----------------------------------------------------------------------------------


def brute_ranked(docs, items, best=10):
    counted = [(i, collections.Counter(re.findall(terms.TERM, lower(t)))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    out = []
    for item, text in items:
        scores = []
        own = set(re.findall(terms.TERM, lower(text)))
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c in counted) + 1))) for t in own}
        for (doc, c), n in zip(counted, sizes, strict=True):
            m = 10 + 90 * n * n_docs // max(total, 1)
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, rank + 1, doc, -less) for rank, (less, doc) in enumerate(sorted(scores)[:best])]
    return collections.Counter(out)


@pytest.fixture(scope="module")
def searched():
    draw = random.Random(11)
    names = [f"w{i}" for i in range(40)] + ["Été", "\U0001f600", "A1"]
    docs = [(i, " ".join(draw.choices(names, k=draw.randint(1, 40)))) for i in range(120)]
    docs += [(200 + i, docs[0][1]) for i in range(15)] + [(None, docs[1][1]), (300, None), (301, ""), (302, "..."), (303, "w1 " * 50_000), (7, docs[7][1]), (7, docs[8][1])]
    items = [(i, " ".join(draw.choices(names, k=draw.randint(1, 8)))) for i in range(30)]
    return docs, [*items, (0, docs[0][1]), (None, "w1 w2"), (50, None), (51, ""), (52, "nowhere")]


@pytest.mark.parametrize("most_postings", [40, 1_000_000])
def test_ranked_search(spark, searched, most_postings):
    docs, items = searched
    asked = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, no string, item string")
    got = ranked_search.ranked(table(spark, docs), asked, most_postings=most_postings)
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_ranked(docs, items)


def test_ranked_search_of_nothing(spark, searched):
    docs, items = searched
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert ranked_search.ranked(table(spark, []), asked).count() == 0
    assert ranked_search.ranked(table(spark, docs), asked.where("false")).count() == 0
    assert ranked_search.ranked(table(spark, [(1, None), (2, "")]), asked).count() == 0
