"""Spelling variants: words one edit apart, found by scans of the sorted vocabulary.

The vocabulary is sorted and cut into blocks of neighbouring words. A block is scanned for many words at
once, depth by depth: the banded row of the edit matrix of a prefix is computed once and serves all entries
that share the prefix (their number follows from the longest common prefixes of adjacent entries), and a
range of entries is skipped as soon as its shared prefix is more than one edit away. With one edit the band
has three cells, and each is 0, 1 or more, so a row is three bits.

An edit in the second half of a word leaves its first half to be found in the sorted list, an edit in the
first half the second half in the list of reversed words. So a word visits only the blocks that hold its
half, and there ranges start to differ only at that depth. Blocks are cut by rank and not by prefix: words
of a crowded prefix go to several blocks, and the words that visit a block are cut into slices.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import stored

#: What words are made of, which of them lose a letter, and which are kept.
LETTER = "A-Za-zÀ-ÿ"
SLIPS, LEAST_CHARS, LEAST_SEEN, RATIO = 31, 7, 2, 10
#: Words in a block of the sorted list, blocks at most (then they grow), and characters kept of a block's ends.
BLOCK_WORDS, MOST_BLOCKS, END_CHARS = 20_000, 65_536, 64
#: Words looked up at once, words that a task counts before it passes them on, characters cut at once.
SCANNED, COUNTED_WORDS, SLICE_CHARS = 4_000, 200_000, 1 << 20

_RUN = re.compile(f"[{LETTER}]{{{LEAST_CHARS},}}+")
_OTHER = re.compile(f"[^{LETTER}]")
#: The edit is still to come; cells of the row that are one: entry one longer, as long, one shorter.
_OPEN, _LONGER, _SAME, _SHORTER = 8, 1, 2, 4


def runs(text: str | None) -> Iterator[list[str]]:
    """Maximal runs of at least ``LEAST_CHARS`` letters, A-Z lower-cased; very long texts in several lists."""
    body = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    at = 0
    while len(body) - at > SLICE_CHARS:
        cut = _OTHER.search(body, at + SLICE_CHARS)
        if not cut:
            break
        yield _RUN.findall(body, at, cut.start())
        at = cut.start()
    yield _RUN.findall(body, at)


def word_of(run: str, seed: int) -> str:
    """The run, or without one code point if its hash says so. ``seed`` is the hash of what stands before it."""
    h = zlib.crc32(run.encode(), seed)
    at = h % len(run)
    return run if h % SLIPS else run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words of all texts, with how often they occur, if at least ``LEAST_SEEN`` times.

    Null texts have no words; a null key counts as an empty one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for own, body in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seed = zlib.crc32(f"{own}:".encode())
                for part in runs(body):
                    for run, n in Counter(part).items():
                        word = word_of(run, seed)
                        if len(word) >= LEAST_CHARS:
                            found[word] += n
                if len(found) > COUNTED_WORDS:
                    yield _counted(found)
                    found = Counter()
        yield _counted(found)

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_SEEN)


def _counted(found: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])


# ---- scan of one block -------------------------------------------------------------------------------


class SortedList:
    """Sorted distinct words as code points, with the common prefixes of neighbours."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length, self.start, self.code = _codes(words)
        self.common = np.zeros(len(words), dtype=np.int64)
        left = np.arange(1, len(words))
        depth = 0
        while len(left):
            left = left[(self.length[left] > depth) & (self.length[left - 1] > depth)]
            left = left[self.code[self.start[left] + depth] == self.code[self.start[left - 1] + depth]]
            depth += 1
            self.common[left] = depth

    def place(self, word: str) -> int:
        at = bisect_left(self.words, word)
        return at if at < len(self.words) and self.words[at] == word else -1


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return length, np.cumsum(length) - length, np.append(code, -1)


def near_entries(entries: SortedList, asked: list[str], opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of asked words and of entries that are one edit apart and share the first ``opens`` code
    points of the asked word, or more."""
    length, start, code = _codes(asked)

    def letter(q: np.ndarray, at: int) -> np.ndarray:
        """The letter of each asked word at a place, -1 beyond its end and before its begin."""
        inside = (length[q] > at) & (at >= 0)
        return np.where(inside, code[np.where(inside, start[q] + at, len(code) - 1)], -1)

    out_q, out_e = [], []
    alive = np.arange(len(entries.words))
    heads = np.zeros(min(1, len(alive)), dtype=np.int64)  # places in alive where a prefix of this depth begins
    q, node = np.arange(len(asked)), np.zeros(len(asked), dtype=np.int64)
    state = np.full(len(asked), _OPEN)
    own = np.fromiter((entries.place(w) for w in asked), dtype=np.int64, count=len(asked))
    depth = 0
    while len(q) and len(heads):
        # entries that end here
        first = alive[heads[node]]
        gap = length[q] - depth
        hit = (entries.length[first] == depth) & (
            ((state & _LONGER > 0) & (gap == -1)) | ((state & _SAME > 0) & (gap == 0)) | ((state & (_SHORTER | _OPEN) > 0) & (gap == 1))
        )
        hit &= (state != _OPEN) | (opens[q] <= depth)
        out_q.append(q[hit])
        out_e.append(first[hit])
        # a range that holds nothing but the word itself is done
        size = np.diff(np.append(heads, len(alive)))
        keep = (state != _OPEN) | (size[node] > 1) | (first != own[q])
        q, node, state = q[keep], node[keep], state[keep]
        # the prefixes that are one longer
        longer = entries.length[alive] > depth
        above = np.repeat(np.arange(len(heads)), size)[longer]
        alive = alive[longer]
        begins = np.flatnonzero((entries.common[alive] <= depth) | np.append(True, above[1:] != above[:-1])) if len(alive) else alive
        parent, added = above[begins], entries.code[entries.start[alive[begins]] + depth]
        rows = (parent << 21) | added
        open_ = state == _OPEN
        one = _opened(q[open_], node[open_], depth, parent, added, opens, length, letter, rows)
        two = _followed(q[~open_], node[~open_], state[~open_], depth, letter, rows)
        q, node, state = (np.concatenate(x) for x in zip(one, two, strict=True))
        heads = begins
        depth += 1
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *out_q]), np.concatenate([none, *out_e])


def _opened(q, node, depth, parent, added, opens, length, letter, rows):
    """Next rows of prefixes without an edit so far: the same letter goes on, any other is the edit."""
    same, same_at = _found(rows, node, letter(q, depth))
    on = q[same], same_at, np.full(same.sum(), _OPEN)
    may = opens[q] <= depth
    q, node = q[may], node[may]
    low, high = np.searchsorted(parent, node), np.searchsorted(parent, node, side="right")
    count = high - low
    wide = np.repeat(q, count)
    child = np.arange(len(wide)) - np.repeat(np.cumsum(count) - count - low, count)
    other = added[child] != letter(wide, depth)
    wide, child = wide[other], child[other]
    state = _LONGER | np.where(length[wide] > depth, _SAME, 0) | np.where(added[child] == letter(wide, depth + 1), _SHORTER, 0)
    return np.concatenate([on[0], wide]), np.concatenate([on[1], child]), np.concatenate([on[2], state])


def _followed(q, node, state, depth, letter, rows):
    """Next rows of prefixes with an edit: each cell that is one asks for one letter."""
    cells = [(_LONGER, letter(q, depth - 1)), (_SAME, letter(q, depth)), (_SHORTER, letter(q, depth + 1))]
    parts = []
    for i, (bit, asked) in enumerate(cells):
        usable = (state & bit > 0) & (asked >= 0)
        for earlier, before in cells[:i]:
            usable &= ~((state & earlier > 0) & (before == asked))
        there, at = _found(rows, node[usable], asked[usable])
        pick = np.flatnonzero(usable)[there]
        new = np.zeros(len(pick), dtype=np.int64)
        for other, theirs in cells:
            new |= np.where((state[pick] & other > 0) & (theirs[pick] == asked[pick]), other, 0)
        parts.append((q[pick], at, new))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _found(rows: np.ndarray, node: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes have a longer prefix with the asked letter, and the numbers of these prefixes."""
    if not len(rows):
        return np.zeros(len(node), dtype=bool), np.zeros(0, dtype=np.int64)
    wanted = (node << 21) | np.maximum(asked, 0)
    at = np.minimum(np.searchsorted(rows, wanted), len(rows) - 1)
    there = (rows[at] == wanted) & (asked >= 0)
    return there, at[there]


# ---- all blocks --------------------------------------------------------------------------------------


def half(length: int, reverse: bool) -> int:
    """Code points that must agree before an edit in the list read forwards (backwards: reversed words)."""
    # the words differ first at place length // 2 or later, or before it; then the rest agrees
    return length - length // 2 if reverse else length // 2


def _near_in(words: DataFrame, reverse: bool, block_words: int) -> DataFrame:
    """``word, n, n_near, best`` for each word and block that it visits in one of the two sorted lists."""
    spark = words.sparkSession
    sorted_by = F.reverse("word") if reverse else F.col("word")
    blocks = max(1, min(MOST_BLOCKS, -(-words.count() // block_words)))
    rows = words.select("word", "n", sorted_by.alias("entry")).repartitionByRange(blocks, "entry").withColumn("block", F.spark_partition_id())
    rows = stored(rows, "sorted")
    ends = rows.groupBy("block").agg(F.min("entry").alias("lo"), F.max("entry").alias("hi"))
    ends = ends.select("block", F.left("lo", F.lit(END_CHARS)).alias("lo"), F.left("hi", F.lit(END_CHARS)).alias("hi")).orderBy("block").collect()
    held = spark.sparkContext.broadcast(([r["block"] for r in ends], [r["lo"] for r in ends], [r["hi"] for r in ends]))

    def visits(entry: str) -> list[int]:
        """Blocks that may hold words that share the half of this one; a block whose words all share a
        prefix more than one edit away is skipped."""
        numbers, los, his = held.value
        prefix = entry[: min(half(len(entry), reverse), END_CHARS)]
        # ends are cut, so the comparison is of cut words, and errs to the wide side
        begin = bisect_left(his, prefix)
        end = bisect_right(los, prefix + "\U0010ffff" * 2)
        if end - begin <= 1:
            return numbers[begin:end]
        return [numbers[i] for i in range(begin, end) if _prefix_near(los[i], his[i], entry)]

    @F.pandas_udf("array<int>")
    def visited(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([visits(e) for e in batch])

    asked = stored(rows.select("word", "n", "entry", F.explode(visited("entry")).alias("block")), "visits")
    slices = asked.groupBy("block").agg(F.ceil(F.count("*") / (2 * block_words)).cast("int").alias("slices"))
    asked = asked.join(F.broadcast(slices), "block").withColumn("slice", F.pmod(F.xxhash64("word"), F.col("slices")).cast("int")).drop("slices")
    copies = rows.join(F.broadcast(slices), "block").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    both = asked.withColumn("listed", F.lit(False)).unionByName(copies.withColumn("listed", F.lit(True)))

    def scan(block: pd.DataFrame) -> pd.DataFrame:
        listed = block[block["listed"]].sort_values("entry", kind="stable")
        questions = block[~block["listed"]].sort_values("entry", kind="stable")
        entries = SortedList(listed["entry"].tolist())
        seen, words_ = listed["n"].to_numpy(), listed["word"].to_numpy()
        texts = questions["entry"].tolist()
        near, best = np.zeros(len(texts), dtype=np.int64), np.full(len(texts), -1)
        # of equal counts the smallest word wins: rank entries by both
        rank = np.empty(len(seen), dtype=np.int64)
        rank[np.lexsort((words_, -seen))] = np.arange(len(seen))
        by_rank = np.argsort(rank)
        for at in range(0, len(texts), SCANNED):
            part = texts[at : at + SCANNED]
            opens = np.array([half(len(w), reverse) for w in part])
            q, e = near_entries(entries, part, opens)
            if reverse:
                q, e = _first_half_differs(q, e, part, entries.words)
            near[at : at + len(part)] = np.bincount(q, minlength=len(part))
            top = np.full(len(part), len(seen))
            np.minimum.at(top, q, rank[e])
            best[at : at + len(part)] = np.where(top < len(seen), by_rank[np.minimum(top, len(seen) - 1)], -1) if len(seen) else -1
        return pd.DataFrame({
            "word": questions["word"].to_numpy(), "n": questions["n"].to_numpy(), "n_near": near,
            "best_n": [int(seen[b]) if b >= 0 else None for b in best], "best_word": [words_[b] if b >= 0 else None for b in best],
        }).astype({"best_n": "Int64"})

    return both.groupBy("block", "slice").applyInPandas(scan, "word string, n long, n_near long, best_n long, best_word string")


def _first_half_differs(q: np.ndarray, e: np.ndarray, asked: list[str], entries: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Leaves out pairs that the list read forwards finds: those that agree in the first half."""
    def agrees(a: str, b: str) -> bool:
        n = half(len(a), False)
        return a[: -n - 1 : -1] == b[: -n - 1 : -1]

    keep = np.fromiter((not agrees(asked[i], entries[j]) for i, j in zip(q.tolist(), e.tolist(), strict=True)), dtype=bool, count=len(q))
    return q[keep], e[keep]


def _prefix_near(lo: str, hi: str, entry: str) -> bool:
    """Whether what all words from ``lo`` to ``hi`` share is at most one edit from a prefix of the entry."""
    n = 0
    while n < min(len(lo), len(hi)) and lo[n] == hi[n]:
        n += 1
    row = (2, 0, 1)  # the row of the empty prefix: entry's prefixes of length -1, 0, 1
    for i in range(n):
        c = lo[i]
        letters = [entry[j] if 0 <= j < len(entry) else "" for j in (i - 1, i, i + 1)]
        longer = min(row[0] + (c != letters[0]), row[1] + 1)
        same = min(row[1] + (c != letters[1]), row[2] + 1, longer + 1)
        shorter = min(row[2] + (c != letters[2]), same + 1)
        row = (longer, same, shorter)
        if min(row) > 1:
            return False
    return True


def variants(words: DataFrame, ratio: int = RATIO, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each of the distinct words ``word, n``: ``word, form, root`` (strings), ``n, n_near,
    form_n``.

    Two words are near if exactly one inserted, deleted or replaced code point makes them equal; words have
    at least ``LEAST_CHARS`` code points. ``form`` is the near word of largest ``n`` (of equal ones the first
    in code-point order), if its ``n`` is at least ``ratio`` times the word's, else null; ``root`` is where
    the forms end, the word itself without a form. No words give no rows.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    found = _near_in(words, False, block_words).unionByName(_near_in(words, True, block_words))
    # a word visits several blocks: counts add up, and of the best ones the best stays
    best = F.min(F.when(F.col("best_word").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best_word").alias("word")))).alias("best")
    near = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    is_form = -F.col("best.less") >= ratio * F.col("n")
    near = near.select("word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    near = stored(near, "near")
    roots = _roots(near.where("form is not null").select("word", "form"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last form of each chain. Counts grow along a chain, so it ends; its length halves
    in each round."""
    links = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = links.select(F.col("word").alias("mid"), F.col("root").alias("far"))
        longer = stored(links.join(ahead, links.root == ahead.mid, "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "forms")
        links = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`variants` of the words of all texts (see :func:`vocabulary`)."""
    return variants(vocabulary(docs, key, text))
