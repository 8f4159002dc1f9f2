"""Ranked lexical search the other way round: documents stream through an index of the queries.

The items are few and the documents many, so the index is made of the items: for each of their terms, the
items that hold it. One pass over the texts counts the terms of the index in each document and stores these
counts; sums over them give the statistics of the whole corpus. In a second pass, over the stored counts, the
index is broadcast, each document's counts run through it, and each task keeps a bounded heap for each item.
The heaps are merged in two steps.

An index is broadcast up to a proven size: items are dealt into blocks of about ``MOST_POSTINGS`` pairs of
item and term, and each block is searched on its own.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.terms import term_slices
from tidemill.session import stored

#: Fixed values of the score: scale of weights, scale of gains, per cent of the length that counts, and the
#: factors of a count and of the length in the denominator.
WEIGHT_SCALE, SCALE, SLOPE, COUNT_FACTOR, LENGTH_FACTOR = 1000, 1_000_000_000, 90, 1000, 8
BEST = 10
#: Pairs of item and term in a block, cells of documents by items that a task scores at once and documents
#: that it begins with, parts of the first merge.
MOST_POSTINGS, CELLS, FIRST, MERGES = 1_000_000, 1 << 20, 16, 64


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``no, item, term``: the distinct terms of each row of ``items``; ``no`` numbers the rows."""
    rows = stored(items.select(F.monotonically_increasing_id().alias("no"), F.col(key).alias("item"), F.col(text).alias("text")), "items")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, item, body in zip(*(batch.column(c) for c in ("no", "item", "text")), strict=True):
                terms: set[bytes] = set()
                for part in term_slices(body.as_py()):
                    terms.update(part)
                n = len(terms)
                yield pa.RecordBatch.from_arrays([pa.repeat(no, n), pa.repeat(item, n), pa.array(sorted(terms), pa.binary())], ["no", "item", "term"])

    return stored(rows.mapInArrow(cut, f"no long, item {rows.schema['item'].dataType.simpleString()}, term binary"), "item-terms")


def term_counts(docs: DataFrame, terms: list[bytes], key: str, text: str) -> DataFrame:
    """For each row of ``docs`` its key, ``n`` (all its terms), and the counts ``tf`` of the listed terms that
    it holds (``term``: their places in the list)."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            sizes, found = [], []
            for body in batch.column("text").to_pylist():
                n, held = 0, Counter()
                for part in term_slices(body):
                    n += len(part)
                    held.update(filter(place.__contains__, part))
                sizes.append(n)
                found.append(held)
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            at = pa.array([place[t] for h in found for t in h], pa.int32())
            tf = pa.array([c for h in found for c in h.values()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, at), pa.ListArray.from_arrays(ends, tf)], ["doc", "n", "term", "tf"]
            )

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "doc long, n long, term array<int>, tf array<long>")


def weights(n_docs: int, held: np.ndarray) -> np.ndarray:
    """Weights of terms that stand in ``held`` of the documents, in doubles, rounded down."""
    return np.floor(WEIGHT_SCALE * np.log((2.0 * n_docs + 2) / (2.0 * held + 1))).astype(np.int64)


class Heaps:
    """The best documents of each item so far: highest score first, of equal scores the smallest key."""

    def __init__(self, items: int, best: int):
        self.best = best
        self.held: list[list[tuple[int, int]]] = [[] for _ in range(items)]
        # what a document must beat: its score, and its key if scores are equal
        self.score = np.zeros(items, dtype=np.int64)
        self.key = np.full(items, np.iinfo(np.int64).min)

    def offer(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """Scores of documents (rows) for all items (columns)."""
        better = (scores > self.score) | ((scores == self.score) & (docs[:, None] < self.key))
        for at, item in zip(*np.nonzero(better), strict=True):
            heap, entry = self.held[item], (int(scores[at, item]), -int(docs[at]))
            if len(heap) < self.best:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.best:
                self.score[item], self.key[item] = heap[0][0], -heap[0][1]


def _searched(counts: DataFrame, terms: list[bytes], postings: DataFrame, best: int) -> DataFrame:
    """``no, doc, score``: the best documents of each item from each task."""
    spark = counts.sparkSession
    n_docs, total = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(terms), dtype=np.int64)
    for row in counts.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow().to_pylist():
        held[row["term"]] = row["df"]
    place = {t: i for i, t in enumerate(terms)}
    rows = postings.select("no", "term").toArrow()
    numbers, item = np.unique(rows.column("no").to_numpy(), return_inverse=True)
    term = np.fromiter((place[t] for t in rows.column("term").to_pylist()), dtype=np.int64, count=rows.num_rows)
    order = np.argsort(term, kind="stable")
    begins = np.searchsorted(term[order], np.arange(len(terms) + 1))
    index = spark.sparkContext.broadcast((numbers, item[order], begins, weights(n_docs, held)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, items, begins, weight = index.value
        heaps = Heaps(len(numbers), best)
        # a few documents first, so that the heaps soon know what to turn away
        step = FIRST
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, step)
                at, step = at + step, min(2 * step, max(FIRST, CELLS // len(numbers)))
                lists, tfs = part.column("term"), part.column("tf")
                size = lists.value_lengths().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(part.num_rows), size)
                t, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy()
                n = part.column("n").to_numpy()[doc]
                m = 100 - SLOPE + (SLOPE * n * n_docs) // total
                gain = weight[t] * ((SCALE * tf) // (COUNT_FACTOR * tf + LENGTH_FACTOR * m))
                reach = begins[t + 1] - begins[t]
                to = items[np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach - begins[t], reach)]
                scores = np.zeros(part.num_rows * len(numbers), dtype=np.int64)
                np.add.at(scores, np.repeat(doc, reach) * len(numbers) + to, np.repeat(gain, reach))
                heaps.offer(scores.reshape(part.num_rows, -1), part.column("doc").to_numpy())
        out = [(numbers[i], -key, score) for i, heap in enumerate(heaps.held) for score, key in heap]
        no, doc, score = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(no, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["no", "doc", "score"])

    return counts.where("size(term) > 0 AND doc IS NOT NULL").mapInArrow(search, "no long, doc long, score long")


def _kept(found: DataFrame, by: list[str], best: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "doc"))
    return found.withColumn("rank", place).where(F.col("rank") <= best)


def ranked(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", best: int = BEST,
    most_postings: int = MOST_POSTINGS,
) -> DataFrame:
    """``item`` (under its own name), ``rank, doc_id, score``: the best documents of each row of ``items``.

    Scores are whole numbers: saturated counts of the item's distinct terms, weighed by how few documents
    hold them. Documents with score 0 are no results; of equal scores the smallest key comes first. Rows of
    ``docs`` without a key are no results, but count in the statistics. Rows of ``docs`` with the same key are
    documents of their own. Null texts have no terms, and items without terms no results.
    """
    spark = docs.sparkSession
    pairs = item_terms(items, item, text)
    blocks = max(1, -(-pairs.count() // most_postings))
    found = spark.createDataFrame([], "no long, doc long, score long")
    for block in range(blocks):
        postings = pairs.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == block)
        terms = sorted(postings.select("term").distinct().toArrow().column("term").to_pylist())
        counts = stored(term_counts(docs, terms, key, text), "term-counts")
        found = found.unionByName(_searched(counts, terms, postings, best))
    found = stored(found, "heaps")
    merged = _kept(found.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(MERGES))), ["no", "part"], best).select("no", "doc", "score")
    names = pairs.select("no", F.col("item").alias(item)).distinct()
    return _kept(merged, ["no"], best).join(names, "no").select(item, F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")
