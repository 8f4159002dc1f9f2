"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

A fingerprint is cut into ``distance + spare`` blocks. Two fingerprints that differ in at most
``distance`` bits share at least ``spare`` blocks, so they meet in one of the tables keyed by ``spare``
of the blocks. Equal fingerprints are one class before that; links join classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import components, free_names, numbered, quoted, settled
from tidemill.session import stored

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
#: Blocks whose values key a table. 2 of 6 blocks: 15 tables, keys of 21 bits. For billions of documents
#: take 4 of 8: 70 tables, keys of 32 bits, fewer chance meetings.
SPARE_BLOCKS = 2
#: Buckets up to this size are joined by Spark; larger ones are compared in pieces of BUCKET_PIECE.
SMALL_BUCKET = 8
BUCKET_PIECE = 4096
SEED = 42

_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one whole text, as a signed 64-bit number; zero without words.

    Words are runs without white space after lower-casing A-Z; a text of fewer words than a shingle is
    one shingle. A bit is set if over half of the shingles' hashes have it.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    ends = np.cumsum([len(t) + 1 for t in tokens])
    joined = b" ".join(tokens)
    span = min(words, len(tokens))
    begins = [0, *ends[: len(tokens) - span].tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[b : e - 1], SEED) for b, e in zip(begins, ends[span - 1 :].tolist(), strict=True)], dtype=np.uint64)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BIT_OF_BYTE for i in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``rid, doc_id, fp`` for each row of ``docs``."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, words) for t in batch], dtype="int64")

    return numbered(docs.select("doc_id", F.col(text).alias("text"))).select("rid", "doc_id", of("text").alias("fp"))


def block_masks(distance: int = MAX_DISTANCE, spare: int = SPARE_BLOCKS) -> list[int]:
    """The bits that key each table, as signed numbers."""
    n = distance + spare
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(blocks, spare)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(prints: DataFrame, distance: int = MAX_DISTANCE, spare: int = SPARE_BLOCKS) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that connect exactly those which chains of
    pairs within ``distance`` bits connect. No pair beyond the distance is a link.

    Small buckets give all their pairs. A larger one gives a spanning forest; it is compared in pieces,
    every two pieces in a task of their own, so that no task holds more than two pieces.
    """
    keys = F.array(*(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(block_masks(distance, spare))))
    rows = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(rows.join(sizes, ["t", "key"]), "buckets")
    few = shared.where(F.col("n") <= SMALL_BUCKET)
    other = few.select(F.col("fp").alias("fp2"), "t", "key")
    pairs = few.join(other, ["t", "key"]).where((F.col("fp") < F.col("fp2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= distance))
    pieces = F.ceil(F.col("n") / BUCKET_PIECE).cast("int")
    many = (
        shared.where(F.col("n") > SMALL_BUCKET)
        .withColumn("pieces", pieces)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("fp", "t", "key", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
    )

    def linked(bucket: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(spanning_links(bucket["fp"].to_numpy(), distance), columns=["a", "b"], dtype="int64")

    forests = many.groupBy("t", "key", "i", "j").applyInPandas(linked, "a long, b long")
    return pairs.select(F.col("fp").alias("a"), F.col("fp2").alias("b")).unionByName(forests)


def spanning_links(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within the distance."""
    left = np.unique(prints).view(np.uint64)
    out: list[tuple[int, int]] = []
    while len(left) > 1:
        open_ = [left[0]]
        left = left[1:]
        while open_ and len(left):
            at = open_.pop()
            near = np.bitwise_count(left ^ at) <= distance
            if near.any():
                hits = left[near]
                left = left[~near]
                out += [(int(at.view(np.int64)), h) for h in hits.view(np.int64).tolist()]
                open_ += list(hits)
    return out


def near_groups(
    docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, spare: int = SPARE_BLOCKS
) -> DataFrame:
    """One row for each row of ``docs``: ``rid, doc_id, fp, component_id`` (the smallest ``doc_id`` that
    chains of links reach, itself included; null only if none of them has one) and ``kept`` (the first
    row of the smallest ``doc_id`` of its group).

    Null and empty texts have fingerprint zero and link with each other like any equal ones.
    """
    rows = stored(fingerprints(docs, text, words), "fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d"), F.col("rid").alias("r"))).alias("best")
    classes = stored(rows.groupBy("fp").agg(best), "classes")
    parts = components(fingerprint_links(classes.select("fp"), distance, spare))
    joined = classes.join(parts, classes.fp == parts.node, "left").select("fp", "best", F.coalesce("component", "fp").alias("part"))
    heads = joined.groupBy("part").agg(F.min("best").alias("head"))
    heads = joined.select("fp", "part").join(heads, "part").select("fp", "head")
    return rows.join(heads, "fp").select(
        "rid", "doc_id", "fp", F.col("head.d").alias("component_id"), (F.col("rid") == F.col("head.r")).alias("kept")
    )


def without_near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of each group, with the columns of ``docs``, whatever their names."""
    docs = settled(docs)
    (rid,) = free_names(docs, "rid")
    stay = near_groups(docs, text).where("kept").select(F.col("rid").alias(rid))
    return numbered(docs, rid).join(stay, rid, "left_semi").select(*map(quoted, docs.columns))
