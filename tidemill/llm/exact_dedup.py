"""Exact duplicates by deterministic block naming.

The text without white space is cut into blocks of a fixed number of characters. Equal blocks get the
same whole number as a name, different blocks different ones. Then adjacent pairs of names are named in
the same way, again and again, until each document has a single name. Names are compared, never hashed:
two documents with the same number of blocks and the same last name are equal, all others are not.

DataFrame functions only. Each round is one keyed count and one keyed join; a block that a third of all
documents hold is combined before the shuffle on the one side and is a skewed join key, which adaptive
execution splits, on the other. The number of rounds is log2(blocks of the longest text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import SPACE, free_names, numbered, quoted, settled, text_or_empty
from tidemill.session import stored

BLOCK_CHARS = 1024


def normalised(text: Column) -> Column:
    """The text without white space; null is empty."""
    return F.regexp_replace(text_or_empty(text), SPACE, "")


def identities(docs: DataFrame, text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each row of ``docs``: ``rid`` (see :func:`~tidemill.llm.common.numbered`),
    ``doc_id, n_chars, text_sha256``, and the identity ``n_blocks, name``.

    Null and empty texts, and texts of white space only, are one empty block. The identity does not
    depend on ``text_sha256``, which is only carried along.
    """
    rows = numbered(docs.select("doc_id", F.col(text).alias("text"))).select(
        "rid", "doc_id", F.length(text_or_empty(F.col("text"))).cast("long").alias("n_chars"), normalised(F.col("text")).alias("body")
    )
    cut = F.when(F.col("body") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("body", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    )
    blocks = (
        rows.select("rid", "doc_id", "n_chars", F.sha2("body", 256).alias("text_sha256"), cut.alias("cut"))
        .select("rid", "doc_id", "n_chars", "text_sha256", F.size("cut").cast("long").alias("n_blocks"), F.posexplode("cut").alias("pos", "block"))
        .withColumn("uid", F.monotonically_increasing_id())
    )
    # a block's name is the smallest number of a place where it stands
    names = blocks.groupBy("block").agg(F.min("uid").alias("name"))
    first = F.col("pos") == 0
    level = stored(
        blocks.join(names, "block").select(
            "rid", F.col("pos").cast("long").alias("pos"), "uid", "name", "n_blocks",
            *(F.when(first, F.col(c)).alias(c) for c in ("doc_id", "n_chars", "text_sha256")),
        ),
        "blocks",
    )
    heads = level.where("pos = 0").select("rid", "doc_id", "n_chars", "text_sha256", "n_blocks")
    level = level.select("rid", "pos", "uid", "name", F.col("n_blocks").alias("left_over"))
    done = [level.where("left_over = 1").select("rid", "name")]
    longest = heads.agg(F.max("n_blocks")).first()[0] or 1
    while longest > 1:
        level = stored(_pair_names(level.where("left_over > 1")), "pairs")
        done.append(level.where("left_over = 1").select("rid", "name"))
        longest = -(-longest // 2)
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return heads.join(named, "rid")


def _pair_names(level: DataFrame) -> DataFrame:
    """Names adjacent pairs of names; a last odd one is a pair with nothing (-1)."""
    pairs = stored(
        level.groupBy("rid", F.expr("pos div 2").alias("pos")).agg(
            F.min("uid").alias("uid"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("r"),
            F.expr("(max(left_over) + 1) div 2").alias("left_over"),
        ),
        "pairs",
    )
    names = pairs.groupBy("l", "r").agg(F.min("uid").alias("name"))
    return pairs.join(names, ["l", "r"]).select("rid", "pos", "uid", "name", "left_over")


def duplicate_groups(docs: DataFrame, text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each row of ``docs``, dropped ones too: ``rid, doc_id, keep_id, group_size, kept,
    text_sha256``.

    Of equal texts the row with the most code points stays, then the smallest ``doc_id`` (null last),
    then the first row, so that of fully equal rows one stays.
    """
    rows = stored(identities(docs, text, block_chars), "identities")
    order = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d"), F.col("rid").alias("r"))
    groups = rows.groupBy("n_blocks", "name").agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    return rows.join(groups, ["n_blocks", "name"]).select(
        "rid", "doc_id", F.col("best.d").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.r")).alias("kept"), "text_sha256"
    )


def without_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``, whatever their names."""
    docs = settled(docs)
    (rid,) = free_names(docs, "rid")
    stay = duplicate_groups(docs, text).where("kept").select(F.col("rid").alias(rid))
    return numbered(docs, rid).join(stay, rid, "left_semi").select(*map(quoted, docs.columns))
