"""License scans by diagonal voting.

Rolling hashes of all runs of ``GRAM`` words are joined with the places of the templates' runs. A document
and a template that share text agree on diagonals: place in the document minus place in the template. Votes
are counted by diagonal, neighbouring diagonals (words put in or left out shift them) are merged, and only
where a template that close must have left so many votes are the words themselves compared, by an edit
matrix that runs over the window of the merged diagonals. Equal hashes thus never decide anything.

Templates are a parameter; their hashes are broadcast up to ``MOST_GRAMS``. The comparison reads the texts a
second time, only those that have candidates: a list of at most ``BUCKETS`` hash values keeps the others out
of the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.terms import TERM, term_slices
from tidemill.session import stored


@dataclass(frozen=True)
class Template:
    """A text that stands for a license; the places of ``phrase`` templates are counted one by one."""

    label: str
    text: str
    phrase: bool = False

    def words(self) -> list[bytes]:
        return [w for part in term_slices(self.text) for w in part]

    def edits(self) -> int:
        """Words that may be changed, put in or left out: none in a phrase, else at most the share
        ``MOST_EDITS``, and so few that one run of ``GRAM`` words at least is untouched."""
        n = len(self.words())
        return 0 if self.phrase else max(0, min(int(MOST_EDITS * n), (n - GRAM) // GRAM))

    def least_votes(self) -> int:
        """Votes that so many edits leave, since each edit breaks ``GRAM`` runs at most."""
        return len(self.words()) - GRAM + 1 - GRAM * self.edits()


#: Phrases and the opening sentences of public licenses, by label.
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
TEMPLATES = PHRASES + (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("mit", "released under the MIT License"),
    Template("mit", "licensed under the MIT License"),
    Template("mit", "SPDX-License-Identifier: MIT"),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("apache-2", "licensed under the Apache License, Version 2.0"),
    Template("apache-2", "SPDX-License-Identifier: Apache-2.0"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("bsd", "under the BSD license"),
    Template("gpl-2", "GNU General Public License, version 2"),
    Template("gpl-3", "GNU General Public License, version 3"),
    Template("gpl-3", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0"),
    Template("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0"),
    Template("cc-by", "Creative Commons Attribution 4.0 International License"),
    Template("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
)
#: Words in a run, share of a template's words that may differ, runs of all templates at most.
GRAM, MOST_EDITS, MOST_GRAMS = 3, 0.2, 1_000_000
#: Hash values that name documents with candidates, rows that a task passes on at once.
BUCKETS, ROWS_AT_ONCE = 1 << 20, 1 << 17

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_VERIFIED = "key string, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double"


def grams(words: list[bytes], before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of the runs that end in ``words``; ``before`` are hashes of the words that precede them,
    as returned by the last call for the same text."""
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    own = np.concatenate([before, own])
    if len(own) < GRAM:
        return np.zeros(0, dtype=np.uint64), own
    rolled = own[: len(own) - GRAM + 1].copy()
    for i in range(1, GRAM):
        rolled = rolled * _FACTOR + own[i : len(own) - GRAM + 1 + i]
    return rolled, own[len(own) - GRAM + 1 :]


def template_grams(templates: tuple[Template, ...]) -> list[tuple[int, int, int]]:
    """Hash, number of the template and place of each run of its words."""
    out = []
    for no, template in enumerate(templates):
        words = template.words()
        if len(words) < GRAM:
            raise ValueError(f"a template has {GRAM} words at least: {template.text!r}")
        rolled, _ = grams(words, np.zeros(0, dtype=np.uint64))
        out += [(int(h), no, at) for at, h in enumerate(rolled.view(np.int64).tolist())]
    if len(out) > MOST_GRAMS:
        raise ValueError(f"the templates have more than {MOST_GRAMS} runs of words")
    return out


def rolling_grams(docs: DataFrame) -> DataFrame:
    """``mark, place, gram`` for each run of words of ``mark, text``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: list[int] = []
        parts: list[np.ndarray] = []
        begins: list[int] = []
        held = 0

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(p) for p in parts], dtype=np.int64)
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - np.array(begins, dtype=np.int64), sizes)
            mark = np.repeat(np.array(marks, dtype=np.int64), sizes)
            gram = np.concatenate([np.zeros(0, dtype=np.uint64), *parts]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(mark), pa.array(place, pa.int32()), pa.array(gram)], ["mark", "place", "gram"])

        for batch in batches:
            for mark, body in zip(batch.column("mark").to_pylist(), batch.column("text").to_pylist(), strict=True):
                last, at = np.zeros(0, dtype=np.uint64), 0
                for words in term_slices(body):
                    rolled, last = grams(words, last)
                    for i in range(0, len(rolled), ROWS_AT_ONCE):
                        piece = rolled[i : i + ROWS_AT_ONCE]
                        marks.append(mark)
                        parts.append(piece)
                        begins.append(at + i)
                        held += len(piece)
                        if held >= ROWS_AT_ONCE:
                            yield flush()
                            marks, parts, begins, held = [], [], [], 0
                    at += len(rolled)
        if parts:
            yield flush()

    return docs.mapInArrow(cut, "mark long, place int, gram long")


def windows(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """``mark, template, lo, hi``: merged diagonals with enough votes. Rows of ``docs`` are ``mark, text``;
    rows that share a mark only add votes, and votes only propose."""
    spark = docs.sparkSession
    places = F.broadcast(spark.createDataFrame(template_grams(templates), "gram long, template int, at int"))
    hits = rolling_grams(docs).join(places, "gram").select("mark", "template", (F.col("place") - F.col("at")).alias("diagonal"))
    votes = hits.groupBy("mark", "template", "diagonal").agg(F.count("*").alias("votes"))
    # the k-th template's slack and least votes, as arrays of a fixed size
    slack = F.array(*(F.lit(t.edits()) for t in templates))[F.col("template")]
    least = F.array(*(F.lit(t.least_votes()) for t in templates))[F.col("template")]
    order = Window.partitionBy("mark", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > slack, F.lit(True))
    chains = votes.withColumn("apart", apart.cast("int")).withColumn("chain", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = chains.groupBy("mark", "template", "chain").agg(F.min("diagonal").alias("lo"), F.max("diagonal").alias("hi"), F.sum("votes").alias("votes"))
    return merged.where(F.col("votes") >= least).select("mark", "template", "lo", "hi")


def least_edits(template: np.ndarray, window: np.ndarray) -> int:
    """Fewest words changed, put in or left out that turn the template into some part of the window."""
    along = np.arange(len(window) + 1)
    row = np.zeros(len(window) + 1, dtype=np.int64)
    for word in template:
        step = np.empty_like(row)
        step[0] = row[0] + 1
        step[1:] = np.minimum(row[:-1] + (window != word), row[1:] + 1)
        row = np.minimum.accumulate(step - along) + along
    return int(row.min())


def _verified(words: list[bytes], candidates: list[dict], templates: list[tuple[Template, list[bytes]]]) -> tuple:
    places, base, labels, score = [], set(), set(), 0.0
    for c in candidates:
        template, own = templates[c["template"]]
        allowed, n = template.edits(), len(own)
        if allowed:
            begin, end = max(0, c["lo"] - allowed), c["hi"] + n + allowed
            numbers = {w: i for i, w in enumerate(dict.fromkeys(own))}
            part = np.fromiter((numbers.get(w, -1) for w in words[begin:end]), dtype=np.int64)
            wrong = least_edits(np.array([numbers[w] for w in own]), part)
        else:
            wrong = 0 if c["lo"] >= 0 and words[c["lo"] : c["lo"] + n] == own else 1
        if wrong > allowed:
            continue
        labels.add(template.label)
        score = max(score, 1 - wrong / n)
        if template.phrase:
            places.append(c["lo"])
            base.add(template.label)
    return len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(labels), score


def scanned(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its key, ``n_words``, the places of phrases ``n_base, first_word,
    last_word``, ``base_labels`` and ``labels`` (sorted arrays), ``score`` (0 to 1).

    A label of the method is one whose template stands somewhere in the text up to its
    ``edits``; the score is the highest share of unchanged words, 0 without a label. Null texts are empty; rows
    with equal key and text have equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(templates)
    name = F.coalesce(F.col("key").cast("string"), F.lit(""))
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    mark, identity = F.xxhash64("key", "text"), F.concat(name, F.lit(":"), F.md5(body))
    found = stored(windows(rows.select(mark.alias("mark"), "text"), templates), "windows")
    lists = found.groupBy("mark").agg(F.collect_list(F.struct("template", "lo", "hi")).alias("candidates"))
    bucket = _bucket(F.col("mark"))
    some = rows.select(mark.alias("mark"), identity.alias("key"), "text").withColumn("bucket", bucket)
    some = some.join(F.broadcast(found.select(bucket.alias("bucket")).distinct()), "bucket", "left_semi")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed = [(t, t.words()) for t in shared.value]
        number, names = pa.int64(), pa.list_(pa.string())
        schema = pa.schema({"key": pa.string(), "n_base": number, "first_word": number, "last_word": number, "base_labels": names, "labels": names, "score": pa.float64()})
        for batch in batches:
            out = []
            for own, body_, candidates in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "candidates")), strict=True):
                words = [w for part in term_slices(body_) for w in part]
                out.append(dict(zip(schema.names, (own, *_verified(words, candidates, parsed)), strict=True)))
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    hits = some.join(lists, "mark").select("key", "text", "candidates").mapInArrow(verify, _VERIFIED).dropDuplicates(["key"])
    sizes = rows.select("key", identity.alias("_identity"), F.regexp_count(body, F.lit(TERM)).cast("long").alias("n_words"))
    hits = hits.withColumnRenamed("key", "_identity")
    none = F.array().cast("array<string>")
    return sizes.join(hits, "_identity", "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _bucket(mark: Column) -> Column:
    return F.pmod(mark, F.lit(BUCKETS))
