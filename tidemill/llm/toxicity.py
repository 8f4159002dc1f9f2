"""Toxicity: a lexicon trie met with Levenshtein automata, windows of context, a calibrated score.

The lexicon is learnt from a bounded sample of labelled rows: words, and stems that several words begin
with, which mark toxic texts. A text's words run through the product of the trie and the automata of all
its terms, which accepts terms, words that begin with a stem, and misspelled terms. Each hit is weighed by
the words around it: a quoted or reported term counts little, a direct insult fully. A logistic regression
on the sums of these weights gives the score.

Scoring is row by row. Only the model, whose size is bounded by its parameters, is sent to the executors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import stored

#: Labelled rows that the model is fitted on, those of smallest hash; terms and stems of the lexicon.
SAMPLE_ROWS = 20_000
MOST_TERMS = 5_000
#: A term or stem stands in at least so many and in this share of the toxic texts, and this share of the
#: texts that hold it is toxic.
LEAST_TEXTS, LEAST_SHARE, PRECISION = 3, 0.004, 0.9
STEM_LENGTHS, STEM_WORDS = range(4, 8), 4
THRESHOLD = 0.7
WINDOW = 6
#: Terms of this strength may be misspelled; what a misspelled one counts.
STRONG, FUZZY_WEIGHT = 0.8, 0.7
#: Marks of quotation, words that report speech, words that address somebody.
QUOTES = "\"“”„«»‹›"
REPORTING = frozenset("said says say quote quoted quotes wrote called word term dijo dice palabra sagte sagt schrieb wort zitat dit disait écrit mot".split())
DIRECT = frozenset("you your you're youre tu tú vous te du dich ihr usted eres es bist are".split())
QUOTED_WEIGHT, REPORTED_WEIGHT, DIRECT_WEIGHT = 0.2, 0.5, 1.5
EXACT, STEM, FUZZY = 0, 1, 2

_WORDS = re.compile(r"\w+")
_TOKENS = re.compile(rf"\w+|[{QUOTES}]")


def errors_allowed(term: str, strength: float) -> int:
    """Misspelled letters that a term may have: none below 5 letters or for weak terms, 1 below 9, else 2."""
    return ((len(term) >= 5) + (len(term) >= 9)) * (strength >= STRONG)


def strength_of(toxic: int, texts: int) -> float:
    """How surely a word marks toxic texts, from 0 to 1: its log odds, which few texts keep low."""
    return float(np.clip(np.log((toxic + 0.5) / (texts - toxic + 0.5)) / 4, 0, 1))


class Automaton:
    """The trie of terms and stems, met with the Levenshtein automata of the terms.

    A state is a set of (trie node, errors so far); states are made when they are first reached. Stems
    count without errors only.
    """

    def __init__(self, terms: dict[str, float], stems: dict[str, float], spared: frozenset[str] = frozenset()) -> None:
        self.spared = spared
        self.errors = {w: errors_allowed(w, x) for w, x in terms.items()}
        self.next: list[dict[str, int]] = [{}]
        self.limit: list[int] = [0]
        self.term: list[str | None] = [None]
        self.stem: list[bool] = [False]
        for word in [*terms, *stems]:
            node = 0
            for char in word:
                if char not in self.next[node]:
                    self.next[node][char] = len(self.next)
                    self.next.append({})
                    self.limit.append(0)
                    self.term.append(None)
                    self.stem.append(False)
                self.limit[node] = max(self.limit[node], self.errors.get(word, 0))
                node = self.next[node][char]
            if word in terms:
                self.term[node] = word
                self.limit[node] = max(self.limit[node], self.errors[word])
            if word in stems:
                self.stem[node] = True
        self.reset()

    def reset(self) -> None:
        start = self._closed({(0, 0)})
        self.states: dict[frozenset, int] = {start: 0}
        self.sets: list[frozenset] = [start]
        self.moves: list[dict[str, int]] = [{}]
        self.accepts: list[int] = [self._accept(start)]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("states", "sets", "moves", "accepts")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.reset()

    def _closed(self, state: set[tuple[int, int]]) -> frozenset:
        """Adds the nodes that skipping letters of a term reaches; drops what can't be accepted."""
        open_ = list(state)
        while open_:
            node, errors = open_.pop()
            for to in self.next[node].values() if node >= 0 else ():
                if errors + 1 <= self.limit[to] and (to, errors + 1) not in state:
                    state.add((to, errors + 1))
                    open_.append((to, errors + 1))
        best: dict[int, int] = {}
        for node, errors in state:
            best[node] = min(errors, best.get(node, errors))
        return frozenset(best.items())

    def _accept(self, state: frozenset) -> int:
        kinds = [
            STEM if node < 0 else EXACT if errors == 0 else FUZZY
            for node, errors in state
            if node < 0 or (self.term[node] is not None and errors <= self.errors[self.term[node]])
        ]
        return min(kinds, default=-1)

    def _move(self, at: int, char: str) -> int:
        reached: set[tuple[int, int]] = set()
        for node, errors in self.sets[at]:
            if node < 0:
                reached.add((-1, 0))
                continue
            for step, to in self.next[node].items():
                if step == char:
                    reached.add((to, errors))
                    if errors == 0 and self.stem[to]:
                        reached.add((-1, 0))
                elif errors + 1 <= self.limit[to]:
                    reached.add((to, errors + 1))
            if errors + 1 <= self.limit[node]:
                reached.add((node, errors + 1))
        state = self._closed(reached)
        if not state:
            to_ = -1
        else:
            to_ = self.states.get(state, -1)
            if to_ < 0:
                to_ = self.states[state] = len(self.sets)
                self.sets.append(state)
                self.moves.append({})
                self.accepts.append(self._accept(state))
        self.moves[at][char] = to_
        return to_

    def kind(self, word: str) -> int:
        """EXACT, STEM or FUZZY; -1 if no term fits or the word is spared."""
        at, moves = 0, self.moves
        for char in word:
            to = moves[at].get(char)
            at = self._move(at, char) if to is None else to
            if at < 0:
                return -1
        found = self.accepts[at]
        return -1 if found == FUZZY and word in self.spared else found


@dataclass
class Model:
    """Lexicon, automaton and the regression's coefficients (the first is the constant)."""

    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    spared: frozenset[str] = frozenset()
    coefficients: np.ndarray = field(default_factory=lambda: np.array([-10.0] + [0.0] * 4))

    def __post_init__(self) -> None:
        self.automaton = Automaton(self.terms, self.stems, self.spared)


def _strength(model: Model, word: str, kind: int) -> float:
    if kind == EXACT:
        return model.terms[word]
    if kind == FUZZY:
        return FUZZY_WEIGHT
    return max(model.stems[word[:k]] for k in STEM_LENGTHS if word[:k] in model.stems)


def features(model: Model, text: str | None) -> list[float]:
    """Of the hits of a whole text: the largest weight, the sums of terms' and stems' weights, the quoted ones.

    A misspelled term counts as a term, a little less.
    """
    lowered = (text or "").lower()
    kind = model.automaton.kind
    hits = {w: k for w in set(_WORDS.findall(lowered)) if (k := kind(w)) >= 0}
    out = [0.0] * 4
    if not hits:
        return out
    tokens = _TOKENS.findall(lowered)
    for i in [i for i, t in enumerate(tokens) if t in hits]:
        before, after = tokens[max(0, i - WINDOW) : i], tokens[i + 1 : i + 1 + WINDOW]
        quoted = any(t in QUOTES for t in before) and any(t in QUOTES for t in after)
        found = hits[tokens[i]]
        weight = _strength(model, tokens[i], found)
        if quoted:
            weight *= QUOTED_WEIGHT
        if any(t in REPORTING for t in before):
            weight *= REPORTED_WEIGHT
        if any(t in DIRECT for t in before) and not quoted:
            weight *= DIRECT_WEIGHT
        out[0] = max(out[0], weight)
        out[2 if found == STEM else 1] += weight
        out[3] += quoted
    return [out[0], *(float(np.log1p(x)) for x in out[1:])]


def probability(model: Model, text: str | None) -> float:
    z = model.coefficients[0] + float(np.dot(model.coefficients[1:], features(model, text)))
    return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled documents: those not held out, of smallest hash.

    Near copies would vote many times; of texts with the same smallest hash of their five-word shingles only
    one is kept. The sample's ids are few and bounded, so they are broadcast to the documents.
    """
    few = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", "toxic")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(rows)
    )

    @F.arrow_udf("long")
    def signature(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_smallest_shingle(t) for t in batch.to_pylist()], pa.int64())

    return (
        docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
        .select("doc_id", "text", "toxic", signature("text").alias("signature"))
        .groupBy("signature", "toxic").agg(F.min(F.struct("doc_id", "text")).alias("row"))
        .select("row.doc_id", "row.text", "toxic")
    )


def _smallest_shingle(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    return min(xxhash.xxh64_intdigest(s, 1) for s in shingles) >> 1


def learn_lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float], set[str]]:
    """Terms and stems with their strength, and the words of clean texts.

    ``sample`` is bounded; so are its words, which are counted on the executors.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, int]] = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                for w in set(_WORDS.findall((text or "").lower())):
                    if len(w) >= 3 and not w.isdigit():
                        rows.append((w, int(toxic > 0)))
            word, marks = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(marks, pa.int64())], ["word", "toxic"])

    texts = sample.agg(F.coalesce(F.sum((F.col("toxic") > 0).cast("long")), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    least = max(LEAST_TEXTS, LEAST_SHARE * texts["t"])
    each = sample.select("text", "toxic").mapInArrow(words, "word string, toxic long")
    counts = each.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("texts"))
    rows = counts.toArrow()
    word, toxic, held = (rows.column(c).to_pylist() for c in ("word", "toxic", "texts"))
    seen = dict(zip(word, zip(toxic, held, strict=True), strict=True))
    clean = {w for w, (t, n) in seen.items() if n > t}
    share = {w: (strength_of(t, n), t) for w, (t, n) in seen.items() if t >= least and t / n >= PRECISION}
    terms = {w: p for w, (p, _) in sorted(share.items(), key=lambda x: -x[1][1])[:MOST_TERMS]}
    begins: dict[str, list[int]] = {}
    for w, (t, n) in seen.items():
        for k in STEM_LENGTHS:
            if len(w) > k:
                sums = begins.setdefault(w[:k], [0, 0, 0])
                sums[0] += t
                sums[1] += n
                sums[2] += 1
    good = {w: strength_of(s[0], s[1]) for w, s in begins.items() if s[2] >= STEM_WORDS and s[0] >= 2 * least and s[0] / s[1] >= PRECISION}
    # a stem whose shorter form is one too adds nothing
    stems = {w: p for w, p in good.items() if not any(w[:k] in good for k in range(STEM_LENGTHS[0], len(w)))}
    return terms, dict(sorted(stems.items(), key=lambda x: -begins[x[0]][0])[:MOST_TERMS]), clean


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled rows that are not held out. Without toxic ones all scores are near 0."""
    sample = stored(training_rows(docs, labels, rows), "toxic-sample")
    terms, stems, clean = learn_lexicon(sample)
    if not terms and not stems:
        return Model()
    automaton = Automaton(terms, stems)
    spared = frozenset(w for w in clean if automaton.kind(w) == FUZZY)
    model = Model(terms, stems, spared)
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(shared.value, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([int(t > 0) for t in batch.column("toxic").to_pylist()], pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "toxic", "x"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    table = sample.select("doc_id", "text", "toxic").mapInArrow(measured, f"doc_id {kind}, toxic long, x array<double>").toArrow()
    x = np.array(table.column("x").to_pylist(), dtype=float).reshape(-1, 4)
    model.coefficients = logistic(x, np.array(table.column("toxic").to_pylist(), dtype=float))
    return model


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Coefficients of a regression with a small square penalty, by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def scorer(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column of scores from 0 to 1; null and empty texts get that of a text without hits."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([probability(shared.value, t) for t in batch.to_pylist()], pa.float64())

    return score(F.col(text))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row."""
    rows = docs.select("doc_id", "text")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer(rows, model).alias("score")).select(
        "*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows below the threshold, with the columns of ``docs``."""
    return docs.where(scorer(docs, model) < THRESHOLD)
