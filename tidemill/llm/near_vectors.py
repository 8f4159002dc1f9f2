"""Near-duplicate vectors by product quantisation, without losing a pair.

A bounded sample fits a coarse quantiser and, on the residuals, one codebook for each subspace. Every vector
is put in the inverted list of its nearest centre and coded. A vector probes all lists that can hold a vector
within the radius: the bound follows from the distance to the plane between two centres, so the probes
suffice. In a list, distances to the codes are summed from tables; a code's own error, which is stored,
bounds how far the true distance lies below, so only pairs that can't be close are left out. The rest is
compared by exact cosine.

Lists are cut into pieces of bounded size, probing vectors too; a task holds one piece of each. Pairs are
counted and reduced to spanning links where they are found, so no row per pair leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import components, numbered
from tidemill.session import stored, stored_in_rounds

MIN_COSINE = 0.95
#: Vectors, those of smallest hash, that the quantisers are fitted on.
SAMPLE_ROWS = 16_384
#: There are sqrt(rows) lists, up to this many. Vectors of a list, and probing vectors, that meet in a task.
MOST_LISTS, LIST_PIECE, PROBE_PIECE = 4096, 1024, 2048
SUBSPACES, CODES, ROUNDS = 8, 256, 8
#: Bytes of vectors that are dealt to pieces at a time: so many times the bytes of all, or so many if that is more.
ROUND_SHARE, ROUND_BYTES = 2, 1 << 28
#: Numbers that are held at once beside the vectors and centres.
HELD = 1 << 21
_SLACK, _TABLE_SLACK = 1e-9, 1e-4


def unit_rows(vectors: list[list | None], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are usable (right length, all components finite, not zero), and these as unit vectors in
    double precision."""
    good = np.array([v is not None and len(v) == dim and None not in v for v in vectors], dtype=bool)
    rows = np.array([v for v, g in zip(vectors, good, strict=True) if g], dtype=np.float64).reshape(-1, max(dim, 1))
    top = np.abs(rows).max(axis=1, initial=0.0)
    fine = np.isfinite(top) & (top > 0) & np.isfinite(rows).all(axis=1)
    good[np.flatnonzero(good)[~fine]] = False
    rows = rows[fine] / top[fine, None]
    return good, rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    square = (centres**2).sum(1) - 2 * rows @ centres.T
    at = square.argmin(1)
    return at, square


def k_means(rows: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Centres of a bounded sample; an empty one stays where it was."""
    draw = np.random.default_rng(seed)
    centres = rows[draw.choice(len(rows), size=min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        at, _ = _nearest(rows, centres)
        count = np.bincount(at, minlength=len(centres))
        order = np.argsort(at, kind="stable")
        used = count > 0
        sums = np.add.reduceat(rows[order], (np.cumsum(count) - count)[used], axis=0)
        centres[used] = sums / count[used, None]
    return centres


def _between(centres: np.ndarray) -> np.ndarray:
    """Distances of all centres to each other, a few rows at a time: the differences are never held at once."""
    out = np.empty((len(centres), len(centres)))
    step = max(1, HELD // centres.size)
    for lo in range(0, len(centres), step):
        out[lo : lo + step] = np.linalg.norm(centres[lo : lo + step, None] - centres[None], axis=2)
    return out


class Quantiser:
    """Centres of the lists and codebooks of the residuals' subspaces."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        self.dim = sample.shape[1]
        self.cuts = [range(*x) for x in zip(*(lambda e: (e[:-1], e[1:]))([self.dim * i // SUBSPACES for i in range(SUBSPACES + 1)]), strict=True) if x[1] > x[0]]
        self.centres = k_means(sample, lists)
        rest = sample - self.centres[_nearest(sample, self.centres)[0]]
        self.books = [k_means(rest[:, list(c)], CODES) for c in self.cuts]
        self.between = _between(self.centres)

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and error of each vector, and its squared distances to all centres less its square."""
        at, square = _nearest(rows, self.centres)
        rest = rows - self.centres[at]
        codes = np.stack([_nearest(rest[:, list(c)], b)[0] for c, b in zip(self.cuts, self.books, strict=True)], axis=1).astype(np.uint8)
        shown = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return at, codes, np.linalg.norm(rest - shown, axis=1), square

    def probes(self, at: np.ndarray, square: np.ndarray, radius: float) -> np.ndarray:
        """Which lists may hold a vector within the radius: the own one and those whose plane to the own
        centre is not further off."""
        gap = square - square[np.arange(len(at)), at][:, None]
        return gap <= 2 * radius * self.between[at] + _SLACK

    def table(self, rest: np.ndarray, subspace: int) -> np.ndarray:
        """Squared distances from all codes of a subspace to the residuals of probing vectors, a column each."""
        cut, book = self.cuts[subspace], self.books[subspace]
        part = rest[:, cut.start : cut.stop]
        return ((book**2).sum(1)[:, None] - 2 * book @ part.T + (part**2).sum(1)[None]).astype(np.float32)


def close_pairs(
    quantiser: Quantiser, at: int, probing: np.ndarray, base: np.ndarray, codes: np.ndarray, errors: np.ndarray, min_cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the probing and listed vectors whose cosine is at least ``min_cosine``."""
    radius = float(np.sqrt(max(2 - 2 * min_cosine, 0))) + _SLACK
    # tables and sums are in single precision, which the slack makes up for
    within = ((radius + errors) ** 2 + _TABLE_SLACK).astype(np.float32)[:, None]
    out = []
    for lo in range(0, len(probing), 256):
        part = probing[lo : lo + 256]
        rest = part - quantiser.centres[at]
        square = np.zeros((len(base), len(part)), dtype=np.float32)
        for i in range(codes.shape[1]):
            square += quantiser.table(rest, i)[codes[:, i]]
        y, x = np.nonzero(square <= within)
        fits = np.einsum("ij,ij->i", part[x], base[y]) >= min_cosine
        out.append((x[fits] + lo, y[fits]))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int))


def _roots(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """The smallest node of each node's component."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_links(vectors: DataFrame, dim: int, rows: int, min_cosine: float = MIN_COSINE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``a, b, n``: for vectors ``rid, embedding, copies``, how many (with copies) are linked to ``a``, and
    spanning links from ``a`` to ``b``. One of a pair's lists finds it, once."""
    spark = vectors.sparkSession
    few = vectors.orderBy(F.xxhash64("rid"), "rid").limit(sample_rows).select("embedding").toArrow()
    _, sample = unit_rows(few.column(0).to_pylist(), dim)
    if not len(sample):  # nothing to compare
        return spark.createDataFrame([], "a long, b long, n long")
    quantiser = Quantiser(sample, min(MOST_LISTS, int(np.ceil(np.sqrt(rows)))))
    radius = float(np.sqrt(max(2 - 2 * min_cosine, 0))) + _SLACK
    shared = spark.sparkContext.broadcast(quantiser)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        step = max(256, HELD // len(q.centres))
        for batch in (whole.slice(lo, step) for whole in batches for lo in range(0, whole.num_rows, step)):
            good, units = unit_rows(batch.column("embedding").to_pylist(), dim)
            ids, copies = (batch.column(c).to_numpy(zero_copy_only=False)[good] for c in ("rid", "copies"))
            at, codes, errors, square = q.encode(units) if len(units) else (np.zeros(0, int), np.zeros((0, 1), np.uint8), np.zeros(0), np.zeros((0, len(q.centres))))
            # each pair meets in the list of the higher number, or in the common one
            lists = [(np.flatnonzero(p[a:]) + a).tolist() for p, a in zip(q.probes(at, square, radius), at.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(copies), pa.array(at.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors), pa.array([u.tobytes() for u in units], pa.binary()), pa.array(lists, pa.list_(pa.int32()))],
                ["rid", "copies", "list", "codes", "error", "unit", "probes"],
            )

    indexed = stored(vectors.mapInArrow(index, "rid long, copies long, list int, codes binary, error double, unit binary, probes array<int>"), "index")
    probing = indexed.select("rid", "copies", F.col("list").alias("own"), "unit", F.explode("probes").alias("list"))
    # pieces: how many each list and its probing vectors need; a row per list
    held = indexed.groupBy("list").agg(F.count("*").alias("n_held"), F.ceil(F.count("*") / LIST_PIECE).cast("int").alias("pieces"))
    asked = probing.groupBy("list").agg(F.count("*").alias("n_asked"), F.ceil(F.count("*") / PROBE_PIECE).cast("int").alias("waves"))
    cut = stored(held.join(asked, "list"), "pieces")
    # lists take turns, so that the vectors dealt in a round are no more than a few times all vectors
    dealt, n_vectors = cut.agg(F.sum(F.col("n_held") * F.col("waves") + F.col("n_asked") * F.col("pieces")), F.sum("n_held")).first()
    rounds = max(1, -(-(dealt or 0) * 8 * dim // max(ROUND_BYTES, ROUND_SHARE * (n_vectors or 0) * 8 * dim)))
    cut = cut.select("list", "pieces", "waves")
    spot = F.xxhash64("rid")
    base = (
        indexed.select(*(F.col(c).alias(c) for c in ("rid", "copies", "list", "codes", "error", "unit"))).join(F.broadcast(cut), "list")
        .select("rid", "copies", "list", "codes", "error", "unit", F.pmod(spot, F.col("pieces")).cast("int").alias("piece"), F.explode(F.sequence(F.lit(0), F.col("waves") - 1)).alias("wave"))
    )
    probing = (
        probing.join(F.broadcast(cut), "list")
        .select(*(F.col(c).alias(c) for c in ("rid", "copies", "list", "own", "unit")), F.pmod(spot, F.col("waves")).cast("int").alias("wave"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    )

    def meet(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        if not len(ask) or not len(have):
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
        at = int(have["list"].iloc[0])
        left, right = (np.frombuffer(b"".join(x["unit"])).reshape(len(x), -1) for x in (ask, have))
        codes = np.frombuffer(b"".join(have["codes"]), dtype=np.uint8).reshape(len(have), -1)
        x, y = close_pairs(shared.value, at, left, right, codes, have["error"].to_numpy(), min_cosine)
        i, j = ask["rid"].to_numpy()[x], have["rid"].to_numpy()[y]
        once = (ask["own"].to_numpy()[x] != at) | (i < j)
        x, y, i, j = x[once], y[once], i[once], j[once]
        ids, place = np.unique(np.concatenate([i, j]), return_inverse=True)
        count = np.bincount(place, weights=np.concatenate([have["copies"].to_numpy()[y], ask["copies"].to_numpy()[x]]), minlength=len(ids))
        root = _roots(place[: len(i)], place[len(i) :], len(ids))
        return pd.DataFrame({"a": ids, "b": ids[root], "n": count.astype(np.int64)})

    keys = ("list", "piece", "wave")

    def links(turn: int) -> DataFrame:
        ask, have = (x.where(F.pmod(F.xxhash64("list"), F.lit(rounds)) == turn) if rounds > 1 else x for x in (probing, base))
        return ask.groupBy(*keys).cogroup(have.groupBy(*keys)).applyInPandas(meet, "a long, b long, n long")

    return links(0) if rounds == 1 else stored_in_rounds([links(r) for r in range(rounds)], "near")


def near_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row for each row of ``vectors``: the key, ``n_links`` (other rows with a cosine of at least
    ``min_cosine``), ``component_id`` (smallest key that links reach, itself included), ``kept`` (whether that
    is its own).

    Vectors that are null, zero, or hold null or non-finite components link with nothing. The vectors of each
    length are searched by themselves, with their own quantiser. Equal vectors are one class before the search.
    Rows without a key count as links; a component of such rows alone has none.
    """
    rows = numbered(vectors.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("embedding")))
    e = F.col("embedding")
    usable = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = rows.withColumn("embedding", F.when(F.coalesce(usable, F.lit(False)), e))
    classes = stored(
        rows.where("embedding is not null").groupBy("embedding").agg(F.min("rid").alias("rid"), F.count("*").alias("copies")), "vectors"
    )
    found = None
    for dim, n in classes.groupBy(F.size("embedding").alias("dim")).count().where("count > 1").orderBy("dim").collect():
        more = stored(near_links(classes.where(F.size("embedding") == dim), dim, n, min_cosine), "near")
        found = more if found is None else found.unionByName(more)
    if found is None:  # nothing to compare
        found = classes.sparkSession.createDataFrame([], "a long, b long, n long")
    links = found.groupBy("a").agg(F.sum("n").alias("n"))
    parts = components(found.select("a", "b"))
    heads = (
        classes.join(links, classes.rid == links.a, "left").join(parts, classes.rid == parts.node, "left")
        .select(F.col("embedding"), F.coalesce("component", "rid").alias("part"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    placed = stored(
        rows.join(heads, "embedding", "left").select("key", F.coalesce("part", F.col("rid")).alias("part"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "placed"
    )
    least = placed.groupBy("part").agg(F.min("key").alias("component_id"))
    return placed.join(least, "part").select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
