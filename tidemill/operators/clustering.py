"""Scaling, k-means, PCA, DBSCAN, silhouettes and the distance-based anomaly detector."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.operators.blocks import PAIR, block_count, hash_block, into_block_pairs
from tidemill.operators.ordered import exact_percentiles, id_grain, row_numbers
from tidemill.session import cut_lineage, packed


# ---- scaling --------------------------------------------------------------------------------

def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation per column, in place; a constant column becomes 0."""
    stats = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols],
    ).first()
    return df.select(
        *[
            ((F.col(c).cast("double") - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)).alias(c)
            if c in cols
            else F.col(c)
            for c in df.columns
        ]
    )


def standardize_vectors(df: DataFrame, col: str, size: int) -> DataFrame:
    """As ``standardize`` for the elements of an array column."""
    x = [F.element_at(F.col(col), i + 1).cast("double") for i in range(size)]
    stats = df.agg(*[F.avg(e).alias(f"m{i}") for i, e in enumerate(x)], *[F.stddev_pop(e).alias(f"s{i}") for i, e in enumerate(x)]).first()
    means = F.array(*[F.lit(stats[f"m{i}"]) for i in range(size)])
    devs = F.array(*[F.lit(stats[f"s{i}"] or 1.0) for i in range(size)])
    centred = F.zip_with(F.col(col).cast("array<double>"), means, lambda a, b: a - b)
    return df.withColumn(col, F.zip_with(centred, devs, lambda a, b: a / b))


# ---- k-means and PCA ------------------------------------------------------------------------

def as_vectors(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(col).cast("array<double>")))


def fit_kmeans(df: DataFrame, k: int, restarts: int = 10, seed: int = 42, features: str = "features", max_iter: int = 20):
    """The best of several seeded runs by training cost."""
    with packed(df.select(features)) as data:
        return _best_kmeans(data, k, restarts, seed, features, max_iter)


def _best_kmeans(data: DataFrame, k: int, restarts: int, seed: int, features: str = "features", max_iter: int = 20):
    runs = [KMeans(k=k, seed=seed + r, maxIter=max_iter, featuresCol=features, predictionCol="cluster") for r in range(restarts)]
    return min((run.fit(data) for run in runs), key=lambda m: m.summary.trainingCost)


def total_spread(df: DataFrame, col: str, size: int) -> float:
    """Sum of squared distances to the mean: the cost of a single cluster."""
    row = df.agg(*[(F.var_pop(F.element_at(F.col(col), i + 1).cast("double")) * F.count("*")).alias(f"v{i}") for i in range(size)]).first()
    return float(sum(row))


def kmeans_elbow(df: DataFrame, col: str, size: int, ks: Sequence[int], restarts: int = 10, seed: int = 42) -> list[tuple[int, float]]:
    """(k, cost) per k; a single cluster needs no model."""
    with packed(as_vectors(df, col).select(col, "features")) as data:
        return [
            (k, float(total_spread(data, col, size) if k == 1 else _best_kmeans(data.select("features"), k, restarts, seed).summary.trainingCost))
            for k in ks
        ]


def pca(df: DataFrame, col: str, size: int, n: int) -> tuple[DataFrame, list[float]]:
    """Projection of the centred arrays on n principal components (as ``pca``), and the explained shares."""
    means = df.agg(*[F.avg(F.element_at(F.col(col), i + 1).cast("double")) for i in range(size)]).first()
    middle = F.array(*[F.lit(float(m)) for m in means])
    centred = df.withColumn("__c", array_to_vector(F.zip_with(F.col(col).cast("array<double>"), middle, lambda a, b: a - b)))
    model = PCA(k=min(n, size), inputCol="__c", outputCol="__p").fit(centred)
    shares = [float(v) for v in model.explainedVariance.toArray()]
    return model.transform(centred).withColumn("pca", vector_to_array("__p")).drop("__c", "__p"), shares


# ---- silhouette -----------------------------------------------------------------------------

#: Blocks that points are dealt into at most while blocks are small, and points of the largest block.
SILHOUETTE_BLOCKS, SILHOUETTE_BLOCK = 48, 1 << 15


def _product_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by one matrix product; pairs so close (or not finite) that the product would lose
    digits are subtracted."""
    norms = np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1)[None]
    with np.errstate(invalid="ignore", over="ignore"):
        squares = norms - 2.0 * (a @ b.T)
        i, j = np.nonzero(~(squares > 1e-5 * norms) | ~np.isfinite(norms))
        for part in _batches(len(i), 1, a.shape[1]):
            squares[i[part], j[part]] = np.square(a[i[part]] - b[j[part]]).sum(axis=1)
        return np.sqrt(squares, out=squares)


def silhouette_block(n_points: int, least: int) -> int:
    """Points of a block: more of them as points grow in number, so that a block travels to fewer others."""
    return max(least, min(n_points // SILHOUETTE_BLOCKS, SILHOUETTE_BLOCK))


def silhouette(df: DataFrame, key: str, col: str, label: str, block_size: int = 2048) -> DataFrame:
    """Silhouette per point with Euclidean distances, exact: (key, label, a, b, silhouette).

    Every point meets every other in some block pair; a block pair emits one sum per point and
    cluster. Blocks grow with the number of points, up to a bound, since every block is sent to every other; a
    group holds a bounded piece of its distances at once. The work is quadratic, as the measure is defined; for
    millions of points use ``ClusteringEvaluator``, whose squared distances need one pass.
    """
    points = df.select(F.col(key).alias("id"), F.col(col).cast("array<double>").alias("x"), F.col(label).cast("int").alias("c"))
    sizes = points.groupBy("c").agg(F.count("*").alias("n"))
    n_points = points.count()
    blocks = block_count(n_points, silhouette_block(n_points, block_size))
    paired = into_block_pairs(points.withColumn("block", hash_block(F.col("id"), blocks)), "block", blocks)

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["pair_lo"].iloc[0]), int(pdf["pair_hi"].iloc[0])
        a, b = pdf[pdf["block"] == lo], pdf[pdf["block"] == hi]
        parts = [pd.DataFrame({"id": a["id"].iloc[:0], "other": np.zeros(0, int), "dist": np.zeros(0)})]
        if len(a) and len(b):
            xa, xb = np.stack(a["x"].to_numpy()), np.stack(b["x"].to_numpy())
            sides = []
            for points_ in (a, b):
                labels, at = np.unique(points_["c"].to_numpy(), return_inverse=True)
                member = np.zeros((len(points_), len(labels)))
                member[np.arange(len(points_)), at] = 1.0
                sides.append((labels, member))
            (labels_a, of_a), (labels_b, of_b) = sides
            to_b, to_a = np.empty((len(a), len(labels_b))), np.zeros((len(b), len(labels_a)))
            for part in _batches(len(a), len(b), 1):
                d = _product_distances(xa[part], xb)
                to_b[part] = d @ of_b
                to_a += d.T @ of_a[part]
            for total, own, labels in [(to_b, a, labels_b)] + ([] if lo == hi else [(to_a, b, labels_a)]):
                parts.append(
                    pd.DataFrame(
                        {
                            "id": np.repeat(own["id"].to_numpy(), len(labels)),
                            "other": np.tile(labels, len(own)),
                            "dist": total.reshape(-1),
                        }
                    )
                )
        return pd.concat(parts)

    id_type = points.schema["id"].dataType.simpleString()
    partial = paired.groupBy(*PAIR).applyInPandas(sums, f"id {id_type}, other int, dist double")
    per = partial.groupBy("id", "other").agg(F.sum("dist").alias("dist"))
    per = per.join(sizes.withColumnRenamed("c", "other"), "other").join(points.select("id", "c"), "id")
    own = F.col("other") == F.col("c")
    ab = per.groupBy("id", "c").agg(
        F.max(F.when(own, F.col("n"))).alias("n_own"),
        F.max(F.when(own, F.try_divide(F.col("dist"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("dist") / F.col("n"))).alias("b"),
    )
    s = F.when(F.col("n_own") == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    return ab.select(F.col("id").alias(key), F.col("c").alias(label), "a", "b", s.alias("silhouette"))


# ---- DBSCAN ---------------------------------------------------------------------------------

#: Dimensions that cells are laid over, points that a cell should hold on average, distances held at once.
GRID_DIMENSIONS, FEW_POINTS, HELD_DISTANCES = 3, 64, 1 << 21
#: Points of a large part that ask which other parts are near.
FEW_ASKERS = 8


class _Ranged:
    """Points in the order of their distance to a pivot: by the triangle inequality, what lies within eps of
    a point lies within eps of its distance."""

    def __init__(self, points: np.ndarray, pivot: np.ndarray):
        self.reach = _distances(points, pivot[None])[:, 0]
        self.order = np.argsort(self.reach, kind="stable")
        self.points, self.reach = points[self.order], self.reach[self.order]

    def slice(self, reach: np.ndarray, eps: float) -> slice:
        slack = 1e-9 * (1 + abs(reach).max())
        return slice(*np.searchsorted(self.reach, [reach.min() - eps - slack, reach.max() + eps + slack]))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(a[:, None] - b[None]).sum(axis=2))


def _batches(n: int, others: int, dims: int) -> Iterator[slice]:
    step = max(1, HELD_DISTANCES // max(1, others * dims))
    return (slice(at, at + step) for at in range(0, n, step))


def _enough_near(asked: np.ndarray, others: np.ndarray, weights: np.ndarray, eps: float, least: int, pivot: np.ndarray) -> np.ndarray:
    """Summed weights of the others within eps of each asked point; counting ends once ``least`` is reached."""
    found = np.zeros(len(asked), dtype=np.int64)
    if not len(asked) or not len(others):
        return found
    near, mine = _Ranged(others, pivot), _Ranged(asked, pivot)
    weights = weights[near.order]
    counts = np.zeros(len(asked), dtype=np.int64)
    for part in _batches(len(asked), 64, asked.shape[1] * 16):
        within = near.slice(mine.reach[part], eps)
        todo, total = np.arange(part.start, min(part.stop, len(asked))), np.zeros(min(part.stop, len(asked)) - part.start, dtype=np.int64)
        step, at = 64, within.start
        while len(todo) and at < within.stop:
            upto = min(at + step, within.stop)
            hit = _distances(mine.points[todo], near.points[at:upto]) <= eps
            total[todo - part.start] += hit @ weights[at:upto]
            todo = todo[total[todo - part.start] < least]
            at, step = upto, max(64, HELD_DISTANCES // max(1, len(todo) * asked.shape[1]))
        counts[part] = total
    found[mine.order] = counts
    return found


def _forest(points: np.ndarray, eps: float, pivot: np.ndarray) -> np.ndarray:
    """For each point the first point of its component, where points within eps are linked. A point is
    compared with those not reached yet, so a crowd costs a few comparisons per point."""
    ranged = _Ranged(points, pivot)
    root = np.full(len(points), -1)
    left = np.arange(len(points))  # places in the order of distance to the pivot
    while len(left):
        members, todo, left = [left[:1]], left[:1], left[1:]
        while len(todo) and len(left):
            batch, todo = todo[:16], todo[16:]
            lo, hi = np.searchsorted(left, [ranged.slice(ranged.reach[batch], eps).start, ranged.slice(ranged.reach[batch], eps).stop])
            hit = np.zeros(len(left), dtype=bool)
            for part in _batches(hi - lo, len(batch), points.shape[1]):
                at = left[lo:hi][part]
                hit[lo + part.start : lo + part.start + len(at)] = (_distances(ranged.points[at], ranged.points[batch]) <= eps).any(axis=1)
            members.append(left[hit])
            todo, left = np.concatenate([todo, left[hit]]), left[~hit]
        own = ranged.order[np.concatenate(members)]
        root[own] = own.min()
    return root


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component of the edges (a, b).

    Each round takes the least label among a node's neighbours, as an aggregate that combines
    map-side, then jumps to the label's own label. Rounds are cut by checkpoints.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = cut_lineage(both)
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")))
    while True:
        offered = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("offer"))
        )
        lower = labels.join(offered, "node").select("node", "root", F.least("root", "offer").alias("next"))
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        moved = cut_lineage(
            lower.join(jump, "next", "left").select("node", "root", F.least("next", F.coalesce("beyond", "next")).alias("next"))
        )
        changed = moved.filter("root <> next").limit(1).count()
        labels = moved.select("node", F.col("next").alias("root"))
        if not changed:
            return labels


def _usable(col: str, size: int) -> Column:
    x = F.col(col)
    return x.isNotNull() & (F.size(x) == size) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))


def _cell_side(points: DataFrame, wide: Sequence[int], eps: float) -> float:
    """A side of at least eps, doubled while cells would hold too few points to be worth a group."""
    sides = [eps * (1 + 1e-9) * 2**i for i in range(6)]
    cells = [F.approx_count_distinct(F.array(*[F.floor(F.element_at("x", d + 1) / side) for d in wide])) for side in sides]
    n, *counts = points.agg(F.count("*"), *cells).first()
    return next((side for side, c in zip(sides, counts, strict=True) if n >= FEW_POINTS * c), sides[-1])


def _meetings(askers: DataFrame, others: DataFrame, wide: Sequence[int], side: float, eps: float, block_size: int,
              answer: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """What ``answer`` gives for groups (at, piece, block) of askers and others, in which every asker meets all others
    within eps once. Both have the columns id, x, cell and what ``answer`` reads, others also ``piece``.

    A group holds a piece of the others of one cell, and the askers of that cell and its neighbours whose distance
    to the cell is eps at most; more than ``block_size`` of these are cut into blocks. Others that no asker visits
    are not moved, so the copies follow the number of askers.
    """
    def gap(i: int, step: int) -> Column:
        value, cell = F.element_at("x", wide[i] + 1), F.col("cell")[i]
        # rounding must not keep an asker away from a cell
        return F.greatest((((cell + 1) * side - value) if step > 0 else (value - cell * side)) - F.abs(value) * 1e-9, F.lit(0.0))

    near = []
    for steps in itertools.product((-1, 0, 1), repeat=len(wide)):
        to = F.array(*[F.col("cell")[i] + F.lit(s).cast("long") for i, s in enumerate(steps)])
        apart = sum((gap(i, s) * gap(i, s) for i, s in enumerate(steps) if s), F.lit(0.0))
        near.append(F.when(apart <= (eps * (1 + 1e-6)) ** 2, to))
    pieces = others.select(F.col("cell").alias("at"), "piece").distinct()
    visits = askers.withColumn("at", F.explode(F.array_compact(F.array(*near)))).drop("cell").join(pieces, "at")
    blocks = visits.groupBy("at", "piece").agg(F.ceil(F.count("*") / block_size).cast("int").alias("blocks"))
    asked = visits.join(blocks, ["at", "piece"]).withColumn("block", hash_block(F.col("id"), F.col("blocks"))).drop("blocks")
    met = others.withColumnRenamed("cell", "at").join(blocks, ["at", "piece"])
    met = met.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    both = asked.withColumn("asks", F.lit(True)).unionByName(met.withColumn("asks", F.lit(False)))

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        return answer(pdf[pdf["asks"]], pdf[~pdf["asks"]])

    return both.groupBy("at", "piece", "block").applyInPandas(split, schema)


def dbscan(df: DataFrame, key: str, col: str, size: int, eps: float = 1.8, min_samples: int = 5, block_size: int = 2048) -> DataFrame:
    """DBSCAN labels (key, label): clusters from 0 in the order of their first core point, noise -1.

    Equal points collapse to one weighted point. Cells of side eps over the dimensions that spread most say
    which points can be neighbours; neighbour cells meet by key. Cells so small that all their points lie
    within eps of each other make their points core at once if they hold enough. The others are counted among
    a bounded piece of their own cell, and where that is not enough among all neighbours; counting ends once
    a point has enough. Core points are linked by spanning forests of the pieces. A few points of each large part
    then tell which parts belong together; only core points outside the largest whole that this gives, and points
    that are not core, meet all core points next to them. Neighbour pairs are never emitted; inside a group the
    distance to a pivot rules most points out. Connected components join the parts.

    Vectors that are null, have another length or components that are null, NaN or infinite are noise.
    """
    rows = df.select(F.col(key).alias("id"), F.col(col).cast("array<double>").alias("x"))
    points = cut_lineage(rows.filter(_usable("x", size)).groupBy("x").agg(F.min("id").alias("id"), F.count("*").alias("weight")))
    parts = [F.element_at("x", i + 1) for i in range(size)]
    spread_ = points.agg(*[F.var_pop(p).alias(f"s{i}") for i, p in enumerate(parts)]).first()
    wide = sorted(range(size), key=lambda i: (-(spread_[i] or 0.0), i))[:GRID_DIMENSIONS]
    # rounding must not put points into one small cell that are further apart than eps, nor tear neighbours apart
    small = eps / math.sqrt(size) * (1 - 1e-9)
    fine = F.transform("x", lambda v: F.floor(v / small))
    crowds = points.groupBy(fine.alias("fine")).agg(F.sum("weight").alias("held")).filter(F.col("held") >= min_samples).select("fine", F.lit(True).alias("dense"))
    side = _cell_side(points, wide, eps)
    cell = F.array(*[F.floor(F.element_at("x", i + 1) / side) for i in wide])
    placed = points.withColumn("fine", fine).join(crowds, "fine", "left").select("id", "x", "weight", F.coalesce("dense", F.lit(False)).alias("dense"), cell.alias("cell"))
    cuts = placed.groupBy("cell").agg(F.ceil(F.count("*") / block_size).cast("int").alias("cuts"))
    placed = cut_lineage(placed.join(cuts, "cell").withColumn("piece", hash_block(F.col("id"), F.col("cuts"))).drop("cuts"))
    kind = rows.schema["id"].dataType.simpleString()

    def crowded(pdf: pd.DataFrame) -> pd.DataFrame:
        x, asked = np.stack(pdf["x"].to_numpy()), ~pdf["dense"].to_numpy(bool)
        found = _enough_near(x[asked], x, pdf["weight"].to_numpy(), eps, min_samples, x[0])
        return pd.DataFrame({"id": pdf["id"].to_numpy()[asked][found >= min_samples]})

    # most core points show within their own piece of a cell; only the others go to all neighbours
    alone = placed.groupBy("cell", "piece").applyInPandas(crowded, f"id {kind}").withColumn("crowded", F.lit(True))
    placed = placed.join(alone, "id", "left").withColumn("dense", F.col("dense") | F.coalesce("crowded", F.lit(False))).drop("crowded")
    placed = cut_lineage(placed)

    def counts(asked: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros(len(asked), dtype=np.int64)
        if len(asked) and len(others):
            y = np.stack(others["x"].to_numpy())
            n = _enough_near(np.stack(asked["x"].to_numpy()), y, others["weight"].to_numpy(), eps, min_samples, y[0])
        return pd.DataFrame({"id": asked["id"], "n": n})

    every = placed.select("id", "x", "weight", "cell", "piece", "dense")
    near = _meetings(every.drop("piece").filter("not dense").drop("dense"), every.drop("dense"), wide, side, eps, block_size, counts, f"id {kind}, n long")
    enough = near.groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_samples).select("id", F.lit(True).alias("enough"))
    marked = placed.join(enough, "id", "left").select("id", "x", "cell", "piece", (F.col("dense") | F.coalesce("enough", F.lit(False))).alias("core"))
    marked = cut_lineage(marked)

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")  # the first of a component is its smallest id
        x, ids = np.stack(pdf["x"].to_numpy()), pdf["id"].to_numpy()
        return pd.DataFrame({"id": ids, "root": ids[_forest(x, eps, x[0])]})

    linked = cut_lineage(marked.filter("core").groupBy("cell", "piece").applyInPandas(local, f"id {kind}, root {kind}"))
    cores = cut_lineage(marked.filter("core").drop("core").join(linked, "id"))

    def links(asked: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(others):
            return pd.DataFrame({"a": asked["a"][:0], "b": others["a"][:0], "core": asked["core"][:0]})
        y = np.stack(others["x"].to_numpy())
        ranged, mine = _Ranged(y, y[0]), _Ranged(np.stack(asked["x"].to_numpy()), y[0])
        begins, from_ = pd.factorize(asked["a"].to_numpy(), use_na_sentinel=False)
        ends, to = pd.factorize(others["a"].to_numpy(), use_na_sentinel=False)
        core = np.zeros(len(from_), dtype=bool)
        core[begins] = asked["core"].to_numpy(bool)
        begins, ends = begins[mine.order], ends[ranged.order]
        found = [np.zeros(0, dtype=np.int64)]
        for part in _batches(len(begins), len(ends), size):
            within = ranged.slice(mine.reach[part], eps)
            i, j = np.nonzero(_distances(mine.points[part], ranged.points[within]) <= eps)
            found.append(np.unique(begins[part][i] * len(to) + ends[within][j]))
        a, b = np.divmod(np.unique(np.concatenate(found)), len(to))
        out = pd.DataFrame({"a": from_[a], "b": to[b], "core": core[a]})
        return out[~out["core"] | (out["a"] != out["b"])]

    def linked_to(askers: DataFrame, others: DataFrame) -> DataFrame:
        """Roots that askers (id, x, cell, a, core) reach: (a, b, core)."""
        named = others.select("id", "x", "cell", "piece", F.col("root").alias("a"), F.lit(True).alias("core"))
        return cut_lineage(_meetings(askers, named, wide, side, eps, block_size, links, f"a {kind}, b {kind}, core boolean").distinct())

    def joined(roots: DataFrame, pairs: DataFrame) -> DataFrame:
        own = roots.select(F.col("root").alias("a"), F.col("root").alias("b")).distinct()
        return connected_components(own.unionByName(pairs.filter("core").select("a", "b"))).select(F.col("node").alias("part"), F.col("root").alias("whole"))

    # a few points of each large part visit one piece of each cell; that joins most parts of crowded cells
    parts = cores.groupBy("root").agg(F.count("*").alias("n"))
    few = cores.join(parts.filter(F.col("n") >= FEW_POINTS), "root").filter(F.pmod(F.xxhash64("id", F.lit("few")), F.col("n")) < FEW_ASKERS)
    few = few.select("id", "x", "cell", F.col("root").alias("a"), F.lit(True).alias("core"))
    wholes = joined(parts, linked_to(few, cores.filter("piece = 0")))
    cores = cut_lineage(cores.join(wholes, F.col("root") == F.col("part")).select("id", "x", "cell", "piece", F.col("whole").alias("root")))
    # two core points of one whole need not meet any more, so those of the largest whole ask nobody
    largest = cores.groupBy("root").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "root").limit(1).select(F.col("root").alias("largest"))
    others = cores.join(largest, F.col("root") == F.col("largest"), "left_anti").select("id", "x", "cell", F.col("root").alias("a"), F.lit(True).alias("core"))
    edge = marked.filter("not core").select("id", "x", "cell", F.col("id").alias("a"), "core")
    pairs = linked_to(others.unionByName(edge), cores)
    wholes = joined(cores, pairs)
    roots = cores.join(wholes, F.col("root") == F.col("part")).select(F.col("id").alias("node"), F.col("whole").alias("root"))
    border = (
        pairs.filter("not core")
        .join(wholes, F.col("b") == F.col("part"))
        .groupBy(F.col("a").alias("node"))
        .agg(F.min("whole").alias("root"))
    )
    assigned = roots.unionByName(border)
    firsts = roots.select("root").distinct()
    numbers = row_numbers(firsts, [], [F.col("root")], id_grain(firsts, "root"), "number")
    named = assigned.join(numbers, "root").select(F.col("node").alias("id"), (F.col("number") - 1).cast("int").alias("label"))
    per_point = placed.select("id", "x").join(named, "id").select("x", "label")
    return rows.join(per_point, "x", "left").select(F.col("id").alias(key), F.coalesce("label", F.lit(-1)).alias("label"))


def cluster_counts(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Number of clusters without noise, number of noise points."""
    return labelled.agg(
        F.countDistinct(F.when(F.col(label) >= 0, F.col(label))).alias("n_clusters"),
        F.count_if(F.col(label) == -1).alias("n_noise"),
    )


# ---- anomaly detector -----------------------------------------------------------------------

@dataclass(frozen=True)
class Detector:
    """All a scorer needs: a few numbers that travel as literals in the plan."""

    features: list[str]
    means: list[float]
    stds: list[float]
    centers: list[list[float]]
    threshold: float


def features_or_defaults(defaults: Mapping[str, float] = fv.DETECTOR_DEFAULTS) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(d)).alias(c) for c, d in defaults.items()]


def distance_score(detector: Detector, defaults: Mapping[str, float] = fv.DETECTOR_DEFAULTS) -> Column:
    """Distance to the nearest centre, written out per feature so that it compiles to plain arithmetic."""
    scaled = [
        (F.coalesce(F.col(c).cast("double"), F.lit(defaults[c])) - F.lit(m)) / F.lit(s)
        for c, m, s in zip(detector.features, detector.means, detector.stds)
    ]
    dists = []
    for center in detector.centers:
        gaps = [x - F.lit(v) for x, v in zip(scaled, center)]
        dists.append(F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])))
    return F.least(*dists) if len(dists) > 1 else dists[0]


def score(df: DataFrame, detector: Detector) -> DataFrame:
    """Adds ``distance`` and ``ml_anomaly``; pure column expressions, also on a stream."""
    return df.withColumn("distance", distance_score(detector)).withColumn(
        "ml_anomaly", F.col("distance") > F.lit(detector.threshold)
    )


def _with_threshold(df: DataFrame, d: Detector, contamination: float) -> Detector:
    scored = df.select(distance_score(d).alias("distance"))
    (limit,) = exact_percentiles(scored, "distance", [1 - contamination])
    return Detector(d.features, d.means, d.stds, d.centers, float(limit))


def fit_detector(df: DataFrame, k: int = 2, contamination: float = 0.05, seed: int = 42, max_iter: int = 30,
                 defaults: Mapping[str, float] = fv.DETECTOR_DEFAULTS) -> Detector:
    """Scales (sample deviation, 0 counts as 1), clusters, and sets the limit at the 95th percentile of
    the training distances."""
    names = list(defaults)
    with packed(df.select(*features_or_defaults(defaults))) as data:
        return _fit_detector(data, names, k, contamination, seed, max_iter)


def _fit_detector(data: DataFrame, names: list[str], k: int, contamination: float, seed: int, max_iter: int) -> Detector:
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=names, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster"),
        ]
    ).fit(data)
    scaler, km = model.stages[1], model.stages[2]
    d = Detector(
        names,
        [float(v) for v in scaler.mean],
        [float(v) or 1.0 for v in scaler.std],
        [[float(v) for v in c] for c in km.clusterCenters()],
        float("inf"),
    )
    return _with_threshold(data, d, contamination)


def fit_baseline_detector(df: DataFrame, contamination: float = 0.05, defaults: Mapping[str, float] = fv.DETECTOR_DEFAULTS) -> Detector:
    """One centre at the mean, population deviation: plain aggregates."""
    names = list(defaults)
    data = df.select(*features_or_defaults(defaults))
    row = data.agg(*[F.avg(c) for c in names], *[F.stddev_pop(c) for c in names]).first()
    n = len(names)
    d = Detector(names, [float(v) for v in row[:n]], [float(v) or 1.0 for v in row[n:]], [[0.0] * n], float("inf"))
    return _with_threshold(data, d, contamination)


def fit_baseline_groups(df: DataFrame, group: str, contamination: float = 0.05, defaults: Mapping[str, float] = fv.DETECTOR_DEFAULTS) -> dict[int, Detector]:
    """``fit_baseline_detector`` for every group of rows at once, as two aggregates. For bounded groups (the
    limit is a percentile of a group's distances), and few enough for their numbers to be listed."""
    names = list(defaults)
    rows = df.select(group, *features_or_defaults(defaults))
    stats = rows.groupBy(group).agg(*[F.avg(c).alias(f"m_{c}") for c in names], *[F.stddev_pop(c).alias(f"s_{c}") for c in names])
    gaps = [(F.col(c) - F.col(f"m_{c}")) / F.when(F.col(f"s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{c}")) for c in names]
    far = rows.join(stats, group).withColumn("distance", F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])))
    limits = far.groupBy(group).agg(F.percentile("distance", 1 - contamination).alias("limit"))
    found = {}
    for r in stats.join(limits, group).collect():
        found[r[group]] = Detector(names, [r[f"m_{c}"] for c in names], [r[f"s_{c}"] or 1.0 for c in names], [[0.0] * len(names)], r["limit"])
    return found


def segment_profile(df: DataFrame, cluster: str, frequency: str, ticket: str) -> DataFrame:
    """Size and means per segment with a marketing action. Cluster numbers are arbitrary, so the action
    follows the rank of the segment by ticket size."""
    stats = df.groupBy(cluster).agg(
        F.count("*").alias("n"), F.avg(frequency).alias("avg_frequency"), F.avg(ticket).alias("avg_ticket")
    )
    place = F.row_number().over(Window.orderBy(F.desc("avg_ticket"), cluster))
    busiest = F.row_number().over(Window.orderBy(F.desc("avg_frequency"), cluster))
    action = F.when(F.col("by_ticket") == 1, "vip_offers").when(F.col("by_frequency") == 1, "volume_promotions").otherwise("reactivation")
    return stats.withColumn("by_ticket", place).withColumn("by_frequency", busiest).withColumn("action", action)
