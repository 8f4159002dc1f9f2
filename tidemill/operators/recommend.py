"""User-to-user collaborative filtering on long ratings (user, item, rating).

Nothing is pivoted to a dense matrix. Users meet in the inverted lists of the items they share; items with
so many raters that pairing them would be quadratic are handled by norm bounds and matrix products.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.blocks import PAIR, hash_block, into_near_pairs
from tidemill.operators.ordered import id_grain, row_numbers
from tidemill.operators.relational import hash_order
from tidemill.session import cut_lineage, discard, settled, stored_in_rounds, task_count

SIM_DIGITS = 9
HOT_PRODUCTS = 16_384
#: Raters of an item whose pairs are still summed one by one, and what a bound may be off by rounding.
HOT_RATERS = 1024
NORM_SLACK = 1e-9
#: Entries of lists that a task receives on average, that it works on at once, and that one row holds.
TASK_ENTRIES, HELD_ENTRIES, PIECE = 4_000_000, 500_000, 256
#: Entries of lists that are shuffled at a time: so many for each rating, or so many in all if that is more.
ROUND_SHARE, ROUND_ENTRIES = 3, 20_000_000


def mean_ratings(rows: DataFrame) -> DataFrame:
    """One rating per (user, item): repeated ones are averaged."""
    return rows.groupBy("user", "item").agg(F.avg("rating").alias("rating"))


def centred(ratings: DataFrame) -> DataFrame:
    """Ratings with the user's mean, the deviation from it, and the norm of all the user's deviations.

    Mean and norm come from one aggregate that is joined back, not from a window, so a user with a
    third of all ratings is split by AQE. A user never has more rows than there are items. The norm of
    equal ratings is exactly 0.
    """
    spread = F.sqrt(F.var_pop("rating") * F.count("rating"))
    stats = ratings.groupBy("user").agg(F.avg("rating").alias("user_mean"), spread.alias("norm"))
    return ratings.join(stats, "user").withColumn("dev", F.col("rating") - F.col("user_mean"))


def pair_similarity(ratings: DataFrame, pairs: DataFrame) -> DataFrame:
    """Mean-centred cosine of given user pairs (u, v): work is bounded by the ratings of those users.

    The deviations of every v travel as lists to their u, behind u's own, and meet them there.
    """
    c = centred(ratings).filter("item is not null")
    lists = cut_lineage(_in_lists(c.select("user", "item", F.col("dev").alias("value"))))
    links = cut_lineage(pairs.select("u", "v").distinct())
    norms = cut_lineage(c.groupBy("user").agg(F.max("norm").alias("norm")))
    (n_links,) = links.agg(F.count("*")).first()
    n_values, n_users = lists.agg(F.sum(F.size("entry")), F.approx_count_distinct("user")).first()
    entries = n_links * (n_values or 0) / max(1, n_users)
    rounds = _rounds(entries, n_values)
    most = HELD_ENTRIES

    def dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, known, worth = None, None, np.zeros(0)  # the items of the last row so far and their values
        for batch in batches:
            for piece, n in _pieces(batch, most):
                rows = pa.concat_arrays([*([row] if row is not None else []), piece.column("row")]).dictionary_encode()
                codes = rows.indices.to_numpy().astype(np.int64)
                old = 0 if row is None else len(known)
                items = pa.concat_arrays([*([known] if row is not None else []), piece.column("entry").flatten()])
                coded = items.dictionary_encode()
                at = np.repeat(codes, [*([old] if row is not None else []), *n])
                keys = at * len(coded.dictionary) + coded.indices.to_numpy().astype(np.int64)
                value = np.concatenate([worth, piece.column("value").flatten().fill_null(0.0).to_numpy(zero_copy_only=False)])
                own = np.concatenate([np.ones(old, bool), np.repeat(piece.column("own").to_numpy(zero_copy_only=False), n)])
                table, place = np.unique(keys[own], return_inverse=True)
                sums, other = np.bincount(place, value[own], len(table)), np.flatnonzero(~own)
                if len(other) and len(table):
                    found = np.minimum(np.searchsorted(table, keys[other]), len(table) - 1)
                    product = np.where(table[found] == keys[other], sums[found] * value[other], 0.0)
                    link = np.repeat(np.arange(len(n)), n)[other - old]
                    met = np.unique(link)
                    dot = np.bincount(link, product, len(n))[met]
                    yield pa.RecordBatch.from_arrays([piece.column("row").take(met), piece.column("v").take(met), pa.array(dot)], ["u", "v", "dot"])
                last = table // max(1, len(coded.dictionary)) == codes[-1]
                row, known, worth = rows.dictionary.take([codes[-1]]), coded.dictionary.take(table[last] % max(1, len(coded.dictionary))), sums[last]

    kind = dict(links.dtypes)

    def compared(some: DataFrame) -> DataFrame:
        mine = lists.join(some.select(F.col("u").alias("user")).distinct(), "user").select(F.col("user").alias("row"), F.lit(True).alias("own"), F.col("user").alias("v"), "entry", "value")
        theirs = some.join(lists.withColumnRenamed("user", "v"), "v").select(F.col("u").alias("row"), F.lit(False).alias("own"), "v", "entry", "value")
        rows = theirs.unionByName(mine).repartition(_tasks(links, entries / rounds), "row").sortWithinPartitions("row", F.desc("own"))
        met = rows.mapInArrow(dots, f"u {kind['u']}, v {kind['v']}, dot double").groupBy("u", "v").agg(F.sum("dot").alias("dot"))
        for side in "uv":
            met = met.join(norms.select(F.col("user").alias(side), F.col("norm").alias(f"n{side}")), side)
        sim = F.coalesce(F.try_divide(F.col("dot"), F.col("nu") * F.col("nv")), F.lit(0.0))
        return met.select("u", "v", F.round(sim, SIM_DIGITS).alias("sim"))

    found = _in_rounds([compared(some) for some in _turns(links, "u", rounds)], lists, links, norms)
    return pairs.join(found, ["u", "v"], "left").select("u", "v", F.coalesce("sim", F.lit(0.0)).alias("sim"))


def _dots(left: pd.DataFrame, right: pd.DataFrame, nl: int, nr: int) -> np.ndarray:
    """Dot products of two blocks of sparse rating vectors.

    Items with many raters on both sides go through dense matrix products of a bounded width, the
    others through one pass over their few co-ratings.
    """
    out = np.zeros((nl, nr))
    items = np.intersect1d(left["item"].unique(), right["item"].unique())
    if not len(items):
        return out

    def by_item(side):
        pos = np.searchsorted(items, side["item"].to_numpy())
        pos = np.minimum(pos, len(items) - 1)
        keep = items[pos] == side["item"].to_numpy()
        pos, user, val = pos[keep], side["at"].to_numpy()[keep], side["w"].to_numpy()[keep]
        order = np.argsort(pos, kind="stable")
        return pos[order], user[order], val[order], np.bincount(pos, minlength=len(items))

    lp, lu, lv, lc = by_item(left)
    rp, ru, rv, rc = by_item(right)
    l0, r0 = np.concatenate([[0], np.cumsum(lc)]), np.concatenate([[0], np.cumsum(rc)])
    work = lc * rc
    hot = np.flatnonzero(work > HOT_PRODUCTS)
    for at in range(0, len(hot), 512):
        part = hot[at : at + 512]
        a, b = np.zeros((nl, len(part))), np.zeros((len(part), nr))
        for j, it in enumerate(part):
            a[lu[l0[it] : l0[it + 1]], j] = lv[l0[it] : l0[it + 1]]
            b[j, ru[r0[it] : r0[it + 1]]] = rv[r0[it] : r0[it + 1]]
        out += a @ b
    cold = np.flatnonzero((work > 0) & (work <= HOT_PRODUCTS))
    flat = out.reshape(-1)
    ends = np.cumsum(work[cold])
    at = 0
    while at < len(cold):
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4_000_000, side="right"))
        part = cold[at : max(upto, at + 1)]
        n = work[part]
        owner = np.repeat(np.arange(len(part)), n)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        li = l0[part][owner] + inner // rc[part][owner]
        ri = r0[part][owner] + inner % rc[part][owner]
        flat += np.bincount(lu[li] * nr + ru[ri], weights=lv[li] * rv[ri], minlength=nl * nr)
        at += len(part)
    return out


@dataclass
class _Sums:
    """Sums by row and entry: the places ``at`` and ``of`` in the distinct ``rows`` and ``entries``, the sums, and
    what is known of each row and entry beside them."""

    rows: pa.Array
    entries: pa.Array
    at: np.ndarray
    of: np.ndarray
    sums: list[np.ndarray]
    of_row: list[pa.Array]
    of_entry: list[pa.Array]

    def part(self, keep: np.ndarray) -> _Sums:
        return _Sums(self.rows, self.entries, self.at[keep], self.of[keep], [x[keep] for x in self.sums], self.of_row, self.of_entry)


def _first_places(codes: np.ndarray, kinds: int) -> np.ndarray:
    out = np.zeros(kinds, dtype=np.int64)
    out[codes[::-1]] = np.arange(len(codes))[::-1]
    return out


def _pieces(batch: pa.RecordBatch, most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of a batch, so many at once that their lists hold about ``most`` entries, and the lists' lengths."""
    n = pc.list_value_length(batch.column("entry")).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(n), 0
    while at < len(n):
        before = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        if ends[upto - 1] > before:
            yield batch.slice(at, upto - at), n[at:upto]
        at = upto


def _added(held: _Sums | None, batch: pa.RecordBatch, n: np.ndarray, terms: Callable, of_row: Sequence[str], of_entry: Sequence[str]) -> _Sums:
    """The sums of a batch of lists, and those held of the row before it."""
    old = slice(0, len(held.at) if held else 0)
    carried = [held.rows.take(held.at[:1])] if held else []
    rows = pa.concat_arrays([*carried, batch.column("row")]).dictionary_encode()
    codes = rows.indices.to_numpy().astype(np.int64)
    entries = pa.concat_arrays([*([held.entries.take(held.of)] if held else []), batch.column("entry").flatten()]).dictionary_encode("encode")
    of = entries.indices.to_numpy().astype(np.int64)
    at = np.repeat(codes, [*([old.stop] if held else []), *n])
    values = terms(batch, n)
    if held:
        values = [np.concatenate([a, b]) for a, b in zip(held.sums, values, strict=True)]
    kinds = len(entries.dictionary)
    keys, place = np.unique(at * kinds + of, return_inverse=True)
    sums = [np.bincount(place, x, len(keys)) for x in values]
    row_first, entry_first = _first_places(codes, len(rows.dictionary)), _first_places(of, kinds)
    beside_rows = [pa.concat_arrays([*([held.of_row[i].take(held.at[:1])] if held else []), batch.column(c)]).take(row_first) for i, c in enumerate(of_row)]
    beside_entries = [pa.concat_arrays([*([held.of_entry[i].take(held.of)] if held else []), batch.column(c).flatten()]).take(entry_first) for i, c in enumerate(of_entry)]
    return _Sums(rows.dictionary, entries.dictionary, keys // kinds, keys % kinds, sums, beside_rows, beside_entries)


def sums_of_lists(lists: DataFrame, tasks: int, terms: Callable, emit: Callable, schema: str, of_row: Sequence[str] = (), of_entry: Sequence[str] = ()) -> DataFrame:
    """Sums by row and entry over (row, entry, ...), where ``entry`` is a list: what a join and an aggregate of
    one row per entry would give, without those rows in a shuffle or a hash table.

    Lists travel whole and meet sorted by row; a task holds the sums of the rows of one piece of a batch and of
    the row that goes on. ``terms`` gives the values of a batch's entries, ``emit`` the output of finished sums.
    """

    most = HELD_ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Sums | None = None
        for batch in batches:
            for piece, n in _pieces(batch, most):
                found = _added(held, piece, n, terms, of_row, of_entry)
                last = found.at == found.at[-1]
                held = found.part(last)
                if not last.all():
                    yield emit(found.part(~last))
        if held:
            yield emit(held)

    return lists.repartition(tasks, "row").sortWithinPartitions("row").mapInArrow(run, schema)


def unit_vectors(ratings: DataFrame) -> DataFrame:
    """Each user's deviations, scaled to length 1 (user, item, w); users without any have no rows."""
    return centred(ratings).filter("norm > 0").select("user", "item", (F.col("dev") / F.col("norm")).alias("w"))


def neighbours(
    ratings: DataFrame,
    clusters: DataFrame | None = None,
    k: int = 30,
    min_sim: float = 0.05,
    fallback_below: int = 10,
    hot_raters: int = HOT_RATERS,
    block_size: int = 2048,
) -> DataFrame:
    """The k most similar users per user: (u, v, sim, rank), with at least ``min_sim``, ties to the lower id.

    With ``clusters`` (user, cluster; one row per user) the neighbours come from the user's own cluster, and
    from everybody where that gives fewer than ``fallback_below``. Both lists fall out of one pass.
    """
    vectors = unit_vectors(ratings)
    if clusters is None:
        members = None
        vectors = vectors.withColumn("cluster", F.lit(None).cast("long"))
    else:
        members = clusters.select("user", F.col("cluster").cast("long").alias("cluster"))
        vectors = vectors.join(members, "user", "left")
    vectors = cut_lineage(vectors)
    near = cut_lineage(_nearest(similar_users(vectors, k, min_sim, hot_raters, block_size), members is not None, k, fallback_below))
    discard(vectors)
    return near


def _nearest(pairs: DataFrame, clustered: bool, k: int, fallback_below: int) -> DataFrame:
    """The k best of each user's pairs, with clusters as :func:`neighbours` says."""
    if not clustered:
        return _best(pairs, ["u"], k).select("u", "v", "sim", "rank")
    scopes = F.when(F.col("same"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    ranked = _best(pairs.select("u", "v", "sim", F.explode(scopes).alias("own_cluster")), ["u", "own_cluster"], k)
    n_own = F.sum(F.col("own_cluster").cast("int")).over(Window.partitionBy("u"))
    return (
        ranked.withColumn("n_own", n_own)
        .filter(F.col("own_cluster") == (F.col("n_own") >= fallback_below))
        .select("u", "v", "sim", "rank")
    )


def _best(pairs: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """The k best of each list: every task keeps its own k before the rows of a list meet."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("sim"), "v"))
    return pairs.withColumn("rank", place).filter(F.col("rank") <= k)


def similar_users(
    vectors: DataFrame, k: int, min_sim: float, hot_raters: int = HOT_RATERS, block_size: int = 2048
) -> DataFrame:
    """Pairs (u, v, sim, same) with at least ``min_sim``, both ways round: for each u at least its k best, and
    its k best of the same cluster. ``vectors`` (user, item, w, cluster) is a stored table of unit vectors.

    Each item has an inverted list of its raters. Users meet in the lists of the items that they share, and
    products are summed by pair, so the work grows with the ratings times the longest list. Lists of more
    than ``hot_raters`` are not paired; a norm bound says what they can matter for, as the products of a pair
    over hot items are at most the product of the norms of their hot parts:

    * Where this product is below ``min_sim``, the two need a cold item in common. So they met in a list; if
      its sum and the bound together reach ``min_sim``, the hot products are added exactly.
    * All others are users with a hot norm of ``min_sim`` or more. They are compared with each other in
      blocks of about equal norm, by matrix products of whole vectors, and a block pair is skipped if its
      norms are too small. A block pair passes on the k best of each user, never the pairs.
    """
    sizes = cut_lineage(vectors.groupBy("item").agg(F.count("*").alias("raters")))
    hot = sizes.filter(F.col("raters") > hot_raters).select("item", F.lit(True).alias("hot"))
    met, n_rows = sizes.agg(
        F.sum(F.when(F.col("raters") <= hot_raters, F.col("raters") * (F.col("raters") - 1) / 2)), F.sum("raters")
    ).first()
    rounds = _rounds(met, n_rows)
    tasks = _tasks(vectors, (met or 0) / rounds)
    if hot.isEmpty():
        pairs = _list_pairs(vectors.withColumn("hot_norm", F.lit(0.0)), min_sim, tasks, rounds)
        return _both_ways(pairs.withColumn("sim", F.round("dot", SIM_DIGITS)).filter(F.col("sim") >= min_sim))

    rows = vectors.join(hot, "item", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    norm = F.sqrt(F.sum(F.when(F.col("hot"), F.col("w") * F.col("w")).otherwise(0.0)))
    rows = cut_lineage(rows.join(rows.groupBy("user").agg(norm.alias("hot_norm")), "user"))
    bound = F.col("u_norm") * F.col("v_norm")
    cold = _list_pairs(rows.filter("not hot"), min_sim, tasks, rounds)
    cold = cold.filter((bound < min_sim) & (F.col("dot") + bound >= min_sim - NORM_SLACK)).select("u", "v", "dot", "same")
    cold = cut_lineage(cold)
    mine, theirs = (rows.filter("hot").select("item", F.col("user").alias(name), F.col("w").alias(f"{name}_w")) for name in "uv")
    more = cold.join(mine, "u").join(theirs, ["v", "item"]).select("u", "v", (F.col("u_w") * F.col("v_w")).alias("dot"), "same")
    light = cold.unionByName(more).groupBy("u", "v", "same").agg(F.round(F.sum("dot"), SIM_DIGITS).alias("sim"))
    return _both_ways(light.filter(F.col("sim") >= min_sim)).unionByName(_heavy_pairs(rows.filter(F.col("hot_norm") >= min_sim), k, min_sim, block_size))


def _tasks(df: DataFrame, entries: float | None) -> int:
    return max(task_count(df.sparkSession), math.ceil((entries or 0) / TASK_ENTRIES))


def _rounds(entries: float | None, ratings: float | None) -> int:
    """In how many rounds the entries of lists are shuffled, so that those of one round are no more than a few
    times the ratings."""
    return max(1, math.ceil((entries or 0) / max(ROUND_ENTRIES, ROUND_SHARE * (ratings or 0))))


def _turns(rows: DataFrame, user: str, rounds: int) -> list[DataFrame]:
    """The rows, dealt to rounds by a hash of the user."""
    turn = F.pmod(F.xxhash64(user), F.lit(rounds))
    return [rows.filter(turn == r) for r in range(rounds)] if rounds > 1 else [rows]


def _in_rounds(parts: list[DataFrame], *tables: DataFrame) -> DataFrame:
    """A single round as it is; several are stored one after the other, and the stored tables they read go."""
    if len(parts) == 1:
        return parts[0]
    out = stored_in_rounds(parts)
    discard(*tables)
    return out


def _list_pairs(rows: DataFrame, min_sim: float, tasks: int, rounds: int) -> DataFrame:
    """Sums of products (u, v, dot, same, u_norm, v_norm) of the users that meet in the lists, each pair once
    (u < v), of those that can reach ``min_sim`` with the bound. Each user takes the rest of every list it is in,
    in the round of that user; what is found is stored.
    """
    one = F.struct("user", F.coalesce("w", F.lit(0.0)).alias("w"), "cluster", F.col("hot_norm").alias("norm"))
    lists = rows.filter("user is not null and item is not null").groupBy("item").agg(F.sort_array(F.collect_list(one)).alias("l"))
    lists = cut_lineage(lists.select("l")) if rounds > 1 else lists
    own = lists.select("l", F.posexplode("l").alias("p", "own")).select("l", "p", "own", F.col("own.user").alias("row"))
    each = [
        some.withColumn("rest", F.expr("slice(l, p + 2, size(l))")).filter(F.size("rest") > 0).select(
            "row", F.col("own.w").alias("a"), F.col("own.cluster").alias("u_cluster"), F.col("own.norm").alias("u_norm"),
            F.col("rest.user").alias("entry"), F.col("rest.w").alias("b"), F.col("rest.cluster").alias("v_cluster"), F.col("rest.norm").alias("v_norm"),
        )
        for some in _turns(own, "row", rounds)
    ]
    names = ["u", "v", "dot", "u_cluster", "v_cluster", "u_norm", "v_norm"]

    def terms(batch: pa.RecordBatch, n: np.ndarray) -> list[np.ndarray]:
        return [np.repeat(batch.column("a").to_numpy(), n) * batch.column("b").flatten().to_numpy()]

    def emit(found: _Sums) -> pa.RecordBatch:
        norms = found.of_row[1].to_numpy()[found.at], found.of_entry[1].to_numpy()[found.of]
        # the caller rounds and compares exactly
        near = np.flatnonzero(found.sums[0] + norms[0] * norms[1] >= min_sim - 10 * NORM_SLACK)
        at, of = found.at[near], found.of[near]
        u, v = found.rows.take(at), found.entries.take(of)
        out = [u, v, pa.array(found.sums[0][near]), found.of_row[0].take(at), found.of_entry[0].take(of), pa.array(norms[0][near]), pa.array(norms[1][near])]
        return pa.RecordBatch.from_arrays(out, names).filter(pc.not_equal(u, v))

    kind = rows.schema["user"].dataType.simpleString()
    schema = f"u {kind}, v {kind}, dot double, u_cluster long, v_cluster long, u_norm double, v_norm double"
    met = _in_rounds([sums_of_lists(some, tasks, terms, emit, schema, ["u_cluster", "u_norm"], ["v_cluster", "v_norm"]) for some in each], lists)
    return met.select("u", "v", "dot", (F.col("u_cluster") == F.col("v_cluster")).alias("same"), "u_norm", "v_norm")


def _both_ways(pairs: DataFrame) -> DataFrame:
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return pairs.select(F.explode(ends).alias("e"), "sim", F.coalesce("same", F.lit(False)).alias("same")).select("e.u", "e.v", "sim", "same")


def _heavy_pairs(rows: DataFrame, k: int, min_sim: float, block_size: int) -> DataFrame:
    """The k best of each user in each block pair, of pairs whose hot norms multiply to ``min_sim`` or more."""
    users = rows.select("user", "hot_norm").distinct().withColumn("step", F.floor(-4 * F.log2("hot_norm")).cast("int"))
    steps = users.groupBy("step").agg(F.ceil(F.count("*") / block_size).cast("int").alias("cuts"), F.max("hot_norm").alias("norm"))
    blocks = steps.select("step", "norm", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    blocks = cut_lineage(blocks.withColumn("block", F.monotonically_increasing_id()))
    users = users.join(steps.select("step", "cuts"), "step").withColumn("cut", hash_block(F.col("user"), F.col("cuts")))
    placed = rows.join(users.join(blocks, ["step", "cut"]).select("user", "block"), "user").select("user", "item", "w", "cluster", "hot_norm", "block")
    one, two = (blocks.select(F.col("block").alias(name), F.col("norm").alias(f"{name}_norm")) for name in PAIR)
    reach = F.col("pair_lo_norm") * F.col("pair_hi_norm") >= min_sim
    pairs = cut_lineage(one.join(two, (F.col("pair_lo") <= F.col("pair_hi")) & reach).select(*PAIR))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf["pair_lo"].iloc[0], pdf["pair_hi"].iloc[0]
        sides = []
        for b in (lo, hi):
            side = pdf[pdf["block"] == b]
            ids, first, at = np.unique(side["user"].to_numpy(), return_index=True, return_inverse=True)
            cluster = side["cluster"].to_numpy(dtype=float, na_value=np.nan)[first]
            sides.append((ids, side["hot_norm"].to_numpy()[first], cluster, side.assign(at=at)))
        (ul, nl, cl, left), (ur, nr, cr, right) = sides
        parts = [pd.DataFrame({"u": ul[:0], "v": ul[:0], "sim": np.zeros(0), "same": np.zeros(0, bool)})]
        if len(ul) and len(ur):
            sims = np.round(_dots(left, right, len(ul), len(ur)), SIM_DIGITS)
            sims[np.outer(nl, nr) < min_sim] = 0.0
            if lo == hi:
                np.fill_diagonal(sims, 0.0)
            for s, a, b, ca, cb in [(sims, ul, ur, cl, cr)] + ([] if lo == hi else [(sims.T, ur, ul, cr, cl)]):
                row, col = np.nonzero(s >= min_sim)
                # users are sorted, so their places rank like their ids
                order = np.lexsort((col, -s[row, col], row))
                row, col = row[order], col[order]
                same = ca[row] == cb[col]
                keep = _first_of_each(row, k)
                keep[np.flatnonzero(same)[_first_of_each(row[same], k)]] = True
                row, col = row[keep], col[keep]
                parts.append(pd.DataFrame({"u": a[row], "v": b[col], "sim": s[row, col], "same": same[keep]}))
        return pd.concat(parts)

    kind = rows.schema["user"].dataType.simpleString()
    return into_near_pairs(placed, "block", pairs).groupBy(*PAIR).applyInPandas(compare, f"u {kind}, v {kind}, sim double, same boolean")


def _first_of_each(sorted_rows: np.ndarray, k: int) -> np.ndarray:
    return np.arange(len(sorted_rows)) - np.searchsorted(sorted_rows, sorted_rows) < k


def predictions(ratings: DataFrame, near: DataFrame, means_from: DataFrame | None = None, top: int | None = None) -> DataFrame:
    """Predicted rating (u, item, score, user_mean) of every unseen item that a neighbour has rated:
    user mean + sum(sim * (rating - neighbour mean)) / sum(|sim|). With ``top``, the best of each user only.
    """
    base = means_from if means_from is not None else ratings
    means = base.groupBy(F.col("user").alias("u")).agg(F.avg("rating").alias("user_mean"))
    dev = base.join(means, F.col("user") == F.col("u")).select("user", "item", (F.col("rating") - F.col("user_mean")).alias("value"))

    def finished(votes: DataFrame) -> DataFrame:
        return votes.select("u", "item", F.round("score", SIM_DIGITS).alias("score"), "user_mean")

    return _voted(ratings, near, means, dev, finished, top, few=top is not None)


def raw_predictions(ratings: DataFrame, near: DataFrame, each_user: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Variant without means: sum(sim * rating) / sum(|sim|). ``each_user`` is applied to the predictions, a round
    of users at a time; it groups them by ``u``, or treats rows one by one."""

    def finished(votes: DataFrame) -> DataFrame:
        rows = votes.select("u", "item", F.round("score", SIM_DIGITS).alias("score"))
        return each_user(rows) if each_user else rows

    return _voted(
        ratings.filter("item is not null"), near, None, ratings.select("user", "item", F.col("rating").alias("value")), finished, least=1e-9, few=each_user is not None
    )


def _voted(ratings: DataFrame, near: DataFrame, means: DataFrame | None, values: DataFrame, finished: Callable[[DataFrame], DataFrame],
           top: int | None = None, least: float = 0.0, few: bool = False) -> DataFrame:
    """(u, item, score, user_mean): the mean (0 without ``means``) plus the weighted mean of the neighbours' values,
    of the items that u has no rating of. ``least`` stands in for weights of sum 0. ``finished`` is applied to these rows.

    A neighbour's values come as lists, and so do the user's own ratings, without a similarity. If ``few`` rows
    come of a user, they are worked out in rounds of users and stored.
    """
    near = settled(near.select("u", "v", "sim"))
    means = cut_lineage(means.select("u", F.col("user_mean").cast("double").alias("user_mean"))) if means is not None else None
    (n_links,) = near.agg(F.count("*")).first()
    n_values, n_users = values.agg(F.count("*"), F.approx_count_distinct("user")).first()
    entries = n_links * n_values / max(1, n_users)
    rounds = _rounds(entries, n_values) if few else 1
    tasks = _tasks(near, entries / rounds)
    theirs = _in_lists(values).withColumnRenamed("user", "v")
    seen = _in_lists(ratings.select("user", "item", F.lit(0.0).alias("value"))).withColumnRenamed("user", "u")
    if rounds > 1:
        theirs, seen = cut_lineage(theirs), cut_lineage(seen)

    def lists(some: DataFrame) -> DataFrame:
        some = some.withColumn("sim", F.col("sim").cast("double"))
        some = some.join(means, "u") if means is not None else some.withColumn("user_mean", F.lit(0.0))
        voted = some.join(theirs, "v").select(F.col("u").alias("row"), "sim", "user_mean", "entry", "value")
        users = some.groupBy("u").agg(F.max("user_mean").alias("user_mean"))
        own = users.join(seen, "u").select(F.col("u").alias("row"), F.lit(None).cast("double").alias("sim"), "user_mean", "entry", "value")
        return voted.unionByName(own)

    def terms(batch: pa.RecordBatch, n: np.ndarray) -> list[np.ndarray]:
        sim, value = batch.column("sim"), batch.column("value").flatten()
        weight, seen = (np.repeat(x.to_numpy(zero_copy_only=False), n) for x in (sim.fill_null(0.0), sim.is_null()))
        return [weight * value.fill_null(0.0).to_numpy(zero_copy_only=False), np.abs(weight), ~seen & value.is_valid().to_numpy(zero_copy_only=False), seen]

    def emit(found: _Sums) -> pa.RecordBatch:
        found = found.part(found.sums[3] == 0)
        up, weight, known, _ = found.sums
        mean = found.of_row[0].to_numpy(zero_copy_only=False)[found.at]
        if not least and (weight == 0).any():
            raise ZeroDivisionError("similarities of sum 0")
        score, known = mean + up / np.where(weight == 0, least or 1.0, weight), known > 0
        if top is not None:
            # as Spark orders: NaN first, null last, then by item
            worth = np.where(known, np.where(np.isnan(score), np.inf, np.round(score, SIM_DIGITS)), -np.inf)
            place = np.empty(len(found.entries), dtype=np.int64)
            place[pc.array_sort_indices(found.entries, null_placement="at_start").to_numpy()] = np.arange(len(place))
            order = np.lexsort((place[found.of], -worth, found.at))
            best = order[_first_of_each(found.at[order], top)]
            found, score, known, mean = found.part(best), score[best], known[best], mean[best]
        score = pa.array(score, mask=~known)
        return pa.RecordBatch.from_arrays([found.rows.take(found.at), found.entries.take(found.of), score, pa.array(mean)], ["u", "item", "score", "user_mean"])

    schema = f"u {dict(near.dtypes)['u']}, item {dict(values.dtypes)['item']}, score double, user_mean double"
    return _in_rounds([finished(sums_of_lists(lists(some), tasks, terms, emit, schema, ["user_mean"])) for some in _turns(near, "u", rounds)], theirs, seen)


def _in_lists(values: DataFrame) -> DataFrame:
    """Items and values of a user as lists (user, entry, value) of a bounded length."""
    whole = values.groupBy("user").agg(F.collect_list(F.struct("item", "value")).alias("l"))
    first = F.explode(F.expr(f"sequence(1, size(l), {PIECE})")).alias("first")
    return whole.select("user", "l", first).select("user", F.expr(f"slice(l, first, {PIECE})").alias("l")).select("user", F.col("l.item").alias("entry"), F.col("l.value").alias("value"))


def unrated_fillers(ratings: DataFrame, predicted: DataFrame, items: DataFrame, users: DataFrame, n: int) -> DataFrame:
    """Per user the first n items that are neither seen nor predicted: they score the user's mean.

    Found as gaps between the occupied positions of the item list, without a user x item grid.
    """
    known = items.select("item").distinct()
    place = row_numbers(known, [], [F.col("item")], id_grain(known, "item"), "pos")
    n_items = known.count()
    taken = (
        ratings.select(F.col("user").alias("u"), "item")
        .join(users, "u", "left_semi")
        .unionByName(predicted.select("u", "item"))
        .join(place, "item")
        .select("u", F.col("pos").cast("long").alias("pos"))
    )
    ends = users.select("u", F.explode(F.array(F.lit(0).cast("long"), F.lit(n_items + 1).cast("long"))).alias("pos"))
    w = Window.partitionBy("u").orderBy("pos")
    gaps = taken.unionByName(ends).withColumn("prev", F.lag("pos").over(w)).filter(F.col("pos") - F.col("prev") > 1)
    free = gaps.select(
        "u",
        F.explode(F.sequence(F.col("prev") + 1, F.least(F.col("pos") - 1, F.col("prev") + n))).alias("pos"),
    )
    first = free.withColumn("r", F.row_number().over(Window.partitionBy("u").orderBy("pos"))).filter(F.col("r") <= n)
    return first.join(place.select("item", F.col("pos").cast("long").alias("pos")), "pos").select("u", "item")


def recommend(
    ratings: DataFrame,
    near: DataFrame,
    n: int = 5,
    means_from: DataFrame | None = None,
) -> DataFrame:
    """Top n unseen items per user (u, item, score, rank); ties to the lower item id.

    Items no neighbour rated score the user's mean and compete with the rest. They can only matter to
    users with fewer than n predictions above their mean, so only those are looked at. Users without
    any neighbour get no rows.
    """
    base = means_from if means_from is not None else ratings
    near = settled(near.select("u", "v", "sim"))
    best = Window.partitionBy("u").orderBy(F.desc("score"), "item")
    voted = predictions(ratings, near, means_from, n)
    top = cut_lineage(voted.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n))
    full = top.groupBy("u").agg(F.count_if(F.col("score") > F.round("user_mean", SIM_DIGITS)).alias("above")).filter(F.col("above") >= n)
    short = cut_lineage(near.select("u").distinct().join(full, "u", "left_anti"))
    if short.isEmpty():
        return top.select("u", "item", "score", "rank")
    again = predictions(ratings.join(short.withColumnRenamed("u", "user"), "user", "left_semi"), near.join(short, "u", "left_semi"), base)
    fill = unrated_fillers(ratings, again, base.select("item"), short, n)
    means = base.groupBy(F.col("user").alias("u")).agg(F.avg("rating").alias("user_mean"))
    fill = fill.join(means, "u").select("u", "item", F.round("user_mean", SIM_DIGITS).alias("score"))
    both = top.select("u", "item", "score").unionByName(fill)
    return both.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def holdout(ratings: DataFrame, threshold: float = 3.5, min_relevant: int = 4, share: float = 0.25,
            low: int = 1, high: int = 5, seed: int = 42) -> DataFrame:
    """Per user with enough relevant items, a quarter of them (at least 1, at most 5), by hash order."""
    relevant = ratings.filter(F.col("rating") >= threshold)
    sizes = relevant.groupBy("user").agg(F.count("*").alias("n_rel")).filter(F.col("n_rel") >= min_relevant)
    h = hash_order(F.concat_ws("/", F.col("user").cast("string"), F.col("item").cast("string")), seed)
    w = Window.partitionBy("user").orderBy("h", "item")
    first = relevant.select("user", "item", h.alias("h")).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= high)
    quota = F.greatest(F.lit(low), F.least(F.lit(high), F.floor(F.col("n_rel") * share)))
    return first.join(sizes, "user").filter(F.col("r") <= quota).select("user", "item")


def precision_at_k(recs: DataFrame, held: DataFrame, k: int = 5) -> DataFrame:
    """Hits per evaluated user over k (k even if fewer were recommended): mean, population deviation."""
    users = held.select(F.col("user").alias("u")).distinct().join(recs.select("u").distinct(), "u", "left_semi")
    hits = (
        recs.filter(F.col("rank") <= k)
        .join(held.select(F.col("user").alias("u"), "item"), ["u", "item"], "left_semi")
        .groupBy("u")
        .agg(F.count("*").alias("hits"))
    )
    per_user = users.join(hits, "u", "left").select(F.coalesce(F.col("hits"), F.lit(0)).cast("double").alias("hits"))
    p = F.col("hits") / k
    return per_user.agg(
        F.coalesce(F.avg(p), F.lit(0.0)).alias("precision_at_k"),
        F.coalesce(F.stddev_pop(p), F.lit(0.0)).alias("std"),
        F.count("*").alias("n_evaluated"),
    )


def evaluate(ratings: DataFrame, clusters: DataFrame | None = None, k: int = 5, threshold: float = 3.5,
             leaky: bool = False) -> DataFrame:
    """Precision at k over held-out items. By default similarities and means come from the remaining
    ratings only; ``leaky`` computes them from all ratings, as the published procedure does."""
    ratings = cut_lineage(ratings)
    held = cut_lineage(holdout(ratings, threshold))
    train = cut_lineage(ratings.join(held, ["user", "item"], "left_anti"))
    base = ratings if leaky else train
    near = neighbours(base, clusters)
    recs = recommend(train, near, k, means_from=base if leaky else None)
    return precision_at_k(recs, held, k)


# ---- user features --------------------------------------------------------------------------

def user_features(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("user").agg(
        F.avg("rating").alias("avg_rating"),
        F.avg("progress").alias("avg_progress"),
        F.sum("sessions").alias("total_sessions"),
        F.avg("duration").alias("avg_duration"),
        F.avg("completed").alias("completed_ratio"),
        F.countDistinct("item").alias("n_items"),
    )

