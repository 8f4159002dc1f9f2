"""Operators against brute force, on small tables with a hot key, borders and missing values."""

import datetime as dt
import hashlib
import math
import os
import random
import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill import session
from tidemill.functions import dates, numbers, text
from tidemill.operators import aggregates, clustering, dialogue, evaluate, models, ordered, recommend, sensors, segments, series, textmodels
from tidemill.operators import relational as rel
from tidemill.plans import registered, views
from tidemill.session import cut_lineage, packed


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one key; some keys are null."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((i, key, rng.randrange(200), float(rng.randrange(50))))
    return spark.createDataFrame(rows, "id int, key string, at int, x double").cache()


def collected(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=repr)


class TestOrdered:
    def test_row_numbers_equal_a_plain_window(self, skewed):
        w = Window.partitionBy("key").orderBy("at", "id")
        want = skewed.withColumn("n", F.row_number().over(w).cast("bigint"))
        got = ordered.row_numbers(skewed, ["key"], [F.col("at"), F.col("id")], F.floor(F.col("at") / 10), "n")
        assert collected(got, "id", "n") == collected(want, "id", "n")

    @pytest.mark.parametrize("chunk", [1, 7, 50, 10_000])
    def test_framed_equals_a_plain_window(self, skewed, chunk):
        w = Window.partitionBy("key").orderBy("at", "id")

        def build(win):
            return {
                "m": F.round(F.avg("x").over(win.rowsBetween(-3, 2)), 9), "back": F.lag("x", 3).over(win), "n": F.count("x").over(win.rowsBetween(-3, 2)),
            }

        want = skewed.select("*", *[c.alias(n) for n, c in build(w).items()])
        got = ordered.framed(skewed, ["key"], [F.col("at"), F.col("id")], F.floor(F.col("at") / 10), build, 3, 2, chunk)
        assert collected(got, "id", "m", "back", "n") == collected(want, "id", "m", "back", "n")

    def test_running_totals_without_key(self, skewed):
        w = Window.orderBy("x", "id").rowsBetween(Window.unboundedPreceding, 0)
        want = skewed.withColumn("t", F.sum("at").over(w))
        graded = ordered.with_quantile_grain(skewed, "x", 6)
        got = ordered.running_totals(graded, [], [F.col("x"), F.col("id")], {"t": F.col("at")}, F.col(ordered.GRAIN))
        assert collected(got, "id", "t") == collected(want, "id", "t")

    @pytest.mark.parametrize("values", [1, 20, 20_000])
    def test_percentiles_of_many_columns(self, spark, values):
        rng = np.random.default_rng(3)
        n = 30_000
        columns = {
            "x": np.concatenate([rng.normal(size=n // 2), np.full(n // 2, 0.25)]), "equal": np.full(n, 7.0), "two": np.arange(n) % 2 * 1.0,
            "far": np.concatenate([rng.normal(size=n - 2), [1e300, -1e300]]), "a.b": rng.integers(0, 50, n) * 1.0, "rare": np.where(np.arange(n) < 9, rng.normal(size=n), np.nan),
        }
        df = spark.createDataFrame(pd.DataFrame(columns)).unionByName(spark.createDataFrame([(None,) * 6], ", ".join(f"`{c}` double" for c in columns)))
        ps = [0.0, 0.05, 0.5, 0.77, 0.95, 1.0]
        got = ordered.exact_percentiles_of(df.withColumn("none", F.lit(None).cast("double")), [*columns, "none"], ps, values)
        for c, xs in columns.items():
            assert got[c] == pytest.approx(list(np.percentile(xs[~np.isnan(xs)], [p * 100 for p in ps])))
        assert got["none"] == [None] * 6
        assert ordered.exact_percentiles(df, "x", [0.3]) == pytest.approx([np.percentile(columns["x"], 30)])

    def test_percentile_of_nothing(self, spark):
        assert ordered.exact_percentiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]


class TestSession:
    def test_crowded_partitions_are_dealt_out(self, spark):
        crowded = spark.range(0, 10_000, 1, 8)
        with packed(crowded, rows_per_task=50, most_rows=100) as data:
            sizes = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) == 100 and max(sizes) < 200
            assert sorted(r.id for r in data.collect()) == list(range(10_000))
        with packed(crowded, rows_per_task=50, most_rows=10_000) as data:
            assert data.rdd.getNumPartitions() == 8


class TestRelational:
    def test_split_sizes_are_exact_per_stratum(self, skewed):
        parts = rel.rank_split(skewed, "id", [0.8, 0.1, 0.1], ["key"])
        sizes = {(r.key, r.part): r["count"] for r in parts.groupBy("key", "part").count().collect()}
        for key, n in skewed.groupBy("key").count().collect():
            assert sizes[key, 0] == math.floor(n * 0.8)
            assert sizes[key, 0] + sizes[key, 1] == math.floor(n * 0.9)
            assert sum(v for (k, _), v in sizes.items() if k == key) == n

    def test_split_is_repeatable_and_whole(self, skewed):
        a, b = (rel.rank_split(skewed.repartition(n), "id", [0.7, 0.3]) for n in (2, 5))
        assert collected(a, "id", "part") == collected(b, "id", "part")
        assert a.count() == skewed.count()

    def test_split_ranks_rows_of_equal_and_missing_keys(self, spark):
        keys = [None] * 7 + ["a"] * 90 + [f"k{i}" for i in range(200)]
        rows = spark.createDataFrame([(k, i % 3 if i % 5 else None) for i, k in enumerate(keys)], "k string, s int")
        for strata in ([], ["s"]):
            parts = rel.rank_split(rows, "k", [0.01, 0.3, 0.3, 0.39], strata)
            got = {}
            for r in parts.collect():
                place = ("" if r.k is None else hashlib.md5(f"42:{r.k}".encode()).hexdigest(), r.k or "")
                got.setdefault(r.s if strata else 0, []).append((place, r.part))
            assert sum(map(len, got.values())) == len(keys)
            for members in got.values():
                n, members = len(members), sorted(members)
                want = [sum(i >= math.floor(n * upto) for upto in (0.01, 0.31, 0.61)) for i in range(n)]
                assert [p for _, p in members] == want

    def test_split_shuffles_only_the_rows_of_cut_grains(self, spark):
        rows = cut_lineage(spark.range(50_000).withColumn("wide", F.repeat(F.lit("x"), 100)))
        parts = rel.rank_split(rows, "id", [0.7, 0.3])
        plan = parts._jdf.queryExecution().executedPlan().toString()
        sure, ranked = plan.split("Union", 1)[1].split("Window", 1)
        assert "hashpartitioning" not in sure and "hashpartitioning" in ranked
        assert parts.groupBy("part").count().orderBy("part").collect() == [(0, 35_000), (1, 15_000)]

    def test_cut_is_right_closed(self, spark):
        df = spark.createDataFrame([(1.0,), (1.5,), (2.0,), (5.0,), (5.1,), (None,)], "x double")
        got = [r[0] for r in df.select(rel.cut(F.col("x"), [1, 2, 5], ["1-2", "2-5"])).collect()]
        assert got == [None, "1-2", "1-2", "2-5", None, None]

    def test_levels_refuse_keys(self, skewed):
        with pytest.raises(ValueError):
            rel.levels(skewed, "id", at_most=100)

    def test_first_interval_wins(self, spark):
        days = spark.createDataFrame([(1, dt.date(2024, 1, d)) for d in range(1, 8)], "p int, day date")
        offers = spark.createDataFrame(
            [(0, 1, dt.date(2024, 1, 2), dt.date(2024, 1, 4), 10), (1, 1, dt.date(2024, 1, 4), dt.date(2024, 1, 5), 20)],
            "place int, p int, a date, b date, pct int")
        got = rel.interval_match(days, offers, ["p"], "day", "a", "b", "place").orderBy("day").select("pct").collect()
        assert [r.pct for r in got] == [None, 10, 10, 10, 20, None, None]

    def test_optional_filters_take_zero_as_a_value(self, spark):
        df = spark.createDataFrame([(0,), (1,)], "k int")
        assert rel.optional_filters(df, {"k": 0}).count() == 1
        assert rel.optional_filters(df, {"k": None}).count() == 2


class TestRecommend:
    @pytest.fixture(scope="class")
    def ratings(self, spark):
        rng = random.Random(5)
        rows = {}
        for u in range(60):
            for i in rng.sample(range(25), rng.randrange(2, 9)):
                rows[u, i] = float(rng.randrange(1, 6))
            rows[u, 0] = float(rng.randrange(1, 6))  # everybody rates one item
        for i in range(25):
            rows[60, i] = 3.0  # a constant user has no direction
        return spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user int, item int, rating double").cache()

    @staticmethod
    def brute(ratings):
        rs = {(r.user, r.item): r.rating for r in ratings.collect()}
        users, items = sorted({u for u, _ in rs}), sorted({i for _, i in rs})
        m = np.zeros((len(users), len(items)))
        for (u, i), r in rs.items():
            m[u, i] = r
        mask = m > 0
        mean = m.sum(1) / mask.sum(1)
        c = np.where(mask, m - mean[:, None], 0)
        norm = np.linalg.norm(c, axis=1)
        sim = c @ c.T / np.where(np.outer(norm, norm) == 0, 1, np.outer(norm, norm))
        np.fill_diagonal(sim, 0)
        return np.round(sim, 9), mask, mean, c

    @pytest.mark.parametrize(("hot_raters", "block_size"), [(1000, 7), (0, 7), (5, 7), (12, 1000), (20, 3)])
    def test_neighbours_equal_brute_force(self, ratings, hot_raters, block_size, monkeypatch):
        monkeypatch.setattr(recommend, "HOT_PRODUCTS", 20)
        sim, *_ = self.brute(ratings)
        want = []
        for u in range(len(sim)):
            near = sorted([(-s, v) for v, s in enumerate(sim[u]) if s >= 0.05])[:6]
            want += [(u, v) for _, v in near]
        got = recommend.neighbours(ratings, k=6, hot_raters=hot_raters, block_size=block_size)
        assert sorted((r.u, r.v) for r in got.collect()) == sorted(want)

    @pytest.mark.parametrize("hot_raters", [1000, 8])
    def test_own_cluster_comes_first(self, spark, ratings, hot_raters):
        sim, *_ = self.brute(ratings)
        # a large cluster, a small one, a single user, and users without one
        cluster = [0 if u % 3 else 1 if u % 4 else None for u in range(len(sim))]
        cluster[1] = 2
        want = []
        for u in range(len(sim)):
            near = sorted((-s, v) for v, s in enumerate(sim[u]) if s >= 0.05)
            own = [x for x in near if cluster[u] is not None and cluster[x[1]] == cluster[u]][:6]
            want += [(u, v) for _, v in (own if len(own) >= 4 else near[:6])]
        clusters = spark.createDataFrame(list(enumerate(cluster)), "user int, cluster int")
        got = recommend.neighbours(ratings, clusters, k=6, fallback_below=4, hot_raters=hot_raters, block_size=5)
        assert sorted((r.u, r.v) for r in got.collect()) == sorted(want)

    def test_text_ids(self, spark, ratings):
        named = ratings.select(F.format_string("U%04d", "user").alias("user"), F.format_string("C%03d", "item").alias("item"), "rating")
        want = recommend.recommend(ratings, recommend.neighbours(ratings, k=2, block_size=16))
        got = recommend.recommend(named, recommend.neighbours(named, k=2, block_size=16))
        assert sorted((r.u, r.item) for r in got.collect()) == sorted((f"U{r.u:04d}", f"C{r.item:03d}") for r in want.collect())

    def test_recommendations_equal_brute_force(self, spark, ratings):
        sim, mask, mean, c = self.brute(ratings)
        want = []
        for u in range(len(sim)):
            near = [v for _, v in sorted([(-s, v) for v, s in enumerate(sim[u]) if s >= 0.05])[:2]]
            if not near:
                continue
            scores = []
            for i in range(mask.shape[1]):
                if not mask[u, i]:
                    w = sum(abs(sim[u, v]) for v in near if mask[v, i])
                    up = sum(sim[u, v] * c[v, i] for v in near)
                    scores.append((-round(mean[u] + (up / w if w else 0), 9), i))
            want += [(u, i) for _, i in sorted(scores)[:5]]
        near = recommend.neighbours(ratings, k=2, block_size=16)
        got = recommend.recommend(ratings, near)
        assert sorted((r.u, r.item) for r in got.collect()) == sorted(want)

    @pytest.mark.parametrize(("piece", "held"), [(256, 500_000), (2, 7)])
    def test_votes_and_pairs_travel_as_lists(self, spark, ratings, piece, held, monkeypatch):
        monkeypatch.setattr(recommend, "PIECE", piece)
        monkeypatch.setattr(recommend, "HELD_ENTRIES", held)
        sim, mask, mean, c = self.brute(ratings)
        near = recommend.neighbours(ratings, k=4)
        want, raw = {}, {}
        for u in range(len(sim)):
            best = [v for _, v in sorted([(-s, v) for v, s in enumerate(sim[u]) if s >= 0.05])[:4]]
            for i in range(mask.shape[1]):
                voters = [v for v in best if mask[v, i]]
                if voters and not mask[u, i]:
                    weight = sum(sim[u, v] for v in voters)
                    want[u, i] = mean[u] + sum(sim[u, v] * c[v, i] for v in voters) / weight
                    raw[u, i] = sum(sim[u, v] * (c[v, i] + mean[v]) for v in voters) / weight
        voted = recommend.predictions(ratings, near)
        assert {(r.u, r.item): r.score for r in voted.collect()} == pytest.approx(want, abs=1e-8)
        assert {(r.u, r.item): r.score for r in recommend.raw_predictions(ratings, near).collect()} == pytest.approx(raw, abs=1e-8)
        pairs = spark.createDataFrame([(u, v) for u in range(61) for v in range(0, 61, 7)] + [(3, 99), (99, 3)], "u int, v int")
        given = recommend.pair_similarity(ratings, pairs)
        own = [[float(c[u] @ c[v] / n) if (n := np.linalg.norm(c[u]) * np.linalg.norm(c[v])) else 0.0 for v in range(61)] for u in range(61)]
        assert {(r.u, r.v): r.sim for r in given.collect()} == pytest.approx({(u, v): own[u][v] if max(u, v) < 61 else 0.0 for u, v in pairs.collect()}, abs=1e-8)
        # no row of a single vote or product is dealt by user and item
        for rows in (voted, given):
            plan = rows._jdf.queryExecution().optimizedPlan().toString()
            assert "RepartitionByExpression [u#" not in plan and "RepartitionByExpression [row#" in plan

    def test_rounds_give_the_same_rows(self, spark, ratings, monkeypatch):
        def every():
            near = recommend.neighbours(ratings, k=4)
            totals = recommend.raw_predictions(ratings, near, lambda raw: raw.groupBy("u").agg(F.count("*"), F.round(F.sum("score"), 6)))
            pairs = spark.createDataFrame([(u, v) for u in range(61) for v in range(0, 61, 7)] + [(3, 3), (3, 3)], "u int, v int")
            found = near, recommend.recommend(ratings, near), totals, recommend.pair_similarity(ratings, pairs)
            return [sorted(tuple(r) for r in df.collect()) for df in found]

        whole = every()
        seen, kept = [], recommend.stored_in_rounds
        monkeypatch.setattr(recommend, "ROUND_SHARE", 0)
        monkeypatch.setattr(recommend, "ROUND_ENTRIES", 700)
        monkeypatch.setattr(recommend, "stored_in_rounds", lambda parts, *a: seen.append(len(parts)) or kept(parts, *a))
        parts = every()
        assert len(seen) >= 3 and min(seen) > 1
        assert [len(rows) for rows in parts] == [len(rows) for rows in whole]
        for one, two in zip(parts, whole, strict=True):
            assert [x for r in one for x in r] == pytest.approx([x for r in two for x in r], abs=1e-8)

    def test_stored_tables_leave_no_shuffle_files(self, spark):
        def left():
            files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
            return {str(files.apply(i).getPath()) for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

        setting = spark.conf.get(session.FREED, None)
        before = left()
        table = session.stored_in_rounds([spark.range(1000).repartition(3, "id").filter(F.col("id") % 2 == r) for r in range(2)])
        deadline = time.time() + 20
        while left() - before and time.time() < deadline:
            time.sleep(0.1)
        assert not left() - before
        assert table.agg(F.sum("id")).first()[0] == 499500
        assert spark.conf.get(session.FREED, None) == setting
        folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        assert len(folders) == 2
        session.discard(table)
        assert not any(os.path.exists(f.removeprefix("file://")) for f in folders)

    def test_holdout_sizes(self, ratings):
        held = {r.user: r["count"] for r in recommend.holdout(ratings).groupBy("user").count().collect()}
        relevant = {r.user: r["count"] for r in ratings.filter("rating >= 3.5").groupBy("user").count().collect()}
        assert held == {u: max(1, min(5, int(n * 0.25))) for u, n in relevant.items() if n >= 4}

    def test_given_pairs(self, spark, ratings):
        sim, *_ = self.brute(ratings)
        pairs = spark.createDataFrame([(0, 1), (3, 9), (5, 60)], "u int, v int")
        assert {(r.u, r.v): r.sim for r in recommend.pair_similarity(ratings, pairs).collect()} == pytest.approx(
            {(0, 1): sim[0, 1], (3, 9): sim[3, 9], (5, 60): 0.0}, abs=1e-8)


class TestClustering:
    @pytest.fixture(scope="class")
    def points(self, spark):
        rng = np.random.default_rng(11)
        blobs = [rng.normal(c, 0.25, (40, 2)) for c in ((0, 0), (3, 0), (0.5, 4))]
        chain = np.column_stack([np.linspace(-4, 4, 30), np.full(30, 8.0)])
        copies = np.tile([[0.1, 0.1]], (60, 1))  # many copies of one point
        noise = rng.uniform(-9, -6, (6, 2))
        xs = np.concatenate([*blobs, chain, copies, noise])
        order = rng.permutation(len(xs))
        return xs[order], spark.createDataFrame([(int(i), [float(a) for a in x]) for i, x in enumerate(xs[order])], "id long, x array<double>").cache()

    @staticmethod
    def brute_dbscan(xs, eps, min_samples):
        near = [np.flatnonzero(np.sqrt(((xs - x) ** 2).sum(1)) <= eps) for x in xs]
        core = [len(n) >= min_samples for n in near]
        label, out = 0, [-1] * len(xs)
        for i in range(len(xs)):
            if out[i] != -1 or not core[i]:
                continue
            todo = [i]
            while todo:
                j = todo.pop()
                if out[j] == -1:
                    out[j] = label
                    if core[j]:
                        todo += list(near[j])
            label += 1
        return out

    @pytest.mark.parametrize("block_size", [16, 4096])
    def test_dbscan_equals_brute_force(self, points, block_size):
        xs, df = points
        got = clustering.dbscan(df, "id", "x", 2, eps=0.4, min_samples=5, block_size=block_size)
        assert [r.label for r in got.orderBy("id").collect()] == self.brute_dbscan(xs, 0.4, 5)
        counts = clustering.cluster_counts(got).first()
        assert counts.n_noise == self.brute_dbscan(xs, 0.4, 5).count(-1)

    @pytest.mark.parametrize(("dims", "eps", "block_size"), [(1, 0.05, 20), (5, 1.1, 30), (5, 2.0, 4096), (8, 1.8, 64)])
    def test_dbscan_in_many_dimensions(self, spark, dims, eps, block_size):
        rng = np.random.default_rng(dims)
        xs = np.concatenate([rng.normal(c, 0.4, (60, dims)) for c in (0, 2, 5)] + [rng.uniform(-8, 8, (40, dims))])
        df = spark.createDataFrame([(i, [float(a) for a in x], "n") for i, x in enumerate(xs)], "id long, x array<double>, own string")
        got = clustering.dbscan(df, "id", "x", dims, eps=eps, min_samples=4, block_size=block_size)
        assert [r.label for r in got.orderBy("id").collect()] == self.brute_dbscan(xs, eps, 4)

    def test_dbscan_of_unusable_vectors(self, spark):
        rows = [(i, [0.1 * i, 0.0]) for i in range(6)] + [(6, None), (7, [float("nan"), 0.0]), (8, [0.0]), (9, [None, 0.0]), (10, [float("inf"), 0.0])]
        df = spark.createDataFrame(rows, "id long, x array<double>")
        got = clustering.dbscan(df, "id", "x", 2, eps=0.15, min_samples=2)
        assert [r.label for r in got.orderBy("id").collect()] == [0] * 6 + [-1] * 5
        assert clustering.dbscan(df.filter("id > 5"), "id", "x", 2).count() == 5
        assert clustering.dbscan(df.filter("id > 99"), "id", "x", 2).count() == 0

    def test_dbscan_with_text_ids(self, points):
        xs, df = points
        named = df.withColumn("id", F.format_string("U%04d", "id"))
        got = clustering.dbscan(named, "id", "x", 2, eps=0.4, min_samples=5, block_size=64)
        assert [r.label for r in got.orderBy("id").collect()] == self.brute_dbscan(xs, 0.4, 5)

    def test_dbscan_moves_points_to_askers_only(self, spark):
        """A crowd in 25 pieces: the pieces that one asker meets are copied once, far cells not at all, none without askers."""
        rng = np.random.default_rng(3)
        xs = np.concatenate([rng.uniform(0, 1, (500, 2)), rng.uniform(5, 6, (100, 2))])
        df = spark.createDataFrame([(i, [float(a) for a in x]) for i, x in enumerate(xs)], "id long, x array<double>")
        others = df.withColumn("cell", F.transform("x", lambda v: F.floor(v / 0.5))).withColumn("piece", (F.col("id") % 25).cast("int"))

        def met(asked, others):
            return pd.DataFrame({"asked": [len(asked)], "others": [len(others)]})

        for ids in ([], [7], list(range(40))):
            askers = others.filter(F.col("id").isin(ids)).drop("piece")
            rows = clustering._meetings(askers, others, [0, 1], 0.5, 0.5, 20, met, "asked long, others long").collect()
            assert all(r.asked <= 40 for r in rows) and sum(r.others for r in rows) <= (0, 500, 2000)[min(len(ids), 2)]
            near = sum(r.asked * r.others for r in rows)
            assert near >= sum((np.sqrt(((xs - xs[i]) ** 2).sum(1)) <= 0.5).sum() for i in ids)

    def test_components_of_a_long_path(self, spark):
        edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20], "a long, b long")
        roots = {r.node: r.root for r in clustering.connected_components(edges).collect()}
        assert roots == {i: 0 if i <= 20 else 21 for i in range(41)}

    def test_distances_by_products_keep_the_digits_of_close_points(self):
        rng = np.random.default_rng(5)
        a = rng.normal(size=(40, 6)) + 1000
        b = np.concatenate([a[:10], a[10:20] + 1e-7, a[20:] + rng.normal(size=(20, 6)), [[np.inf] * 6]])
        want = np.sqrt(np.square(a[:, None] - b[None]).sum(axis=2))
        np.testing.assert_allclose(clustering._product_distances(a, b), want, rtol=1e-9, atol=0)

    def test_silhouette_blocks_grow_up_to_a_bound(self):
        assert [clustering.silhouette_block(n, 2048) for n in (10, 98_304, 480_000, 10**8)] == [2048, 2048, 10_000, 1 << 15]

    @pytest.mark.parametrize("block_size", [50, 4096])
    def test_silhouette_equals_brute_force(self, points, block_size):
        xs, df = points
        labels = np.arange(len(xs)) % 3
        labels[0] = 7  # a cluster of one
        want = []
        for i, x in enumerate(xs):
            d = np.sqrt(((xs - x) ** 2).sum(1))
            own = labels == labels[i]
            if own.sum() == 1:
                want.append(0.0)
                continue
            a = d[own].sum() / (own.sum() - 1)
            b = min(d[labels == k].mean() for k in set(labels) if k != labels[i])
            want.append((b - a) / max(a, b))
        label = F.when(F.col("id") == 0, 7).otherwise((F.col("id") % 3).cast("int"))
        got = clustering.silhouette(df.withColumn("c", label), "id", "x", "c", block_size)
        assert [r.silhouette for r in got.orderBy("id").collect()] == pytest.approx(want)

    def test_detector_limit_flags_five_percent(self, spark):
        rng = np.random.default_rng(1)
        rows = [(float(a), float(b), 1500.0, 45.0, None) for a, b in rng.normal(size=(400, 2))]
        df = spark.createDataFrame(rows, "temperatura double, vibracion double, velocidad_rpm double, consumo_kw double, presion_bar double")
        for d in (clustering.fit_detector(df), clustering.fit_baseline_detector(df)):
            assert clustering.score(df, d).filter("ml_anomaly").count() == 20
            assert d.stds[4] == 1.0  # a constant feature does not divide by zero

    def test_elbow_falls(self, points):
        _, df = points
        costs = [c for _, c in clustering.kmeans_elbow(df, "x", 2, [1, 2, 3], restarts=2)]
        assert costs == sorted(costs, reverse=True)


class TestSensors:
    @pytest.fixture(scope="class")
    def readings(self, spark):
        ts = dt.datetime(2024, 1, 1)
        return spark.createDataFrame(
            [
                ("MAQ-001", ts, 80.0, 2.0, 1480.0, 45.0, None, 0),  # missing pressure
                ("MAQ-002", ts, 95.0, 4.5, 1520.0, 70.0, 2.5, 0),  # exactly at the limits
                ("MAQ-003", ts, 99.0, 5.0, 2000.0, 45.0, 6.0, 3),  # two rules at once, speed off
                ("MAQ-004", ts, 70.0, 2.0, 1460.0, 40.0, 6.0, 0),  # the model only
            ],
            "maquina_id string, ts timestamp, temperatura double, vibracion double, velocidad_rpm double, consumo_kw double, presion_bar double, error_code int",
        )

    def test_rules_are_strict(self, readings):
        got = {(r.maquina_id, r.tipo_anomalia) for r in sensors.detect_rules(readings).collect()}
        assert got == {("MAQ-003", "UMBRAL_ALTO_TEMPERATURA"), ("MAQ-003", "UMBRAL_ALTO_VIBRACION")}

    def test_missing_counts_as_zero_on_request(self, readings):
        got = {(r.maquina_id, r.tipo_anomalia) for r in sensors.detect_rules(readings, missing_as_zero=True).collect()}
        assert ("MAQ-001", "UMBRAL_BAJO_PRESION_BAR") in got and len(got) == 3

    def test_model_event_only_without_rule(self, readings):
        scored = readings.select("*", F.lit(3.0).alias("distance"), F.col("maquina_id").isin("MAQ-003", "MAQ-004").alias("ml_anomaly"), F.lit(2.0).alias("ml_threshold"))
        rows = {r.maquina_id: r for r in sensors.flag(scored).collect()}
        assert [e.tipo_anomalia for e in rows["MAQ-004"].events] == ["ANOMALIA_ML"]
        assert rows["MAQ-004"].events[0].umbral == 2.0
        assert len(rows["MAQ-003"].events) == 2 and rows["MAQ-003"].es_anomalia
        assert not rows["MAQ-001"].es_anomalia and rows["MAQ-001"].events == []

    def test_states_and_deviation(self, spark, readings):
        flagged = readings.withColumn("es_anomalia", F.col("maquina_id").isin("MAQ-003", "MAQ-004"))
        states = [r[0] for r in flagged.orderBy("maquina_id").select(sensors.machine_state()).collect()]
        assert states == ["normal", "normal", "critico", "advertencia"]
        off = sensors.deviation_rule(readings, sensors.nominal_table(spark)).orderBy("maquina_id").collect()
        assert [(r.rpm_off, r.error_flag) for r in off] == [(False, False), (False, False), (True, True), (False, False)]

    def test_last_write_wins(self, readings):
        again = readings.withColumn("v", F.lit(1)).unionByName(readings.withColumn("temperatura", F.lit(1.0)).withColumn("v", F.lit(2)))
        assert {r.temperatura for r in sensors.last_writes(again, "v").collect()} == {1.0}


class TestDialogue:
    @staticmethod
    def simulate(m, turns):
        state, out = "idle", []
        for msg, intent in turns:
            before, key = state, msg.lower().strip()
            key = "si" if key in ("si", "sí", "ok") else "no" if key in ("no", "nope") else key
            if key == "ayuda":
                pass
            elif state == "idle":
                state = m.starts.get(intent, "idle")
            elif "salir" in msg:
                state = "idle"
            else:
                options = dict(m.options[state])
                hit = key if key in options else next((o for o in options if len(o) > 4 and (key in o or o in key)), None)
                state = (options[hit] or "idle") if hit else state
            out.append((before, state))
        return out

    @pytest.mark.parametrize("chunk", [2, 5, 1000])
    def test_long_and_short_sessions(self, spark, chunk):
        rng, m = random.Random(2), dialogue.Machine()
        words = ["si", "no", "inicio", "program", "ayuda", "quiero salir", "no tengo internet", "ok", ""]
        sessions = {s: [(rng.choice(words), rng.choice(["problema_wifi", "computadora_lenta", "otro"])) for _ in range(n)] for s, n in ((1, 60), (2, 3), (3, 1))}
        rows = [(s, i, msg, intent) for s, ts in sessions.items() for i, (msg, intent) in enumerate(ts)]
        df = spark.createDataFrame(rows, "s long, t long, message string, intent string")
        got = dialogue.dialogue(df, "s", "t", "message", "intent", m, chunk).orderBy("s", "t").collect()
        want = [x for s in sorted(sessions) for x in self.simulate(m, sessions[s])]
        assert [(r.state_before, r.state_after) for r in got] == want

    def test_walk_through_a_flow(self, spark):
        talk = [("mi wifi falla", "problema_wifi"), ("quizás", "otro"), ("sí", "otro"), ("ayuda", "otro"), ("no", "otro"), ("gracias", "otro")]
        df = spark.createDataFrame([(1, i, m, k) for i, (m, k) in enumerate(talk)], "s long, t long, message string, intent string")
        got = dialogue.dialogue(df, "s", "t", "message", "intent").orderBy("t").collect()
        assert [r.action for r in got] == ["start", "repeat", "advance", "help", "finish", "answer"]
        assert got[2].state_after == "wifi_otros" and got[-1].state_after == "idle"

    def test_clear_starts_over(self, spark):
        turns = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 0)], "s long, t long")
        cleared = spark.createDataFrame([(1, 2)], "s long, t long")
        got = {(r.s, r.t): (r.turn_no, r.turn_count) for r in dialogue.session_history(turns, "s", "t", cleared).collect()}
        assert got == {(1, 3): (1, 2), (1, 4): (2, 2), (2, 0): (1, 1)}


class TestSeries:
    def test_week_ends_on_sunday_and_gaps_are_zero(self, spark):
        rows = [(1, dt.date(2024, 1, 7), 2), (1, dt.date(2024, 1, 8), 3), (1, dt.date(2024, 1, 28), 4)]
        got = aggregates.weekly(spark.createDataFrame(rows, "k int, d date, u long"), ["k"], "d", "u").orderBy("week_end").collect()
        assert [(r.week_end.day, r.units) for r in got] == [(7, 2), (14, 3), (21, 0), (28, 4)]

    def test_calendar(self, spark):
        row = spark.createDataFrame([(dt.date(2024, 12, 30),)], "d date").select(
            *[c.alias(n) for n, c in dates.date_parts(F.col("d")).items()], dates.day_name(F.col("d")).alias("name")).first()
        assert (row.day_of_week, row.week_of_year, row.is_weekend, row.quarter, row.name) == (0, 1, 0, 4, "Monday")

    def test_short_history_takes_the_mean(self, spark):
        daily = spark.createDataFrame([(1, dt.date(2024, 1, d), float(d)) for d in (1, 2, 3)], "k int, sale_date date, u double")
        targets = spark.createDataFrame([(1, dt.date(2024, 1, 3)), (2, dt.date(2024, 1, 3))], "k int, day date")
        got = {r.k: r for r in series.as_of_history(targets, daily, ["k"], "day", "u", [1, 2, 7], [2, 7]).collect()}
        assert (got[1].lag_1, got[1].lag_2, got[1].lag_7, got[1].roll_2, got[1].roll_7) == (2.0, 1.0, 1.5, 1.5, 1.5)
        assert got[2].lag_1 == 0.0 and got[2].roll_7 == 0.0

    def test_forecast_follows_a_steady_series(self, spark):
        rows = [(1, dt.date(2023, 1, 1) + dt.timedelta(days=7 * w), 100 + (w % 4)) for w in range(60)]
        got = series.forecast_series(spark.createDataFrame(rows, "k int, sale_date date, units_sold long"), ["k"]).collect()
        assert len(got) == 8 and all(95 < r.forecast < 108 and r.lower <= r.forecast <= r.upper for r in got)
        assert got[0].week_end == dt.date(2023, 1, 1) + dt.timedelta(days=7 * 60)

    def test_short_series_are_not_lost(self, spark):
        rows = [(k, dt.date(2023, 1, 1) + dt.timedelta(days=7 * w), 100 + (w % 4)) for k, n in ((1, 5), (2, 14), (3, 22)) for w in range(n)]
        got = series.forecast_series(spark.createDataFrame(rows, "k int, sale_date date, units_sold long"), ["k"]).collect()
        status = {k: {r.status for r in got if r.k == k} for k in (1, 2, 3)}
        assert status == {1: {"too_short"}, 2: {"ok"}, 3: {"ok"}}
        assert [r.forecast for r in got if r.k == 1] == [None] and all(r.lower <= r.forecast <= r.upper for r in got if r.k > 1)

    def test_trend_line(self, spark):
        daily = spark.createDataFrame([(dt.date(2024, 1, d), 10.0 + 2 * d) for d in range(1, 11)], "day date, mean_value double")
        got = series.linear_trend(series.with_day_index(daily)).orderBy("forecast_day").collect()
        assert [r.predicted for r in got] == [32.0 + 2 * i for i in range(7)]
        assert [r.alert for r in got] == ["NO", "SÍ", "SÍ", "SÍ", "SÍ", "SÍ", "SÍ"]


class TestEvaluate:
    def test_auc_counts_ties_half(self, spark):
        rows = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.1), (1, 0.1)]
        auc = evaluate.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc
        want = sum((a > b) + 0.5 * (a == b) for ya, a in rows if ya for yb, b in rows if not yb) / 6
        assert auc == pytest.approx(want)

    def test_report_without_predictions_of_a_class(self, spark):
        df = spark.createDataFrame([("a", "a"), ("b", "a"), ("a", "a")], "y string, p string")
        rows = {r["class"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
        assert rows["b"].precision == 0 and rows["b"].f1 == 0 and rows["a"].recall == 1
        assert rows["weighted avg"].recall == pytest.approx(2 / 3)

    def test_mape_floor(self, spark):
        df = spark.createDataFrame([(0.0, 2.0), (10.0, 5.0)], "y double, p double")
        m = evaluate.regression_metrics(df, "y", "p").first()
        assert (m.mae, m.mape) == (3.5, 125.0)


class TestText:
    def apply(self, spark, fn, *values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]

    def test_normalise(self, spark):
        got = self.apply(spark, text.normalise, "  ¡HOLA,   Mundo!  ", "", "niño áéíóú", "a\tb\nc")
        assert got == ["¡hola mundo", "", "nino aeiou", "a b c"]

    def test_known_quirk_of_the_accent_table(self, spark):
        assert self.apply(spark, text.fold_accents, "ã ñ") == ["ä n"]

    def test_keywords(self, spark):
        stop = text.stopwords()
        got = self.apply(spark, lambda s: text.keywords(s, stop), "No puedo conectar el WiFi, por favor", "está 123 ab", "")
        assert got == [["puedo", "conectar", "wifi"], [], []]

    def test_accents_do_not_matter(self, spark):
        stop = text.stopwords()
        a, b = self.apply(spark, lambda s: text.keywords(s, stop), "contraseña olvidé", "contrasena olvide")
        assert a == b == ["contrasena", "olvide"]

    def test_options(self, spark):
        got = self.apply(spark, lambda s: text.match_option(text.normalise_answer(s), ["inicio", "programas", "si"]), "al inicio", "programa", "SÍ ", "no", "no si")
        assert got == ["inicio", "programas", "si", None, None]

    def test_prices_and_ids(self, spark):
        assert self.apply(spark, text.parse_price, "Â£51.77", "£ 3", "gratis") == [51.77, 3.0, None]
        row = spark.range(1).select(text.format_id("U", F.lit(7), 4), text.format_id("MAQ-", F.lit(12345), 3)).first()
        assert tuple(row) == ("U0007", "MAQ-12345")

    def test_ngrams(self, spark):
        got = self.apply(spark, lambda s: text.ngrams(F.split(s, " "), 2), "a b c", "a")
        assert got == [["a b", "b c"], []]

    def test_stems_of_known_words(self, spark):
        """Words of the stemmer's published sample vocabulary."""
        known = """che che checa chec checar chec checo chec checoslovaquia checoslovaqui chedraoui chedraoui chefs chefs cheliabinsk cheliabinsk chelo chel
        chemical chemical chemise chemis chepo chep cheque chequ cheques chequ cheraw cheraw chesca chesc chester chest chetumal chetumal chetumaleños chetumaleñ
        chevrolet chevrolet cheyene cheyen cheyenne cheyenn chi chi chía chi chiapaneca chiapanec chiapas chiap chiba chib chic chic chica chic chicago chicag
        chicana chican chicano chican chicas chic chicharrones chicharron chichen chich chichimecas chichimec chicles chicl chico chic
        torá tor tórax torax torcer torc toreado tor toreados tor toreándolo tor torear tor toreara tor torearlo tor toreó tore torero torer toreros torer
        torio tori tormenta torment tormentas torment tornado torn tornados torn tornar torn tornen torn torneo torne torneos torne tornillo tornill
        tornillos tornill torniquete torniquet torno torn toro tor toronto toront toros tor torpedearon torped torpeza torpez torrado torr torralba torralb
        torre torr torrencial torrencial torrenciales torrencial torrente torrent torreon torreon torreón torreon torres torr torrescano torrescan""".split()
        # and one for each rule of the first and second step
        known += """rápidamente rapid amablemente amabl activamente activ relativamente relat naciones nacion solución solucion instituciones institu biología biolog
        existencia existent comunidades comun posibilidad posibil negativa negat haciéndola hac diciendo dic contribuyendo contribu contribuyéndolo contribuyendol
        huyen huy constituyen constitu paguemos pag vivíamos viv logística logist""".split()
        words, stems = known[::2], known[1::2]
        rows = spark.createDataFrame(list(enumerate(words)), "i int, w string").select("i", text.stem_word(F.col("w")).alias("s"))
        got = {words[r.i]: r.s for r in rows.collect()}
        assert got == dict(zip(words, stems))
        assert self.apply(spark, lambda s: text.stem(F.split(s, " ")), "torres", "") == [["torr"], [""]]

    def test_stems_leave_three_letters(self, spark):
        got = self.apply(spark, lambda s: text.stem(F.split(s, " ")), "impresoras conectado sol uno")
        assert got == [["impresor", "conect", "sol", "uno"]]

    def test_rounding(self, spark):
        row = spark.range(1).select(numbers.round_half_up(F.lit(11884.405), 2), numbers.round_half_even(F.lit(2.5), 0)).first()
        assert tuple(row) == (11884.41, 2.0)


class TestLookupsAndProfiles:
    def test_absent_key_is_an_error(self, spark):
        rows = spark.createDataFrame([(1, "a")], "k int, v string")
        assert rel.found(rows.filter("k = 1"), "key 1").count() == 1
        with pytest.raises(LookupError, match="key 2"):
            rel.found(rows.filter("k = 2"), "key 2")

    def test_latest_row_of_equal_times(self, spark):
        rows = spark.createDataFrame([("m", 5, 1), ("m", 5, 3), ("m", 5, 2), ("m", 4, 9)], "m string, ts int, id int")
        assert [r.id for r in rel.latest_by_key(rows, ["m"], "ts", "id").collect()] == [3]

    def test_cell_statistics(self, spark):
        rows = spark.createDataFrame([([1.0, 2.0],), ([3.0, None],), (None,), ([],)], "x array<double>")
        whole = aggregates.cell_stats(rows, "x").first()
        assert (whole.n, whole.total, whole.low, whole.high, whole.mean) == (3, 6.0, 1.0, 3.0, 2.0)
        assert whole.std == pytest.approx((2 / 3) ** 0.5)
        by = {r.pos: (r.n, r.total) for r in aggregates.cell_stats(rows, "x", by_position=True).collect()}
        assert by == {0: (2, 4.0), 1: (1, 2.0)}

    def test_profile_has_shape_and_types(self, spark):
        rows = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0)], "a int, b double")
        got = {r.column: r for r in aggregates.profile(rows, ["a", "b"]).collect()}
        assert (got["a"].type, got["a"].rows, got["a"].n, got["a"].median) == ("int", 3, 3, 2.0)
        assert (got["b"].type, got["b"].rows, got["b"].n, got["b"].mean) == ("double", 3, 2, 3.0)



class TestSentiment:
    def test_equals_brute_force(self, spark):
        draw = random.Random(6)
        words = "good bad fine poor mill tide Ñu x y2".split()
        rows = [(i, " ".join(draw.choices(words, k=draw.randint(0, 9))), draw.choice(["pos", "neg", "odd"])) for i in range(60)]
        train, test = rows[:40], [*rows[40:], (98, "unknown words only", "pos"), (99, None, "neg")]
        frame = "doc_id int, text string, label string"
        model = textmodels.train_sentiment(spark.createDataFrame([*train, (97, "good good", None)], frame))
        got = {r.doc_id: r.predicted for r in textmodels.predict_sentiment(model, spark.createDataFrame(test, frame), "doc_id").collect()}

        def cut(t):
            return [w for w in (t or "").lower().split() if len(w) > 1]

        seen = {c: [w for _, t, k in train if k == c for w in cut(t)] for c in ("neg", "odd", "pos")}
        known = {w for ws in seen.values() for w in ws}
        for i, t, _ in test:
            score = {
                c: math.log(sum(k == c for *_, k in train) + 1) + sum(math.log((ws.count(w) + 1) / (len(ws) + len(known))) for w in cut(t) if w in known)
                for c, ws in seen.items()
            }
            assert score[got[i]] == pytest.approx(max(score.values()))


class TestSegments:
    @pytest.fixture(scope="class")
    def planted(self, spark):
        rng = np.random.default_rng(21)
        centres = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 1], [9, 9, -2]], dtype=float)
        truth = rng.integers(0, 4, 400)
        xs = centres[truth] + rng.normal(size=(400, 3))
        df = spark.createDataFrame([(i, [float(a) for a in x]) for i, x in enumerate(xs)], "user long, x array<double>").repartition(5)
        return xs, truth, df.cache()

    @staticmethod
    def squared_silhouette(xs, labels):
        d = np.square(xs[:, None] - xs[None]).sum(axis=2)
        out = []
        for i in range(len(xs)):
            own = labels == labels[i]
            if own.sum() == 1 or own.all():
                out.append(0.0)
                continue
            a = d[i, own].sum() / (own.sum() - 1)
            b = min(d[i, labels == c].mean() for c in set(labels) if c != labels[i])
            out.append((b - a) / max(a, b))
        return float(np.mean(out))

    def test_chooses_the_planted_number(self, spark, planted):
        xs, truth, df = planted
        ks = range(1, 8)
        found = segments.fit_many(df, "user", ks, restarts=5)
        costs = [found[k].cost for k in ks]
        assert costs == sorted(costs, reverse=True)
        assert costs[0] == pytest.approx(np.square(xs - xs.mean(axis=0)).sum())
        scores = segments.silhouettes(df, [found[k] for k in ks])
        assert max(zip(scores, ks))[1] == 4 and scores[0] == 0.0
        labels = np.array([r.cluster for r in segments.assigned(df, found[4].centres).orderBy("user").collect()])
        assert len({(a, b) for a, b in zip(truth, labels)}) == 4
        for k, s in zip(ks, scores):
            own = np.square(xs[:, None] - found[k].centres[None]).sum(axis=2).argmin(axis=1)
            assert s == pytest.approx(self.squared_silhouette(xs, own))
            assert found[k].cost == pytest.approx(np.square(xs - found[k].centres[own]).sum())
            for c in range(k):  # a finished run: each centre is the mean of its points
                assert found[k].centres[c] == pytest.approx(xs[own == c].mean(axis=0), abs=1e-3)
        rows = df.select("x", F.when(F.col("user") == 0, -7).otherwise(F.col("user") % 3).alias("label"))
        labels = np.array([-7 if i == 0 else i % 3 for i in range(len(xs))])
        assert segments.labelled_silhouette(rows) == pytest.approx(self.squared_silhouette(xs, labels))
        assert segments.labelled_silhouette(rows.filter("label = 1")) == 0.0

    def test_features_are_read_once(self, spark):
        seen = spark.sparkContext.accumulator(0)
        rows = spark.sparkContext.parallelize([(u, float(u % 3), None if u == 2 else 1.0) for u in range(12)], 2)
        features = rows.map(lambda r: (seen.add(1), r)[1]).toDF("user long, a double, b double")
        found = {r.user: r.x for r in segments.scaled_vectors(features, "user", ["a", "b"]).collect()}
        assert seen.value == 12
        a, b = np.array([u % 3 for u in range(12)]), np.array([u != 2 for u in range(12)], float)
        want = np.column_stack([(a - a.mean()) / a.std(), (b - b.mean()) / b.std()])
        assert np.allclose([found[u] for u in range(12)], want)

    def test_fewer_places_than_clusters(self, spark):
        df = spark.createDataFrame([(i, [float(i % 2), 1.0]) for i in range(20)], "user long, x array<double>")
        found = segments.fit_many(df, "user", [1, 2, 5], restarts=2)
        assert found[2].cost == found[5].cost == pytest.approx(0.0) and found[5].k == 2
        assert segments.silhouettes(df, [found[2]]) == [1.0]

    def test_segments_of_planted_users(self, spark):
        """Two ways to behave, in two categories, and one user like nobody else."""
        rng = np.random.default_rng(8)
        rows = []
        for u in range(60):
            kind = u % 2
            for i in range(8):
                rating, length = (4.5, 10.0) if kind else (1.5, 40.0)
                rows.append((u, 100 * kind + i, rating + float(rng.normal(0, 0.1)), float(rng.normal(50, 1)), 3, length + float(rng.normal(0, 0.5)), kind, "AB"[kind]))
        rows += [(99, 500 + i, 3.0, 900.0, 70, 500.0, 1, "C") for i in range(40)]
        columns = "user long, item long, rating double, progress double, sessions long, duration double, completed int, category string"
        found = segments.segment_users(spark.createDataFrame(rows, columns), ks=range(2, 6), restarts=3)
        users = {r.user: r for r in found.users.collect()}
        assert len(users) == 61 and users[99].dbscan_cluster == -1
        assert found.metrics["best_k"] == found.metrics["n_clusters_km"] == 3
        assert len({(u % 2, users[u].kmeans_cluster) for u in range(60)}) == 2
        assert len({(u % 2, users[u].dbscan_cluster) for u in range(60)}) == 2
        assert (found.metrics["n_clusters_db"], found.metrics["n_noise_db"]) == (2, 1)
        assert 0.8 < found.metrics["km_silhouette"] <= 1 and 0.8 < found.metrics["db_silhouette"] <= 1


class TestRegisteredQueries:
    def test_co_rating_pairs_follow_from_the_ratings(self, spark):
        sf = "/root/testdata/sf0.001"
        m = views.ratings(spark, sf).toPandas().pivot(index="user", columns="item", values="rating").astype(float)
        dev = m.sub(m.mean(axis=1), axis=0).fillna(0.0)
        norm = np.sqrt((dev**2).sum(axis=1))
        w = dev[norm > 1e-9].div(norm[norm > 1e-9], axis=0)
        sims = np.round(w.to_numpy() @ w.to_numpy().T, recommend.SIM_DIGITS)
        np.fill_diagonal(sims, 0.0)
        want = {}
        for i, u in enumerate(w.index):
            best = sorted((-s, v) for s, v in zip(sims[i], w.index) if s >= 0.05)[:30]
            want |= {(u, v): -s for s, v in best}
        got = {(r.u, r.v): r.sim for r in registered()["j7_co_rating_similarity"](spark, sf).collect()}
        assert any(abs(u - v) > 1 for u, v in want) and got == pytest.approx(want, abs=2e-6)

    def test_dbscan_query_clusters_on_all_dimensions(self, spark, tmp_path):
        rng = np.random.default_rng(9)
        xs = np.zeros((60, 64))
        xs[:25, 63], xs[25:50, 30] = 5.0, -5.0
        xs[50:, 4:] = rng.uniform(2, 9, (10, 60))
        xs[:, 4:] += rng.normal(scale=0.05, size=(60, 60))
        xs = xs[rng.permutation(60)]
        spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(xs)], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
        got = registered()["m6_dbscan"](spark, str(tmp_path)).orderBy("vec_id").collect()
        want = TestClustering.brute_dbscan(xs, 1.8, 5)
        assert set(want) == {-1, 0, 1} and [r.label for r in got] == want

    @pytest.mark.parametrize("name", ["m9_forest", "m9_boosting", "m11_random_search", "m12_demand_forecast", "m14_importances", "l10_top_importances", "s23_saved_model", "m28_boosted_trees", "m29_tuning"])
    def test_models_are_trained_with_the_defaults(self, spark, monkeypatch, name):
        class Seen(Exception):
            pass

        def seen(*args, **kwargs):
            raise Seen(args, kwargs)

        for f in ("fit", "fit_and_score", "random_search", "tune_boosted"):
            monkeypatch.setattr(models, f, seen)
        with pytest.raises(Seen) as caught:
            registered()[name](spark, "/root/testdata/sf0.001")
        args, kwargs = caught.value.args
        if name in ("m11_random_search", "m29_tuning"):
            assert kwargs == {} and len(args) == 2
        else:
            default = {"m9_boosting": models.boosting_regressor, "m28_boosted_trees": models.boosted_classifier}.get(name, models.forest_regressor)()
            assert type(args[0]) is type(default)
            assert {p.name: v for p, v in args[0].extractParamMap().items()} == {p.name: v for p, v in default.extractParamMap().items()}


class TestTfidf:
    def test_terms_are_counted_where_their_text_is(self, spark):
        rng = random.Random(3)
        docs = [(d % 30, " ".join(rng.choice(["uno", "dos", "tres", "cuatro", "x"]) for _ in range(rng.randrange(9)))) for d in range(40)] + [(None, "uno dos"), (77, None)]
        counts = {}
        for d, t in docs:
            words = [w for w in (t or "").split() if len(w) > 1]
            for g in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
                counts[d, g] = counts.get((d, g), 0) + 1
        df, total = {}, {}
        for (_, g), n in counts.items():
            df[g], total[g] = df.get(g, 0) + 1, total.get(g, 0) + n
        vocab = sorted(df, key=lambda g: (-total[g], g))[:7]
        raw = {(d, g): (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + df[g])) + 1) for (d, g), n in counts.items() if g in vocab}
        norm = {}
        for (d, _), w in raw.items():
            norm[d] = norm.get(d, 0) + w * w
        rows = spark.createDataFrame(docs, "doc_id int, text string")
        got = textmodels.tfidf(rows, "doc_id", textmodels.word_tokens(F.col("text")), max_features=7)
        assert {(r.doc_id, r.term): r.weight for r in got.collect()} == pytest.approx({k: w / math.sqrt(norm[k[0]]) for k, w in raw.items()})
        assert "hashpartitioning(doc_id#" in (plan := got._jdf.queryExecution().executedPlan().toString())
        assert not re.search(r"hashpartitioning\(doc_id#\w+, term#", plan)
