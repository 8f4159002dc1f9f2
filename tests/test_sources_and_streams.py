"""Readers, writers and streaming jobs on small files."""

import datetime as dt
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemill.functions import text
from tidemill.operators import clustering, models, textmodels
from tidemill.plans import streams
from tidemill.session import cut_lineage, shared_dir, side_by_side
from tidemill.sources import pages, readers, writers
from tidemill.sources.upserts import UpsertStore
from tidemill.streaming import jobs


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named
    assert cut_lineage(spark.range(3)).count() == 3


def test_zip_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("a.csv", "k,v\n1,x\n2,y\n")
        z.writestr("notes.txt", "not a table")
    (tmp_path / "bad.zip").write_bytes(b"broken")
    good, bad = readers.zipped_csv(readers.binary_files(spark, str(tmp_path)), "k int, v string")
    assert sorted((r.k, r.v) for r in good.collect()) == [(1, "x"), (2, "y")]
    assert [r.archive.rsplit("/", 1)[1] for r in bad.collect()] == ["bad.zip"]


def test_zip_records_are_read_whole(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one.csv", 'k,v\r\n1,"a, b"\r\n2,"two\nlines and ""quotes"""\r\nk,v\r\n\r\n3\r\nx,\r\n')
        z.writestr("sub/two.CSV", "other,names\n7,ü\n")
        z.writestr("note.txt", "no,table")
        z.writestr("empty.csv", "")
    with zipfile.ZipFile(tmp_path / "late.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("good.csv", "k,v\n8,lost\n")
        z.writestr("broken.csv", "k,v\n" + "".join(f"{i},{i * 7919 % 104729}\n" for i in range(20_000)))
    data = bytearray((tmp_path / "late.zip").read_bytes())
    data[len(data) // 2 : len(data) // 2 + 40] = bytes(40)
    (tmp_path / "late.zip").write_bytes(bytes(data))
    with zipfile.ZipFile(tmp_path / "latin.zip", "w") as z:
        z.writestr("l.csv", "k,v\n9,é\n".encode("latin-1"))
    good, bad = readers.zipped_csv(readers.binary_files(spark, str(tmp_path)), "k int, v string")
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([
        ("one.csv", 1, "a, b"), ("one.csv", 2, 'two\nlines and "quotes"'), ("one.csv", None, "v"), ("one.csv", 3, None), ("one.csv", None, None), ("sub/two.CSV", 7, "ü")], key=repr)
    assert sorted(r.archive.rsplit("/", 1)[1] for r in bad.collect()) == ["late.zip", "latin.zip"]


def test_arff_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.arff").write_text("@relation a\n@attribute x numeric\n@attribute 'full name' string\n@data\n1,'Doe, J.'\n2,\"O'Neil\"\n3,it\\'s\n4,''\n5\n")
    (tmp_path / "b.arff").write_text("% other order\n@RELATION b\n@ATTRIBUTE \"full name\" string\n@ATTRIBUTE y {'p, q',r}\n@attribute x numeric\n@DATA\n?,'p, q',6\nMy,r,\n")
    rows = readers.read_arff(spark, str(tmp_path))
    assert rows.columns == ["x", "full name", "y"]
    want = [("1", "Doe, J.", None), ("2", "O'Neil", None), ("3", "it's", None), ("4", "", None), ("5", None, None), ("6", None, "p, q"), ("", "My", "r")]
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(want, key=repr)


def test_arff(spark, tmp_path):
    (tmp_path / "t.arff").write_text("% note\n@RELATION r\n@ATTRIBUTE x NUMERIC\n@attribute 'class' {Abnormal,Normal}\n@DATA\n1.5,'Abnormal'\n?,Normal\n")
    rows = readers.read_arff(spark, str(tmp_path / "t.arff")).collect()
    assert [(r.x, r["class"]) for r in rows] == [("1.5", "Abnormal"), (None, "Normal")]


def test_intents_document(spark, tmp_path):
    doc = {"intents": [{"tag": "hola_mundo", "description": "d", "patterns": ["a", "b", "c", "d"], "responses": ["r"]},
                       {"tag": "saludo", "description": "", "patterns": ["x"], "responses": []}]}
    (tmp_path / "i.json").write_text(json.dumps(doc))
    intents = readers.read_intents(spark, str(tmp_path / "i.json"))
    faq = textmodels.faq_rows(intents).collect()
    assert [(r.category, r.example_questions) for r in faq] == [("Hola Mundo", ["a", "b", "c"])]
    raw = spark.read.schema(readers.INTENTS_SCHEMA).option("multiLine", True).json(str(tmp_path / "i.json"))
    assert textmodels.explode_intents(raw).count() == 5


def test_append_new_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    for _ in range(2):
        writers.append_new(df, str(tmp_path / "t"), ["k"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_batches_repeat_without_duplicates(spark, tmp_path):
    for _ in range(2):
        writers.write_batch_once(spark.range(5), str(tmp_path / "t"), 3)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


ITEM = """<article class="product_pod"><p class="star-rating {}"></p><h3><a href="b" title="{}">..</a></h3>
<p class="price_color">{}</p><p class="instock availability"><i class="icon-ok"></i>
   In stock  </p></article>"""


def test_items_of_a_page(spark):
    html = "<html>" + ITEM.format("Three", "A Light in the Attic", "Â£51.77") + ITEM.format("Nine", "B", "free") + "</html>"
    df = spark.createDataFrame([(1, html), (2, "<p>no items</p>")], "page_id int, html string")
    rows = pages.extract_items(df).orderBy("titulo").collect()
    assert [(r.titulo, r.precio, r.rating, r.disponibilidad) for r in rows] == [
        ("A Light in the Attic", 51.77, 3, "In stock"), ("B", None, 0, "In stock")]


def test_next_page(spark):
    link = '<li class="next"><a href="{}">next</a></li>'
    df = spark.createDataFrame(
        [("http://s.org/cat/page-1.html", link.format("page-2.html")), ("http://s.org/cat/x", link.format("/root")),
         ("http://s.org", link.format("http://other.org/a")), ("http://s.org/cat/page-9.html", "last")], "url string, html string")
    assert [r.next_url for r in pages.next_url(df).collect()] == ["http://s.org/cat/page-2.html", "http://s.org/root", "http://other.org/a", None]


SCHEMA = "maquina_id string, ts timestamp, n long, temperatura double, vibracion double, velocidad_rpm double, consumo_kw double, presion_bar double, error_code int"


def write_readings(spark, folder, start, n):
    rows = [("MAQ-001", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), i, 70.0 + i % 5, 2.0 + i % 3, 1500.0 + i % 7, 45.0, 6.0, 0) for i in range(start, start + n)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_retraining_takes_exact_groups_across_batches(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for start, n in ((0, 30), (30, 45), (75, 10)):
        write_readings(spark, src, start, n)
        stream = jobs.file_stream(spark, src, spark.read.parquet(src).schema)
        jobs.run_retraining(stream, out, "n", 20, clustering.fit_baseline_detector)
    versions = spark.read.parquet(f"{out}/versions").orderBy("version").collect()
    assert [v.version for v in versions] == [1, 2, 3, 4]
    first = [70.0 + i % 5 for i in range(20)]
    assert json.loads(versions[0].means)[0] == pytest.approx(sum(first) / 20)
    assert jobs.load_detector(spark, out, list(clustering.fv.DETECTOR_DEFAULTS)).threshold == versions[-1].threshold
    assert spark.read.parquet(f"{out}/buffer/2").count() == 5


def test_sensor_stream_equals_batch(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    write_readings(spark, src, 0, 40)
    readings = spark.read.parquet(src)
    d = clustering.fit_baseline_detector(readings)
    jobs.run_sensor_stream(jobs.file_stream(spark, src, readings.schema), d, out)
    want = jobs.flagged(readings, d)
    assert spark.read.parquet(f"{out}/events").count() == want.select(F.explode("events")).count()
    assert spark.read.parquet(f"{out}/points").count() == 40 * 7
    assert spark.read.parquet(f"{out}/readings").filter("es_anomalia").count() == want.filter("es_anomalia").count()


def test_dialogue_state_survives_between_batches(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for turns in ([(1, 0, [2, 1]), (2, 0, [1, 1])], [(1, 1, [1, 2]), (1, 2, [1, 1])]):
        spark.createDataFrame(turns, "conv_id long, turn long, step array<int>").coalesce(1).write.mode("append").parquet(src)
        stream = jobs.dialogue_stream(jobs.file_stream(spark, src, spark.read.parquet(src).schema))
        jobs.run_to_end(stream, f"{out}/checkpoint", path=f"{out}/states")
    got = {(r.conv_id, r.turn): (r.state_before, r.state_after) for r in spark.read.parquet(f"{out}/states").collect()}
    assert got == {(1, 0): (1, 2), (2, 0): (1, 1), (1, 1): (2, 2), (1, 2): (2, 1)}


class TestUpsertStore:
    SCHEMA = "maquina_id string, ts timestamp, version int, value double"

    def batch(self, spark, rows):
        return spark.createDataFrame([(m, at(s), v, x) for m, s, v, x in rows], self.SCHEMA)

    def held(self, spark, store):
        return {(r.maquina_id, int((r.ts - at(0)).total_seconds())): (r.version, r.value) for r in store.read(spark).collect()}

    def test_last_write_wins_in_any_order(self, spark, tmp_path):
        store = UpsertStore(str(tmp_path), buckets=4, runs_per_level=2)
        draw, want = random.Random(1), {}
        for i in range(9):
            rows = [(f"m{draw.randrange(4)}", draw.randrange(6), draw.randrange(30), float(draw.randrange(100))) for _ in range(12)]
            for m, s, v, x in rows:
                want[m, s] = max(want.get((m, s), (-1, 0.0)), (v, x))
            store.write(self.batch(spark, rows), i)
            if i in (3, 8):
                store.write(self.batch(spark, rows), i)  # a repeated batch
            assert self.held(spark, store) == want
        runs = store.runs(spark)
        assert len(runs) <= 4 and sorted(b for r in runs for b in r["batches"]) == list(range(9))
        files = list(tmp_path.glob("runs/*/*/*.parquet"))
        named = {r["run"] for n in store.manifests(spark) for r in store.runs(spark, n)}
        assert {f.parent.parent.name.removeprefix("run=") for f in files} <= named and len(store.manifests(spark)) <= 3
        got = [(r.ts, r.value) for r in store.newest(spark, "m1", 3).collect()]
        assert got == [(at(s), want["m1", s][1]) for s in sorted((s for m, s in want if m == "m1"), reverse=True)[:3]]

    def test_a_killed_writer_leaves_nothing_behind(self, spark, tmp_path, monkeypatch):
        store = UpsertStore(str(tmp_path), runs_per_level=2)
        store.write(self.batch(spark, [("a", 1, 1, 1.0)]), 0)

        def killed(self, spark, runs):
            raise KeyboardInterrupt

        with monkeypatch.context() as m:
            m.setattr(UpsertStore, "_commit", killed)
            with pytest.raises(KeyboardInterrupt):
                store.write(self.batch(spark, [("a", 1, 2, 2.0)]), 1)
        assert self.held(spark, store) == {("a", 1): (1, 1.0)} and len(list(tmp_path.glob("runs/*"))) == 2
        store.write(self.batch(spark, [("a", 1, 2, 2.0)]), 1)
        assert self.held(spark, store) == {("a", 1): (2, 2.0)}
        # a merge that is killed before its manifest: the runs it read still count
        store.write(self.batch(spark, [("a", 2, 1, 3.0)]), 2)
        with monkeypatch.context() as m:
            m.setattr(UpsertStore, "merge", lambda self, spark: None)
            store.write(self.batch(spark, [("a", 3, 1, 4.0)]), 3)
        before = self.held(spark, store)
        with monkeypatch.context() as m:
            m.setattr(UpsertStore, "_commit", killed)
            with pytest.raises(KeyboardInterrupt):
                store.merge(spark)
        assert self.held(spark, store) == before == {("a", 1): (2, 2.0), ("a", 2): (1, 3.0), ("a", 3): (1, 4.0)}
        store.merge(spark)
        assert self.held(spark, store) == before
        named = {r["run"] for n in store.manifests(spark) for r in store.runs(spark, n)}
        assert {p.name.removeprefix("run=") for p in tmp_path.glob("runs/*")} == named


def run_parts(spark, src, out, schema, parts, build, name="rows"):
    """Appends each part as a file and runs the stream over it, as a stopped and restarted query would."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        jobs.run_to_end(build(jobs.file_stream(spark, src, spark.read.parquet(src).schema)), f"{out}/checkpoint", path=f"{out}/{name}")
    return spark.read.parquet(f"{out}/{name}").collect()


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def test_clear_cancels_the_open_dialogue(spark, tmp_path):
    steps = [2, 3, 1]  # each turn advances
    parts = [[(1, 0, steps, False), (1, 1, steps, False)], [(1, 3, steps, None), (1, 2, steps, True), (2, 0, steps, True)]]
    got = run_parts(spark, str(tmp_path / "src"), str(tmp_path / "out"), "conv_id long, turn long, step array<int>, clear boolean", parts,
                    lambda s: jobs.dialogue_stream(s, clear="clear"))
    assert {(r.conv_id, r.turn): (r.state_before, r.state_after) for r in got} == {(1, 0): (1, 2), (1, 1): (2, 3), (1, 2): (3, 1), (1, 3): (1, 2), (2, 0): (1, 1)}


def test_idle_sessions_expire(spark, tmp_path):
    """A turn after the gap starts anew, and the timer drops the state of sessions that do not come back."""
    schema = "conv_id string, turn long, step array<int>, clear boolean, ts timestamp"
    steps = [2, 3, 1]
    parts = [[("a", 0, steps, False, at(0)), ("b", 0, steps, False, at(5))], [("a", 1, steps, False, at(50)), ("c", 0, steps, False, at(60))],
             [("a", 2, steps, False, at(300)), ("a", 3, steps, False, at(310))], [("c", 1, steps, False, at(311)), ("d", 0, steps, False, at(900))], [("d", 1, steps, False, at(901))]]
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    left = []
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        stream = jobs.dialogue_stream(jobs.file_stream(spark, src, spark.read.parquet(src).schema), ts="ts", idle_seconds=100, watermark="0 seconds")
        q = jobs.start(stream, f"{out}/checkpoint", path=f"{out}/rows")
        q.awaitTermination()
        left.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = {(r.conv_id, r.turn): (r.state_before, r.state_after) for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {("a", 0): (1, 2), ("b", 0): (1, 2), ("a", 1): (2, 3), ("c", 0): (1, 2), ("a", 2): (1, 2), ("a", 3): (2, 3), ("c", 1): (1, 2), ("d", 0): (1, 2), ("d", 1): (2, 3)}
    assert left[1] == 3 and left[-1] == 1


def test_long_session_in_frames(spark, tmp_path, monkeypatch):
    n = 25_000
    rows = [(1, i, [2, 1]) for i in range(n)]
    random.Random(2).shuffle(rows)
    got = run_parts(spark, str(tmp_path / "src"), str(tmp_path / "out"), "conv_id long, turn long, step array<int>", [rows], jobs.dialogue_stream)
    assert len(got) == n and all(r.state_before == 1 + r.turn % 2 and r.state_after == 2 - r.turn % 2 for r in got)


def test_stream_fills_empty_windows(spark, tmp_path):
    schema = "m string, ts timestamp, value double"
    parts = [[("a", at(1), 1.0), ("b", at(2), 5.0), ("a", at(9), 2.0)], [("a", at(47), 4.0), ("a", at(44), None), ("b", at(11), 1.0)],
             [("a", at(95), 8.0), ("a", at(12), 99.0)], [("b", at(200), 7.0)]]
    got = run_parts(spark, str(tmp_path / "src"), str(tmp_path / "out"), schema, parts, lambda s: jobs.filled_windows_stream(s, 10, "m"), "windows")
    found = sorted((r.m, int((r.window_end - at(0)).total_seconds()), r.value) for r in got)
    # the point at 12 comes when its window is long closed; the last windows stay open
    assert [x for x in found if x[0] == "a"] == [("a", 10, 3.0), ("a", 20, None), ("a", 30, None), ("a", 40, None), ("a", 50, 4.0), ("a", 60, None), ("a", 70, None), ("a", 80, None), ("a", 90, None), ("a", 100, 8.0)]
    assert [x for x in found if x[0] == "b"] == [("b", 10, 5.0), ("b", 20, 1.0)] + [("b", 10 * i, None) for i in range(3, 21)]


@pytest.mark.parametrize("kind", ["baseline", "k-means"])
def test_detector_is_swapped_while_the_stream_runs(spark, tmp_path, kind):
    """Later batches are scored by the versions that earlier ones have learnt, as a batch replay is."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    names = list(clustering.fv.DETECTOR_DEFAULTS)
    first = clustering.Detector(names, [70.0, 2.0, 1500.0, 45.0, 6.0], [1.0] * 5, [[0.0] * 5], 2.0)
    cuts = [(0, 30), (30, 45), (75, 10)]
    fit = clustering.fit_baseline_detector if kind == "baseline" else clustering.fit_detector
    groups = clustering.fit_baseline_groups if kind == "baseline" else None
    for start, n in cuts:
        write_readings(spark, src, start, n)
        jobs.run_online_detection(jobs.file_stream(spark, src, spark.read.parquet(src).schema), out, "n", first, 20, fit, groups)
    rows = spark.read.parquet(src)
    got = {r.n: (r.version, r.distance, r.ml_anomaly) for r in spark.read.parquet(f"{out}/readings").collect()}
    assert {n: v for n, (v, *_) in got.items()} == {i: 0 if i < 30 else 1 if i < 75 else 3 for i in range(85)}
    versions = {0: first} | {g: fit(rows.filter((F.col("n") >= 20 * (g - 1)) & (F.col("n") < 20 * g))) for g in (1, 3)}
    for version, detector in versions.items():
        for r in clustering.score(rows, detector).collect():
            if got[r.n][0] == version:
                assert got[r.n][1] == pytest.approx(r.distance) and got[r.n][2] == r.ml_anomaly
    assert {r.version for r in spark.read.parquet(f"{out}/versions").collect()} == {1, 2, 3, 4}
    assert not (tmp_path / "out" / "buffer" / "0").exists()


def test_stems_are_worked_out_once_a_distinct_word(spark):
    rows = [(1, "conectado conectado redes"), (1, "redes"), (None, ""), (2, None), (3, "impresoras " * 40 + "sol")]
    df = spark.createDataFrame(rows, "k int, t string").select("k", F.split("t", " ").alias("tokens"), F.length("t").alias("n"))
    got = textmodels.stemmed(df)
    want = df.withColumn("tokens", text.stem(F.col("tokens")))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    # what is left to later passes is a scan
    assert "FileScan" in got._jdf.queryExecution().executedPlan().toString() and "regexp" not in got._jdf.queryExecution().executedPlan().toString()


def test_intent_model(spark, tmp_path):
    train = [("problema_wifi", "no tengo internet"), ("problema_wifi", "wifi internet caido"), ("problema_wifi", "internet no funciona wifi"),
             ("problema_impresora", "impresora atascada"), ("problema_impresora", "impresora no imprime papel"), ("problema_impresora", "la impresora falla"),
             ("saludo", "hola buenos dias"), ("saludo", "hola necesito ayuda"), ("saludo", "buenas tardes hola")]
    df = spark.createDataFrame(train, "tag string, text string").withColumn("tokens", F.split("text", " "))
    model = textmodels.train_intent(df)
    asked = spark.createDataFrame([("la impresora no funciona", "problema_impresora"), ("hola", "saludo"), ("xkcd mango fibonacci", "desconocido")], "text string, want string")
    asked = asked.withColumn("tokens", F.split("text", " "))
    assert [r.intent == r.want for r in textmodels.predict_intent(model, asked, 0.4).collect()] == [True, True, True]
    model.write().overwrite().save(str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    same = textmodels.predict_intent(again, asked, 0.4)
    assert [r.intent for r in same.collect()] == [r.want for r in same.collect()]


def test_search_draws_are_repeatable():
    a, b = (models.draw(models.FOREST_GRID, 20, 42) for _ in range(2))
    assert a == b and len(a) == 20


def test_search_compares_all_draws_and_refits_the_best(spark):
    rng = random.Random(4)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=d), float(d % 7), float(i), float(3 * (d % 7) + rng.random())) for d in range(60) for i in range(4)]
    data = models.assembled(spark.createDataFrame(rows, "day date, a double, b double, y double"), ["a", "b"], "y", keep=["day"])
    train, test = models.time_split(data, "day", "2024-02-15")
    grid = {"numTrees": [2, 4], "maxDepth": [1, 4], "minInstancesPerNode": [2], "featureSubsetStrategy": ["all"]}
    best, board = models.random_search(train, "day", grid, n_iter=10, folds=3)
    again = models.random_search(train, "day", grid, n_iter=10, folds=3, at_once=1)
    assert len(board) == 4 and (best, board) == again
    assert best["maxDepth"] == 4 and dict((p["maxDepth"], e) for p, e in board)[1] > min(e for _, e in board)
    _, scored, metrics = models.refit(best, train, test)
    assert scored.count() == test.count() and metrics.first().r2 > 0.9
    # a table of one day has no folds to learn from
    assert models.random_search(train.filter("day = DATE '2024-01-05'"), "day", grid, n_iter=1)[1][0][1] == float("inf")


def test_jobs_side_by_side(spark):
    assert side_by_side([lambda i=i: spark.range(i).count() for i in range(9)], 3) == list(range(9))
    with pytest.raises(ZeroDivisionError):
        side_by_side([lambda i=i: 1 // i for i in range(9)], 3)


def test_saved_model_gives_the_same_answers(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), (F.col("id") % 7 + F.col("id") % 3).alias("y"))
    data = models.assembled(rows, ["a", "b"], "y")
    model, scored, metrics = models.fit_and_score(models.forest_regressor(5, 4, 1), data, data)
    models.save_model(model, str(tmp_path / "m"), ["a", "b"], metrics)
    loaded, names, stored = models.load_model(spark, str(tmp_path / "m"))
    assert names == ["a", "b"] and stored.first() == metrics.first()
    assert loaded.transform(data).agg(F.sum("prediction")).first()[0] == pytest.approx(scored.agg(F.sum("prediction")).first()[0])
    assert [r.feature for r in models.importances(spark, model, names, 1).collect()] == ["a"]


@pytest.mark.parametrize("files", [0, 3])
def test_tables_of_one_file_or_a_folder_are_streamed_whole(spark, tmp_path, files):
    sf = tmp_path / "sf"
    sf.mkdir()
    rows = [(c, t, "user", "x" * (c + t)) for c in range(4) for t in range(5)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    if files:
        table.repartition(files).write.parquet(f"{sf}/conversations.parquet")
    else:
        table.toPandas().to_parquet(sf / "conversations.parquet")
    (sf / "other.parquet").write_bytes((next(sf.rglob("part-*.parquet")) if files else sf / "conversations.parquet").read_bytes())
    found = streams.st7_stream(spark, str(sf)).collect()
    want, n = [], {}
    for c, t, _, text in rows:
        n[c] = 0 if len(text) % 5 == 0 else n.get(c, 0) + 1
        want += [(c, t, n[c])] if n[c] else []
    assert sorted((r.conv_id, r.turn, r.turn_no) for r in found) == sorted(want)
    assert streams.st6_stream(spark, str(sf)).count() == streams.st7_clear(spark, str(sf)).count() == len(rows)


def test_results_are_not_written_by_one_task(spark, tmp_path):
    writers.write_results({"r": spark.range(0, 30, 1, 3).withColumn("b", F.col("id") % 2), "none": spark.range(0)}, str(tmp_path))
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 3
    back = readers.read_csv(spark, f"{tmp_path}/r", "id bigint, b bigint")
    assert sorted(map(tuple, back.collect())) == [(i, i % 2) for i in range(30)]
    assert readers.read_csv(spark, f"{tmp_path}/none", "id bigint").count() == 0


def test_parts_of_a_stream_number_the_rows_once(spark):
    def reads(parts):
        seen = spark.sparkContext.accumulator(0)
        rows = spark.sparkContext.parallelize(range(40), 2).map(lambda i: (seen.add(1), (i, i * 2))[1]).toDF("event_id long, x long")
        source = streams.in_parts(spark, rows, "event_id", parts, "parts")
        return source, seen.value

    assert reads(8)[1] == reads(2)[1]
    assert reads(4)[0].isStreaming
