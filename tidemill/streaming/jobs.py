"""Structured Streaming jobs: sensor pipeline, windows, retraining, de-duplication, dialogue state."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemill.operators import sensors
from tidemill.operators.clustering import Detector, fit_detector, score
from tidemill.operators.ordered import row_numbers
from tidemill.session import side_by_side
from tidemill.sources.upserts import UpsertStore
from tidemill.sources.writers import path_exists, remove_path, write_batch_once


def file_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 64) -> DataFrame:
    """Parquet files as a stream, a bounded number of files per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None, path: str | None = None,
          mode: str = "append", available_now: bool = True) -> StreamingQuery:
    """Starts a checkpointed query into a batch function or a parquet folder."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.foreachBatch(each).start() if each else writer.format("parquet").start(path)


def run_to_end(stream: DataFrame, checkpoint: str, each=None, path: str | None = None, mode: str = "append") -> None:
    start(stream, checkpoint, each, path, mode).awaitTermination()


# ---- sensor pipeline ------------------------------------------------------------------------

def flagged(readings: DataFrame, detector: Detector) -> DataFrame:
    """Readings with rule events, model distance and combined flag; stateless column expressions."""
    return sensors.flag(score(readings, detector).withColumn("ml_threshold", F.lit(detector.threshold)))


def store_flagged(rows: DataFrame, keep: Sequence[str], out: str, batch_id: int) -> None:
    """Fans flagged readings out to three stores: readings, anomaly events, time-series points. Every write
    owns a folder per batch, so a repeated batch replaces its own output."""
    write_batch_once(rows.select(*keep, "es_anomalia", "n_rules", "ml_anomaly"), f"{out}/readings", batch_id)
    events = rows.select(*keep, F.explode("events").alias("e")).select(*keep, "e.*")
    events = events.withColumn("id", sensors.event_id("maquina_id", "ts", "tipo_anomalia"))
    write_batch_once(events, f"{out}/events", batch_id)
    write_batch_once(sensors.to_points(rows), f"{out}/points", batch_id)


def run_sensor_stream(stream: DataFrame, detector: Detector, out: str) -> None:
    """Scores each micro-batch with one detector and stores it; the batch is cached for its three writes."""
    keep = list(stream.columns)

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = flagged(batch, detector).persist()
        try:
            store_flagged(rows, keep, out, batch_id)
        finally:
            rows.unpersist()

    run_to_end(stream, f"{out}/checkpoint", each)


def run_online_detection(stream: DataFrame, out: str, order: str, first: Detector, n: int = 500, fit: Callable[[DataFrame], Detector] = fit_detector,
                         fit_groups: Callable[[DataFrame, str], dict[int, Detector]] | None = None) -> None:
    """Scores a stream with a detector that is swapped while it runs.

    Each micro-batch is scored by the newest version that earlier batches have stored (``first``, version 0,
    before there is one), then its readings join the buffer, and every n of them give the next version. A
    repeated batch finds the same versions, since only those of earlier batches count. The output tells the
    ``version`` of each reading.
    """
    learner = Retraining(out, order, n, fit, fit_groups)
    keep = [*stream.columns, "version", "distance"]

    def each(batch: DataFrame, batch_id: int) -> None:
        detector, version = first, 0
        row = learner.newest(batch.sparkSession, batch_id)
        if row is not None:
            detector, version = as_detector(row, first.features), row.version
        rows = flagged(batch, detector).withColumn("version", F.lit(version)).persist()
        try:
            store_flagged(rows, keep, out, batch_id)
        finally:
            rows.unpersist()
        learner.learn(batch, batch_id)

    run_to_end(stream, f"{out}/checkpoint", each)


def running_counters(readings: DataFrame) -> DataFrame:
    """Totals so far: readings, rule events, readings that the model alone flagged."""
    return readings.agg(
        F.count("*").alias("total"), F.sum("n_rules").cast("bigint").alias("by_rule"), F.count_if(F.col("ml_anomaly") & (F.col("n_rules") == 0)).alias("by_model")
    )


# ---- windows --------------------------------------------------------------------------------

def watermarked(stream: DataFrame, ts: str, watermark: str) -> DataFrame:
    """Watermarks need an instant; times without a zone are read in the session's zone (UTC)."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)


def tumbling_stream(points: DataFrame, size: str, keys: Sequence[str], how: str = "avg", watermark: str = "10 minutes") -> DataFrame:
    return sensors.tumbling(watermarked(points, "ts", watermark), size, keys, how)


def dedupe_stream(stream: DataFrame, keys: Sequence[str], watermark: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Repeated readings are dropped; state is kept for the watermark only."""
    return watermarked(stream, ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def filled_windows_stream(points: DataFrame, size_seconds: int, key: str | None = None, watermark: str = "0 seconds", ts: str = "ts") -> DataFrame:
    """Tumbling sums (key, window_end, value) of closed windows, with the empty ones between them (null sum).

    A key's state is its last window passed on, and the sums of the windows still open. A timer fires when the
    watermark passes the end of the next window; then every closed window goes out in order, empty ones
    included. What is still open at the end of the stream stays open. Points that come after their window was
    passed on are too late and dropped.
    """
    size = 1000 * size_seconds
    by = F.col(key) if key else F.lit(0)
    kind = dict(points.dtypes)[key] if key else "int"
    rows = watermarked(points, ts, watermark).select(by.alias("key"), ts, (F.floor(F.unix_millis(ts) / size) + 1).alias("slot"), F.col("value").cast("double").alias("value"))

    def close(key_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, slots, sums = state.get if state.exists else (None, [], [])
        held = dict(zip(slots, sums))
        if not state.hasTimedOut:
            for pdf in frames:
                for slot, value in pdf.groupby("slot")["value"].sum(min_count=1).items():
                    if last is None or slot > last:
                        old = held.get(slot)
                        held[slot] = old if pd.isna(value) else float(value) + (old or 0.0)
        now = state.getCurrentWatermarkMs() // size  # the last slot that is closed
        if held:
            last = min(held) - 1 if last is None else last
            # empty windows go out if a later one is known to hold something
            upto = min(now, max(held))
            while last < upto:
                # one piece at a time: a long gap is never listed as a whole
                piece = list(range(last + 1, min(last + SESSION_ROWS, upto) + 1))
                yield pd.DataFrame({"key": key_[0], "slot": piece, "value": pd.array([held.pop(s, None) for s in piece], dtype="Float64")})
                last = piece[-1]
        left = sorted(held)
        state.update((last, left, [held[s] for s in left]))
        if left:
            state.setTimeoutTimestamp(max((last + 1) * size, state.getCurrentWatermarkMs() + 1))

    sums = rows.groupBy("key").applyInPandasWithState(
        close, f"key {kind}, slot bigint, value double", "last bigint, slots array<bigint>, sums array<double>", "append", GroupStateTimeout.EventTimeTimeout
    )
    end = F.timestamp_millis(F.col("slot") * size).alias("window_end")
    return sums.select(*[F.col("key").alias(key)] if key else [], end, "value")


# ---- upsert by key and time -----------------------------------------------------------------

def upsert_readings(stream: DataFrame, out: str, version: str) -> None:
    """Wide-row store: per (machine, time) the newest write wins (see :class:`UpsertStore`)."""
    store = UpsertStore(out, version="write_no")
    run_to_end(stream.withColumn("write_no", F.col(version)), f"{out}/checkpoint", store.write)


def stored_readings(spark: SparkSession, out: str) -> DataFrame:
    return UpsertStore(out, version="write_no").read(spark).drop("write_no")


# ---- retraining -----------------------------------------------------------------------------

def retrain_groups(readings: DataFrame, order: str, n: int, grain) -> DataFrame:
    """Numbers the readings in order and deals them into groups of exactly n (``generation`` from 1)."""
    numbered = row_numbers(readings, [], [F.col(order)], grain, "no")
    return numbered.withColumn("generation", (F.floor((F.col("no") - 1) / n) + 1).cast("int"))


class Retraining:
    """A buffer of readings, and a parameter table with a version for every n of them.

    Each version is fitted on exactly the n oldest readings not learnt from yet. The table is a few numbers a
    version; buffers hold fewer than n readings, and the one before the last is removed.
    """

    def __init__(self, out: str, order: str, n: int, fit: Callable[[DataFrame], Detector],
                 fit_groups: Callable[[DataFrame, str], dict[int, Detector]] | None = None):
        self.out, self.order, self.n, self.fit, self.fit_groups = out, order, n, fit, fit_groups

    def newest(self, spark: SparkSession, before: int | None = None):
        """The row of the newest version, of those that batches before the given one have stored."""
        path = f"{self.out}/versions"
        if not path_exists(spark, path):
            return None
        rows = spark.read.parquet(path)
        rows = rows if before is None else rows.filter(F.col("batch_id") < before)
        return rows.orderBy(F.desc("version")).first()

    def learn(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carried = f"{self.out}/buffer/{batch_id - 1}"
        rows = batch
        if path_exists(spark, carried):
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(carried))
        grouped = retrain_groups(rows, self.order, self.n, F.floor(F.col(self.order).cast("double") / 65536)).persist()
        try:
            full = grouped.count() // self.n
            last = self.newest(spark, batch_id)
            known = last.version if last else 0
            made = []
            for g, d in sorted(self._fitted(grouped.filter(F.col("generation") <= full).drop("no"), full).items()):
                made.append((known + g, self.n, json.dumps(d.means), json.dumps(d.stds), json.dumps(d.centers), d.threshold))
            if made:
                schema = "version int, trained_on int, means string, stds string, centers string, threshold double"
                write_batch_once(spark.createDataFrame(made, schema), f"{self.out}/versions", batch_id)
            rest = grouped.filter(F.col("generation") > full).select(*batch.columns)
            rest.write.mode("overwrite").parquet(f"{self.out}/buffer/{batch_id}")
        finally:
            grouped.unpersist()
        remove_path(spark, f"{self.out}/buffer/{batch_id - 2}")

    def _fitted(self, groups: DataFrame, full: int) -> dict[int, Detector]:
        if not full:
            return {}
        if self.fit_groups:
            return self.fit_groups(groups, "generation")
        parts = [groups.filter(F.col("generation") == g).drop("generation") for g in range(1, full + 1)]
        return dict(enumerate(side_by_side([partial(self.fit, part) for part in parts]), 1))


def run_retraining(stream: DataFrame, out: str, order: str, n: int = 500, fit: Callable[[DataFrame], Detector] = fit_detector,
                   fit_groups: Callable[[DataFrame, str], dict[int, Detector]] | None = None) -> None:
    """Only learns from the stream: see :class:`Retraining`."""
    run_to_end(stream, f"{out}/checkpoint", Retraining(out, order, n, fit, fit_groups).learn)


def as_detector(row, features: Sequence[str]) -> Detector:
    return Detector(list(features), json.loads(row.means), json.loads(row.stds), json.loads(row.centers), row.threshold)


def load_detector(spark: SparkSession, out: str, features: Sequence[str]) -> Detector | None:
    """The newest stored version."""
    row = Retraining(out, "", 0, fit_detector).newest(spark)
    return as_detector(row, features) if row else None


# ---- dialogue and session state -------------------------------------------------------------

#: Rows that a session passes on at once.
SESSION_ROWS = 10_000


def _session_turns(turns: DataFrame, session: str, order: str, steps: Column, clear: Column, ts: str | None, idle_seconds: int, watermark: str) -> DataFrame:
    """(session, order, state_before, state_after, turn_no) of every turn, with the state of a session kept
    across micro-batches: state number, turns since the last clear, time of the last turn.

    A turn with ``clear`` set ends the open dialogue and the history and is not counted itself. With ``ts``,
    a turn more than ``idle_seconds`` after the one before it starts a new session, and a timer drops the
    state of a session once the watermark has passed that time. Turns of a micro-batch are held as plain
    numbers (a few bytes per turn and state of the machine) and put in order by ``order``.
    """
    kinds = dict(turns.dtypes)
    schema = f"`{session}` {kinds[session]}, `{order}` {kinds[order]}, state_before int, state_after int, turn_no bigint"
    at = F.unix_millis(F.col(ts).cast("timestamp")) if ts else F.lit(0)
    source = watermarked(turns, ts, watermark) if ts else turns
    rows = source.select(session, order, steps.alias("__steps"), F.coalesce(clear, F.lit(False)).alias("__clear"), at.alias("__at"), *[ts] if ts else [])

    def advance(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        current, n, last = state.get if state.exists else (1, 0, None)
        parts = [(f[order].to_numpy(), np.stack(f["__steps"].to_numpy()).astype(np.int16), f["__clear"].to_numpy(bool), f["__at"].to_numpy()) for f in frames if len(f)]
        orders, steps_, clears, times = (np.concatenate(p) for p in zip(*parts))
        places = np.argsort(orders, kind="stable")
        for begin in range(0, len(places), SESSION_ROWS):
            out = []
            for i in places[begin : begin + SESSION_ROWS]:
                if ts and last is not None and times[i] - last > 1000 * idle_seconds:
                    current, n = 1, 0
                before = current
                current, n = (1, 0) if clears[i] else (int(steps_[i][current - 1]), n + 1)
                last = int(times[i])
                out.append((before, current, n))
            before, after, numbers = zip(*out)
            yield pd.DataFrame({session: key[0], order: orders[places[begin : begin + SESSION_ROWS]], "state_before": before, "state_after": after, "turn_no": numbers})
        state.update((current, n, last))
        if ts:
            # a watermark that has passed already would be an error; the timer then fires with the next batch
            state.setTimeoutTimestamp(max(last + 1000 * idle_seconds, state.getCurrentWatermarkMs()) + 1)

    timer = GroupStateTimeout.EventTimeTimeout if ts else GroupStateTimeout.NoTimeout
    return rows.groupBy(session).applyInPandasWithState(advance, schema, "current int, n bigint, last bigint", "append", timer)


def dialogue_stream(turns: DataFrame, steps: str = "step", session: str = "conv_id", order: str = "turn", clear: str | None = None,
                    ts: str | None = None, idle_seconds: int = 1800, watermark: str = "10 minutes") -> DataFrame:
    """State per session across micro-batches: (session, turn, state number before and after).

    ``steps`` holds, per turn, the next state for every state (see ``dialogue.Machine``), so the Python
    part only looks up one number per turn. ``clear`` names a flag that cancels the open dialogue. With a time
    ``ts``, sessions expire: see :func:`_session_turns`.
    """
    cleared = F.col(clear) if clear else F.lit(False)
    return _session_turns(turns, session, order, F.col(steps), cleared, ts, idle_seconds, watermark).drop("turn_no")


def history_stream(turns: DataFrame, session: str = "conv_id", order: str = "turn", clear: str = "clear", ts: str | None = None,
                   idle_seconds: int = 1800, watermark: str = "10 minutes") -> DataFrame:
    """Turn counter per session across micro-batches; a turn with ``clear`` set starts over and is not
    counted itself. With a time ``ts``, sessions expire."""
    rows = _session_turns(turns, session, order, F.array(F.lit(1)), F.col(clear), ts, idle_seconds, watermark)
    return rows.filter("turn_no > 0").select(session, order, "turn_no")
