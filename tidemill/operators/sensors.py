"""Threshold rules, machine states and time-series points of sensor readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.text import rule_code

Rule = tuple[str, str, float, str]
POINT_FIELDS = ["temperatura", "vibracion", "velocidad_rpm", "consumo_kw", "presion_bar", "error_code", "anomalia_flag"]


def _event(code: Column, field: str, value: Column, limit: float, origin: str) -> Column:
    return F.struct(
        code.alias("tipo_anomalia"), F.lit(field).alias("campo"), value.alias("valor"),
        F.lit(float(limit)).alias("umbral"), F.lit(origin).alias("origen"),
    )


def rule_events(rules: Sequence[Rule] = fv.SENSOR_RULES, missing_as_zero: bool = False) -> Column:
    """Array of the rules a reading violates (strictly). A missing value violates none, or counts as 0."""
    out = []
    for field, kind, limit, _unit in rules:
        x = F.col(field).cast("double")
        x = F.coalesce(x, F.lit(0.0)) if missing_as_zero else x
        broken = x > limit if kind == "max" else x < limit
        out.append(F.when(broken, _event(rule_code(F.lit(field), kind), field, x, limit, "umbral")))
    return F.filter(F.array(*out), lambda e: e.isNotNull())


def detect_rules(df: DataFrame, rules: Sequence[Rule] = fv.SENSOR_RULES, missing_as_zero: bool = False) -> DataFrame:
    """One row per violated rule, with the whole reading attached."""
    return df.withColumn("__e", F.explode(rule_events(rules, missing_as_zero))).select("*", "__e.*").drop("__e")


def flag(df: DataFrame, rules: Sequence[Rule] = fv.SENSOR_RULES, missing_as_zero: bool = False) -> DataFrame:
    """``events`` (the violated rules, or the model's own event if no rule fired) and ``es_anomalia``.
    Expects ``distance``, ``ml_anomaly`` and ``ml_threshold``."""
    fired = rule_events(rules, missing_as_zero)
    model = _event(F.lit("ANOMALIA_ML"), "multivariante", F.col("distance"), 0.0, "kmeans").withField("umbral", F.col("ml_threshold"))
    by_rule = F.size("__rules") > 0
    # the model may be null on unreadable rows: that is no anomaly
    by_model = F.coalesce(F.col("ml_anomaly"), F.lit(False))
    return (
        df.withColumn("__rules", fired)
        .withColumn("events", F.when(by_rule, F.col("__rules")).when(by_model, F.array(model)).otherwise(F.slice("__rules", 1, 0)))
        .withColumn("es_anomalia", by_rule | by_model)
        .withColumn("n_rules", F.size("__rules"))
        .drop("__rules")
    )


def event_id(*cols: str) -> Column:
    """A repeatable id: the same reading and rule always give the same one, so a retried write can be
    recognised."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256)


def machine_state(temperature: str = "temperatura", flagged: str = "es_anomalia", critical: float = 95.0) -> Column:
    return F.when(F.col(temperature) > critical, "critico").when(F.col(flagged), "advertencia").otherwise("normal")


def nominal_table(spark, nominal: Mapping[str, Sequence[float]] = fv.MACHINE_NOMINAL) -> DataFrame:
    cols = ["maquina_id", "nominal_temp", "nominal_vib", "nominal_rpm", "nominal_kw", "nominal_bar"]
    return spark.createDataFrame([(m, *v) for m, v in nominal.items()], cols)


def deviation_rule(df: DataFrame, nominal: DataFrame, share: float = 0.25) -> DataFrame:
    """Flags a speed more than ``share`` off the machine's nominal one, and any error code. Machines
    without a nominal value are not judged on speed."""
    joined = df.join(nominal.select("maquina_id", "nominal_rpm"), "maquina_id", "left")
    off = F.abs(F.col("velocidad_rpm") / F.col("nominal_rpm") - 1) > share
    return joined.withColumn("rpm_off", F.coalesce(off, F.lit(False))).withColumn("error_flag", F.coalesce(F.col("error_code") > 0, F.lit(False)))


def to_points(df: DataFrame) -> DataFrame:
    """Long form: one row per field, with the tags ``maquina_id`` and ``es_anomalia`` (lower-case text)."""
    wide = df.select(
        "ts", "maquina_id", F.lower(F.col("es_anomalia").cast("string")).alias("es_anomalia"),
        *[F.col(c).cast("double") for c in POINT_FIELDS[:-1]],
        F.col("es_anomalia").cast("int").cast("double").alias("anomalia_flag"),
    )
    return wide.unpivot(["ts", "maquina_id", "es_anomalia"], POINT_FIELDS, "field", "value").filter(F.col("value").isNotNull())


def window_end(ts: Column, size: str) -> Column:
    return F.window(ts, size).getField("end")


def tumbling(points: DataFrame, size: str, keys: Sequence[str] = ("maquina_id", "field"), how: str = "avg", name: str = "value") -> DataFrame:
    """Tumbling-window mean or sum per key, labelled by the end of the window; empty windows absent."""
    agg = F.avg("value") if how == "avg" else F.sum("value")
    return points.groupBy(F.window("ts", size).alias("w"), *keys).agg(agg.alias(name)).select(
        F.col("w.end").alias("window_end"), *keys, name
    )


def tumbling_filled(points: DataFrame, size: str, name: str = "value") -> DataFrame:
    """Tumbling sum over all rows with empty windows kept (their sum is null). The grid of windows follows
    from the first and last one, and is dealt out in ranges."""
    sums = points.groupBy(F.window("ts", size).alias("w")).agg(F.sum("value").alias(name)).select(
        F.col("w.end").alias("window_end"), name
    )
    micros = F.unix_micros(F.col("window_end").cast("timestamp"))
    step, first, last = sums.agg(F.max(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {size}"))), F.min(micros), F.max(micros)).first()
    if first is None:
        return sums
    grid = points.sparkSession.range(first, last + 1, step).select(F.timestamp_micros("id").cast(sums.schema["window_end"].dataType).alias("window_end"))
    return grid.join(sums, "window_end", "left")


def last_writes(df: DataFrame, version: str) -> DataFrame:
    """One row per (machine, time): the write with the highest ``version`` wins. Combines map-side."""
    rest = [c for c in df.columns if c not in ("maquina_id", "ts")]
    last = F.max_by(F.struct(*rest), F.col(version))
    return df.groupBy("maquina_id", "ts").agg(last.alias("r")).select("maquina_id", "ts", "r.*")
