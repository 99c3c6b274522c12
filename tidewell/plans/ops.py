"""DQ report and operations queries (Q31a-c, A23, O5, K8 metrics rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ERROR, WARN
from ..functions import with_half_up
from ..operators import dq

DQ_COLS = ["ingest_date", "entity", "check", "column", "severity", "passed",
           "failed_records", "total_records", "failed_ratio"]

#: The metric columns of the per-entity operations table; a DQ report holds the second list.
ENTITY_METRICS = ["RowsIngested", "RowCount", "RowsQuarantined", "ChecksTotal", "DuplicateKeys", "BlankValues",
                  "FormatViolations", "OutOfRangeNumerics", "FutureDatedRecords", "ProcessingDurationMs"]
REPORT_METRICS = ["ChecksTotal", "DuplicateKeys", "BlankValues", "FormatViolations", "OutOfRangeNumerics",
                  "FutureDatedRecords"]


def run_verdict(report: DataFrame) -> DataFrame:
    """Checks run, ERROR and WARN failures per run."""
    return report.groupBy("ingest_date", "run_id").agg(
        F.count(F.lit(1)).alias("checks_rodados"),
        F.count_if(~F.col("passed") & (F.col("severity") == ERROR)).alias("reprovou_error"),
        F.count_if(~F.col("passed") & (F.col("severity") == WARN)).alias("reprovou_warn")) \
        .orderBy(F.col("ingest_date").desc(), "run_id")


def trend(report: DataFrame) -> DataFrame:
    """Affected checks with their percentage, per load."""
    r = report.where(F.col("failed_records") > 0)
    r = with_half_up(r, "pct", F.col("failed_records") * 100, F.col("total_records"), 2)
    return r.select("ingest_date", "entity", "column", "check", "failed_records", "pct") \
        .orderBy("entity", "column", "ingest_date", "check")


def verdict_changes(report: DataFrame) -> DataFrame:
    """Checks whose verdict flipped since the previous load.

    The window is per (entity, column, check): one row per load, so each
    partition is bounded by the number of loads.
    """
    w = Window.partitionBy("entity", "column", "check").orderBy("ingest_date", "run_id")
    h = report.select("entity", "column", "check", "ingest_date", "passed", "failed_records",
                      F.lag("passed").over(w).alias("passed_anterior"),
                      F.lag("failed_records").over(w).alias("registros_anterior"))
    return (h.where(F.col("passed_anterior").isNotNull() & (F.col("passed") != F.col("passed_anterior")))
            .orderBy(F.col("ingest_date").desc(), "entity", "column", "check"))


def run_metrics(report: DataFrame, layer: str = "silver") -> DataFrame:
    """K8 re-aimed: metric rows (layer, entity, metric, value, ts) from check results."""
    m = dq.metrics(report, ["ingest_date", "entity", "checked_at"])
    return m.select(F.lit(layer).alias("layer"), "entity", "metric", "value", "ingest_date",
                    F.substring("checked_at", 1, 19).cast("timestamp_ntz").alias("ts"))


def dq_alarm(report: DataFrame, layer: str = "silver") -> DataFrame:
    """A23 re-aimed: hours in which ERROR checks failed, per layer."""
    m = run_metrics(report, layer).where(F.col("metric") == "ChecksFailedError")
    g = m.groupBy(F.window("ts", "1 hour").start.alias("window_start"), "layer") \
        .agg(F.sum("value").cast("bigint").alias("checks_failed_error"))
    return g.where(F.col("checks_failed_error") > 0)


def latest_checks(report: DataFrame, k: int = 30) -> DataFrame:
    """O5 re-aimed: the latest affected checks (top-k is the feature)."""
    return (dq.measured(report)
            .orderBy(F.col("checked_at").desc(), F.col("failed_records").desc(),
                     "entity", "check", "column")
            .limit(k).select("checked_at", *DQ_COLS))


def entity_rows(metrics: DataFrame, names: list[str] = ENTITY_METRICS, k: int = 30) -> DataFrame:
    """O5 re-aimed: the latest runs, one wide row per entity and load (top-k is the feature).

    A metric that a run did not record is null.
    """
    wide = metrics.groupBy("ts", "ingest_date", "entity").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in names])
    return wide.orderBy(F.col("ts").desc(), F.col("ingest_date").desc(), "entity").limit(k)


def latest_metrics(report: DataFrame, k: int = 30) -> DataFrame:
    """``entity_rows`` of a DQ report, which knows the check metrics only."""
    return entity_rows(run_metrics(report), REPORT_METRICS, k)


def degraded_alarm(metrics: DataFrame) -> DataFrame:
    """A23 re-aimed: hours in which a layer ran on its previous snapshot."""
    g = metrics.where(F.col("metric") == "DegradedMode").groupBy(
        F.window("ts", "1 hour").start.alias("window_start"), "layer").agg(F.max("value").alias("degraded_mode"))
    return g.where(F.col("degraded_mode") > 0)


#: The alarms (metric, statistic, layers); each breaches above 0 in an hour, a missing hour does not.
ALARMS = [("ChecksFailedError", "Sum", ["silver", "gold"]), ("DegradedMode", "Maximum", ["reference"])]


def alarms(metrics: DataFrame) -> DataFrame:
    """Every hour in which an alarm changes its state, from written run metrics.

    The hours of a layer run without a gap from its first metric to one hour after its last (bounded by the
    calendar); an hour without the metric is "not breaching". The first hour always shows.
    """
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    per = metrics.select("layer", hour.alias("window_start"), "metric", "value")
    rules = metrics.sparkSession.createDataFrame(
        [(m, stat, layer) for m, stat, layers in ALARMS for layer in layers], "metric string, statistic string, layer string")
    axis = per.groupBy("layer").agg(F.min("window_start").alias("a"), F.max("window_start").alias("b")).join(
        F.broadcast(rules), "layer").select("layer", "metric", "statistic", F.explode(F.expr(
            "sequence(a, b + INTERVAL 1 HOUR, INTERVAL 1 HOUR)")).alias("window_start"))
    seen = per.groupBy("layer", "metric", "window_start").agg(F.sum("value").alias("s"), F.max("value").alias("m"))
    key = ["layer", "metric", "window_start"]
    value = F.when(F.col("statistic") == "Sum", F.col("s")).otherwise(F.col("m"))
    state = F.when(F.coalesce(value, F.lit(0)) > 0, "ALARM").otherwise("OK")
    hours = axis.join(seen, key, "left").select(*key, "statistic", value.cast("bigint").alias("value"), state.alias("state"))
    before = F.lag("state").over(Window.partitionBy("layer", "metric").orderBy("window_start"))
    return hours.withColumn("_b", before).where(~F.col("_b").eqNullSafe(F.col("state"))).drop("_b")


def check_metrics(checks: DataFrame, layer: str, at: str) -> DataFrame:
    """Metric rows (layer, metric, value, ts) of a job's checks, all of one instant."""
    return dq.metrics(checks).select(F.lit(layer).alias("layer"), "metric", "value",
                                     F.lit(at).cast("timestamp_ntz").alias("ts"))
