"""Sinks (K1-K10): Parquet/JSON writers, quarantine, DQ report, snapshots, gated publish.

What a run writes beside its tables (quarantine, DQ report, metrics) has a folder
of its own per run id, overwritten as a whole: a repeated run replaces its rows.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import ERROR
from ..operators import dq
from ..session import stored_bytes
from . import manifest


class DataQualityError(RuntimeError):
    """Raised by the fail-fast gate (K10) when ERROR checks failed."""


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, counts: dict[str, Column] | None = None) -> dict:
    """K1: snappy Parquet, idempotent overwrite; returns rows (observed), columns and bytes written.

    ``counts`` (name -> condition) are counted by the same write, as ``counts`` of the result.
    """
    obs = Observation(f"w{abs(hash(path))}")
    extra = {f"_{k}": (name, cond) for k, (name, cond) in enumerate((counts or {}).items())}
    w = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                   *[F.count_if(cond).alias(k) for k, (_, cond) in extra.items()]).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("compression", "snappy").parquet(path)
    info = {"rows": int(obs.get.get("rows", 0)), "columns": len(df.columns),
            "bytes": stored_bytes(df.sparkSession, path) or 0, "path": path}
    if counts is not None:
        info["counts"] = {name: n for k, (name, _) in extra.items() if (n := int(obs.get.get(k, 0)))}
    return info


def write_jsonl(df: DataFrame, path: str, mode: str = "append",
                partition_by: list[str] | None = None) -> None:
    """K2: JSON lines."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_quarantine(q: DataFrame, base: str, entity: str, run_id: str, at: str,
                     reasons: list[str] | None = None) -> dict:
    """K3: one folder per (run, ingest_date, reason) with run columns added; counts of the named reasons."""
    out = (q.withColumn("_run_id", F.lit(run_id)).withColumn("_quarantined_at", F.lit(at))
           .withColumn("reason", F.col("_quarantine_reason")))
    return write_parquet(out, os.path.join(base, "quarantine", entity, f"run={run_id}"), "overwrite",
                         ["ingest_date", "reason"], {r: F.col("reason") == r for r in reasons or []})


def write_dq_report(results: DataFrame, base: str, ingest_date: str, run_id: str,
                    checked_at: str, layer: str = "silver") -> str | None:
    """K4: DQ rows as JSON lines under ``layer=/run=/ingest_date=``; failure never blocks the load."""
    path = os.path.join(base, "quality", "dq_report")
    try:
        cols = [c for c in results.columns if c != "seq"]
        out = results.select(*cols)
        if "ingest_date" not in cols:
            out = out.withColumn("ingest_date", F.lit(ingest_date))
        if "details" not in cols:
            out = dq.with_details(out, dq.no_samples(out, ["ingest_date"]), ["ingest_date"])
        for c, v in (("run_id", run_id), ("checked_at", checked_at)):  # of each load's own, where there are
            out = out if c in cols else out.withColumn(c, F.lit(v))
        write_jsonl(out, os.path.join(path, f"layer={layer}", f"run={run_id}"), "overwrite", ["ingest_date"])
        return path
    except Exception:  # noqa: BLE001 - observability must not break the load
        return None


def publish_snapshot(df: DataFrame, base: str, snapshot_date: str, run_id: str,
                     sort_by: list[str] | None = None) -> dict:
    """K5: immutable dated snapshot, then overwrite the ``current`` pointer.

    With ``sort_by`` (O2) the files, in the order of their names, hold the rows in that order: rows are dealt
    by range and sorted within each file.
    """
    snap = os.path.join(base, f"snapshot_date={snapshot_date}", f"run_id={run_id}")
    info = write_parquet(df.orderBy(*sort_by) if sort_by else df, snap, "overwrite")
    written = df.sparkSession.read.parquet(snap)
    write_parquet(written.orderBy(*sort_by) if sort_by else written, os.path.join(base, "current"), "overwrite")
    return {**info, "snapshot": snap, "current": os.path.join(base, "current")}


def write_unpublished(tables: dict[str, DataFrame], order: list[str], base: str, run_id: str) -> dict[str, dict]:
    """K6, first half: write every table once, in ``order`` (dimensions first), where no reader looks yet."""
    out, run = {}, manifest.run_folder(run_id)
    for name in order:
        info = write_parquet(tables[name], os.path.join(base, name, run), "overwrite")
        out[name] = {**info, "path": f"{name}/{run}"}
    return out


def publish_all_or_nothing(spark: SparkSession, written: dict[str, dict], base: str, run_id: str,
                           checks: DataFrame, fail_on_error: bool = True) -> dict:
    """K6, second half: one switch to all written tables, only if no ERROR check failed."""
    n_err = checks.where(~F.col("passed") & (F.col("severity") == ERROR)).count()
    if n_err and fail_on_error:
        return {"published": False, "errors": n_err}
    version = manifest.commit(spark, base, run_id, written)
    return {"published": True, "errors": n_err, "version": version, "tables": written}


def write_metrics(rows: DataFrame, base: str, layer: str, run_id: str) -> None:
    """K8: run metrics (entity, metric, value, ingest_date, ts) under ``layer=/run=``."""
    write_parquet(rows, os.path.join(base, "ops", "run_metrics", f"layer={layer}", f"run={run_id}"), "overwrite")


def summary(checks: DataFrame, limit: int = 20) -> dict:
    """K9: counts plus the first ``limit`` failed ERROR checks (bounded collect)."""
    agg = checks.agg(F.count(F.lit(1)).alias("n"),
                     F.count_if(~F.col("passed") & (F.col("severity") == ERROR)).alias("e"),
                     F.count_if(~F.col("passed") & (F.col("severity") != ERROR)).alias("w")).first()
    errs = (checks.where(~F.col("passed") & (F.col("severity") == ERROR))
            .orderBy("entity", "check", "column").limit(limit).collect())
    return {"checks_run": agg["n"], "errors": agg["e"], "warnings": agg["w"],
            "error_details": [r.asDict() for r in errs]}


def gate(summary_: dict, fail_on_error: bool = True, what: str = "load") -> None:
    """Raise when ERROR checks failed."""
    if fail_on_error and summary_.get("errors"):
        raise DataQualityError(f"data quality rejected the {what}: {summary_['errors']} ERROR check(s)")
