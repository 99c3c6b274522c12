"""Batch jobs over files: fx -> silver -> gold (the three stages, run in order).

Each job reads its inputs from paths, runs its DQ battery, writes its outputs
(gated where the original gates) and returns a summary dict. Orchestration is
a plain function call; scheduling and retries belong to whatever submits it.
"""

from __future__ import annotations

import datetime as _dt
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (BRONZE_CONTRACTS, FX_CONTRACT, GOLD_CONTRACTS, GOLD_WRITE_ORDER, References)
from ..operators import dq, fx, silver as sv, star as st, taxonomy
from ..session import materialise
from .. import sinks, sources
from . import incremental

SILVER_COLUMNS = {
    "players": ["player_id", "signup_date", "acquisition_channel", "country", "preferred_currency",
                "kyc_status", "self_excluded", "is_targetable"],
    "deposits": ["deposit_id", "player_id", "deposit_ts", "amount", "currency", "status", "fx_rate",
                 "fx_rate_date", "amount_brl", "is_confirmed"],
    "bets": ["bet_id", "player_id", "bet_ts", "stake", "currency", "product", "payout", "fx_rate",
             "fx_rate_date", "stake_brl", "payout_brl"],
    "campaigns": ["campaign_id", "campaign_name", "created_date", "status", "geo", "channel",
                  "objective", "product", "audience", "period", "offer", "campaign_name_std"],
    "campaign_touchpoints": ["touchpoint_id", "player_id", "campaign_id", "channel", "event_ts",
                             "event_type"],
}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _settled(parts: list[DataFrame], name: str) -> DataFrame:
    """All check rows of a job, evaluated once (a few hundred rows)."""
    allc = _union([c.drop("seq", "failed_ratio") for c in parts])
    return materialise(dq.with_ratio(allc), f"checks-{name}")


def _write_metrics(checks: DataFrame, sizes: dict[str, dict[str, int]], out_base: str, layer: str, run_id: str,
                   ingest_date: str | None, at: str) -> None:
    """K8: check totals of each entity, and what was read and written (a few rows an entity)."""
    rows = [(e, m, int(v)) for e, of in sizes.items() for m, v in of.items()]
    found = dq.metrics(checks, ["entity"]).select("entity", "metric", "value").unionByName(
        checks.sparkSession.createDataFrame(rows, "entity string, metric string, value bigint"))
    sinks.write_metrics(found.withColumn("ingest_date", F.lit(ingest_date).cast("string")).withColumn(
        "ts", F.substring(F.lit(at), 1, 19).try_cast("timestamp_ntz")), out_base, layer, run_id)


def _written(info: dict) -> dict[str, int]:
    return {"RowCount": info["rows"], "ColumnCount": info["columns"], "BytesWritten": info["bytes"]}


def _since(began: float) -> dict[str, int]:
    return {"ProcessingDurationMs": int((time.monotonic() - began) * 1000)}


def typed_rows(e: str, clean: DataFrame, fx_table: DataFrame) -> DataFrame:
    """Clean bronze rows of an entity as silver rows: types, conversion, taxonomy, flags."""
    spec = sv.TRANSFORMS.get(e, {})
    typed = sv.cast(clean, spec)
    if spec.get("money"):
        m = spec["money"]
        typed = fx.to_brl(typed, fx_table, m["cols"], m["currency"], m["date"])
    if e == "campaigns":
        typed = taxonomy.parse(typed, clean.sparkSession)
    return sv.derive_flags(e, typed).select(*SILVER_COLUMNS[e])


def run_silver_increment(spark: SparkSession, bronze_root: str, fx_path: str, out_base: str, refs: References,
                         run_id: str, ingest_date: str | None = None, entities: list[str] | None = None) -> dict:
    """Silver job over what landed since its last run (S4); see ``plans.incremental``."""
    fx_table = spark.read.parquet(fx_path)
    return incremental.run(spark, bronze_root, out_base, refs, run_id,
                           lambda e, clean: typed_rows(e, clean, fx_table), ingest_date, entities)


def _load_entity(spark: SparkSession, e: str, df: DataFrame, fx_table: DataFrame, refs: References,
                 ingest_date: str | None, out_base: str, run_id: str, at: str
                 ) -> tuple[dict[str, int], dict[str, int], DataFrame, DataFrame]:
    """One entity from bronze to silver; returns its metrics, quarantined rows by reason, check and distinct rows."""
    began, contract, groups = time.monotonic(), BRONZE_CONTRACTS[e], ["ingest_date"]
    rows = sources.conform(df, contract.columns)
    # distinct rows + multiplicity: the one shuffle of the entity, read by the DQ battery, the FK
    # checks and both writes; kept in the shared folder, where no lost executor takes them along
    distinct = materialise(sv.collapse(rows, contract.columns + groups), f"distinct-{e}")
    checks = [dq.run_contract(df, e, contract, refs.quarantine[e], groups, distinct_rows=distinct)]
    clean, quarantine = sv.split(rows, contract, refs.quarantine[e], extra_cols=groups, groups=distinct)
    q_info = sinks.write_quarantine(quarantine, out_base, e, run_id, at, sv.reasons(contract))
    typed = typed_rows(e, clean.select(*contract.columns), fx_table)
    money = sv.TRANSFORMS.get(e, {}).get("money")
    if money:
        checks.append(fx.missing_rate_check(typed, e, money["currency"])
                      .withColumn("ingest_date", F.lit(ingest_date)))
    w = sinks.write_parquet(typed, os.path.join(out_base, "silver", e), "overwrite")
    rows_in = int(distinct.agg(F.sum("_copies")).first()[0] or 0)
    diff = abs(rows_in - w["rows"] - q_info["rows"])
    checks.append(dq.expect(spark, e, "reconciliation", None, "ERROR", diff == 0, diff, rows_in)
                  .withColumn("ingest_date", F.lit(ingest_date)))
    found = _settled(checks, e)
    return ({"RowsIngested": rows_in, **_written(w), "RowsQuarantined": q_info["rows"], **_since(began)},
            q_info["counts"], found, distinct)


def run_fx(spark: SparkSession, quotes_path: str, out_base: str, start: _dt.date, end: _dt.date,
           run_id: str, snapshot_date: str, fail_on_error: bool = True) -> dict:
    """FX job: landed quotes -> dense table -> checks -> snapshot + current."""
    began, fetched_at = time.monotonic(), f"{snapshot_date}T00:00:00+00:00"
    degraded = False
    current = os.path.join(out_base, "reference", "fx_rates", "current")
    try:
        quotes, digest = sources.landed_quotes(spark, quotes_path)
        dense = fx.build_dense(quotes.drop("payload_sha256"), start, end, fetched_at)
        published = quotes.select("pub_date").where(
            F.col("pub_date").between(F.lit(start), F.lit(end))).distinct().count()
    except sources.SourceUnavailable:  # degraded mode; any other error is one of the code
        dense = sources.read_previous_fx(spark, current, start.isoformat(), end.isoformat())
        if dense is None:
            raise
        degraded, digest, published = True, [], 0
    checks = _settled([dq.run_contract(dense, "fx_rates", FX_CONTRACT),
                       fx.coverage_check(dense, start, end),
                       fx.jump_check(dense).drop("worst_jump")], "fx")
    summ = sinks.summary(checks, 10)
    info = None
    if not (summ["errors"] and fail_on_error):
        info = sinks.publish_snapshot(dense, os.path.join(out_base, "reference", "fx_rates"),
                                      snapshot_date, run_id, ["rate_date", "from_currency"])
    sinks.write_dq_report(checks, out_base, snapshot_date, run_id, fetched_at, "reference")
    sizes = {"fx_rates": {**(_written(info) if info else {}), "DegradedMode": int(degraded), **_since(began)}}
    _write_metrics(checks, sizes, out_base, "reference", run_id, snapshot_date, fetched_at)
    out = {"run_id": run_id, "published_days": published, "degraded_mode": degraded,
           "payload_sha256": digest, "output": info, "dq": summ}
    sinks.gate(summ, fail_on_error, "fx table")
    return out


def run_silver(spark: SparkSession, bronze_root: str, fx_path: str, out_base: str,
               refs: References, ingest_date: str | None, run_id: str,
               entities: list[str] | None = None, fail_on_error: bool = True) -> dict:
    """Silver job: bronze CSV -> DQ -> quarantine -> typed, converted Parquet.

    An entity whose read, transform or write fails is recorded; the others are loaded.
    """
    fx_table = spark.read.parquet(fx_path)
    frames, failures = sources.read_entities(spark, bronze_root, ingest_date, entities)
    at = f"{ingest_date or 'all'}T00:00:00+00:00"
    checks, distinct, results, sizes = [], {}, {}, {}
    for e, df in frames.items():
        try:
            sizes[e], reasons, found, distinct[e] = _load_entity(spark, e, df, fx_table, refs, ingest_date, out_base,
                                                                 run_id, at)
        except Exception as exc:  # noqa: BLE001 - one entity must not stop the others
            failures.append({"entity": e, "error": f"{type(exc).__name__}: {exc}"})
            continue
        checks.append(found)
        results[e] = {"rows_ingested": sizes[e]["RowsIngested"], "rows_written": sizes[e]["RowCount"],
                      "rows_quarantined": sizes[e]["RowsQuarantined"], "quarantine": reasons, "columns": sizes[e]["ColumnCount"],
                      "bytes_written": sizes[e]["BytesWritten"]}
    if not checks:
        raise RuntimeError(f"no entity was loaded: {failures}")
    fk = dq.run_foreign_keys(distinct, BRONZE_CONTRACTS, ["ingest_date"], weight_col="_copies")
    values = [dq.violating_values(d, e, BRONZE_CONTRACTS[e], ["ingest_date"]) for e, d in distinct.items()]
    values += dq.orphan_values(distinct, BRONZE_CONTRACTS, ["ingest_date"])
    shown = dq.smallest_values(_union(values), ["ingest_date"])
    allc = materialise(dq.with_details(_settled(checks + ([fk] if fk is not None else []), "silver"), shown,
                                       ["ingest_date"]), "report-silver")
    summ = sinks.summary(allc)
    sinks.write_dq_report(allc, out_base, ingest_date or "all", run_id, at)
    _write_metrics(allc, sizes, out_base, "silver", run_id, ingest_date, at)
    out = {"run_id": run_id, "results": results, "failures": failures, "dq": summ}
    if failures:
        raise RuntimeError(f"{len(failures)} entity(ies) failed: {failures}")
    sinks.gate(summ, fail_on_error, "silver load")
    return out


def run_gold(spark: SparkSession, silver_base: str, out_base: str, refs: References, run_id: str,
             fail_on_error: bool = True) -> dict:
    """Gold job: silver -> star -> contracts + FKs + invariants -> all-or-nothing publish."""
    silver = {e: spark.read.parquet(os.path.join(silver_base, "silver", e)) for e in BRONZE_CONTRACTS}
    began, day = time.monotonic(), refs.dormancy_ref.isoformat()
    gold = os.path.join(out_base, "gold")
    # written once, where no reader looks yet: the checks read what a commit publishes
    written = sinks.write_unpublished(st.build_star(silver, refs.dormancy_ref), GOLD_WRITE_ORDER, gold, run_id)
    star = {name: spark.read.parquet(os.path.join(gold, info["path"])) for name, info in written.items()}
    checks = [dq.run_contract(star[n], n, GOLD_CONTRACTS[n], refs.dormancy_ref) for n in GOLD_WRITE_ORDER]
    fk = dq.run_foreign_keys(star, GOLD_CONTRACTS)
    if fk is not None:
        checks.append(fk)
    checks.append(st.invariants(star, silver))
    allc = _settled(checks, "gold")
    summ = sinks.summary(allc)
    pub = sinks.publish_all_or_nothing(spark, written, gold, run_id, allc, fail_on_error)
    at = f"{day}T00:00:00+00:00"
    sinks.write_dq_report(allc, out_base, day, run_id, at, "gold")
    sizes = {name: _written(info) for name, info in pub.get("tables", {}).items()}
    _write_metrics(allc, sizes | {"star": _since(began)}, out_base, "gold", run_id, day, at)
    out = {"run_id": run_id, "published": pub, "dq": summ}
    sinks.gate(summ, fail_on_error, "star")
    return out


def land_testdata(spark: SparkSession, sf_dir: str, root: str) -> dict:
    """Write the bound test tables as a bronze landing zone (CSV by ingest_date) and
    the quote payloads as JSON files, so the file-based jobs can run end to end."""
    from ..sources import bindings

    for e, df in bindings.bronze(spark, sf_dir).items():
        df.write.mode("overwrite").partitionBy("ingest_date").option("header", True) \
            .csv(os.path.join(root, "bronze", e))
    start, end = bindings.fx_window(spark, sf_dir)
    q = bindings.quotes(spark, sf_dir)
    # one payload per year, like ranged API responses landed as files
    per_year = (q.groupBy(F.year("pub_date").alias("y"), F.date_format("pub_date", "yyyy-MM-dd").alias("d"))
                .agg(F.map_from_entries(F.collect_list(F.struct("currency", "per_base"))).alias("m"))
                .groupBy("y").agg(F.map_from_entries(F.collect_list(F.struct("d", "m"))).alias("rates")))
    qdir = os.path.join(root, "landing", "quotes")
    per_year.select("y", F.to_json(F.struct("rates")).alias("value")) \
        .write.mode("overwrite").partitionBy("y").text(qdir)
    return {"start": start, "end": end, "bronze": os.path.join(root, "bronze"), "quotes": qdir}
