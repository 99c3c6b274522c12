"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query builds its plan from the given tables through the lazy ``Lake``;
column names and types match ``tidewell.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BRONZE_CONTRACTS, FX_CONTRACT
from ..operators import dq, fx, silver as sv, star
from ..session import materialise, state_of
from ..sources import bindings, table_path
from . import incremental, marts, ops, silver_queries as sq
from .lake import Lake

DQ_COLS = ["ingest_date", "entity", "check", "column", "severity", "passed",
           "failed_records", "total_records", "failed_ratio"]


_LAKES: dict[tuple[str, str], tuple[tuple, Lake]] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake over ``sf_dir``; built anew when the application or the files below it are others."""
    key = (spark.sparkContext.applicationId, sf_dir)
    state = tuple(state_of(spark, table_path(spark, sf_dir, t)) for t in bindings.TABLES)
    if key not in _LAKES or _LAKES[key][0] != state:
        _LAKES[key] = state, Lake.from_testdata(spark, sf_dir)
    return _LAKES[key][1]


def _p360(lk: Lake) -> DataFrame:
    return marts.player_360(lk.star, lk.refs.dormancy_ref)


def _quarantine_reasons(lk: Lake) -> DataFrame:
    parts = [lk.quarantine(e).groupBy("ingest_date", F.col(sv.REASON).alias("reason"))
             .agg(F.count(F.lit(1)).alias("rows")).withColumn("entity", F.lit(e))
             for e in lk.bronze]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("entity", "ingest_date", "reason", "rows")


def _reconciliation(lk: Lake) -> DataFrame:
    parts = [sv.reconciliation(e, lk.bronze[e], lk.clean(e), lk.quarantine(e)) for e in lk.bronze]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("entity", "check", "passed", "failed_records", "rows_in", "rows_written",
                      "rows_quarantined")


def _tax_parse(lk: Lake) -> DataFrame:
    return lk.silver["campaigns"].select(
        "campaign_name", "geo", "channel", "objective", "product", "audience", "period", "offer",
        "campaign_name_std").distinct()


def _star_invariants(lk: Lake) -> DataFrame:
    return star.invariants(lk.star, lk.silver).select(
        "entity", "check", "column", "passed", "failed_records", "total_records")


#: Load days before this one count as loaded earlier in the incremental queries.
LOADED_BEFORE = "1996-01-01"


def _second_load(lk: Lake) -> tuple[DataFrame, DataFrame]:
    """Deposits of the later load days, and those sent again, against what the earlier days have written."""
    contract, ref = BRONZE_CONTRACTS["deposits"], lk.refs.quarantine["deposits"]
    sent = lk.bronze["deposits"].unionByName(lk.resent_deposits)
    day = F.col("ingest_date")
    first, _ = incremental.split_new(sent.where(day < LOADED_BEFORE), contract, ref)
    return incremental.split_new(sent.where(day >= LOADED_BEFORE), contract, ref, first)


def _value_tiers(lk: Lake) -> DataFrame:
    return marts.value_tiers(marts.stored_base(lk.star, lk.refs.dormancy_ref))


def _dq(lk: Lake) -> DataFrame:
    return lk.dq_report()


REGISTRY: dict[str, Callable[[Lake], DataFrame]] = {
    # fx
    "fx_dense": lambda lk: lk.fx,
    "fx_calendar_coverage": lambda lk: fx.coverage_check(lk.fx, lk.fx_start, lk.fx_end),
    "fx_daily_jump": lambda lk: fx.jump_check(lk.fx),
    # silver
    "silver_players": lambda lk: lk.silver["players"],
    "silver_deposits": lambda lk: lk.silver["deposits"],
    "silver_bets": lambda lk: lk.silver["bets"],
    "silver_campaigns": lambda lk: lk.silver["campaigns"],
    "silver_touchpoints": lambda lk: lk.silver["campaign_touchpoints"],
    "quarantine_reasons": _quarantine_reasons,
    "reconciliation": _reconciliation,
    "tax_parse": _tax_parse,
    # star
    "dim_date": lambda lk: lk.star["dim_date"],
    "dim_player": lambda lk: lk.star["dim_player"],
    "dim_campaign": lambda lk: lk.star["dim_campaign"],
    "fact_deposit": lambda lk: lk.star["fact_deposit"],
    "fact_bet": lambda lk: lk.star["fact_bet"],
    "fact_touchpoint": lambda lk: lk.star["fact_touchpoint"],
    "star_invariants": _star_invariants,
    # marts
    "player_360": _p360,
    "value_tiers": _value_tiers,
    "primary_product": lambda lk: marts.primary_product(lk.star),
    "value_segments": lambda lk: marts.value_segments(_p360(lk)),
    "last_offer": lambda lk: marts.last_offer(lk.star, lk.refs.touch_ref),
    "ltv_channel_offer_product": lambda lk: marts.ltv_channel_offer_product(
        _p360(lk), marts.last_offer(lk.star, lk.refs.touch_ref)),
    "taxonomy_conformance": lambda lk: marts.taxonomy_conformance(lk.star),
    "dormancy_gaps": lambda lk: marts.dormancy_gaps(lk.star),
    "dormancy_return": lambda lk: marts.dormancy_return(lk.star, lk.refs.dormancy_ref),
    "target_list": lambda lk: marts.target_list(
        _p360(lk), marts.last_offer(lk.star, lk.refs.touch_ref)),
    # silver queries
    "volume_sanity": lambda lk: sq.volume_sanity(lk.silver),
    "rows_without_rate": lambda lk: sq.rows_without_rate(lk.silver),
    "deposits_by_currency": lambda lk: sq.deposits_by_currency(lk.silver),
    "ltv_by_channel": lambda lk: sq.ltv_by_channel(lk.silver),
    "product_result": lambda lk: sq.product_result(lk.silver),
    "compliance_counts": lambda lk: sq.compliance_counts(lk.silver),
    "silver_conformance": lambda lk: sq.silver_conformance(lk.silver),
    "channel_offer_fanout": lambda lk: sq.channel_offer_fanout(lk.silver),
    # dq
    "dq_bronze_checks": lambda lk: _dq(lk).select(*DQ_COLS),
    "dq_errors": lambda lk: dq.errors(lk.history).select(*DQ_COLS),
    "dq_warnings": lambda lk: dq.warnings(lk.history).select(*DQ_COLS),
    "dq_measured": lambda lk: dq.measured(lk.history).select(*DQ_COLS, "dq_check", "dq_violation"),
    "dq_metrics": lambda lk: dq.metrics(lk.history, ["ingest_date", "entity"]),
    "dq_run_verdict": lambda lk: ops.run_verdict(lk.history),
    "dq_trend": lambda lk: ops.trend(lk.history),
    "dq_verdict_changes": lambda lk: ops.verdict_changes(lk.history),
    # ops
    "ops_dq_alarm": lambda lk: ops.dq_alarm(lk.history),
    "ops_latest_checks": lambda lk: ops.latest_checks(lk.history),
}


def _dq_check(check: str) -> Callable[[Lake], DataFrame]:
    return lambda lk: lk.history.where(F.col("check") == check).select(*DQ_COLS)


def _gold_checks(lk: Lake) -> DataFrame:
    from ..config import GOLD_CONTRACTS

    ref = lk.refs.dormancy_ref
    # the star is written once; every check reads the tables, as the gold job's do. The calendar
    # spans the written facts, row for row their silver tables, which are not deduplicated again.
    stored = {n: materialise(t, f"star-{n}") for n, t in lk.star.items() if n != "dim_date"}
    spanned = {s: stored[n] if n.startswith("fact_") else lk.silver[s] for n, (s, _) in star.STAR.items()}
    stored["dim_date"] = materialise(star.dim_date(spanned, ref), "star-dim_date")
    tagged = {n: t.withColumn("ingest_date", F.lit(ref.isoformat())) for n, t in stored.items()}
    parts = [dq.run_contract(tagged[n], n, c, ref, ["ingest_date"], ratio=False)
             for n, c in GOLD_CONTRACTS.items()]
    fk = dq.run_foreign_keys(tagged, GOLD_CONTRACTS, ["ingest_date"], ratio=False)
    out = parts[0]
    for p in parts[1:] + [fk]:
        out = out.unionByName(p)
    return dq.with_ratio(out).select(*DQ_COLS)


def _fx_checks(lk: Lake) -> DataFrame:
    """FX contract battery on the dense table (blanks, domains, rate positive and
    within the floor/ceiling band, one row per day and pair), tagged with the
    run's end day. The dense table is bounded by days x pairs."""
    tagged = lk.fx.withColumn("ingest_date", F.lit(lk.fx_end.isoformat()))
    out = dq.run_contract(tagged, "fx_rates", FX_CONTRACT, None, ["ingest_date"], ratio=False)
    return dq.with_ratio(out).select(*DQ_COLS)


def _tax_stage(lk: Lake, stage: str) -> DataFrame:
    from ..operators import taxonomy as tx

    names = lk.clean("campaigns").select("campaign_name").where(F.col("campaign_name").isNotNull()) \
        .distinct()
    vocab = tx.vocabulary(lk.spark)
    exact = tx.exact_hits(names, vocab)
    if stage == "exact":
        return exact.select("campaign_name", "segment", "term")
    return tx.fuzzy_hits(names, vocab, solved=exact).select("campaign_name", "segment", "term")


def _tax_tokens(lk: Lake) -> DataFrame:
    from ..operators import taxonomy as tx

    names = lk.clean("campaigns").select("campaign_name").where(F.col("campaign_name").isNotNull()) \
        .distinct()
    t = tx.tokens()
    return names.select("campaign_name", F.array_join(t, "|").alias("tokens"),
                        F.size(t).cast("int").alias("n_tokens"))


def _quarantine_rows(entity: str) -> Callable[[Lake], DataFrame]:
    return lambda lk: lk.quarantine(entity).select(
        *BRONZE_CONTRACTS[entity].columns, "ingest_date", sv.REASON)


def _fx_carried(lk: Lake) -> DataFrame:
    return lk.fx.groupBy("from_currency").agg(
        F.count_if("is_carried_forward").alias("carried"), F.count(F.lit(1)).alias("days"))


def _alarms(lk: Lake) -> DataFrame:
    """All layers' metrics: each load's checks, the star's and the rates', and the days whose USD is carried forward."""
    cols = ["layer", "metric", "value", "ts"]
    degraded = lk.fx.where("from_currency = 'USD'").select(
        F.lit("reference").alias("layer"), F.lit("DegradedMode").alias("metric"),
        F.col("is_carried_forward").cast("bigint").alias("value"), F.col("rate_date").cast("timestamp_ntz").alias("ts"))
    gold = ops.check_metrics(_gold_checks(lk), "gold", f"{lk.refs.dormancy_ref.isoformat()} 04:00:00")
    return ops.alarms(ops.run_metrics(lk.history).select(*cols).unionByName(gold).unionByName(degraded))


def _fx_rate_coverage(lk: Lake) -> DataFrame:
    return fx.missing_rate_check(lk.silver["deposits"], "deposits", "currency").unionByName(
        fx.missing_rate_check(lk.silver["bets"], "bets", "currency"))


EXTRA: dict[str, Callable[[Lake], DataFrame]] = {
    "incremental_loads": lambda lk: incremental.outcomes(*_second_load(lk)),
    "incremental_resent": lambda lk: _second_load(lk)[1].where(F.col(sv.REASON) == incremental.RESENT).select(
        *BRONZE_CONTRACTS["deposits"].columns, "ingest_date", sv.REASON),
    "fx_cross_rate": lambda lk: lk.fx.where(F.col("from_currency") != "BRL"),
    "fx_identity": lambda lk: lk.fx.where(F.col("from_currency") == "BRL"),
    "fx_carried_forward": _fx_carried,
    **{f"dq_{c}": _dq_check(c) for c in (
        "schema_contract", "row_count_not_zero", "row_count_drift", "primary_key_conflict",
        "primary_key_unique", "duplicate_event", "not_blank", "accepted_values",
        "timestamp_parseable", "not_future_dated", "numeric_parseable", "numeric_range",
        "value_ceiling", "id_pattern", "no_surrounding_whitespace", "referential_integrity")},
    "dq_details": lambda lk: lk.history.where("failed_records > 0").select(
        "ingest_date", "entity", "check", "column", "details"),
    "ops_alarms": _alarms,
    "fx_rate_coverage": _fx_rate_coverage,
    "dq_gold_checks": _gold_checks,
    "dq_fx_checks": _fx_checks,
    "dq_value_floor": lambda lk: _fx_checks(lk).where(F.col("check") == "value_floor"),
    "tax_tokens": _tax_tokens,
    "tax_exact": lambda lk: _tax_stage(lk, "exact"),
    "tax_fuzzy": lambda lk: _tax_stage(lk, "fuzzy"),
    "quarantine_bets": _quarantine_rows("bets"),
    "quarantine_deposits": _quarantine_rows("deposits"),
    "ops_run_metrics": lambda lk: ops.run_metrics(lk.history),
    "ops_latest_metrics": lambda lk: ops.latest_metrics(lk.history),
}
REGISTRY.update(EXTRA)


NO_ORACLE: set[str] = set()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name, fn in REGISTRY.items():
        def run(spark, sf_dir, fn=fn):
            return fn(lake(spark, sf_dir))
        run.__name__ = name
        out[name] = run
    return out
