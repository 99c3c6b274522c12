"""The layered lakehouse as lazy DataFrames: bronze -> fx -> silver -> gold.

``Lake`` wires the operators together for one bronze source. Every layer is a
lazily built DataFrame (memoised per instance, so queries built from the same
``Lake`` share plan fragments and Spark can reuse exchanges). Only two things
are materialised eagerly: the FX window bounds (one tiny aggregate) and the
dense FX table, written to the shared folder so that joins against it are
broadcast from a *measured* size (it is bounded by calendar days x pairs).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BRONZE_CONTRACTS, TESTDATA_REFS, References
from ..operators import dq, fx, silver as sv, star as st, taxonomy
from .. import sinks, sources
from ..session import materialise, scratch_folder
from ..sources import bindings


class Lake:
    def __init__(self, spark: SparkSession, bronze: dict[str, DataFrame], quotes: DataFrame,
                 fx_window: Callable[[], tuple[_dt.date, _dt.date]], refs: References = TESTDATA_REFS):
        self.spark = spark
        self.bronze = bronze
        self.quotes = quotes
        self._fx_window = fx_window
        self.refs = refs

    # ------------------------------------------------------------------ build
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str,
                      refs: References = TESTDATA_REFS) -> "Lake":
        lake = cls(spark, bindings.bronze(spark, sf_dir), bindings.quotes(spark, sf_dir),
                   lambda: bindings.fx_window(spark, sf_dir), refs)
        lake.resent_deposits = bindings.resent_deposits(spark, sf_dir)
        return lake

    # --------------------------------------------------------------------- fx
    @cached_property
    def fx_window(self) -> tuple[_dt.date, _dt.date]:
        """First and last day of the FX calendar; asked for by queries that need rates only."""
        return self._fx_window()

    @property
    def fx_start(self) -> _dt.date:
        return self.fx_window[0]

    @property
    def fx_end(self) -> _dt.date:
        return self.fx_window[1]

    @cached_property
    def fx_plan(self) -> DataFrame:
        return fx.build_dense(self.quotes, self.fx_start, self.fx_end, f"{self.fx_end.isoformat()}T00:00:00+00:00")

    @cached_property
    def fx(self) -> DataFrame:
        """Dense FX table, written once per lake to the shared folder."""
        return materialise(self.fx_plan, "fx_rates")

    # ----------------------------------------------------------------- silver
    @cached_property
    def distinct_rows(self) -> dict[str, DataFrame]:
        """Per entity: distinct bronze rows (+ ingest_date) with their multiplicity, written once per lake.

        The one shuffle of each bronze entity. DQ rules, key checks, FK checks and samples
        read the columns they need of it, and none binds or collapses the rows again.
        """
        return {e: materialise(sv.collapse(df, BRONZE_CONTRACTS[e].columns + ["ingest_date"]), f"distinct-{e}")
                for e, df in self.bronze.items()}

    @cached_property
    def split(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        out = {}
        for e, df in self.bronze.items():
            out[e] = sv.split(df, BRONZE_CONTRACTS[e], self.refs.quarantine[e],
                              extra_cols=["ingest_date"])
        return out

    def clean(self, entity: str) -> DataFrame:
        return self.split[entity][0]

    def quarantine(self, entity: str) -> DataFrame:
        return self.split[entity][1]

    def _typed(self, entity: str) -> DataFrame:
        spec = sv.TRANSFORMS.get(entity, {})
        cols = BRONZE_CONTRACTS[entity].columns
        typed = sv.cast(self.clean(entity).select(*cols), spec)
        money = spec.get("money")
        if money:
            typed = fx.to_brl(typed, self.fx, money["cols"], money["currency"], money["date"])
        if entity == "campaigns":
            typed = taxonomy.parse(typed, self.spark)
        return sv.derive_flags(entity, typed)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        order = {
            "players": ["player_id", "signup_date", "acquisition_channel", "country",
                        "preferred_currency", "kyc_status", "self_excluded", "is_targetable"],
            "deposits": ["deposit_id", "player_id", "deposit_ts", "amount", "currency", "status",
                         "fx_rate", "fx_rate_date", "amount_brl", "is_confirmed"],
            "bets": ["bet_id", "player_id", "bet_ts", "stake", "currency", "product", "payout",
                     "fx_rate", "fx_rate_date", "stake_brl", "payout_brl"],
            "campaigns": ["campaign_id", "campaign_name", "created_date", "status", "geo",
                          "channel", "objective", "product", "audience", "period", "offer",
                          "campaign_name_std"],
            "campaign_touchpoints": ["touchpoint_id", "player_id", "campaign_id", "channel",
                                     "event_ts", "event_type"],
        }
        return {e: self._typed(e).select(*order[e]) for e in self.bronze}

    # ------------------------------------------------------------------- gold
    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return st.build_star(self.silver, self.refs.dormancy_ref)

    # --------------------------------------------------------------------- dq
    def bronze_checks(self, group_cols: list[str] | None = ("ingest_date",)) -> DataFrame:
        """Contract battery per entity (and per load) plus referential integrity."""
        group_cols = list(group_cols or [])
        parts = []
        shared = group_cols == ["ingest_date"]
        for e, df in self.bronze.items():
            data = df.select(*BRONZE_CONTRACTS[e].columns, *group_cols)
            parts.append(dq.run_contract(data, e, BRONZE_CONTRACTS[e],
                                         self.refs.quarantine[e], group_cols, ratio=False,
                                         distinct_rows=self.distinct_rows[e] if shared else None))
        if shared:
            frames, weight = self.distinct_rows, "_copies"
        else:
            frames = {e: df.select(*BRONZE_CONTRACTS[e].columns, *group_cols)
                      for e, df in self.bronze.items()}
            weight = None
        fk = dq.run_foreign_keys(frames, BRONZE_CONTRACTS, group_cols, ratio=False,
                                 weight_col=weight)
        if fk is not None:
            parts.append(fk)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return dq.with_ratio(out)

    def samples(self) -> DataFrame:
        """The first violating values of each check per load (O3), from the shared distinct rows."""
        groups = ["ingest_date"]
        parts = [dq.violating_values(df, e, BRONZE_CONTRACTS[e], groups) for e, df in self.distinct_rows.items()]
        parts += dq.orphan_values(self.distinct_rows, BRONZE_CONTRACTS, groups)
        return dq.smallest_values(reduce(DataFrame.unionByName, parts), groups)

    @cached_property
    def history(self) -> DataFrame:
        """The DQ report as written (K4): JSON lines, one run per lake; the newest run of each load day."""
        base = scratch_folder(self.spark, "dq-report")
        rows = dq.with_details(self.dq_report(), self.samples(), ["ingest_date"])
        path = sinks.write_dq_report(rows, base, "", "lake", "")
        if path is None:
            raise RuntimeError("the DQ report could not be written")
        return sources.read_dq_history(self.spark, path)

    def dq_report(self) -> DataFrame:
        """The DQ report rows (entity x check per ingest load) with run columns."""
        r = self.bronze_checks(["ingest_date"])
        return (r.withColumn("run_id", F.concat(F.lit("run-"), F.col("ingest_date")))
                .withColumn("checked_at", F.concat(F.col("ingest_date"), F.lit("T03:00:00+00:00"))))
