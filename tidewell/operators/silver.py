"""Bronze -> silver: quarantine, typing, conversion, flags.

Exact duplicates are removed with an aggregation over all columns (map-side
partial aggregation collapses re-sent copies before the shuffle), not with a
window over all columns: a group of identical rows can be arbitrarily hot and
a window would put it in one task. Quarantined copies are re-expanded from the
multiplicity in bounded chunks spread over tasks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Contract
from ..functions import is_blank, to_bool, to_date, to_number, to_ts, ts_lit

COPIES = "_copies"
REASON = "_quarantine_reason"
EXPAND_CHUNK = 4096

# typing/transform spec per entity (what raw text becomes)
TRANSFORMS = {
    "players": {"dates": ["signup_date"], "booleans": ["self_excluded"],
                "fill": {"acquisition_channel": "unknown"}},
    "deposits": {"timestamps": ["deposit_ts"], "numbers": ["amount"],
                 "money": {"cols": ["amount"], "currency": "currency", "date": "deposit_ts"}},
    "bets": {"timestamps": ["bet_ts"], "numbers": ["stake", "payout"],
             "money": {"cols": ["stake", "payout"], "currency": "currency", "date": "bet_ts"}},
    "campaigns": {"dates": ["created_date"]},
    "campaign_touchpoints": {"timestamps": ["event_ts"]},
}


def collapse(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct rows over ``cols`` with their multiplicity (nulls equal)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(COPIES))


def expand_copies(groups: DataFrame, n_col: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Emit ``n_col`` copies of each row without materialising a huge array.

    Two-level explode: chunk ids first (a hot group gets many chunk rows, which
    are hash-spread across tasks), then at most ``chunk`` copies per chunk row.
    """
    g = groups.where(F.col(n_col) > 0)
    g = g.withColumn("_chunk", F.explode(F.sequence(F.lit(0), ((F.col(n_col) - 1) / chunk)
                                                      .cast("long"))))
    g = g.repartition("_chunk", *[c for c in groups.columns if c != n_col][:3])
    n_here = F.least(F.lit(chunk).cast("long"), F.col(n_col) - F.col("_chunk") * chunk)
    g = g.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), n_here)))
    return g.drop("_chunk", "_i", n_col)


def future_code(contract: Contract, ref: _dt.date) -> F.Column:
    """1-based position (contract order) of the first future-dated column, else null."""
    ref_ts = ts_lit(ref)
    expr = None
    for i, c in enumerate(contract.dates, start=1):
        cond = F.coalesce(to_ts(F.col(c)) > ref_ts, F.lit(False))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr if expr is not None else F.lit(None).cast("int")


def future_label(contract: Contract, code: F.Column) -> F.Column:
    """``future_dated__{col}`` for a :func:`future_code`, null for null."""
    expr = None
    for i, c in enumerate(contract.dates, start=1):
        label = F.lit(f"future_dated__{c}")
        expr = F.when(code == i, label) if expr is None else expr.when(code == i, label)
    return expr if expr is not None else F.lit(None).cast("string")


def future_reason(contract: Contract, ref: _dt.date) -> F.Column:
    """First future-dated column in contract order, else null."""
    return future_label(contract, future_code(contract, ref))


def reasons(contract: Contract) -> list[str]:
    """Every quarantine reason that :func:`split` can give."""
    return ["duplicate_row", *[f"future_dated__{c}" for c in contract.dates]]


def split(df: DataFrame, contract: Contract, ref: _dt.date,
          extra_cols: list[str] | None = None,
          groups: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine). First matching reason wins: ``duplicate_row`` for
    every copy beyond the first, then ``future_dated__{col}`` for survivors.

    ``clean`` keeps the bronze columns; ``quarantine`` adds ``_quarantine_reason``.
    Conflicting keys are never resolved here (that is a DQ ERROR). ``groups``
    may pass the precomputed ``collapse`` so DQ and the split share one shuffle.
    """
    cols = list(contract.columns) + [c for c in (extra_cols or []) if c in df.columns]
    if groups is None:
        # the reason is derived from an aggregate output, so filters on it stay above
        # the dedup and clean / duplicate / future branches share one exchange. The
        # aggregated value is an int code (fixed-width buffer: hash aggregation with
        # map-side combine; a string max would force a sort-based aggregate).
        groups = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias(COPIES),
                                        F.max(future_code(contract, ref)).alias("_future_code"))
                  .withColumn("_future", future_label(contract, F.col("_future_code")))
                  .drop("_future_code"))
    else:
        groups = groups.withColumn("_future", future_reason(contract, ref))
    survivors = groups.drop(COPIES)
    clean = survivors.where(F.col("_future").isNull()).drop("_future")
    future_q = survivors.where(F.col("_future").isNotNull()).withColumnRenamed("_future", REASON)
    dup_groups = groups.where(F.col(COPIES) > 1).select(
        *cols, (F.col(COPIES) - 1).alias("_extra"))
    dup_q = expand_copies(dup_groups, "_extra").withColumn(REASON, F.lit("duplicate_row"))
    quarantine = dup_q.unionByName(future_q.select(*cols, REASON))
    return clean, quarantine


#: Kind of a typed column -> how its text is read (D1); what cannot be read is null.
READERS = {"timestamps": to_ts, "dates": to_date, "numbers": to_number, "booleans": to_bool}


def cast(df: DataFrame, spec: dict) -> DataFrame:
    """One projection: tolerant typing (D1) and explicit fill of blanks."""
    kinds = {c: kind for kind in READERS for c in spec.get(kind, ())}
    fills = spec.get("fill", {})

    def typed(c: str):
        if c in kinds:
            return READERS[kinds[c]](c).alias(c)
        if c in fills:
            return F.when(is_blank(c), F.lit(fills[c])).otherwise(F.col(c)).alias(c)
        return F.col(c)

    return df.select(*map(typed, df.columns))


def derive_flags(entity: str, df: DataFrame) -> DataFrame:
    """is_targetable / is_confirmed (D12), null-safe like the original code."""
    if entity == "players":
        return df.withColumn(
            "is_targetable",
            ~F.coalesce(F.col("self_excluded"), F.lit(False))
            & ~F.col("kyc_status").eqNullSafe("rejected"))
    if entity == "deposits":
        return df.withColumn("is_confirmed", F.col("status").eqNullSafe("confirmed"))
    return df


def reconciliation(entity: str, bronze: DataFrame, clean: DataFrame,
                   quarantine: DataFrame) -> DataFrame:
    """read == written + quarantined (Q19), from the actual outputs."""
    tagged = (bronze.select(F.lit(0).alias("_s"))
              .unionByName(clean.select(F.lit(1).alias("_s")))
              .unionByName(quarantine.select(F.lit(2).alias("_s"))))
    j = tagged.agg(F.count_if(F.col("_s") == 0).alias("rows_in"),
                   F.count_if(F.col("_s") == 1).alias("rows_written"),
                   F.count_if(F.col("_s") == 2).alias("rows_quarantined"))
    diff = F.col("rows_in") - F.col("rows_written") - F.col("rows_quarantined")
    return j.select(F.lit(entity).alias("entity"), F.lit("reconciliation").alias("check"),
                    F.lit("").alias("column"), F.lit("ERROR").alias("severity"),
                    (diff == 0).alias("passed"), F.abs(diff).cast("bigint").alias("failed_records"),
                    F.col("rows_in").cast("bigint").alias("total_records"),
                    "rows_in", "rows_written", "rows_quarantined")
