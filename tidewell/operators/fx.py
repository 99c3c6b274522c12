"""FX reference: sparse quotes -> dense daily table -> BRL conversion.

Carry-forward never interpolates and never looks ahead. Instead of a
calendar-wide window, each quote is expanded over the days until the next
quote of the same currency (``lead`` + ``sequence``), so the work is one small
window per currency over publication days only, and the source date of every
filled day is kept per currency (and per pair: the older of its two inputs).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (ERROR, FX_BASE, FX_JUMP_LIMIT, FX_LOOKBACK_DAYS, FX_QUOTES,
                      FX_RATE_SOURCE, FX_ROUND, FX_TARGET, WARN)
from ..functions import iso_day, round_half_even_2


def densify_quotes(quotes: DataFrame, start: _dt.date, end: _dt.date,
                   lookback_days: int = FX_LOOKBACK_DAYS) -> DataFrame:
    """(pub_date, currency, per_base) -> one row per calendar day and currency.

    The fill runs over [start - lookback, end] and is trimmed to [start, end]
    afterwards, so a window that opens on a weekend or holiday still has a
    source. Null and zero quotes count as not published; of several quotes of a
    day and currency (overlapping payloads) the highest counts.
    """
    fetch_start = start - _dt.timedelta(days=lookback_days)
    q = (quotes.where(F.col("per_base").isNotNull() & (F.col("per_base") != 0)
                      & ~F.isnan("per_base"))
         .select(F.col("pub_date").cast("date").alias("pub_date"), "currency", "per_base")
         .where(F.col("pub_date").between(F.lit(fetch_start), F.lit(end)))
         .groupBy("pub_date", "currency").agg(F.max("per_base").alias("per_base")))
    nxt = F.lead("pub_date").over(Window.partitionBy("currency").orderBy("pub_date"))
    q = q.withColumn("until", F.coalesce(F.date_sub(nxt, 1), F.lit(end)))
    dense = q.select("currency", "per_base", F.col("pub_date").alias("source_date"),
                     F.explode(F.sequence("pub_date", "until")).alias("day"))
    return dense.where(F.col("day").between(F.lit(start), F.lit(end)))


def build_dense(quotes: DataFrame, start: _dt.date, end: _dt.date, fetched_at: str = "",
                lookback_days: int = FX_LOOKBACK_DAYS) -> DataFrame:
    """Dense daily X->BRL table (D3-D6) in the published column order."""
    daily = densify_quotes(quotes, start, end, lookback_days)
    tgt = daily.where(F.col("currency") == FX_TARGET).select(
        "day", F.col("per_base").alias("tgt_per_base"), F.col("source_date").alias("tgt_src"))
    # the base currency is 1 per base on every day, sourced like the target
    base_rows = tgt.select("day", F.lit(FX_BASE).alias("currency"),
                           F.lit(1.0).alias("per_base"), F.col("tgt_src").alias("source_date"))
    quoted = [c for c in FX_QUOTES if c != FX_BASE]
    others = daily.where(F.col("currency").isin(quoted))
    if FX_BASE in FX_QUOTES:
        others = others.unionByName(base_rows)
    cross = others.join(tgt, "day").select(
        "day", F.col("currency").alias("from_currency"),
        F.round(F.col("tgt_per_base") / F.col("per_base"), FX_ROUND).alias("rate"),
        F.least("source_date", "tgt_src").alias("src"))
    identity = tgt.select("day", F.lit(FX_TARGET).alias("from_currency"),
                          F.lit(1.0).alias("rate"), F.col("day").alias("src"))
    out = cross.unionByName(identity)
    return out.select(
        iso_day("day").alias("rate_date"), "from_currency",
        F.lit(FX_TARGET).alias("to_currency"), "rate",
        iso_day("src").alias("source_rate_date"),
        (F.col("src") != F.col("day")).alias("is_carried_forward"),
        F.lit(FX_RATE_SOURCE).alias("rate_source"),
        F.lit(fetched_at).alias("fetched_at"))


def load_fx(fx: DataFrame) -> DataFrame:
    """Join-side slice of the dense table (D8): to=BRL, unique per (day, from)."""
    return (fx.where(F.col("to_currency") == FX_TARGET)
            .select("rate_date", "from_currency", "rate", "source_rate_date")
            .dropDuplicates(["rate_date", "from_currency"]))


def to_brl(df: DataFrame, fx: DataFrame, amount_cols: list[str], currency_col: str,
           ts_col: str) -> DataFrame:
    """Convert amounts with the rate of the transaction's own day.

    Left equi-join on (ISO day, currency): row preserving. The rate table is
    bounded by calendar days x currencies; when it comes from a written table
    the planner broadcasts it from its measured size, otherwise it shuffles.
    """
    rates = load_fx(fx).select(F.col("rate_date").alias("_rd"), F.col("from_currency").alias("_fc"),
                               F.col("rate").alias("fx_rate"),
                               F.col("source_rate_date").alias("fx_rate_date"))
    d = df.withColumn("_jd", iso_day(F.col(ts_col)))
    j = d.join(rates, (F.col("_jd") == F.col("_rd")) & (F.col(currency_col) == F.col("_fc")), "left")
    for c in amount_cols:
        j = j.withColumn(f"{c}_brl", round_half_even_2(F.col(c) * F.col("fx_rate")))
    return j.drop("_jd", "_rd", "_fc")


# ------------------------------------------------------------------ FX checks
def coverage_check(fx: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """calendar_coverage (Q21): every day x pair present."""
    expected = ((end - start).days + 1) * (len(FX_QUOTES) + 1)
    missing = F.lit(expected) - F.col("n")
    return fx.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("fx_rates").alias("entity"), F.lit("calendar_coverage").alias("check"),
        F.lit("rate_date").alias("column"), F.lit(ERROR).alias("severity"),
        (missing == 0).alias("passed"), F.abs(missing).cast("bigint").alias("failed_records"),
        F.lit(expected).cast("bigint").alias("total_records"))


def jump_check(fx: DataFrame) -> DataFrame:
    """daily_jump (Q22): |day-over-day change| > 10 % per quoted currency."""
    w = Window.partitionBy("from_currency").orderBy("rate_date")
    pct = F.when(F.col("from_currency").isin(FX_QUOTES),
                 F.abs(F.col("rate") / F.lag("rate").over(w) - 1))
    a = fx.select(pct.alias("pct")).agg(
        F.count_if(F.col("pct") > FX_JUMP_LIMIT).alias("bad"),
        F.coalesce(F.max("pct"), F.lit(0.0)).alias("worst"),
        F.count(F.lit(1)).alias("total"))
    return a.select(F.lit("fx_rates").alias("entity"), F.lit("daily_jump").alias("check"),
                    F.lit("rate").alias("column"), F.lit(WARN).alias("severity"),
                    (F.col("bad") == 0).alias("passed"), F.col("bad").cast("bigint").alias("failed_records"),
                    F.col("total").cast("bigint").alias("total_records"),
                    F.round("worst", 6).alias("worst_jump"))


def missing_rate_check(df: DataFrame, entity: str, currency_col: str) -> DataFrame:
    """fx_rate_coverage (Q20): no converted row may lack a rate."""
    a = df.agg(F.count_if(F.col("fx_rate").isNull()).alias("m"), F.count(F.lit(1)).alias("n"))
    return a.select(F.lit(entity).alias("entity"), F.lit("fx_rate_coverage").alias("check"),
                    F.lit(currency_col).alias("column"), F.lit(ERROR).alias("severity"),
                    (F.col("m") == 0).alias("passed"), F.col("m").cast("bigint").alias("failed_records"),
                    F.col("n").cast("bigint").alias("total_records"))
