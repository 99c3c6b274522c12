"""Gold marts (D23-D30): player 360, value tiers, offers, taxonomy, dormancy curves.

Shapes follow the original views; the plans are written for scale:
aggregate facts by player *before* joining (no fan-out), top-1 per player as a
partial aggregate (``min_by``/``max_by``) instead of a per-player window, global
quartiles from three selected cut keys, and windows only where their
partitions are bounded (activity days per player <= calendar days).
Ties the views leave undefined get deterministic tie-breaks (player_id,
product, touchpoint_id).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (DEFAULT_OFFER, DEFAULT_PRODUCT, DEFAULT_TIER, DORMANCY_DAYS,
                      TARGET_DAYS, TARGET_TIERS, TIER_LABELS, UNKNOWN)
from ..functions import cents, day_bucket, ts_lit, whole_days, with_half_up
from ..operators import ranking
from ..session import materialise


def _dec(c: str) -> F.Column:
    return F.col(c).cast("decimal(38,2)")


def _money(c: F.Column) -> F.Column:
    return F.round(c, 2).cast("double")


def player_base(star: dict[str, DataFrame], ref: _dt.date) -> DataFrame:
    """Per-player facts: LTV, activity, primary product, dormancy (``dorm``)."""
    dep = (star["fact_deposit"].where(F.col("is_confirmed"))
           .groupBy("player_id")
           .agg(F.sum(_dec("amount_brl")).alias("ltv_dec"),
                F.count(F.lit(1)).alias("deposit_count"),
                F.max("deposit_ts").alias("last_deposit")))
    # one pass over bets: (player, product) partials feed both totals and the top product
    pp = (star["fact_bet"].groupBy("player_id", "product")
          .agg(F.sum(_dec("stake_brl")).alias("stake"), F.sum(_dec("net_brl")).alias("net"),
               F.count(F.lit(1)).alias("n"), F.max("bet_ts").alias("last")))
    bet = (pp.groupBy("player_id")
           .agg(F.sum("stake").alias("stake_dec"), F.sum("net").alias("net_dec"),
                F.sum("n").alias("bet_count"), F.max("last").alias("last_bet"),
                F.min_by("product", F.struct(-F.col("stake"), F.col("product")))
                .alias("primary_product")))
    pl = star["dim_player"].select("player_id", "country", "acquisition_channel", "kyc_status",
                                   "self_excluded", "is_targetable")
    base = pl.join(dep, "player_id", "left").join(bet, "player_id", "left")
    last = F.greatest("last_deposit", "last_bet")  # null-skipping, = coalesce chain
    days = whole_days(last, ts_lit(ref))
    return base.select(
        "player_id", "country", "acquisition_channel", "kyc_status", "self_excluded",
        "is_targetable",
        F.coalesce("primary_product", F.lit(DEFAULT_PRODUCT)).alias("primary_product"),
        F.coalesce("deposit_count", F.lit(0)).cast("bigint").alias("deposit_count"),
        F.coalesce("bet_count", F.lit(0)).cast("bigint").alias("bet_count"),
        _money(F.coalesce("ltv_dec", F.lit(0))).alias("ltv_brl"),
        _money(F.coalesce("stake_dec", F.lit(0))).alias("total_stake_brl"),
        _money(F.coalesce("net_dec", F.lit(0))).alias("net_brl"),
        days.alias("days_inactive"),
        (days > DORMANCY_DAYS).alias("is_dormant"),
    )


def stored_base(star: dict[str, DataFrame], ref: _dt.date) -> DataFrame:
    """``player_base`` as a table of the shared folder: one row per player, read in several passes."""
    return materialise(player_base(star, ref), "player-base")


def _ranked() -> F.Column:
    """Players that get a value tier."""
    return F.col("is_dormant") & (F.col("ltv_brl") > 0) & F.col("is_targetable")


def _tier(dorm: DataFrame) -> F.Column:
    """Quartile (W3) of a ranked player of the stored table, from three cut keys."""
    cuts = ranking.cut_keys(dorm.where(_ranked()), len(TIER_LABELS), "ltv_brl", "player_id")
    return ranking.tile(cuts, "ltv_brl", "player_id")


def _label(t: F.Column) -> F.Column:
    label = F.lit(DEFAULT_TIER)
    for k in sorted(TIER_LABELS, reverse=True):
        label = F.when(t == k, TIER_LABELS[k]).otherwise(label)
    return label


def value_tiers(dorm: DataFrame) -> DataFrame:
    """Quartiles of LTV over dormant, valuable, targetable players (W3); ``dorm`` is a stored table."""
    t = _tier(dorm)
    return dorm.where(_ranked()).select("player_id", t.alias("t"), _label(t).alias("value_tier"))


def player_360(star: dict[str, DataFrame], ref: _dt.date, dorm: DataFrame | None = None) -> DataFrame:
    """vw_player_360 (D23); ``dorm`` may pass the stored player base."""
    dorm = dorm if dorm is not None else stored_base(star, ref)
    tier = F.when(_ranked(), _label(_tier(dorm))).otherwise(F.lit(DEFAULT_TIER))
    return dorm.select(
        "player_id", "country", "acquisition_channel", "primary_product", "kyc_status",
        "self_excluded", "is_dormant", "days_inactive", tier.alias("value_tier"),
        "deposit_count", "bet_count", "ltv_brl", "total_stake_brl", "net_brl")


def _actionable() -> F.Column:
    return (F.col("is_dormant") & (F.col("ltv_brl") > 0) & ~F.col("self_excluded")
            & (F.col("kyc_status") != "rejected"))


def value_segments(p360: DataFrame) -> DataFrame:
    """vw_segmentos_valor (D24): tier summary with share of targeted LTV."""
    g = (p360.where(_actionable()).groupBy("value_tier")
         .agg(F.count(F.lit(1)).alias("jogadores"),
              F.min("ltv_brl").alias("mn"), F.sum(_dec("ltv_brl")).alias("sm"),
              F.sum("deposit_count").alias("dep")))
    g = g.withColumn("tot", F.sum("sm").over(Window.partitionBy()))  # <= 5 aggregated rows
    g = with_half_up(g, "ltv_medio_brl", cents("sm"), F.col("jogadores"), 2, 2)
    g = with_half_up(g, "pct_do_ltv_alvo", cents("sm") * 100, cents("tot"), 1)
    g = with_half_up(g, "depositos_medio", F.col("dep"), F.col("jogadores"), 1)
    return g.select(
        "value_tier", "jogadores", F.round("mn", 2).alias("ltv_min_brl"), "ltv_medio_brl",
        _money(F.col("sm")).alias("ltv_total_brl"), "pct_do_ltv_alvo", "depositos_medio")


def last_offer(star: dict[str, DataFrame], touch_ref: _dt.date) -> DataFrame:
    """Offer of each player's latest touchpoint strictly before the cut."""
    t = star["fact_touchpoint"].where(F.col("event_ts") < ts_lit(touch_ref)) \
        .select("player_id", "campaign_id", "event_ts", "touchpoint_id")
    # Each player's last touch per campaign first: a hot campaign is joined once per player.
    t = t.groupBy("player_id", "campaign_id").agg(
        F.max(F.struct("event_ts", "touchpoint_id")).alias("at"))
    c = star["dim_campaign"].select("campaign_id", "offer")
    return t.join(c, "campaign_id").groupBy("player_id").agg(F.max_by("offer", "at").alias("offer"))


def ltv_channel_offer_product(p360: DataFrame, offers: DataFrame) -> DataFrame:
    """vw_ltv_canal_oferta_produto."""
    j = p360.join(offers, "player_id", "left") \
        .withColumn("offer", F.coalesce("offer", F.lit(DEFAULT_OFFER)))
    g = j.groupBy("acquisition_channel", "offer", "primary_product").agg(
        F.count(F.lit(1)).alias("jogadores"),
        F.sum(F.when(F.col("is_dormant"), 1).otherwise(0)).cast("bigint").alias("dormentes"),
        F.sum(F.when(_actionable(), 1).otherwise(0)).cast("bigint").alias("acionaveis"),
        F.sum(_dec("ltv_brl")).alias("sm"))
    g = with_half_up(g, "ltv_medio_brl", cents("sm"), F.col("jogadores"), 2, 2)
    return g.select("acquisition_channel", "offer", "primary_product", "jogadores", "dormentes",
                    "acionaveis", _money(F.col("sm")).alias("ltv_total_brl"), "ltv_medio_brl")


def _resolved(cols: list[str]) -> F.Column:
    return (F.lit(7) - F.size(F.filter(F.array(*[F.col(c) for c in cols]),
                                      lambda x: x == UNKNOWN))).cast("int")


def taxonomy_conformance(star: dict[str, DataFrame]) -> DataFrame:
    """vw_conformidade_taxonomia (D26): touchpoints counted per campaign first."""
    per = star["fact_touchpoint"].where(F.col("touchpoint_id").isNotNull()) \
        .groupBy("campaign_id").agg(F.count(F.lit(1)).alias("n"))
    seg = ["geo", "channel_declarado", "objective", "product", "audience", "period", "offer"]
    keys = ["campaign_id", "campaign_name", "campaign_name_std", "is_taxonomy_compliant"] + seg
    j = star["dim_campaign"].select(*keys).join(per, "campaign_id", "left")
    g = j.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("touchpoints_afetados"))
    return g.select("campaign_id", "campaign_name", "campaign_name_std", "is_taxonomy_compliant",
                    _resolved(seg).alias("segmentos_resolvidos"), "touchpoints_afetados")


def activity_days(star: dict[str, DataFrame]) -> DataFrame:
    """Distinct (player, day) with a confirmed deposit or a bet."""
    d = star["fact_deposit"].where(F.col("is_confirmed")) \
        .select("player_id", F.col("deposit_ts").cast("date").alias("d"))
    b = star["fact_bet"].select("player_id", F.col("bet_ts").cast("date").alias("d"))
    return d.unionByName(b).distinct()


def _gaps(days: DataFrame) -> DataFrame:
    w = Window.partitionBy("player_id").orderBy("d")  # partition size <= calendar days
    return days.select("player_id", "d", F.datediff("d", F.lag("d").over(w)).cast("bigint").alias("gap"))


def dormancy_gaps(star: dict[str, DataFrame]) -> DataFrame:
    """vw_dormencia_gaps."""
    g = _gaps(activity_days(star)).where(F.col("gap").isNotNull())
    agg = g.groupBy(day_bucket("gap").alias("faixa_dias")).agg(
        F.count(F.lit(1)).alias("intervalos"), F.max("gap").alias("maior_gap_da_faixa"))
    agg = agg.withColumn("tot", F.sum("intervalos").over(Window.partitionBy()))      # <= 8 rows
    agg = agg.withColumn("run", F.sum("intervalos").over(Window.orderBy("faixa_dias")))  # <= 8 rows
    agg = with_half_up(agg, "pct", F.col("intervalos") * 100, F.col("tot"), 2)
    agg = with_half_up(agg, "pct_acumulado", F.col("run") * 100, F.col("tot"), 2)
    return agg.select("faixa_dias", "intervalos", "pct", "pct_acumulado", "maior_gap_da_faixa")


def dormancy_return(star: dict[str, DataFrame], ref: _dt.date) -> DataFrame:
    """vw_dormencia_retorno (D28): observed pauses (returned) + open pauses (censored)."""
    days = activity_days(star)
    observed = _gaps(days).select(F.col("gap").alias("dias_parado"), F.lit(1).alias("voltou"))
    open_ = days.groupBy("player_id").agg(F.max("d").alias("last")).select(
        F.datediff(F.lit(ref), F.col("last")).cast("bigint").alias("dias_parado"),
        F.lit(0).alias("voltou"))
    p = observed.unionByName(open_).where(F.col("dias_parado").isNotNull())
    g = p.groupBy(day_bucket("dias_parado").alias("faixa_dias")).agg(
        F.count(F.lit(1)).alias("pausas"), F.sum("voltou").cast("bigint").alias("voltaram"))
    g = with_half_up(g, "taxa_retorno_pct", F.col("voltaram") * 100, F.col("pausas"), 1)
    return g.select("faixa_dias", "pausas", "voltaram", "taxa_retorno_pct")


def primary_product(star: dict[str, DataFrame]) -> DataFrame:
    """Top product by stake per player (W1) on its own."""
    pp = star["fact_bet"].groupBy("player_id", "product").agg(F.sum(_dec("stake_brl")).alias("stake"))
    return pp.groupBy("player_id").agg(
        F.min_by("product", F.struct(-F.col("stake"), F.col("product"))).alias("primary_product"))


def best_offer(p360: DataFrame, offers: DataFrame) -> DataFrame:
    """Offer with the highest mean LTV of its actionable players (top-1 is the feature).

    Means are compared in whole millionths of a cent; ties go to the first name.
    """
    named = offers.where(~F.col("offer").isin(DEFAULT_OFFER, UNKNOWN))
    per = (p360.where(_actionable()).select("player_id", "ltv_brl").join(named, "player_id")
           .groupBy("offer").agg(cents(F.sum(_dec("ltv_brl"))).alias("c"), F.count(F.lit(1)).alias("n")))
    return per.orderBy(F.expr("(c * 1000000) div n").desc(), F.col("offer")).limit(1).select("offer")


def target_list(p360: DataFrame, offers: DataFrame) -> DataFrame:
    """Actionable Q4/Q3 players inactive 31-84 days, with the best offer."""
    lo, hi = TARGET_DAYS
    best = best_offer(p360, offers).scalar()
    t = p360.where(_actionable() & F.col("value_tier").isin(TARGET_TIERS)
                   & F.col("days_inactive").between(lo, hi))
    return t.select("player_id", "value_tier", "days_inactive", "ltv_brl", "acquisition_channel",
                    F.coalesce(best, F.lit(DEFAULT_OFFER)).alias("recommended_offer"))
