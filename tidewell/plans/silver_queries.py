"""Analytical queries over silver (D29a-h)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import UNKNOWN
from ..functions import cents, with_half_up


def _dec(c: str) -> F.Column:
    return F.col(c).cast("decimal(38,2)")


def _money(c: F.Column) -> F.Column:
    return F.round(c, 2).cast("double")


def volume_sanity(s: dict[str, DataFrame]) -> DataFrame:
    """Row count per silver table (one job: tagged union, one aggregate)."""
    names = [("players", "players"), ("deposits", "deposits"), ("bets", "bets"),
             ("campaigns", "campaigns"), ("touchpoints", "campaign_touchpoints")]
    u = None
    for label, key in names:
        part = s[key].select(F.lit(label).alias("entidade"))
        u = part if u is None else u.unionByName(part)
    return u.groupBy("entidade").agg(F.count(F.lit(1)).alias("linhas")).orderBy("entidade")


def rows_without_rate(s: dict[str, DataFrame]) -> DataFrame:
    """Rows with no FX rate in deposits and bets."""
    d = s["deposits"].select(F.col("fx_rate").isNull().alias("m"), F.lit(0).alias("t"))
    b = s["bets"].select(F.col("fx_rate").isNull().alias("m"), F.lit(1).alias("t"))
    u = d.unionByName(b)
    return u.agg(
        F.sum(F.when((F.col("t") == 0) & F.col("m"), 1).when(F.col("t") == 0, 0)).cast("bigint")
        .alias("depositos_sem_taxa"),
        F.sum(F.when((F.col("t") == 1) & F.col("m"), 1).when(F.col("t") == 1, 0)).cast("bigint")
        .alias("apostas_sem_taxa"))


def deposits_by_currency(s: dict[str, DataFrame]) -> DataFrame:
    """Confirmed deposits by currency, original and BRL totals."""
    return (s["deposits"].where(F.col("is_confirmed")).groupBy("currency")
            .agg(F.count(F.lit(1)).alias("depositos"),
                 _money(F.sum(_dec("amount"))).alias("total_moeda_original"),
                 _money(F.sum(_dec("amount_brl"))).alias("total_brl"))
            .orderBy(F.col("total_brl").desc(), "currency"))


def ltv_by_channel(s: dict[str, DataFrame]) -> DataFrame:
    """D29d: LTV per acquisition channel (players with a confirmed deposit).

    Deposits are aggregated per player before the join, so the distinct-player
    count is a plain count after it (no fan-out, no distinct aggregation).
    """
    per = (s["deposits"].where(F.col("is_confirmed")).groupBy("player_id")
           .agg(F.sum(_dec("amount_brl")).alias("dep")))
    p = s["players"].select("player_id", "acquisition_channel")
    j = per.join(p, "player_id")
    g = j.groupBy("acquisition_channel").agg(F.countDistinct("player_id").alias("jogadores"),
                                             F.sum("dep").alias("sm"))
    g = with_half_up(g, "por_jogador", cents("sm"), F.col("jogadores"), 2, 2)
    return (g.select("acquisition_channel", "jogadores", _money(F.col("sm")).alias("depositado_brl"),
                     "por_jogador")
            .orderBy(F.col("depositado_brl").desc(), "acquisition_channel"))


def product_result(s: dict[str, DataFrame]) -> DataFrame:
    """D29e: stake, payout, result and retention by product."""
    g = s["bets"].groupBy("product").agg(F.count(F.lit(1)).alias("apostas"),
                                         F.sum(_dec("stake_brl")).alias("st"),
                                         F.sum(_dec("payout_brl")).alias("po"))
    res = F.col("st") - F.col("po")
    g = with_half_up(g, "retencao_pct", (cents("st") - cents("po")) * 100, cents("st"), 2)
    return (g.select("product", "apostas", _money(F.col("st")).alias("apostado_brl"),
                     _money(F.col("po")).alias("pago_brl"), _money(res).alias("resultado_brl"),
                     "retencao_pct")
            .orderBy("resultado_brl", "product"))


def compliance_counts(s: dict[str, DataFrame]) -> DataFrame:
    """D29f: who may not be targeted."""
    return (s["players"].groupBy("is_targetable", "self_excluded", "kyc_status")
            .agg(F.count(F.lit(1)).alias("jogadores"))
            .orderBy(F.col("is_targetable").asc_nulls_last(), F.col("jogadores").desc(),
                     "self_excluded", "kyc_status"))


def silver_conformance(s: dict[str, DataFrame]) -> DataFrame:
    """D29g: name == standard name (null for a blank name) and resolved segments."""
    segs = ["geo", "channel", "objective", "product", "audience", "period", "offer"]
    c = s["campaigns"]
    return c.select("campaign_id", "campaign_name", "campaign_name_std",
                    (F.col("campaign_name") == F.col("campaign_name_std")).alias("conforme"),
                    (F.lit(7) - F.size(F.filter(F.array(*[F.col(x) for x in segs]),
                                                lambda x: x == UNKNOWN))).cast("int")
                    .alias("segmentos_resolvidos")).orderBy("segmentos_resolvidos", "campaign_id")


def channel_offer_fanout(s: dict[str, DataFrame]) -> DataFrame:
    """D29h: channel x offer x product over clicked campaigns, with the original
    many-to-many sum (each confirmed deposit counted once per click).

    The pairs are never emitted: per player, clicks are counted per campaign
    (before campaigns are joined, so a hot campaign meets one row a player) and
    then per (offer, product), deposits are summed, and both multiplied - the
    same total as joining clicks x deposits, without the quadratic row blow-up
    of a hot player.
    """
    clicks = (s["campaign_touchpoints"].where(F.col("event_type") == "click")
              .groupBy("player_id", "campaign_id").agg(F.count(F.lit(1)).alias("n"))
              .join(s["campaigns"].select("campaign_id", "offer", "product"), "campaign_id")
              .groupBy("player_id", "offer", "product").agg(F.sum("n").alias("n_clicks")))
    dep = (s["deposits"].where(F.col("is_confirmed")).groupBy("player_id")
           .agg(F.sum(_dec("amount_brl")).alias("dep")))
    p = s["players"].select("player_id", "acquisition_channel")
    j = clicks.join(dep, "player_id").join(p, "player_id")
    g = j.groupBy("acquisition_channel", "offer", "product").agg(
        F.countDistinct("player_id").alias("jogadores"),
        F.sum(F.col("dep") * F.col("n_clicks")).alias("sm"))
    return (g.select("acquisition_channel", "offer", "product", "jogadores",
                     _money(F.col("sm")).alias("depositado_brl"))
            .orderBy(F.col("depositado_brl").desc(), "acquisition_channel", "offer", "product"))
