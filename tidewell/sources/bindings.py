"""Bind the driver's TPC-H-like tables to the five bronze entities (§7.3).

Bronze is raw text, exactly what a CSV landing would give: every column is a
string, an ``ingest_date`` partition column says which monthly/yearly load a
row arrived in. All of this is lazy DataFrame code over the given tables, so
the work grows with them. The same mapping is written independently in DuckDB
SQL for the oracle (``tidewell.oracle``).

Injected defects mirror the kinds the original data carries: blank channels,
byte-identical re-sent deposits, conflicting bet ids (natural in lineitem),
future-dated bets, out-of-domain touchpoint types, malformed campaign names.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import read_table as _read_table


#: The later load day of deposits that are sent again.
RESENT_DAY = "2002-01-01"


#: The given tables that the entities and quotes are bound to.
TABLES = ["nation", "customer", "part", "orders", "lineitem", "events"]

#: Session setting: deal every given table out to so many parts first. For benchmarks on tables of one
#: file each, whose scan is a single task; unset (the default) the scan's own splits are kept.
DEAL_OUT = "tidewell.bindings.dealOut"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    df, parts = _read_table(spark, base, name), spark.conf.get(DEAL_OUT, None)
    return df.repartition(int(parts), F.col(df.columns[0])) if parts else df


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def _id(prefix: str, width: int, c: Column) -> Column:
    """``prefix`` + zero-padded integer, never truncated (= printf('%0Nd'))."""
    t = c.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0")))


def _text(c: Column) -> Column:
    return c.cast("string")


def _year_start(ts: Column) -> Column:
    return F.date_format(F.date_trunc("year", ts), "yyyy-MM-dd")


def players(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation is a fixed 25-row table: broadcast is bounded by construction
    n = F.broadcast(read_table(spark, base, "nation").select("n_nationkey", "n_regionkey"))
    k = F.col("c_custkey")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    signup = F.date_add(F.lit("1995-01-01").cast("date"), (k % 365).cast("int"))
    return j.select(
        _id("P", 5, k).alias("player_id"),
        F.date_format(signup, "yyyy-MM-dd").alias("signup_date"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.lower("c_mktsegment")).alias("acquisition_channel"),
        _pick(["BR", "PT", "AO"], F.col("n_nationkey")).alias("country"),
        _pick(["BRL", "USD", "EUR"], F.col("n_regionkey")).alias("preferred_currency"),
        F.when(k % 20 == 0, "rejected").when(k % 20 <= 3, "pending")
         .otherwise("verified").alias("kyc_status"),
        F.when(k % 18 == 0, "true").otherwise("false").alias("self_excluded"),
        _year_start(signup).alias("ingest_date"),
    )


def deposits(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    # every 50th order is re-sent: a byte-identical second copy, generated in the same scan
    o = o.withColumn("_copy", F.explode(F.when(k % 50 == 0, F.array(F.lit(1), F.lit(2)))
                                        .otherwise(F.array(F.lit(1)))))
    return o.select(
        _id("D", 7, k).alias("deposit_id"),
        _id("P", 5, F.col("o_custkey")).alias("player_id"),
        _text(F.col("o_orderdate")).alias("deposit_ts"),
        _text(F.col("o_totalprice")).alias("amount"),
        _pick(["BRL", "USD", "EUR"], k).alias("currency"),
        F.when(F.col("o_orderstatus") == "F", "confirmed")
         .when(F.col("o_orderstatus") == "O", "pending")
         .when(F.col("o_orderstatus") == "P", "failed")
         .otherwise(F.col("o_orderstatus")).alias("status"),
        _year_start(F.col("o_orderdate")).alias("ingest_date"),
    )


def resent_deposits(spark: SparkSession, base: str) -> DataFrame:
    """Every 40th order, sent once more on a later load day (byte-identical but for that day)."""
    number = F.substring("deposit_id", 2, 64).cast("long")
    return deposits(spark, base).where(number % 40 == 0).distinct().withColumn("ingest_date", F.lit(RESENT_DAY))


def bets(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    price = F.col("l_extendedprice")
    return j.select(
        _id("B", 7, F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("bet_id"),
        _id("P", 5, F.col("o_custkey")).alias("player_id"),
        _text(F.col("l_shipdate")).alias("bet_ts"),
        _text(price).alias("stake"),
        _pick(["BRL", "USD", "EUR"], F.col("l_orderkey") + F.col("l_linenumber")).alias("currency"),
        F.when(F.col("l_linestatus") == "F", "sports")
         .when(F.col("l_linestatus") == "O", "casino")
         .otherwise(F.col("l_linestatus")).alias("product"),
        F.when(F.col("l_returnflag") == "R", F.lit("0"))
         .otherwise(_text(price * (F.lit(1.0) + F.col("l_discount") - F.col("l_tax"))))
         .alias("payout"),
        _year_start(F.col("l_shipdate")).alias("ingest_date"),
    )


def campaigns(spark: SparkSession, base: str) -> DataFrame:
    p = read_table(spark, base, "part").select("p_partkey")
    k = F.col("p_partkey")
    geo = _pick(["BR", "PT", "AO"], k)
    chan = _pick(["email", "push", "sms"], F.floor(k / 3))
    obj = _pick(["acquisition", "reactivation", "retention", "crosssell"], F.floor(k / 9))
    prod = _pick(["sports", "casino", "both"], F.floor(k / 2))
    aud = _pick(["new", "active", "dormant", "vip"], F.floor(k / 5))
    period = F.concat(F.lit("202"), _text(k % 5), F.lit("Q"), _text(k % 4 + 1))
    offer = _pick(["bonus50", "bonus100", "freebet", "freespins", "cashback", "none"],
                  F.floor(k / 7))
    # misspelling: drop the character before the last one (reactivation -> reactivaton)
    obj_typo = F.concat(F.expr("substring(o, 1, length(o) - 2)"), F.expr("substring(o, length(o), 1)"))
    offer_split = (F.when(offer == "bonus50", "bonus_50")
                   .when(offer == "bonus100", "bonus_100").otherwise(offer))
    std = F.concat_ws("_", geo, chan, obj, prod, aud, period, offer)
    variant = k % 6
    name = (F.when(variant == 0, std)
            .when(variant == 1, F.upper(std))
            .when(variant == 2, F.concat_ws("-", geo, chan, obj, prod, aud, period, offer))
            .when(variant == 3, F.concat_ws("_", geo, chan, obj, period, offer))
            .when(variant == 4, F.lit(None).cast("string"))
            .otherwise(F.concat_ws("_", aud, geo, chan, F.col("_typo"), prod, period,
                                   offer_split)))
    created = F.date_add(F.lit("2023-12-01").cast("date"), (k % 31).cast("int"))
    return (p.withColumn("o", obj)
             .withColumn("_typo", obj_typo)
             .select(
                 _id("C", 3, k).alias("campaign_id"),
                 name.alias("campaign_name"),
                 F.date_format(created, "yyyy-MM-dd").alias("created_date"),
                 _pick(["active", "paused", "archived"], k).alias("status"),
                 F.lit("2024-01-01").alias("ingest_date"),
             ))


def touchpoints(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events").select("event_id", "ts", "user_id", "event_type")
    k = F.col("event_id")
    et = F.col("event_type")
    return e.select(
        _id("T", 7, k).alias("touchpoint_id"),
        _id("P", 5, F.col("user_id")).alias("player_id"),
        _id("C", 3, F.col("user_id") + k % 100).alias("campaign_id"),  # more users, more campaigns
        _pick(["email", "push", "sms"], k).alias("channel"),
        _text(F.col("ts")).alias("event_ts"),
        F.when(et == "view", "sent").when(et == "click", "open")
         .when(et == "purchase", "click").otherwise(et).alias("event_type"),
        F.date_format(F.date_trunc("month", F.col("ts")), "yyyy-MM-dd").alias("ingest_date"),
    )


BUILDERS = {
    "players": players,
    "deposits": deposits,
    "bets": bets,
    "campaigns": campaigns,
    "campaign_touchpoints": touchpoints,
}


def bronze(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: fn(spark, base) for name, fn in BUILDERS.items()}


def fx_window(spark: SparkSession, base: str) -> tuple[_dt.date, _dt.date]:
    """FX calendar window = the transaction date range (one tiny aggregate)."""
    o = read_table(spark, base, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    li = read_table(spark, base, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    r = o.unionByName(li).agg(F.min("d").alias("start"), F.max("d").alias("end")).first()
    return r["start"], r["end"]


def quotes(spark: SparkSession, base: str) -> DataFrame:
    """Quotes (pub_date, currency, per_base) from the given orders.

    Each day's orders give the quotes published five days before, on weekdays: USD from the day's smallest
    key, BRL from the number of orders. Days without orders have none, and USD is missing where the key
    divides by 23 (a currency missing on a published day, so that each currency is carried forward alone).
    """
    days = read_table(spark, base, "orders").groupBy(
        F.date_sub(F.col("o_orderdate").cast("date"), 5).alias("pub_date")).agg(
        F.min("o_orderkey").alias("k"), F.count(F.lit(1)).alias("n")).where(F.weekday("pub_date") < 5)
    usd = F.when(F.col("k") % 23 != 0, F.lit(1.05) + (F.col("k") % 10) / 100.0)
    brl = F.lit(5.2) + (F.col("n") % 20) / 100.0
    return days.select("pub_date", F.inline(F.array(
        F.struct(F.lit("USD").alias("currency"), usd.alias("per_base")),
        F.struct(F.lit("BRL").alias("currency"), brl.alias("per_base"))))).where("per_base IS NOT NULL")
