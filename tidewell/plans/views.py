"""Catalog registration (S8, S9): external Parquet tables and the mart views.

Tables are registered with plain Spark SQL DDL (``CREATE TABLE ... USING
parquet LOCATION``) so any SQL user can query the published layers; the marts
are registered as session views over the same lazily built DataFrames the
query registry uses, so SQL and DataFrame users get one plan.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from ..config import GOLD_WRITE_ORDER
from ..session import stored_bytes
from ..sinks import manifest
from . import marts

SILVER_TABLES = ["players", "deposits", "bets", "campaigns", "campaign_touchpoints"]


def register_tables(spark: SparkSession, base: str, database: str = "lakehouse") -> list[str]:
    """(Re)create the database and one external table per published folder, on any file system.

    The DQ report is JSON lines with its partitions in the path; the others are Parquet. The star's
    tables are those of one published manifest (folders without a manifest are taken as they are).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    published = manifest.load(spark, os.path.join(base, "gold"))
    star = {name: info["path"] for name, info in published["tables"].items()} if published else {}
    folders = ([(name, ("gold", star.get(name, name)), "parquet") for name in GOLD_WRITE_ORDER]
               + [(f"silver_{name}", ("silver", name), "parquet") for name in SILVER_TABLES]
               + [("fx_rates", ("reference", "fx_rates", "current"), "parquet"),
                  ("dq_report", ("quality", "dq_report"), "json")])
    created = []
    for name, folder, form in folders:
        path = os.path.join(base, *folder)
        if stored_bytes(spark, path) is None:
            continue
        table = f"{database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING {form} LOCATION '{path}'")
        if form == "json":
            spark.sql(f"MSCK REPAIR TABLE {table}")
        created.append(table)
    return created


def register_views(spark: SparkSession, lake) -> list[str]:
    """Session views for the star and the marts (vw_* names of the original layer)."""
    star = lake.star
    p360 = marts.player_360(star, lake.refs.dormancy_ref)
    offers = marts.last_offer(star, lake.refs.touch_ref)
    views = {
        **{name: df for name, df in star.items()},
        "vw_player_360": p360,
        "vw_segmentos_valor": marts.value_segments(p360),
        "vw_ltv_canal_oferta_produto": marts.ltv_channel_offer_product(p360, offers),
        "vw_conformidade_taxonomia": marts.taxonomy_conformance(star),
        "vw_dormencia_gaps": marts.dormancy_gaps(star),
        "vw_dormencia_retorno": marts.dormancy_return(star, lake.refs.dormancy_ref),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
