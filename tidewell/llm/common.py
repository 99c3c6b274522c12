"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidewell.session import materialise, shared_dir

__all__ = ["SPACE_CLASS", "SPACES", "attach", "materialise", "shared_dir", "table", "text_or_empty"]

#: White space that separates words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
#: A derived table is broadcast only up to this many rows, counted beforehand.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast(StringType()), F.lit(""))


def attach(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
           limit: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join a materialised ``small`` table to ``big``.

    ``small`` is counted; up to ``limit`` rows it is broadcast, beyond that a
    sort-merge join runs, whose hot keys AQE splits (the small side is unique
    per key, so a split partition only re-reads one row per key).
    """
    rows = small.limit(limit + 1).count()
    return big.join(F.broadcast(small) if rows <= limit else small.hint("merge"), keys, how)
