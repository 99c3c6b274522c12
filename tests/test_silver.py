"""Quarantine, typing and reconciliation on hand-made bronze rows (edge cases)."""

import datetime as dt

from pyspark.sql import functions as F

from tidewell.config import BRONZE_CONTRACTS
from tidewell.functions import is_blank, to_bool, to_number, to_ts
from tidewell.operators import silver as sv

REF = dt.date(2024, 4, 1)
COLS = BRONZE_CONTRACTS["deposits"].columns


def _deposits(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS))


def test_first_reason_wins_and_reconciles(spark):
    rows = [
        ("D0000001", "P00001", "2024-03-31 10:00:00", "10.0", "BRL", "confirmed"),
        ("D0000001", "P00001", "2024-03-31 10:00:00", "10.0", "BRL", "confirmed"),  # byte copy
        ("D0000002", "P00001", "2024-04-01 00:00:00", "10.0", "BRL", "confirmed"),  # exactly midnight: kept
        ("D0000003", "P00001", "2024-04-01 00:00:00.000001", "1", "BRL", "pending"),  # 1 us later
        ("D0000003", "P00001", "2024-04-01 00:00:00.000001", "1", "BRL", "pending"),  # copy of a future row
        ("D0000004", "P00002", "not a date", "x", "USD", "failed"),
        (None, None, None, None, None, None),
    ]
    df = _deposits(spark, rows)
    clean, q = sv.split(df, BRONZE_CONTRACTS["deposits"], REF)
    reasons = sorted((r[0], r[1]) for r in q.groupBy(sv.REASON).count().collect())
    assert reasons == [("duplicate_row", 2), ("future_dated__deposit_ts", 1)]
    assert clean.count() == 4
    rec = sv.reconciliation("deposits", df, clean, q).first()
    assert rec.passed and rec.rows_in == 7 and rec.rows_written == 4 and rec.rows_quarantined == 3


def test_hot_duplicate_group_expands_exactly(spark):
    row = ("D0000009", "P00009", "2024-01-01 00:00:00", "5", "EUR", "confirmed")
    df = spark.range(10_000).select(*[F.lit(v).alias(c) for c, v in zip(COLS, row)])
    clean, q = sv.split(df, BRONZE_CONTRACTS["deposits"], REF)
    assert clean.count() == 1
    groups = sv.collapse(df, COLS).select(*COLS, (F.col(sv.COPIES) - 1).alias("_x"))
    assert sv.expand_copies(groups, "_x", chunk=7).count() == 9_999
    assert q.count() == 9_999


def test_tolerant_casts(spark):
    df = spark.createDataFrame(
        [("2024-01-05T10:00:00Z", " 12.5 ", "TRUE", "\t"), ("2024-01-05", "nan", "no", " x "),
         ("garbage", "1e3", "maybe", None)], "t string, n string, b string, s string")
    r = df.select(to_ts("t").alias("t"), to_number("n").alias("n"), to_bool("b").alias("b"),
                  is_blank("s").alias("blank")).collect()
    assert r[0].t == dt.datetime(2024, 1, 5, 10) and r[0].n == 12.5 and r[0].b is True and r[0].blank
    assert r[1].t == dt.datetime(2024, 1, 5) and r[1].n is None and r[1].b is False and not r[1].blank
    assert r[2].t is None and r[2].n == 1000.0 and r[2].b is None and r[2].blank


def test_flags_null_safe(spark):
    df = spark.createDataFrame([(None, None), (True, "verified"), (False, "rejected"), (False, None)],
                               "self_excluded boolean, kyc_status string")
    got = [r.is_targetable for r in sv.derive_flags("players", df).collect()]
    assert got == [True, False, False, True]
