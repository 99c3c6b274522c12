"""FX densify: carry-forward, per-currency source dates, look-back, identity, coverage."""

import datetime as dt

from tidewell.operators import fx


def _quotes(spark, rows):
    return spark.createDataFrame(rows, "pub_date date, currency string, per_base double")


def test_weekend_carry_and_identity(spark):
    fri, mon = dt.date(2024, 1, 5), dt.date(2024, 1, 8)
    q = _quotes(spark, [(fri, "USD", 1.1), (fri, "BRL", 5.5), (mon, "USD", 1.0), (mon, "BRL", 6.0)])
    out = {(r.rate_date, r.from_currency): r for r in
           fx.build_dense(q, fri, mon, "t").collect()}
    assert len(out) == 4 * 3  # 4 days x (USD, EUR, BRL identity)
    sat = out[("2024-01-06", "USD")]
    assert sat.rate == round(5.5 / 1.1, 8) and sat.source_rate_date == "2024-01-05"
    assert sat.is_carried_forward
    ident = out[("2024-01-06", "BRL")]
    assert ident.rate == 1.0 and ident.source_rate_date == "2024-01-06" and not ident.is_carried_forward
    assert out[("2024-01-08", "EUR")].rate == 6.0


def test_missing_currency_keeps_its_own_source(spark):
    d1, d2 = dt.date(2024, 1, 8), dt.date(2024, 1, 9)
    q = _quotes(spark, [(d1, "USD", 1.0), (d1, "BRL", 5.0), (d2, "BRL", 6.0)])
    out = {(r.rate_date, r.from_currency): r for r in fx.build_dense(q, d1, d2).collect()}
    usd = out[("2024-01-09", "USD")]
    assert usd.rate == 6.0 and usd.source_rate_date == "2024-01-08" and usd.is_carried_forward
    assert not out[("2024-01-09", "EUR")].is_carried_forward


def test_lookback_fills_a_weekend_start(spark):
    fri, sun = dt.date(2024, 1, 5), dt.date(2024, 1, 7)
    q = _quotes(spark, [(fri, "USD", 1.0), (fri, "BRL", 5.0)])
    out = fx.build_dense(q, dt.date(2024, 1, 6), sun).collect()
    assert len(out) == 2 * 3
    cov = fx.coverage_check(fx.build_dense(q, dt.date(2024, 1, 6), sun), dt.date(2024, 1, 6), sun).first()
    assert cov.passed and cov.failed_records == 0


def test_days_before_first_quote_are_skipped_and_coverage_fails(spark):
    d = dt.date(2024, 1, 10)
    q = _quotes(spark, [(d, "USD", 1.0), (d, "BRL", 5.0)])
    start = dt.date(2023, 12, 1)  # more than the look-back before the first quote
    dense = fx.build_dense(q, start, d)
    assert dense.count() == 3
    cov = fx.coverage_check(dense, start, d).first()
    assert not cov.passed


def test_to_brl_uses_own_day_and_half_even(spark):
    d = dt.date(2024, 1, 5)
    q = _quotes(spark, [(d, "USD", 2.0), (d, "BRL", 5.0)])
    dense = fx.build_dense(q, d, dt.date(2024, 1, 7))
    tx = spark.createDataFrame(
        [("a", 1.01, "USD", dt.datetime(2024, 1, 6, 23, 59)), ("b", 10.0, "BRL", dt.datetime(2024, 1, 7)),
         ("c", 1.0, "USD", dt.datetime(2023, 1, 1))],
        "id string, amount double, currency string, ts timestamp_ntz")
    out = {r.id: r for r in fx.to_brl(tx, dense, ["amount"], "currency", "ts").collect()}
    assert out["a"].fx_rate == 2.5 and out["a"].fx_rate_date == "2024-01-05"
    import numpy as np
    assert out["a"].amount_brl == float(np.rint(1.01 * 2.5 * 100) / 100)  # NumPy rounding
    assert out["b"].amount_brl == 10.0
    assert out["c"].fx_rate is None  # before the window: no rate, row kept
