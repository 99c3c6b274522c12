"""Cut keys by selection against sorted rows: wide spans, ties, prefixes, nulls, few rows."""

import random

import pytest

from tidewell.operators import ranking

CASES = {
    "spread": lambda r, i: (r.uniform(-1e6, 1e6), f"P{i:05d}"),
    "few values": lambda r, i: (float(r.choice([0, 1, 1, 1, 7])), f"P{i:05d}"),
    "one value": lambda r, i: (5.0, f"{'long common prefix ' * 3}{i}"),
    "names that are prefixes": lambda r, i: (1.0, "a" * i),
    "one far value": lambda r, i: (1e15 if i == 0 else i / 100, f"é{i}"),
    "a null name": lambda r, i: (2.0, None if i == 0 else str(i)),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("few", [1, 1000])
def test_cut_keys_are_those_of_the_sorted_rows(spark, monkeypatch, case, few):
    monkeypatch.setattr(ranking, "FEW", few)
    monkeypatch.setattr(ranking, "BUCKETS", 8)
    r = random.Random(1)
    rows = [CASES[case](r, i) for i in range(37 if few == 1 else 301)]
    df = spark.createDataFrame(rows, "v double, k string").cache()
    keys = sorted((v, "0" if k is None else "1" + k) for v, k in rows)
    for n in (4, 3):
        assert ranking.cut_keys(df, n, "v", "k") == [keys[e - 1] for e in ranking.tile_ends(n, len(rows))]
    df.unpersist()


def test_tile_ends_and_empty_tables(spark):
    assert ranking.tile_ends(4, 10) == [3, 6, 8] and ranking.tile_ends(4, 2) == [1, 2, 2]
    empty = spark.createDataFrame([], "v double, k string")
    assert ranking.cut_keys(empty, 4, "v", "k") == [] and ranking.ntile(empty, 4, ["v", "k"]).count() == 0


def test_rows_of_one_key_share_a_tile(spark):
    df = spark.createDataFrame([(1.0, "a")] * 3 + [(2.0, "b")], "v double, k string")
    assert sorted((r.k, r.tile) for r in ranking.ntile(df, 2, ["v", "k"]).collect()) == [("a", 1)] * 3 + [("b", 2)]


def test_tiers_are_decided_without_sort_or_join(spark):
    from tidewell.plans import catalog

    df = catalog.queries()["value_tiers"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Sort", "Window", "Join", "Exchange", "ExistingRDD"))
