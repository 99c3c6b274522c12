"""What the DQ battery and its samples read and move: distinct rows once, few values a task, the star's facts once."""

from tidewell.config import ERROR, Contract
from tidewell.operators import dq
from tidewell.plans import catalog

SMALL = "/root/testdata/sf0.001"


def _reads(df, name):
    return any(name in f for f in df.inputFiles())


def test_a_task_gives_the_first_values_of_a_check_only(spark):
    c = Contract(columns=["id"], pattern={"id": r"K\d{2}"}, domains={"id": (ERROR, ["K01"])})
    df = spark.range(0, 20000, 1, 4).selectExpr(
        "CONCAT('bad', id % 9000) AS id", "IF(id % 3 = 0, NULL, CONCAT('d', id % 3)) AS ingest_date")
    values = dq.violating_values(df, "e", c, ["ingest_date"])
    assert values.count() <= 4 * 3 * (5 + 10)  # tasks, load days, values of both checks
    want = {}
    for k in range(20000):
        want.setdefault(f"d{k % 3}" if k % 3 else None, set()).add(f"bad{k % 9000}")
    got = {(r.ingest_date, r.check): r.samples for r in dq.smallest_values(values, ["ingest_date"]).collect()}
    assert got == {(d, check): sorted(v)[:n] for d, v in want.items()
                   for check, n in (("id_pattern", 5), ("accepted_values", 10))}


def test_first_values_hold_over_many_reductions():
    import pyarrow as pa

    run = dq._first_values(["d"], [("id_pattern", "a"), ("accepted_values", "b")],
                           {"id_pattern": 2, "accepted_values": 3}, batch_rows=7)
    rows = [(None if k % 4 == 0 else f"d{k % 4}", None if k % 5 == 0 else f"é{k * 37 % 101}", None) for k in range(300)]
    batches = [pa.table({n: pa.array([r[i] for r in rows[a:a + 11]], pa.string()) for i, n in enumerate(("d", "_v0", "_v1"))}
                        ).to_batches()[0] for a in range(0, 300, 11)]
    got = sorted((r["d"] or "", r["check"], r["column"], r["value"]) for b in run(iter(batches)) for r in b.to_pylist())
    want = {}
    for d, v, _ in rows:
        if v is not None:
            want.setdefault(d or "", set()).add(v)
    assert got == sorted((d, "id_pattern", "a", v) for d, s in want.items() for v in sorted(s)[:2])


def test_typed_columns_are_blank_where_null(spark):
    c = Contract(columns=["x", "t"], not_blank={"x": (ERROR, 0.0), "t": (ERROR, 0.0)}, positive=["x"])
    df = spark.createDataFrame([(float("nan"), "a"), (float("inf"), " "), (None, ""), (2.0, " a"), (-1.0, None)],
                               "x double, t string")
    got = {(r.check, r.column): r.failed_records for r in dq.run_contract(df, "e", c).collect()}
    assert got[("not_blank", "x")] == 1 and got[("not_blank", "t")] == 3
    assert got[("numeric_parseable", "x")] == 2 and got[("numeric_range", "x")] == 1


def test_battery_and_samples_read_the_stored_distinct_rows(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    lk = catalog.lake(spark, SMALL)
    for df in (lk.bronze_checks(["ingest_date"]), lk.samples()):
        assert _reads(df, "distinct-bets") and not _reads(df, "lineitem")


def test_the_calendar_spans_the_stored_facts(spark, monkeypatch):
    seen = {}

    def spy(df, name, keep=catalog.materialise):
        seen[name] = _reads(df, "lineitem")
        return keep(df, name)

    monkeypatch.setattr(catalog, "materialise", spy)
    catalog._gold_checks(catalog.lake(spark, SMALL))
    assert seen["star-fact_bet"] and not seen["star-dim_date"]
