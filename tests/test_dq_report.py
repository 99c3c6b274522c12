"""Violating samples, details of the written report, and history over report files."""

import json
import os
import random
import tempfile

from tidewell import sinks, sources
from tidewell.config import ERROR, WARN, TESTDATA_REFS, Contract
from tidewell.operators import dq
from tidewell.plans import ops, pipeline

CONTRACT = Contract(columns=["id", "kind", "parent"], domains={"kind": (ERROR, ["a", "b"])},
                    pattern={"id": r"K\d{2}"}, fks={"parent": "owner.id"})
COLS = "id string, kind string, parent string, ingest_date string"


def _rows(n=3000):
    r = random.Random(4)
    return [(r.choice(["K01", "K2", "k03", None, "K٠١", " K05"]) if r.random() < .5 else f"X{r.randrange(40)}",
             r.choice(["a", " b ", "c", "C", None, "", "é", "z\n"]) if r.random() < .5 else f"w{r.randrange(99)}",
             r.choice(["p1", "p2", None, " ", "q"]), r.choice(["d1", "d2", None])) for _ in range(n)]


def test_samples_are_the_first_distinct_violating_values(spark):
    import re

    rows = _rows()
    df, owner = spark.createDataFrame(rows, COLS), spark.createDataFrame([("p1",), (None,)], "id string")
    values = dq.violating_values(df, "e", CONTRACT, ["ingest_date"])
    for v in dq.orphan_values({"e": df, "owner": owner}, {"e": CONTRACT}, ["ingest_date"]):
        values = values.unionByName(v)
    got = {(r["ingest_date"], r["check"], r["column"]): r["samples"]
           for r in dq.smallest_values(values, ["ingest_date"]).collect()}
    want = {}
    for i, kind, parent, day in rows:
        if kind is not None and kind.strip() and kind.strip() not in ("a", "b"):
            want.setdefault((day, "accepted_values", "kind"), set()).add(kind.strip())
        if i is not None and not re.fullmatch(r"K[0-9]{2}", i):
            want.setdefault((day, "id_pattern", "id"), set()).add(i)
        if parent is not None and parent.strip() and parent != "p1":
            want.setdefault((day, "referential_integrity", "parent"), set()).add(parent)
    assert got == {k: sorted(v)[:dq.SAMPLES[k[1]]] for k, v in want.items()}


def test_a_check_that_all_rows_violate_moves_few_rows(spark):
    df = spark.range(1000).selectExpr("CONCAT('bad', id) AS id", "'a' AS kind", "'p' AS parent", "'d' AS ingest_date")
    few = dq.smallest_values(dq.violating_values(df, "e", CONTRACT, ["ingest_date"]), ["ingest_date"])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # in every task, and behind the shuffle
    assert few.first()["samples"] == sorted(f"bad{k}" for k in range(1000))[:5]


def test_details_show_counts_and_samples(spark):
    res = spark.createDataFrame([("e", "id_pattern", "id", 3, 9, "d", ""), ("e", "not_blank", "id", 0, 9, None, ""),
                                 ("e", "schema_contract", "", 1, 3, "d", '{"missing": ["x"]}')],
                                "entity string, check string, column string, failed_records long, total_records long, "
                                "ingest_date string, details string")
    s = spark.createDataFrame([("d", "e", "id_pattern", "id", ['a"b', "c"])],
                              "ingest_date string, entity string, check string, column string, samples array<string>")
    got = {r["check"]: r["details"] for r in dq.with_details(res, s, ["ingest_date"]).collect()}
    assert got["not_blank"] == "" and got["schema_contract"] == '{"missing": ["x"]}'
    assert got["id_pattern"].startswith("failed=3 total=9 samples=") and json.loads(got["id_pattern"][25:]) == ['a"b', "c"]


def _report(spark, day, run, at, passed, base):
    rows = spark.createDataFrame([("e", "not_blank", "c", ERROR, passed, 0 if passed else 4, 10, 0.4),
                                  ("e", "id_pattern", "c", WARN, True, 0, 10, 0.0)],
                                 "entity string, check string, column string, severity string, passed boolean, "
                                 "failed_records bigint, total_records bigint, failed_ratio double")
    return sinks.write_dq_report(rows, base, day, run, at)


def test_history_takes_the_newest_run_of_each_day(spark):
    base = tempfile.mkdtemp(prefix="tidewell-rep-")
    path = _report(spark, "2024-01-01", "r1", "2024-01-01T01:00:00", False, base)
    _report(spark, "2024-01-02", "r2", "2024-01-02T01:00:00", True, base)
    _report(spark, "2024-01-01", "r3", "2024-01-05T01:00:00", True, base)  # day 1 is loaded again, later
    _report(spark, "2024-01-03", "r4", "2024-01-03T01:00:00", False, base)
    h = sources.read_dq_history(spark, path)
    assert sorted({(r.ingest_date, r.run_id) for r in h.collect()}) == [
        ("2024-01-01", "r3"), ("2024-01-02", "r2"), ("2024-01-03", "r4")]
    assert [(r.ingest_date, r.passed) for r in ops.verdict_changes(h).collect()] == [("2024-01-03", False)]
    assert {r.ingest_date: r.reprovou_error for r in ops.run_verdict(h).collect()} == {
        "2024-01-01": 0, "2024-01-02": 0, "2024-01-03": 1}
    assert [r.pct for r in ops.trend(h).collect()] == [40.0]
    plan = ops.trend(h)._jdf.queryExecution().executedPlan().toString()
    assert "Scan json" in plan and "parquet" not in plan.lower()


def test_silver_job_writes_samples_and_counts_per_reason(spark):
    root = tempfile.mkdtemp(prefix="tidewell-rep-")
    land = pipeline.land_testdata(spark, "/root/testdata/sf0.001", root)
    pipeline.run_fx(spark, land["quotes"], root, land["start"], land["end"], "r1", "2001-12-01")
    out = pipeline.run_silver(spark, land["bronze"], os.path.join(root, "reference", "fx_rates", "current"), root,
                              TESTDATA_REFS, None, "r1", ["players", "deposits", "campaign_touchpoints"], False)
    q = spark.read.parquet(os.path.join(root, "quarantine", "deposits"))
    per = {r["reason"]: r["count"] for r in q.groupBy("reason").count().collect()}
    assert out["results"]["deposits"]["quarantine"] == per and per["duplicate_row"] > 0
    rep = sources.read_dq_history(spark, os.path.join(root, "quality", "dq_report"))
    bad = rep.where("failed_records > 0 AND `check` = 'accepted_values'").collect()
    assert bad and all(f"failed={r.failed_records} total={r.total_records} samples=[" in r.details for r in bad)
    assert rep.where("failed_records = 0 AND details <> ''").count() == 0
