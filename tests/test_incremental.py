"""Incremental loads: the ledger, rows sent again, and runs that stop halfway."""

import datetime as dt
import os
import tempfile

import pytest

from tidewell import sinks
from tidewell.config import BRONZE_CONTRACTS, TESTDATA_REFS
from tidewell.operators import silver as sv
from tidewell.plans import incremental
from tidewell.sinks import manifest

E, COLS = "campaigns", BRONZE_CONTRACTS["campaigns"].columns


def _land(root, day, rows, name="a.csv", header=COLS):
    folder = os.path.join(root, "bronze", E, f"ingest_date={day}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(",".join(r) for r in [header, *rows]) + "\n")


def _row(k, created="2024-01-02", name="x"):
    return [f"C{k:03d}", name, created, "active"]


def _run(spark, root, run, **more):
    return incremental.run(spark, os.path.join(root, "bronze"), root, TESTDATA_REFS, run,
                           lambda e, clean: clean, entities=[E], **more)


def _loaded(spark, root):
    base = os.path.join(root, incremental.BASE)
    ids = sorted(r[0] for r in manifest.read(spark, base, E).select("campaign_id").collect())
    kept = sorted((r[0], str(r[1]), r[2]) for r in manifest.read(spark, base, f"{E}_quarantine").select(
        "campaign_id", "ingest_date", sv.REASON).collect())
    return ids, kept


def test_second_run_loads_nothing_and_resent_rows_are_quarantined(spark):
    root = tempfile.mkdtemp(prefix="tidewell-inc-")
    _land(root, "2024-01-01", [_row(1), _row(1), _row(2), _row(3, "2030-01-01")])
    first = _run(spark, root, "r1")
    assert first["version"] == 1 and first["results"][E]["days"] == ["2024-01-01"]
    state = (["C001", "C002"], [("C001", "2024-01-01", "duplicate_row"), ("C003", "2024-01-01", "future_dated__created_date")])
    assert _loaded(spark, root) == state
    again = _run(spark, root, "r2")
    assert again["results"] == {} and again["version"] == 1 and _loaded(spark, root) == state
    # a later day: one new row, one row of the earlier load sent three times, one that was future-dated then
    _land(root, "2024-02-01", [_row(4), _row(1), _row(1), _row(1), _row(3, "2030-01-01"), _row(2, name="other")])
    got = _run(spark, root, "r3")["results"][E]
    assert got == {"rows_ingested": 6, "rows_written": 2, "rows_quarantined": 4, "reconciled": True,
                   "days": ["2024-02-01"]}
    ids, kept = _loaded(spark, root)
    assert ids == ["C001", "C002", "C002", "C004"]
    assert kept.count(("C001", "2024-02-01", incremental.RESENT)) == 3
    # a late file of a loaded day, in another column order: only that file is read
    order = [1, 0, 2, 3]
    _land(root, "2024-01-01", [[_row(k)[j] for j in order] for k in (2, 9)], "late.csv", [COLS[j] for j in order])
    with pytest.raises(Exception, match="(?i)header"):
        _run(spark, root, "r4")  # files of one scan have one header
    _land(root, "2024-01-01", [_row(2), _row(9)], "late.csv")
    got = _run(spark, root, "r5")["results"][E]
    assert (got["rows_ingested"], got["rows_written"]) == (2, 1)
    assert _run(spark, root, "r6")["results"] == {}


def test_a_row_on_two_days_of_one_run_and_a_given_day(spark):
    root = tempfile.mkdtemp(prefix="tidewell-inc-")
    _land(root, "2024-01-01", [_row(1)])
    _land(root, "2024-01-02", [_row(1), _row(2), ["", "", "", ""], ["", "", "", ""]])
    assert _run(spark, root, "r1", ingest_date="2024-01-02")["results"][E]["rows_written"] == 3
    got = _run(spark, root, "r2")["results"][E]
    assert got["days"] == ["2024-01-01"] and (got["rows_written"], got["rows_quarantined"]) == (0, 1)
    both = tempfile.mkdtemp(prefix="tidewell-inc-")
    _land(both, "2024-01-01", [_row(1)])
    _land(both, "2024-01-02", [_row(1), _row(2)])
    _run(spark, both, "r1")
    assert _loaded(spark, both) == (["C001", "C002"], [("C001", "2024-01-02", incremental.RESENT)])


def test_a_run_that_stops_halfway_has_loaded_nothing(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tidewell-inc-")
    _land(root, "2024-01-01", [_row(1), _row(2)])
    write = sinks.write_parquet

    def stops(df, path, *a):
        if "_ledger" in path:
            raise OSError("lost")
        return write(df, path, *a)

    monkeypatch.setattr(sinks, "write_parquet", stops)
    with pytest.raises(OSError):
        _run(spark, root, "r1")
    assert manifest.load(spark, os.path.join(root, incremental.BASE)) is None
    monkeypatch.setattr(sinks, "write_parquet", write)
    assert _run(spark, root, "r1")["results"][E]["rows_written"] == 2
    assert _loaded(spark, root) == (["C001", "C002"], [])


def test_split_against_brute_force(spark):
    import random

    r, contract = random.Random(3), BRONZE_CONTRACTS[E]
    ref = dt.date(2024, 2, 1)
    sent = [(f"C{r.randrange(9):03d}", r.choice(["x", None, "y\tz"]), r.choice(["2024-01-01", "2030-01-01", "odd"]),
             r.choice(["a", None]), f"2024-0{r.randrange(1, 5)}-01") for _ in range(400)]
    df = spark.createDataFrame(sent, ", ".join(f"{c} string" for c in [*COLS, "ingest_date"]))
    first, _ = incremental.split_new(df.where("ingest_date < '2024-02-01'"), contract, ref)
    clean, bad = incremental.split_new(df.where("ingest_date >= '2024-02-01'"), contract, ref, first)
    seen, want = {s[:4] for s in sent if s[4] < "2024-02-01" and s[2] != "2030-01-01"}, []
    for s in sorted(
            (s for s in sent if s[4] >= "2024-02-01"), key=lambda s: s[4]):
        mine = [w for w in want if w[0][:4] == s[:4]]
        if s[:4] in seen or any(w[0][4] < s[4] for w in mine):
            want.append((s, incremental.RESENT))
        elif mine:
            want.append((s, "duplicate_row"))
        else:
            want.append((s, "future_dated__created_date" if s[2] == "2030-01-01" else "written"))
    got = [(tuple(x[c] for c in [*COLS, "ingest_date"]), "written") for x in clean.collect()] + [
        (tuple(x[c] for c in [*COLS, "ingest_date"]), x[sv.REASON]) for x in bad.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
