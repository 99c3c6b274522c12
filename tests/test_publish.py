"""The star is published whole or not at all, by one manifest; no table is written twice."""

import os
import tempfile

import pytest

from tidewell import sinks
from tidewell.plans import views
from tidewell.sinks import manifest

TABLES = ["dim_date", "fact_bet"]
CHECKS = "entity string, passed boolean, severity string"


def _star(spark, n):
    return {t: spark.range(n).selectExpr(f"id AS {t}_key", f"{n} AS load") for t in TABLES}


def _publish(spark, base, run, n, checks=None):
    written = sinks.write_unpublished(_star(spark, n), TABLES, base, run)
    checks = spark.createDataFrame(checks or [("a", True, "ERROR")], CHECKS)
    return sinks.publish_all_or_nothing(spark, written, base, run, checks)


def _loads(spark, base, version=None):
    return {t: [(r["load"], r["count"]) for r in manifest.read(spark, base, t, version).groupBy("load").count().collect()]
            for t in TABLES}


def test_a_run_that_stops_between_tables_is_not_seen(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="tidewell-pub-")
    assert manifest.load(spark, base) is None
    with pytest.raises(FileNotFoundError):
        manifest.read(spark, base, "dim_date")
    assert _publish(spark, base, "r1", 3)["version"] == 1
    old = {t: [(3, 3)] for t in TABLES}
    assert _loads(spark, base) == old
    writes, write = [], sinks.write_parquet

    def stops(df, path, *a):
        writes.append(path)
        if "fact_bet" in path:
            raise OSError("executor lost")
        return write(df, path, *a)

    monkeypatch.setattr(sinks, "write_parquet", stops)
    with pytest.raises(OSError):
        _publish(spark, base, "r2", 5)
    assert _loads(spark, base) == old  # dim_date of r2 is written, and not seen
    monkeypatch.setattr(sinks, "write_parquet", lambda df, path, *a: writes.append(path) or write(df, path, *a))
    del writes[:]
    assert _publish(spark, base, "r2", 5)["version"] == 2
    assert _loads(spark, base) == {t: [(5, 5)] for t in TABLES}
    assert _loads(spark, base, 1) == old  # a reader that resolved the former state still has it whole
    assert sorted(os.path.basename(os.path.dirname(w)) for w in writes) == TABLES  # one write a table


def test_failed_checks_publish_nothing_and_vacuum_removes_what_no_manifest_names(spark):
    base = tempfile.mkdtemp(prefix="tidewell-pub-")
    _publish(spark, base, "r1", 3)
    assert _publish(spark, base, "r2", 4, [("a", False, "ERROR")]) == {"published": False, "errors": 1}
    assert _publish(spark, base, "r3", 5, [("a", False, "WARN")])["published"]
    gone = manifest.vacuum(spark, base, keep=1)
    assert {g.split("=")[1].split(".")[0] for g in gone} == {"r1", "r2"} and len(gone) == 4
    assert manifest.versions(spark, base) == [2] and _loads(spark, base) == {t: [(5, 5)] for t in TABLES}


def test_two_writers_never_take_one_number(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="tidewell-pub-")
    _publish(spark, base, "r1", 3)
    seen, real = [], manifest.versions

    def late(s, b):  # the first look misses a manifest that another writer commits meanwhile
        seen.append(1)
        return real(s, b)[:-1] if len(seen) == 1 else real(s, b)

    written = sinks.write_unpublished(_star(spark, 7), TABLES, base, "r2")
    monkeypatch.setattr(manifest, "versions", late)
    assert manifest.commit(spark, base, "r2", written) == 2 and len(seen) == 2
    assert manifest.load(spark, base, 1)["run_id"] == "r1"
    assert not [f for f in os.listdir(os.path.join(base, manifest.FOLDER)) if "draft" in f and not f.endswith(".crc")]


def test_registered_tables_are_those_of_one_manifest(spark):
    root = tempfile.mkdtemp(prefix="tidewell-pub-")
    base = os.path.join(root, "gold")
    for run, n in (("r1", 3), ("r2", 5)):
        _publish(spark, base, run, n)
    views.register_tables(spark, root, "tw_pub")
    assert spark.sql("SELECT count(*) AS n, max(load) AS l FROM tw_pub.fact_bet").first() == (5, 5)
