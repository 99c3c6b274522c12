"""Alarms on a gap-free hour axis, sorted FX files, and sources that are missing."""

import datetime as dt
import json
import os
import tempfile

import pytest

from tidewell import sinks, sources
from tidewell.plans import ops, pipeline


def test_alarms_end_in_hours_without_metrics(spark):
    at = lambda day, h, m=0: dt.datetime(2024, 1, day, h, m)
    rows = [("silver", "ChecksFailedError", 0, at(1, 3)), ("silver", "ChecksFailedError", 2, at(1, 5, 10)),
            ("silver", "ChecksFailedError", 1, at(1, 5, 50)), ("silver", "ChecksFailedError", 4, at(1, 6)),
            ("silver", "ChecksFailedError", 1, at(3, 0)), ("silver", "BlankValues", 9, at(1, 1)),
            ("reference", "DegradedMode", 1, at(1, 0)), ("reference", "DegradedMode", 1, at(1, 0, 30)),
            ("reference", "DegradedMode", 0, at(1, 1)), ("gold", "ChecksTotal", 5, at(1, 0)),
            ("reference", "ChecksFailedError", 7, at(1, 1))]
    df = spark.createDataFrame(rows, "layer string, metric string, value bigint, ts timestamp_ntz")
    got = sorted((r.layer, r.window_start, r.statistic, r.value, r.state) for r in ops.alarms(df).collect())
    assert got == [("gold", at(1, 0), "Sum", None, "OK"),
                   ("reference", at(1, 0), "Maximum", 1, "ALARM"), ("reference", at(1, 1), "Maximum", 0, "OK"),
                   ("silver", at(1, 1), "Sum", None, "OK"), ("silver", at(1, 5), "Sum", 3, "ALARM"),
                   ("silver", at(1, 7), "Sum", None, "OK"), ("silver", at(3, 0), "Sum", 1, "ALARM"),
                   ("silver", at(3, 1), "Sum", None, "OK")]
    assert ops.alarms(df.limit(0)).count() == 0


def test_files_of_a_sorted_snapshot_are_in_order(spark):
    import pyarrow.parquet as pq

    root = tempfile.mkdtemp(prefix="tidewell-sorted-")
    df = spark.range(5000).selectExpr("CAST(id * 7919 % 5000 AS STRING) AS rate_date", "CAST(id % 3 AS STRING) AS from_currency")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        info = sinks.publish_snapshot(df, root, "2024-01-01", "r1", ["rate_date", "from_currency"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for folder in (info["snapshot"], info["current"]):
        files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
        rows = [tuple(r.values()) for f in files for r in pq.read_table(os.path.join(folder, f)).to_pylist()]
        assert len(files) > 1 and len(rows) == 5000 and rows == sorted(rows)


def test_only_a_missing_source_degrades(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tidewell-deg-")
    with pytest.raises(sources.SourceUnavailable):
        sources.landed_quotes(spark, os.path.join(root, "none"))
    os.makedirs(os.path.join(root, "q"))
    with open(os.path.join(root, "q", "a.json"), "w") as f:
        json.dump({"message": "busy"}, f)
    with pytest.raises(sources.SourceUnavailable):
        sources.landed_quotes(spark, os.path.join(root, "q"))
    assert sources.read_previous_fx(spark, os.path.join(root, "none"), "2024-01-01", "2024-01-02") is None

    def broken(*a):
        raise KeyError("a fault of the code")

    monkeypatch.setattr(sources, "landed_quotes", broken)
    with pytest.raises(KeyError):
        pipeline.run_fx(spark, root, root, dt.date(2024, 1, 1), dt.date(2024, 1, 2), "r", "2024-01-02")
