"""File-based jobs end to end on sf0.001: land -> fx -> silver -> gold."""

import os
import tempfile

import pytest

from tidewell import sinks
from tidewell.config import TESTDATA_REFS
from tidewell.plans import ops, pipeline
from tidewell.sinks import DataQualityError


def test_fx_silver_gold_jobs(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tidewell-pipe-")
    land = pipeline.land_testdata(spark, "/root/testdata/sf0.001", root)
    fx_out = pipeline.run_fx(spark, land["quotes"], root, land["start"], land["end"], "r1", "2001-12-01")
    assert fx_out["dq"]["errors"] == 0 and fx_out["output"]["rows"] > 0
    current = os.path.join(root, "reference", "fx_rates", "current")
    # the binding's campaign ids and touchpoint types violate the ERROR contract -> gate raises,
    # but silver is written first (per-entity publish), like the original job
    with pytest.raises(DataQualityError):
        pipeline.run_silver(spark, land["bronze"], current, root, TESTDATA_REFS, None, "r1")
    s = spark.read.parquet(os.path.join(root, "silver", "deposits"))
    assert s.where("fx_rate IS NULL").count() == 0
    q = spark.read.parquet(os.path.join(root, "quarantine", "deposits"))
    bronze_rows = spark.read.option("header", True).csv(os.path.join(land["bronze"], "deposits")).count()
    assert bronze_rows == s.count() + q.count()
    rep = spark.read.json(os.path.join(root, "quality", "dq_report"))
    assert rep.where("`check` = 'reconciliation' AND NOT passed").count() == 0
    # a repeated run replaces what it wrote
    def written():
        return [spark.read.json(os.path.join(root, "quality", "dq_report", "layer=silver", "run=r2")).count(),
                *[spark.read.parquet(os.path.join(root, *p)).count() for p in (
                    ("quarantine", "deposits", "run=r2"), ("ops", "run_metrics", "layer=silver", "run=r2"))]]
    seen = []
    for _ in range(2):
        pipeline.run_silver(spark, land["bronze"], current, root, TESTDATA_REFS, None, "r2", ["deposits"], False)
        seen.append(written())
    assert seen[0] == seen[1] and min(seen[0]) > 0
    # an entity that cannot be written is recorded, the next one is loaded
    def refuse(q, base, entity, *a, write=sinks.write_quarantine):
        if entity == "players":
            raise OSError("disk")
        return write(q, base, entity, *a)
    monkeypatch.setattr(sinks, "write_quarantine", refuse)
    with pytest.raises(RuntimeError, match="1 entity"):
        pipeline.run_silver(spark, land["bronze"], current, root, TESTDATA_REFS, None, "r3",
                            ["players", "campaigns"], False)
    metrics = spark.read.parquet(os.path.join(root, "ops", "run_metrics"))
    r3 = metrics.where("run = 'r3'")
    assert {r.entity for r in r3.select("entity").distinct().collect()} == {"campaigns"}
    row = r3.where("metric in ('RowsIngested', 'RowCount', 'RowsQuarantined')").groupBy().pivot("metric").sum(
        "value").first()
    assert row.RowsIngested == row.RowCount + row.RowsQuarantined > 0
    assert ops.degraded_alarm(metrics).count() == 0
    assert {"RowsIngested", "ProcessingDurationMs"} < set(ops.entity_rows(metrics).columns)
    gold = pipeline.run_gold(spark, root, root, TESTDATA_REFS, "r1", fail_on_error=False)
    assert gold["published"]["published"]
    s = spark.read.parquet(os.path.join(root, "silver", "deposits"))
    assert spark.read.parquet(os.path.join(root, "gold", "fact_deposit")).count() == s.count()
