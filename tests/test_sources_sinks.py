"""Scans, sinks, catalog registration and degraded FX on small files."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from tidewell import sinks, sources
from tidewell.config import BRONZE_CONTRACTS
from tidewell.plans import pipeline, views


def _tmp():
    return tempfile.mkdtemp(prefix="tidewell-io-")


def test_csv_scan_text_and_inferred(spark):
    root = _tmp()
    p = os.path.join(root, "players", "ingest_date=2024-04-01")
    os.makedirs(p)
    with open(os.path.join(p, "players.csv"), "w", newline="") as fh:
        fh.write("player_id,signup_date,acquisition_channel,country,preferred_currency,kyc_status,"
                 "self_excluded\r\n")
        fh.write("P00001,2023-08-01,,BR,BRL,verified,false\r\n")
        fh.write("P00002,2023-08-02,NA,PT,EUR,pending,true\r\n")
        fh.write("P00003,2023-08-03,seo,AO,USD,nan,false\r\n")
    frames, failures = sources.read_entities(spark, root, "2024-04-01", ["players", "bets"])
    assert list(frames) == ["players"] and failures and failures[0]["entity"] == "bets"
    rows = frames["players"].orderBy("player_id").collect()
    assert [r.acquisition_channel for r in rows] == [None, None, "seo"]
    assert rows[2].kyc_status is None and rows[0].self_excluded == "false"
    assert all(t == "string" for c, t in frames["players"].dtypes if c != "ingest_date")
    inferred = sources.read_bronze_csv(spark, p, infer=True)
    assert dict(inferred.dtypes)["self_excluded"] == "boolean"
    pruned = sources.read_bronze_csv(spark, os.path.join(root, "players"), "2099-01-01")
    assert pruned.count() == 0


def _csv(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as fh:
        fh.write(text)


def test_csv_columns_go_by_header_and_drift_is_reported(spark):
    from tidewell.operators import dq

    cols = BRONZE_CONTRACTS["campaigns"].columns
    swapped = [cols[1], cols[0], *cols[2:]]
    flat = _tmp()
    _csv(flat, "a.csv", ",".join(swapped) + "\nx,C001" + ",v" * (len(cols) - 2) + "\n")
    row = sources.read_bronze_csv(spark, flat).first()
    assert row[cols[0]] == "C001" and row[cols[1]] == "x"  # a flat folder, other column order
    for header, drift in ((cols + ["more"], 1), (cols[:-1], 1), (swapped, 0)):
        root = _tmp()
        _csv(os.path.join(root, "campaigns", "ingest_date=2024-04-01"), "a.csv",
             ",".join(header) + "\n" + ",".join(["1"] * len(header)) + "\n")
        frames, failures = sources.read_entities(spark, root, "2024-04-01", ["campaigns"])
        assert not failures
        res = dq.run_contract(frames["campaigns"], "campaigns", BRONZE_CONTRACTS["campaigns"],
                              group_cols=["ingest_date"]).where("`check` = 'schema_contract'").collect()
        assert [(r.passed, r.failed_records) for r in res] == [(drift == 0, drift)]
        assert sources.conform(frames["campaigns"], cols).columns == [*cols, "ingest_date"]


def test_csv_files_with_other_headers_fail_and_flat_folders_have_no_days(spark):
    import pytest

    mixed = _tmp()
    _csv(mixed, "a.csv", "p,q\n1,2\n")
    _csv(mixed, "b.csv", "q,p\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_bronze_csv(spark, mixed).collect()
    with pytest.raises(ValueError):
        sources.read_bronze_csv(spark, mixed, "2024-04-01")


def test_quote_payload_scan_and_hash(spark):
    root = _tmp()
    with open(os.path.join(root, "q.json"), "w") as fh:
        json.dump({"rates": {"2024-01-05": {"USD": 1.1, "BRL": 5.4}, "2024-01-08": {"BRL": 5.5}}}, fh)
    q = sources.read_quote_files(spark, root)
    got = sorted((str(r.pub_date), r.currency, r.per_base) for r in q.collect())
    assert got == [("2024-01-05", "BRL", 5.4), ("2024-01-05", "USD", 1.1), ("2024-01-08", "BRL", 5.5)]
    assert len(q.select("payload_sha256").distinct().first()[0]) == 64


def test_dq_report_roundtrip_and_degraded_fx(spark):
    root = _tmp()
    res = spark.createDataFrame(
        [("players", "not_blank", "country", "ERROR", True, 0, 10, 0.0)],
        "entity string, check string, column string, severity string, passed boolean, "
        "failed_records bigint, total_records bigint, failed_ratio double")
    assert sinks.write_dq_report(res, root, "2024-04-01", "r1", "2024-04-01T03:00:00+00:00")
    back = sources.read_dq_report(spark, os.path.join(root, "quality", "dq_report"))
    r = back.first()
    assert r.run_id == "r1" and str(r.ingest_date) == "2024-04-01" and r.entity == "players"
    # degraded FX: a previous 'current' snapshot covering the window is used when quotes fail
    qdir = os.path.join(root, "q")
    os.makedirs(qdir)
    with open(os.path.join(qdir, "a.json"), "w") as fh:
        json.dump({"rates": {"2024-01-05": {"USD": 1.0, "BRL": 5.0}}}, fh)
    start, end = dt.date(2024, 1, 5), dt.date(2024, 1, 7)
    ok = pipeline.run_fx(spark, qdir, root, start, end, "r1", "2024-01-07")
    assert not ok["degraded_mode"] and ok["output"]["rows"] == 9
    again = pipeline.run_fx(spark, os.path.join(root, "missing"), root, start, end, "r2", "2024-01-08")
    assert again["degraded_mode"] and again["dq"]["errors"] == 0


def test_register_tables_and_views(spark):
    root = _tmp()
    df = spark.range(3).select(F.col("id").cast("int").alias("date_key"))
    sinks.write_parquet(df, os.path.join(root, "gold", "dim_date"))
    created = views.register_tables(spark, root, "tw_test")
    assert created == ["tw_test.dim_date"]
    assert spark.sql("SELECT count(*) AS n FROM tw_test.dim_date").first().n == 3


def test_register_views_sql_matches_dataframe(spark):
    from tidewell.plans import catalog

    lake = catalog.lake(spark, "/root/testdata/sf0.001")
    names = views.register_views(spark, lake)
    assert "vw_player_360" in names
    n_sql = spark.sql("SELECT count(*) AS n FROM vw_player_360 WHERE value_tier <> 'sem_faixa'").first().n
    n_df = catalog.queries()["value_tiers"](spark, "/root/testdata/sf0.001").count()
    assert n_sql == n_df
    seg = spark.sql("SELECT sum(jogadores) AS n FROM vw_segmentos_valor").first().n
    assert seg > 0
