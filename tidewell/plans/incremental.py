"""Incremental silver loads: a ledger of loaded files, and rows held against earlier loads.

A run without a load day takes what has landed since the last run: the files of
every entity that the ledger does not hold with their length and time of change.
Their load days prune the scan; where a day was loaded before, only its new
files are read. New rows are held against the digests of all rows that earlier
loads wrote: a row that is sent again is quarantined (``RESENT``), however many
days later. Typed rows, quarantine, digests and ledger of all entities become
visible by one manifest (``sinks.manifest``), so a run that stops halfway has
loaded nothing, and a repeated run over the same landing loads nothing either.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import sinks, sources
from ..config import BRONZE_CONTRACTS, Contract, References
from ..operators import silver as sv
from ..session import materialise
from ..sinks import manifest

#: Quarantine reason of a row that an earlier load (or an earlier day of this one) has written.
RESENT = "duplicate_of_earlier_load"
DAY = "ingest_date"
DIGEST = "row_digest"
BASE = "silver_loads"


def digest(columns: list[str]) -> F.Column:
    """32 bytes over all columns; nulls and borders between columns count."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}), 256))


def split_new(rows: DataFrame, contract: Contract, ref: _dt.date,
              earlier: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) of newly landed rows against the digests of ``earlier`` loads.

    The first copy of a row on its earliest load day is clean unless an earlier load wrote it or it is
    future-dated; further copies of that day are ``duplicate_row``, the others ``RESENT``. Both frames
    have the contract's columns, the load day and the digest. Copies are counted before any shuffle of
    rows; what is sent again is found by an anti join on digests.
    """
    cols = contract.columns
    groups = sv.collapse(rows, [*cols, DAY]).withColumn(DIGEST, digest(cols))
    # one row per load day that holds the digest: the window is bounded by the days of this run
    groups = groups.withColumn("_first", F.min(DAY).over(Window.partitionBy(DIGEST)).eqNullSafe(F.col(DAY)))
    if earlier is not None:
        known = earlier.select(DIGEST).distinct().withColumn("_known", F.lit(True))
        groups = groups.join(known, DIGEST, "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    else:
        groups = groups.withColumn("_known", F.lit(False))
    fresh = F.col("_first") & ~F.col("_known")
    groups = groups.withColumn("_future", F.when(fresh, sv.future_reason(contract, ref)))
    out = [*cols, DAY, DIGEST]
    clean = groups.where(fresh & F.col("_future").isNull()).select(*out)
    future = groups.where(F.col("_future").isNotNull()).select(*out, F.col("_future").alias(sv.REASON))
    copies = groups.select(*out, F.when(fresh, F.lit("duplicate_row")).otherwise(RESENT).alias(sv.REASON),
                           (F.col(sv.COPIES) - F.when(fresh, 1).otherwise(0)).alias("_extra"))
    return clean, sv.expand_copies(copies, "_extra").unionByName(future)


def outcomes(clean: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows per load day and outcome: ``written`` or the quarantine reason."""
    tagged = clean.select(DAY, F.lit("written").alias("outcome")).unionByName(
        quarantine.select(DAY, F.col(sv.REASON).alias("outcome")))
    return tagged.groupBy(DAY, "outcome").agg(F.count(F.lit(1)).alias("rows"))


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length, modified, ingest_date of the files under ``path`` (their content is not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.csv").load(path)
    day = F.regexp_extract("path", f"{DAY}=([^/]+)/", 1)
    return files.select("path", "length", F.col("modificationTime").alias("modified"),
                        F.when(day != "", day).alias(DAY))


def fresh_files(spark: SparkSession, bronze_root: str, base: str, entity: str, state: dict | None,
                ingest_date: str | None = None) -> DataFrame:
    """Landed files of an entity that the ledger does not hold as they are now."""
    files = landed_files(spark, os.path.join(bronze_root, entity))
    if ingest_date is not None:
        files = files.where(F.col(DAY) == ingest_date)
    ledger = _published(spark, base, state, f"{entity}_ledger")
    keys = ["path", "length", "modified"]
    return files.join(ledger.select(*keys), keys, "left_anti") if ledger is not None else files


def _published(spark: SparkSession, base: str, state: dict | None, table: str) -> DataFrame | None:
    if state is None or table not in state["tables"]:
        return None
    return spark.read.parquet(*[os.path.join(base, p) for p in manifest.folders(state["tables"][table])])


def read_fresh(spark: SparkSession, bronze_root: str, entity: str, files: DataFrame) -> DataFrame:
    """Rows of the fresh files only: their days prune the scan, their paths the files of a day."""
    days = [r[0] for r in files.select(DAY).distinct().collect()]  # bounded by the calendar
    path = os.path.join(bronze_root, entity)
    rows = sources.read_bronze_csv(spark, path, with_path=True)
    if days and None not in days:
        rows = rows.where(F.col(DAY).cast("string").isin(days))
    rows = rows.join(files.select(F.col("path").alias("_path")), "_path", "left_semi").drop("_path")
    if DAY not in rows.columns:
        rows = rows.withColumn(DAY, F.lit(None).cast("string"))
    return sources.conform(rows, BRONZE_CONTRACTS[entity].columns).withColumn(DAY, F.col(DAY).cast("string"))


def run(spark: SparkSession, bronze_root: str, out_base: str, refs: References, run_id: str, typed,
        ingest_date: str | None = None, entities: list[str] | None = None) -> dict:
    """Load what landed since the last run (or the new files of ``ingest_date``) of every entity.

    ``typed(entity, clean rows)`` gives the silver rows. Returns the counts per entity and the number of
    the manifest (that of the state before, if nothing had landed).
    """
    base = os.path.join(out_base, BASE)
    state = manifest.load(spark, base)
    tables = dict(state["tables"]) if state else {}
    folder, results = manifest.run_folder(run_id), {}

    def add(table: str, df: DataFrame) -> dict:
        info = sinks.write_parquet(df, os.path.join(base, table, folder), "overwrite")
        old = tables.get(table)
        tables[table] = {"paths": (manifest.folders(old) if old else []) + [f"{table}/{folder}"],
                         "rows": info["rows"] + (old["rows"] if old else 0)}
        return info

    for e in entities or list(BRONZE_CONTRACTS):
        files = materialise(fresh_files(spark, bronze_root, base, e, state, ingest_date), f"fresh-{e}")
        if files.isEmpty():
            continue
        contract = BRONZE_CONTRACTS[e]
        rows = read_fresh(spark, bronze_root, e, files)
        clean, quarantine = split_new(rows, contract, refs.quarantine[e],
                                      _published(spark, base, state, f"{e}_digests"))
        clean = materialise(clean, f"clean-{e}")
        q = add(f"{e}_quarantine", quarantine.drop(DIGEST).withColumn("_run_id", F.lit(run_id)))
        w = add(e, typed(e, clean.drop(DIGEST, DAY)))
        add(f"{e}_digests", clean.select(DIGEST, DAY))
        add(f"{e}_ledger", files.withColumn("run_id", F.lit(run_id)))
        rows_in = int(rows.count())
        results[e] = {"rows_ingested": rows_in, "rows_written": w["rows"], "rows_quarantined": q["rows"],
                      "reconciled": rows_in == w["rows"] + q["rows"],
                      "days": sorted(r[0] or "" for r in files.select(DAY).distinct().collect())}
        if not results[e]["reconciled"]:
            raise sinks.DataQualityError(f"{e}: {results[e]}")
    version = manifest.commit(spark, base, run_id, tables) if results else (state or {}).get("version")
    return {"run_id": run_id, "version": version, "results": results}
