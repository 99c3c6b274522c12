"""Scans (bronze CSV, Parquet, JSON quotes, DQ report) and test-table bindings."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BRONZE_CONTRACTS, FX_BASE
from ..functions import na_to_null
from ..session import stored_bytes


def table_path(spark: SparkSession, base: str, name: str) -> str:
    """``{base}/{name}.parquet`` (a file or a folder) or else ``{base}/{name}``, on the file system of ``base``."""
    path = os.path.join(base, f"{name}.parquet")
    return path if stored_bytes(spark, path) is not None else os.path.join(base, name)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet scan (S3)."""
    return spark.read.parquet(table_path(spark, base, name))


def read_bronze_csv(spark: SparkSession, path: str, ingest_date: str | None = None,
                    infer: bool = False, with_path: bool = False) -> DataFrame:
    """Raw CSV scan (S1/S2/S4), columns taken by header name on every file system.

    The frame has the header's own columns, so that the schema check sees drift.
    ``enforceSchema=false`` makes Spark hold each file's header against the first
    one's: a file in another column order fails, it is never bound by position.
    Every column is text unless ``infer`` (S2); NA tokens become null here, once.
    ``ingest_date`` reads that load day only; a day without files is empty, and a
    folder without load days cannot be asked for one. ``with_path`` adds each row's file as ``_path``.
    """
    reader = (spark.read.option("header", True).option("inferSchema", infer)
              .option("enforceSchema", False))
    df = None
    if ingest_date is not None:
        try:
            df = reader.option("basePath", path).csv(f"{path.rstrip('/')}/ingest_date={ingest_date}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if df is None:
        df = reader.csv(path)
        if ingest_date is not None:
            if "ingest_date" not in df.columns:
                raise ValueError(f"{path} has no load days, {ingest_date} cannot be read")
            df = df.where(F.col("ingest_date").cast("string") == ingest_date)
    path_ = [F.col("_metadata.file_path").alias("_path")] if with_path else []
    if infer:
        return df.select("*", *path_)
    return df.select(*[F.col(c) if c == "ingest_date" else na_to_null(c).alias(c) for c in df.columns], *path_)


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """The contract's columns and the load day; what the header lacks is null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in [*columns, "ingest_date"]])


def read_entities(spark: SparkSession, bronze_root: str, ingest_date: str | None = None,
                  entities: list[str] | None = None) -> tuple[dict[str, DataFrame], list[dict]]:
    """Read the selected bronze entities (S5); a missing or unreadable entity is
    recorded in ``failures`` and the others continue (S6)."""
    frames, failures = {}, []
    for entity in entities or list(BRONZE_CONTRACTS):
        path = os.path.join(bronze_root, entity)
        try:
            df = read_bronze_csv(spark, path, ingest_date)
            if "ingest_date" not in df.columns:
                df = df.withColumn("ingest_date", F.lit(None).cast("string"))
            frames[entity] = df
        except Exception as exc:  # noqa: BLE001
            failures.append({"entity": entity, "error": f"{type(exc).__name__}: {exc}"})
    return frames, failures


QUOTE_PAYLOAD = T.StructType([T.StructField(
    "rates", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())))])


def read_quote_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed quote payloads ``{"rates": {"YYYY-MM-DD": {"USD": x, "BRL": y}}}``.

    Each file is one payload; returns (pub_date, currency, per_base, payload_sha256).
    The base currency is never listed in a payload (it is 1 by definition).
    """
    raw = spark.read.option("wholetext", True).text(path)
    parsed = raw.select(F.from_json("value", QUOTE_PAYLOAD).alias("p"),
                        F.sha2(F.col("value"), 256).alias("payload_sha256"))
    days = parsed.select(F.explode("p.rates").alias("day", "quotes"), "payload_sha256")
    return (days.select(F.col("day").try_cast("date").alias("pub_date"),
                        F.explode("quotes").alias("currency", "per_base"), "payload_sha256")
            .where(F.col("currency") != FX_BASE))


class SourceUnavailable(RuntimeError):
    """A source has no data: its path is missing, unreadable or without a usable payload."""


#: Conditions under which Spark reports a missing or unreadable path.
UNREADABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE")


def _unreadable(e: Exception) -> bool:
    return isinstance(e, PySparkException) and (e.getCondition() or "").startswith(UNREADABLE)


def landed_quotes(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(quotes, hashes of their payloads); SourceUnavailable where there are none."""
    try:
        quotes = read_quote_files(spark, path)
        # one hash per landed payload file, which the calendar bounds
        digest = [r[0] for r in quotes.select("payload_sha256").distinct().orderBy("payload_sha256").collect()]
    except PySparkException as e:
        if not _unreadable(e):
            raise
        raise SourceUnavailable(str(e)) from e
    if not digest:
        raise SourceUnavailable(f"no payload with quotes under {path}")
    return quotes, digest


DQ_REPORT_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType()), T.StructField("check", T.StringType()),
    T.StructField("column", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("passed", T.BooleanType()), T.StructField("failed_records", T.LongType()),
    T.StructField("total_records", T.LongType()), T.StructField("failed_ratio", T.DoubleType()),
    T.StructField("details", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("checked_at", T.StringType()),
])


def read_dq_report(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines DQ report partitioned by ``ingest_date=``."""
    return spark.read.schema(DQ_REPORT_SCHEMA).json(path)


def read_dq_history(spark: SparkSession, path: str, layer: str = "silver") -> DataFrame:
    """The report's rows of the newest run of each load day (S7); a repeated load replaces what it found before.

    A load day's runs are told apart by ``checked_at``, then by the run's name. Only the report is read.
    """
    report = read_dq_report(spark, path).where(F.col("layer") == layer).withColumn(
        "ingest_date", F.col("ingest_date").cast("string")).withColumn("run", F.col("run").cast("string"))
    newest = report.groupBy("ingest_date").agg(F.max(F.struct("checked_at", "run")).alias("_at")).select(
        F.col("ingest_date").alias("_day"), F.col("_at.run").alias("_run"))  # a row for each load day
    return report.join(newest, F.col("ingest_date").eqNullSafe(F.col("_day")) & (F.col("run") == F.col("_run"))).drop(
        "_day", "_run")


def read_previous_fx(spark: SparkSession, current_path: str, start: str, end: str) -> DataFrame | None:
    """Degraded source (S12): use the previous snapshot only if it covers ``end``."""
    try:
        prev = spark.read.parquet(current_path)
    except PySparkException as e:
        if not _unreadable(e):
            raise
        return None
    covered = prev.agg(F.max("rate_date").alias("m")).first()["m"]
    if covered is None or covered < end:
        return None
    return prev.where((F.col("rate_date") >= start) & (F.col("rate_date") <= end))
