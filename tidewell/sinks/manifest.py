"""Publication of a set of tables that readers see whole or not at all (K6).

Every publication writes its tables once, each into a folder of its own
(``{base}/{table}/run={run}``), and then a manifest that names those folders.
Manifests are numbered files under ``{base}/_manifest``; the one with the
highest number is the published state. A manifest appears by one rename that
never replaces an existing file: before it readers get the former set, after it
the new one, and of two writers that took the same number one has to retry with
the next. A run that stops earlier leaves folders that no manifest names.
``vacuum`` removes those, and what only older manifests name.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_manifest"
_DIGITS = 12


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the manifests under ``base``, rising."""
    return [int(n[:-5]) for n in _names(spark, os.path.join(base, FOLDER)) if n.endswith(".json") and n[:-5].isdigit()]


def _file(base: str, version: int) -> str:
    return os.path.join(base, FOLDER, f"{version:0{_DIGITS}d}.json")


def load(spark: SparkSession, base: str, version: int | None = None) -> dict | None:
    """The published manifest (or that of ``version``); None where nothing was published."""
    if version is None:
        there = versions(spark, base)
        if not there:
            return None
        version = there[-1]
    text = spark.read.option("wholetext", True).text(_file(base, version)).first()["value"]
    return json.loads(text)


def paths_of(spark: SparkSession, base: str, table: str, version: int | None = None) -> list[str]:
    """Folders of a published table (one, or one per load of a table that grows); none where it is not published."""
    entry = ((load(spark, base, version) or {}).get("tables") or {}).get(table)
    return [os.path.join(base, p) for p in folders(entry)] if entry else []


def folders(entry: dict) -> list[str]:
    """Folders under the base that a manifest's entry names."""
    return entry["paths"] if "paths" in entry else [entry["path"]]


def read(spark: SparkSession, base: str, table: str, version: int | None = None) -> DataFrame:
    """A published table. Take ``version`` from one ``load`` to read several tables of one state."""
    paths = paths_of(spark, base, table, version)
    if not paths:
        raise FileNotFoundError(f"{table} is not published under {base}")
    return spark.read.parquet(*paths)


def run_folder(run_id: str) -> str:
    """Name of a run's folder; another one for each attempt, so that a retry never writes into published files."""
    return f"run={run_id}.{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, base: str, run_id: str, tables: dict[str, dict], attempts: int = 20) -> int:
    """Switch the published state to ``tables`` (name -> path under ``base``, rows, ...); returns its number."""
    folder = os.path.join(base, FOLDER)
    fs, at = _fs(spark, folder)
    fs.mkdirs(at)
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    for _ in range(attempts):
        version = max(versions(spark, base), default=0) + 1
        draft = hadoop.Path(os.path.join(folder, f".draft-{uuid.uuid4().hex}"))
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps({"version": version, "run_id": run_id, "committed_at": time.time(),
                                        "tables": tables}, sort_keys=True).encode()))
        out.close()
        options = spark._jvm.java.lang.reflect.Array.newInstance(
            spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(draft, hadoop.Path(_file(base, version)), options)
            return version
        except Exception as e:  # the number is taken: another writer was first
            fs.delete(draft, False)
            kind = getattr(e, "java_exception", None)
            if kind is None or "FileAlreadyExists" not in kind.getClass().getName():
                raise
    raise RuntimeError(f"no free manifest number under {base} after {attempts} attempts")


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove the run folders that the last ``keep`` manifests don't name, and older manifests.

    Not to be called while a publication under ``base`` runs: its folders are not named yet.
    """
    there = versions(spark, base)
    kept = [load(spark, base, v) for v in there[-keep:]]
    named = {p for m in kept for t in m["tables"].values() for p in folders(t)}
    gone = []
    for table in _names(spark, base):
        if table.startswith(("_", ".")):
            continue
        for run in _names(spark, os.path.join(base, table)):
            path = f"{table}/{run}"
            if run.startswith("run=") and path not in named:
                fs, p = _fs(spark, os.path.join(base, path))
                fs.delete(p, True)
                gone.append(path)
    for v in there[:-keep]:
        fs, p = _fs(spark, _file(base, v))
        fs.delete(p, False)
    return gone
