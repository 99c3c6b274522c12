"""Operator 1: SimHash near-duplicates by a segment-popcount embedding.

A fingerprint of 64 bits is cut into 32 segments of two bits; the vector of
the segments' bit counts is its embedding. The Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints, so a range
join over the embeddings finds every pair. The grid of that join has six axes
(runs of segments): of six parts of a vector at distance ``max_bits`` <= 4 at
least two are equal, so each fingerprint enters the cells of all 15 pairs of
axes, and two fingerprints meet in the cell of their first two equal axes.
Pairs that meet are checked by Manhattan distance, then by exact bits.

Only distinct fingerprints are joined (copies are one row with a count), a pair
leaves the join once and only when it is verified, and components come from
the links by label propagation on the cluster.

Results for odd rows: null or empty text has fingerprint 0 and is linked like
any other; a null ``doc_id`` takes part, its component is the smallest known id
reachable (null if none); repeated rows stay repeated; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import attach, materialise
from tidewell.llm.components import components

SEED = 42
AXES = 6
PAIRS = list(combinations(range(AXES), 2))


def _mask(axis: int) -> int:
    """Bits of the segments of one axis (32 segments dealt over the axes in runs)."""
    lo, hi = axis * 32 // AXES, (axis + 1) * 32 // AXES
    return sum(3 << 2 * s for s in range(lo, hi))


MASKS = [_mask(k) for k in range(AXES)]


def fingerprint(text: str | None, words: int = 4) -> int:
    """Unsigned 64-bit SimHash over word shingles, repeats included."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only, as asked
    if not ws:
        return 0
    joined = b" ".join(ws)
    ends = np.cumsum([len(w) + 1 for w in ws])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    if len(ws) <= words:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1:])]
    n, ones = len(hashes), np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, words) for t in b["text"]), dtype=np.uint64, count=len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp.view(np.int64)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInPandas(
        run, "doc_id long, fp long")


def embed(fp):
    """Segment popcounts as a thermometer code: 0, 1, 2 set bits -> 00, 01, 11.

    The Manhattan distance of two embeddings is the number of differing bits.
    """
    low = F.lit(0x5555555555555555)
    right = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(right).bitwiseAND(low).bitwiseOR(
        F.shiftleft(fp.bitwiseAND(right).bitwiseAND(low), 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def grid(nodes: DataFrame) -> DataFrame:
    """(fp) -> (cell, at, fp, emb): one row for each pair of axes."""
    emb = nodes.select("fp", embed(F.col("fp")).alias("emb"))
    cells = F.array(*[F.struct(F.lit(k).alias("cell"), F.col("emb").bitwiseAND(
        F.lit(_signed(MASKS[i] | MASKS[j]))).alias("at")) for k, (i, j) in enumerate(PAIRS)])
    return emb.select("fp", "emb", F.explode(cells).alias("c")).select("c.cell", "c.at", "fp", "emb")


def _first_meeting(x):
    """True in the cell of the first two equal axes: no pair is reported twice."""
    differs = [x.bitwiseAND(F.lit(_signed(m))) != 0 for m in MASKS]
    out = F.lit(True)
    for k, (i, j) in enumerate(PAIRS):
        before = [differs[g] for g in range(j) if g != i]
        if before:
            said = before[0]
            for d in before[1:]:
                said = said & d
            out = F.when(F.col("l.cell") == k, said).otherwise(out)
    return out


def near_pairs(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """(fp) distinct -> (a, b), a < b: all pairs at ``max_bits`` differing bits or fewer."""
    if not 0 <= max_bits <= AXES - 2:
        raise ValueError(f"the grid covers distances up to {AXES - 2}")
    cells = grid(nodes)
    x = F.col("l.emb").bitwiseXOR(F.col("r.emb"))
    met = cells.alias("l").join(
        cells.alias("r"),
        (F.col("l.cell") == F.col("r.cell")) & (F.col("l.at") == F.col("r.at"))
        & (F.col("l.fp") < F.col("r.fp")) & (F.bit_count(x) <= max_bits)
        & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= max_bits) & _first_meeting(x))
    return met.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def _placed(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, fp, root, component_id, component_size."""
    marks = materialise(fingerprints(docs, words, id_col, text_col), "simhash-marks")
    classes = materialise(marks.groupBy("fp").agg(F.min("doc_id").alias("first"),
                                                  F.count(F.lit(1)).alias("n")), "simhash-classes")
    roots = components(near_pairs(classes.select("fp"), max_bits), "simhash")
    placed = attach(classes, roots.withColumnRenamed("node", "fp"), ["fp"]).withColumn(
        "root", F.coalesce("root", "fp"))
    # Only classes that hang together need the sums; the others are their own component.
    tops = placed.groupBy("root").agg(F.min("first").alias("component_id"),
                                      F.sum("n").alias("component_size"))
    per_class = materialise(placed.join(tops, "root").select("fp", "root", "component_id", "component_size"),
                            "simhash-components")
    return marks.join(per_class, "fp").select("doc_id", "fp", "root", "component_id", "component_size")


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, component_id, component_size (documents)."""
    return _placed(docs, words, max_bits, id_col, text_col).drop("root")


def fp_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` without near duplicates: of each component the row of its smallest doc_id.

    Rows without a doc_id are their component's last: one stays only where the whole
    component has none. Rows that share a doc_id, or have none, are told apart by their
    texts: each component that starts with it keeps one of them, of the smallest
    fingerprint, then text hash. The texts meet the ids that go (and the repeated ones),
    not those that stay: the shorter list of the two.
    """
    found = _placed(docs, words, max_bits, "doc_id", "text")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    odd = materialise(found.groupBy("doc_id").agg(
        F.count_if(first).alias("n"), F.count(F.lit(1)).alias("rows")).where("n <> 1 or rows > 1"), "simhash-odd")
    odd = odd.select(F.col("doc_id").alias("odd__"), "n")
    kept = docs.join(odd, docs["doc_id"].eqNullSafe(odd["odd__"]), "left_anti")
    again = odd.where("n > 0").select("odd__")
    if not again.isEmpty():
        firsts = found.where(first).join(again, F.col("doc_id").eqNullSafe(F.col("odd__")), "left_semi")
        firsts = materialise(firsts.groupBy("doc_id", "root").agg(F.min("fp").alias("fp")).select(
            F.col("doc_id").alias("first__"), F.col("fp").alias("mark__")), "simhash-firsts")

        @F.pandas_udf("long")
        def mark(text: pd.Series) -> pd.Series:
            fps = np.fromiter((fingerprint(t, words) for t in text), dtype=np.uint64, count=len(text))
            return pd.Series(fps.view(np.int64))

        rows = docs.join(again, docs["doc_id"].eqNullSafe(again["odd__"]), "left_semi").select(
            docs.columns).select(F.struct("*").alias("row__"))
        rows = rows.select("row__", F.col("row__.doc_id").cast("long").alias("id__"),
                           F.col("row__.text").cast("string").alias("text__")).withColumn("fp__", mark("text__"))
        rows = rows.join(firsts, F.col("id__").eqNullSafe(F.col("first__")) & (F.col("fp__") == F.col("mark__")), "left_semi")
        one = rows.groupBy("id__", "fp__").agg(F.min_by("row__", F.xxhash64("text__")).alias("row__"))
        kept = kept.unionByName(one.select("row__.*"))
    return kept.select(docs.columns)
