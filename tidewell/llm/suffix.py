"""Operator 9: suffix-array dedup with a run-length index.

A byte goes when a string of ``length`` (200) bytes that covers it starts
anywhere else too. Three steps keep the index to the text that can matter:

1. Anchors. Of the 64-byte strings inside each 200-byte string the one with the
   smallest hash is its anchor; equal strings have equal anchors, so an anchor
   that occurs once proves its strings unique. An anchor with the run of
   strings it stands for is a context (268 bytes on average).
2. Copies. Contexts are grouped by (anchor, hash of the context): one that
   occurs twice is repeated as a whole, and one of the copies represents them.
3. Index. Contexts that share an anchor with a different context are dealt to
   buckets by anchor. Each bucket gets a run-length Burrows-Wheeler index: runs
   with the suffix positions sampled at their heads. Longest matches with the
   neighbour suffix are computed at run heads only; inside a run they fall by
   one per step (the match ends at the same place), so marking both ends of
   each run head's match marks every long match of the bucket.

Anchors with more than ``HOT`` different contexts (a passage on thousands of
different pages) never meet in one bucket: their strings are hashed (128 bits)
and counted, which is exact as well and partially aggregated.

Texts are known by 128 bits of hash, so results do not depend on ids. Copies of
whole documents are one text: if it has 200 bytes, it goes entirely.

Results for odd rows: null text is empty (nothing removed); null ids and
repeated rows are rows like others (repeated rows are copies); an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import attach, materialise

LENGTH = 200
ANCHOR = 64
#: Contexts of one anchor that may meet in a bucket.
HOT = 4000
BUCKET_BYTES = 1 << 20
CHUNK_BITS = 20

_MULT = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if 0 not in _powers or len(_powers[0][0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, _MULT, dtype=np.uint64)
        down = np.full(size, pow(_MULT, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _powers[0] = (np.cumprod(up), np.cumprod(down))
    return _powers[0][0][:n], _powers[0][1][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-byte string of a byte array."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return _mix((sums[k:] - sums[:-k]) * down[:len(data) - k + 1])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    m, span = x, 1
    while 2 * span <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = w - span
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def contexts(chunk: np.ndarray, ends: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Contexts of the documents of a chunk (at most 2^20 bytes; ``ends``: where each document ends).

    Returns (document, start of the first string, start of the last, anchor's place, anchor's hash).
    """
    n, empty = len(chunk), np.zeros(0, dtype=np.int64)
    if n < length:
        return empty, empty, empty, empty, empty.astype(np.uint64)
    h = window_hashes(chunk, anchor)
    mask = np.uint64((1 << CHUNK_BITS) - 1)
    # Ties, which need equal upper bits, go to the left: the choice depends on the string alone.
    key = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    place = (_sliding_min(key, length - anchor + 1) & mask).astype(np.int64)
    starts = np.arange(n - length + 1)
    doc = np.searchsorted(ends, starts, side="right")
    ok = starts + length <= ends[doc]
    starts, doc, place = starts[ok], doc[ok], place[ok]
    if not len(starts):
        return empty, empty, empty, empty, empty.astype(np.uint64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return doc[first], starts[first], starts[last], place[first], h[place[first]]


def _chunks(keys: list, texts: list[bytes], length: int = LENGTH):
    """Documents laid out in chunks of at most 2^20 bytes; long ones overlap by length - 1."""
    size, out, used = 1 << CHUNK_BITS, [], 0
    for key, t in zip(keys, texts):
        step = size - length + 1
        for at in range(0, max(1, len(t) - length + 1), step):
            part = t[at:at + size]
            if len(part) < length:
                continue
            if used + len(part) > size:
                yield out
                out, used = [], 0
            out.append((key, at, part))
            used += len(part)
    if out:
        yield out


def _scan(keys: list, texts: list[bytes]) -> Iterator[tuple]:
    """(key, start, n starts, anchor's offset, anchor hash, context hash, context bytes) per chunk, as lists."""
    for chunk in _chunks(keys, texts):
        raw = b"".join(p for _, _, p in chunk)
        ends = np.cumsum([len(p) for _, _, p in chunk])
        doc, a, b, place, h = contexts(np.frombuffer(raw, dtype=np.uint8), ends)
        if not len(doc):
            continue
        base = ends - np.array([len(p) for _, _, p in chunk])
        shift = np.array([at for _, at, _ in chunk])[doc] - base[doc]
        rel = place - a
        digest = xxhash.xxh3_64_intdigest
        c = np.fromiter((digest(raw[s:e], r) for s, e, r in zip(a.tolist(), (b + LENGTH).tolist(), rel.tolist())),
                        dtype=np.uint64, count=len(a))
        yield [chunk[d][0] for d in doc], a + shift, b - a + 1, rel, h.view(np.int64), c.view(np.int64), raw, a


_ROWS = "k1 long, k2 long, start long, n_starts int, h long, c long"


def anchors(texts: DataFrame) -> DataFrame:
    """texts (k1, k2, bytes) -> one row for each context: text, first start, starts, anchor, context hash."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for keys, start, n, _, h, c, _, _ in _scan(list(zip(b["k1"], b["k2"])), list(b["bytes"])):
                k = np.array(keys, dtype=np.int64)
                yield pd.DataFrame({"k1": k[:, 0], "k2": k[:, 1], "start": start, "n_starts": n, "h": h, "c": c})

    return texts.mapInPandas(run, _ROWS)


class RunLengthIndex:
    """Run-length Burrows-Wheeler index of a few byte strings, with suffix positions at run heads.

    ``ends``: where each string ends in ``data``, which is where a byte follows that UTF-8 never uses.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data = data
        n = len(data)
        self.end_of = ends[np.searchsorted(ends, np.arange(n), side="left")]
        padded = np.concatenate([data, np.full(8, 0xFF, dtype=np.uint8)])
        eight = np.zeros(n, dtype=np.uint64)
        for k in range(8):
            eight = (eight << np.uint64(8)) | padded[k:k + n]
        order = np.argsort(eight, kind="stable")
        rank = self._ranks(order, eight[order])
        self.levels = [(8, rank)]  # ranks by the first 8, 16, ... bytes, for match lengths
        span = 8
        while span < n and rank.max(initial=0) + 1 < n:
            second = np.zeros(n, dtype=np.int64)
            second[:max(0, n - span)] = rank[span:] + 1
            key = (rank << np.int64(32)) | second
            order = np.argsort(key, kind="stable")
            rank, span = self._ranks(order, key[order]), span * 2
            self.levels.append((span, rank))
        self.suffixes = order
        before = np.where(order > 0, data[order - 1], 0xFF)
        head = np.ones(n, dtype=bool)
        # A string's own start has no byte before it and so heads a run of its own.
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0xFF)
        self.heads = np.flatnonzero(head)  # r runs; suffixes[heads] are the sampled positions

    @staticmethod
    def _ranks(order: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (sorted_keys[1:] != sorted_keys[:-1]).astype(np.int64)]))
        return rank

    def matches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """At each run head: its suffix, the suffix before it in order, and their match's length inside the strings."""
        rows = self.heads[self.heads > 0]
        a, b = self.suffixes[rows], self.suffixes[rows - 1]
        room = np.minimum(self.end_of[a] - a, self.end_of[b] - b)
        got = np.zeros(len(a), dtype=np.int64)
        n = len(self.data)
        for span, rank in reversed(self.levels):  # all ranks differ at the last level: each counts once
            x, y = a + got, b + got
            inside = (x < n) & (y < n) & (got < room)
            same = np.zeros(len(a), dtype=bool)
            same[inside] = rank[x[inside]] == rank[y[inside]]
            got[same] += span
        for _ in range(7):
            x, y = a + got, b + got
            inside = (x < n) & (y < n) & (got < room)
            same = np.zeros(len(a), dtype=bool)
            same[inside] = self.data[x[inside]] == self.data[y[inside]]
            got[same] += 1
        return a, b, np.minimum(got, room)

    def repeated(self, length: int) -> np.ndarray:
        """Per byte: is it covered by a string of ``length`` bytes that starts elsewhere too?"""
        a, b, got = self.matches()
        long = got >= length
        step = np.zeros(len(self.data) + 1, dtype=np.int64)
        for at in (a[long], b[long]):
            np.add.at(step, at, 1)
            np.add.at(step, at + got[long], -1)
        return np.cumsum(step[:-1]) > 0


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def repeated_in(parts: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Per byte string of a small collection: its spans that repeat within the collection."""
    data = np.frombuffer(b"".join(p + b"\xff" for p in parts), dtype=np.uint8)
    sizes = np.array([len(p) + 1 for p in parts])
    ends = np.cumsum(sizes) - 1
    marked = RunLengthIndex(data, ends).repeated(length)
    return [_runs(marked[e - s + 1:e]) for s, e in zip(sizes.tolist(), ends.tolist())]


_SPANS = "k1 long, k2 long, start long, stop long"


def _index_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    out = []
    found = repeated_in(list(rows["bytes"]))
    for k1, k2, at, single, spans in zip(rows["k1"], rows["k2"], rows["start"], rows["single"], found):
        if single:
            out += [(k1, k2, at + a, at + b) for a, b in spans]
    return pd.DataFrame(out, columns=["k1", "k2", "start", "stop"]).astype("int64")


def _string_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    digest = xxhash.xxh3_128_intdigest
    for b in batches:
        rows = []
        for k1, k2, at, single, raw in zip(b["k1"], b["k2"], b["start"], b["single"], b["bytes"]):
            for o in range(len(raw) - LENGTH + 1):
                d = digest(raw[o:o + LENGTH])
                rows.append((k1, k2, at + o, bool(single), (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63)))
        yield pd.DataFrame(rows, columns=["k1", "k2", "start", "single", "hi", "lo"]).astype(
            {"k1": "int64", "k2": "int64", "start": "int64", "single": bool, "hi": "int64", "lo": "int64"})


def repeated_spans(texts: DataFrame) -> DataFrame:
    """texts (k1, k2, bytes), distinct -> (k1, k2, start, stop): spans that cover all repeated strings."""
    spark = texts.sparkSession
    found = anchors(texts)
    classes = found.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min("k1").alias("k1_0"))
    classes = materialise(classes, "suffix-classes")
    # Anchors that occur once are done with here.
    seen = classes.groupBy("h").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")).where("all > 1")
    classes = materialise(classes.join(seen.drop("all"), "h"), "suffix-repeated")
    placed = found.join(classes, ["h", "c"])
    placed = materialise(placed.where("n > 1 or kinds > 1"), "suffix-places")
    whole = placed.where("n > 1").select("k1", "k2", "start", (F.col("start") + F.col("n_starts") + LENGTH - 1).alias("stop"))
    # What has to be compared byte by byte: single contexts, and one copy of each repeated one.
    single = placed.where("n = 1 and kinds > 1").select("k1", "k2", "start", "n_starts", "h", "kinds", F.lit(True).alias("single"))
    copies = placed.where("n > 1 and kinds > 1 and k1 = k1_0").dropDuplicates(["h", "c"]).select(
        "k1", "k2", "start", "n_starts", "h", "kinds", F.lit(False).alias("single"))
    wanted = single.unionByName(copies).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("start", "n_starts", "h", "kinds", "single")).alias("at"))
    cut = texts.join(wanted, ["k1", "k2"]).select("k1", "k2", "bytes", F.explode("at").alias("a")).select(
        "k1", "k2", "a.*", F.substring(F.col("bytes"), F.col("a.start").cast("int") + 1,
                                       F.col("a.n_starts").cast("int") + LENGTH - 1).alias("bytes"))
    cut = materialise(cut, "suffix-contexts")
    cold = cut.where(F.col("kinds") <= HOT)
    total = cold.agg(F.sum(F.length("bytes"))).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_BYTES))
    near = cold.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets))).groupBy("bucket").applyInPandas(
        _index_bucket, _SPANS)
    spans = whole.unionByName(near)
    hot = cut.where(F.col("kinds") > HOT)
    if not hot.isEmpty():
        strings = materialise(hot.select("k1", "k2", "start", "single", "bytes").mapInPandas(
            _string_hashes, "k1 long, k2 long, start long, single boolean, hi long, lo long"), "suffix-strings")
        twice = strings.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        spans = spans.unionByName(strings.where("single").join(twice, ["hi", "lo"]).select(
            "k1", "k2", "start", (F.col("start") + LENGTH).alias("stop")))
    return spans


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), F.col("text")).alias("k2"),
                       F.col("text").cast("binary").alias("bytes"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed, as [start, stop) bytes)."""
    rows = _keyed(docs, id_col, text_col)
    long = F.length("bytes") >= LENGTH
    copies = materialise(rows.where(long).groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).where("n > 1"), "suffix-copies")
    # Of whole copies one stands for all; rows with the same id, or none, may add equal texts, which changes nothing:
    # such a text is repeated anyway.
    known = attach(rows.where(long), copies, ["k1", "k2"])
    texts = known.where("n is null or doc_id <=> first").select("k1", "k2", "bytes")
    spans = repeated_spans(texts)
    per_text = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("cover"))
    met = attach(rows, copies.select("k1", "k2", "n"), ["k1", "k2"]).join(per_text, ["k1", "k2"], "left")

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                  "spans array<struct<start:long,stop:long>>")
    def apply(raw: pd.Series, n: pd.Series, cover: pd.Series) -> pd.DataFrame:
        out = []
        for t, copies, c in zip(raw, n, cover):
            if copies == copies and copies is not None and copies > 1:
                merged = [(0, len(t))]
            else:
                merged = merge(sorted((x["start"], x["stop"]) for x in c) if c is not None else [])
            kept, at = hashlib.sha256(), 0
            for a, b in merged:
                kept.update(t[at:a])
                at = b
            kept.update(t[at:])
            out.append((len(t), sum(b - a for a, b in merged), len(merged), kept.hexdigest(),
                        [{"start": a, "stop": b} for a, b in merged]))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return met.withColumn("r", apply("bytes", "n", "cover")).select("doc_id", "r.*")


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans -> maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out
