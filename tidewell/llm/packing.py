"""Operator 6: best-fit decreasing packing of tokenised documents.

Best-fit decreasing looks at lengths only, and there are at most ``capacity``
of them. So documents are cut into pieces and counted by length on the
cluster, the driver packs the histogram (a bounded table whatever the corpus)
and returns placements: runs of equally long pieces that go to runs of bins.
A segment tree over remaining capacities gives the tightest open bin that
still takes a length in logarithmic time; equal bins are one run, so the
result is that of best-fit decreasing over all documents at once, not per
partition. Pieces get a rank within their length (prefix counts over salted
slots, so a hot length is many small groups) and look up their placement.

Results for odd rows: null or empty text is the end mark alone, one token; a
null doc_id is kept; repeated rows are packed as often as they come; an empty
table gives an empty table.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import materialise

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
END = 0
#: Ranks are numbered in groups of about this many pieces.
SLOT = 50_000

_coders: dict[str, "Coder"] = {}


#: Fixed value: the published split pattern of byte-level BPE vocabularies of this kind.
BYTE_LEVEL = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _bytes_of_symbols() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on in rising order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Coder:
    """Token ids of whole texts as bytes (little-endian unsigned 32-bit), those that ``tokenizers`` gives.

    A byte-level BPE whose merges are numbered like their tokens is a table of
    ranks, which ``tiktoken`` applies several times faster; the table is built
    from the tokenizer's own file. A file of any other kind, and a text that
    the fast way refuses, goes through ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = self._ranked()

    def _ranked(self):
        import tiktoken

        file = json.loads(self.tokenizer.to_str())
        model, split = file["model"], file["pre_tokenizer"] or {}
        added = file.get("added_tokens") or []
        plain = (model["type"] == "BPE" and not file["normalizer"] and split.get("type") == "ByteLevel"
                 and split.get("use_regex") and not split.get("add_prefix_space")
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                    "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                 and not any(t[k] for t in added for k in ("lstrip", "rstrip", "single_word", "normalized")))
        if not plain:
            return None
        symbols, vocab = _bytes_of_symbols(), model["vocab"]
        names = {t["content"] for t in added}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(set(merged)) or len(vocab) != 256 + len(merged) + len(names & vocab.keys()):
            return None
        ranks = {bytes(symbols[c] for c in token): i for token, i in vocab.items() if token not in names}
        return tiktoken.Encoding(name="ranked", pat_str=BYTE_LEVEL, mergeable_ranks=ranks,
                                 special_tokens={t["content"]: t["id"] for t in added})

    def _one(self, text: str) -> bytes:
        if self.fast is not None:
            try:
                return array("I", self.fast.encode(text, allowed_special="all")).tobytes()
            except (ValueError, RecursionError):  # a run too long for its pattern matcher
                pass
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        once = {t: self._one(t) for t in dict.fromkeys(texts)}
        return [once[t] for t in texts]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def coder(path: str | None = None) -> Coder:
    path = path or tokenizer_path()
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than capacity."""
    first = n % capacity or capacity
    return [(0, min(first, n))] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: a row for each piece of each document."""
    end = np.array([END], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = coder(tokenizer)
        for b in batches:
            rows = []
            for k in range(0, len(b), 256):
                part = b.iloc[k:k + 256]
                for doc, ids in zip(part["doc_id"], code.encode([t or "" for t in part["text"]])):
                    ids += end
                    for i, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append((doc, i, s, n, zlib.crc32(ids[4 * s:4 * (s + n)])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInPandas(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Tightest:
    """Segment tree over remaining capacities: which of them have open bins."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, room: int, there: bool) -> None:
        k = room + self.leaves
        self.any[k] = there
        while k > 1:
            k //= 2
            self.any[k] = self.any[2 * k] or self.any[2 * k + 1]

    def at_least(self, room: int) -> int | None:
        """The smallest capacity >= room with an open bin."""
        k = room + self.leaves
        if self.any[k]:
            return room
        while k > 1:
            if k % 2 == 0 and self.any[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.any[2 * k] else 2 * k + 1
                return k - self.leaves
            k //= 2
        return None


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Best-fit decreasing of a histogram of lengths.

    Returns placements (length, rank, count, bin, each, offset): the ``count``
    pieces of that length from ``rank`` on fill bins from ``bin`` on, ``each``
    of them to a bin, the first at ``offset`` in its bin.
    """
    tree, open_, bins, out = Tightest(capacity), defaultdict(deque), 0, []

    def push(room: int, start: int, n: int) -> None:
        if room and n:
            open_[room].appendleft((start, n))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.at_least(length)
            if room is None:  # new bins, filled with as many of this length as they take
                room, start, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                start, n = open_[room].popleft()
                if not open_[room]:
                    tree.set(room, False)
            each = min(room // length, left)
            used = min(n, left // each)
            out.append((length, rank, used * each, start, each, capacity - room))
            rank, left = rank + used * each, left - used * each
            if n > used and room == capacity:  # a last new bin, not full of this length
                out.append((length, rank, left, start + used, left, 0))
                push(capacity - left * length, start + used, 1)
                rank, left = rank + left, 0
            elif n > used:
                push(room, start + used, n - used)
            push(room - each * length, start, used)
    return out


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` rows with sequence_id and offset."""
    spark = parts.sparkSession
    parts = materialise(parts, "packing-pieces")
    # Full pieces fill a sequence on their own; they need no rank.
    full = parts.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = parts.where(F.col("length") < capacity)
    counts = {r["length"]: r["count"] for r in rest.groupBy("length").count().collect()}  # < capacity rows
    plan = best_fit(counts, capacity)
    slots = spark.createDataFrame([(k, -(-n // SLOT)) for k, n in counts.items()], "length long, slots long")
    where = spark.createDataFrame(plan, "length long, rank0 long, count long, bin long, each long, at long")
    rows = rest.join(F.broadcast(slots), "length").withColumn("slot", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("slots")))
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("length", "slot").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = rows.withColumn("number", number - 1).join(base, ["length", "slot"]).withColumn(
        "rank", F.col("base") + F.col("number"))
    where = where.withColumnRenamed("length", "len")
    placed = ranked.join(F.broadcast(where), (F.col("length") == F.col("len")) & (F.col("rank") >= F.col("rank0"))
                         & (F.col("rank") < F.col("rank0") + F.col("count")))
    done = placed.withColumn("k", F.col("rank") - F.col("rank0")).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr("bin + k div each").alias("sequence_id"),
        F.expr("at + (k % each) * length").alias("offset"))
    return done.unionByName(full)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    return pack(pieces(docs, capacity, tokenizer), capacity)
