"""Operator 5: exact top-k search over binary codes by incremental multi-index hashing.

A vector's code is the signs of its components. Codes are dealt into blocks of
bounded size, queries into chunks, and every chunk meets every block once, in a
cell of its own. A cell cuts its codes into m segments of about log2(codes)
bits and keeps an index per segment: the codes under each value. A step grows
one segment's search radius by one: it probes the segment's values at exactly r
flipped bits (or picks them from the values that occur, where those are fewer),
all segments at r = 0 before any at r = 1, so the step with the fewest masks is
always next. A code that was not met differs in more than r_i bits in every
segment i, so after t steps every code within t - 1 bits has been met, and a
query is closed once its k-th verified distance lies within that radius. A round
takes the next steps until their masks come to a quarter of those before
(``FIRST`` at least), so there are few rounds and a query is probed little
beyond what it needs.

Probes and the codes they meet stay arrays inside a cell; rows between tasks are
packed codes (a block goes to ``CHUNKS`` chunks) and k codes a query and block at
most. Blocks are taken one, one, two, four, ...: each turn as many as all before
it, with the k-th distances of those before as bounds, so that a turn of further
blocks adds about k codes a query, and probes no further than the bound.

How many codes an exact search must compare is up to the data: for codes without
near neighbours it nears all of them, so comparisons (not rows) outgrow the input.

A code met through several segments or steps is taken where it is met first,
which is a condition on the two codes alone, so there is no distinct step.
Equal vectors are one code: a code that a third of all rows share is indexed,
probed and searched once, with its k smallest ids as members.

Results for odd rows: null vectors have no code and take no part; components
that are null, zero or missing give 0 bits; ties go to the smaller id, and
repeated rows are results of their own; an empty table gives an empty table.
The query's own row is a result like any other ("against all rows").
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import attach, materialise

K = 10
EVERY = 20
#: Probing is cheaper than a scan up to about 2^16 values a segment.
MAX_SEGMENT = 16
#: Masks of a round: this many at least, and a quarter of those of the rounds before.
FIRST = 512
#: Words of 64 bits of a block's codes and of a chunk's queries, about: what a task holds at a time.
BLOCK = CHUNK = 1 << 18
#: Chunks at least, so that few blocks keep many tasks busy.
CHUNKS = 16
#: Rows packed into one, and queries that a cell searches at a time.
PIECE, BATCH = 256, 512
#: Probes, or codes met, that a cell holds at a time.
HELD = 1 << 20
_FAR = 1 << 30
_NO_ID = -(1 << 63)


def codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(id, c0, c1, ...) with 64 sign bits a column, and the number of bits."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where("v is not null")
    size = max(1, v.agg(F.max(F.size("v"))).first()[0] or 1)
    words = max(1, math.ceil(size / 64))
    bits = [F.expr(
        f"aggregate(slice(v, {64 * w + 1}, 64), struct(0L as x, 0 as i), (s, e) -> struct("
        f"s.x | shiftleft(cast(coalesce(e > 0, false) as bigint), s.i) as x, s.i + 1 as i), s -> s.x)"
    ).alias(f"c{w}") for w in range(words)]
    return v.select("id", *bits), size


def segments(size: int, n_codes: int) -> list[tuple[int, int, int]]:
    """(column, shift, width) of the segments of ``size`` bits, widths near log2 of the number of codes."""
    want = min(MAX_SEGMENT, max(4, round(math.log2(max(n_codes, 2)))))
    out = []
    for w in range(math.ceil(size / 64)):
        bits = min(64, size - 64 * w)
        parts = math.ceil(bits / want)
        cuts = [bits * k // parts for k in range(parts + 1)]
        out += [(w, a, b - a) for a, b in zip(cuts, cuts[1:])]
    return out


def rounds(segs: list[tuple[int, int, int]], first: int = FIRST) -> Iterator[list[tuple[int, int]]]:
    """The steps (segment, radius) of each round, cheapest first."""
    used, now, masks = 0, [], 0
    for r in range(max(s[2] for s in segs) + 1):
        for k, (_, _, width) in enumerate(segs):
            now.append((k, r))
            masks += math.comb(width, r)
            if masks >= max(first, used / 4):
                yield now
                used, now, masks = used + masks, [], 0
    if now:
        yield now


@cache
def _masks(width: int) -> list[np.ndarray]:
    """The masks of ``width`` bits by their number of flipped bits."""
    every = np.arange(1 << width)
    flips = np.bitwise_count(every)
    return [every[flips == r] for r in range(width + 1)]


def _values(code: np.ndarray, segs) -> list[np.ndarray]:
    return [((code[:, word] >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
            for word, shift, width in segs]


class Index:
    """The multi-index of a block of codes."""

    def __init__(self, code: np.ndarray, n: np.ndarray, segs: list[tuple[int, int, int]]):
        self.words, self.n, self.segs = list(code.T.copy()), n, segs
        self.values = _values(code, segs)
        self.order = [np.argsort(v, kind="stable") for v in self.values]
        self.starts = [np.searchsorted(v[o], np.arange((1 << s[2]) + 1))
                       for v, o, s in zip(self.values, self.order, segs)]
        self.there = [np.nonzero(np.diff(s))[0] for s in self.starts]

    def met(self, at: np.ndarray, i: int, r: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in ``at``, code) where segment ``i`` differs in ``r`` bits from the value in ``at``."""
        masks, there, starts = _masks(self.segs[i][2])[r], self.there[i], self.starts[i]
        step = max(1, HELD // max(1, min(len(masks), len(there))))
        for a in range(0, len(at), step):
            part = at[a:a + step, None]
            if len(masks) <= len(there):
                value = (part ^ masks).ravel()
                row = np.repeat(np.arange(len(part)), len(masks))
            else:
                row, place = np.nonzero(np.bitwise_count(part ^ there) == r)
                value = there[place]
            first = starts[value]
            count = starts[value + 1] - first
            some = np.nonzero(count)[0]
            row, first, count = row[some] + a, first[some], count[some]
            ends, b = np.cumsum(count), 0
            while b < len(row):
                done = ends[b] - count[b]
                e = max(b + 1, int(np.searchsorted(ends, done + HELD, "right")))
                skip = np.repeat(first[b:e] - (ends[b:e] - count[b:e] - done), count[b:e])
                yield np.repeat(row[b:e], count[b:e]), self.order[i][skip + np.arange(len(skip))]
                b = e

    def search(self, code: np.ndarray, bound: np.ndarray, plan: list[list[tuple[int, int]]], k: int):
        """(query, code, distance) of each query's k nearest codes, but those beyond its bound."""
        words, values = list(code.T.copy()), _values(code, self.segs)
        kth, open_, taken = bound.copy(), np.arange(len(code)), 0
        best = tuple(np.empty(0, np.int64) for _ in range(3))
        found, held = [best], 0

        def merge():
            """Keep k codes a query, and lower its k-th distance to theirs."""
            q, c, d = (np.concatenate(x) for x in zip(*found))
            o = np.lexsort((c, d, q))
            q, c, d = q[o], c[o], d[o]
            new = np.diff(q, prepend=-1) != 0
            head = np.nonzero(new)[0][np.cumsum(new) - 1]
            keep = np.arange(len(q)) - head < k
            n = np.minimum(self.n[c], k)
            rows = np.cumsum(n)
            full = keep & (rows - (rows - n)[head] >= k)
            np.minimum.at(kth, q[full], d[full])
            return q[keep], c[keep], d[keep]

        for steps in plan:
            for i, r in steps:
                for row, c in self.met(values[i][open_], i, r):
                    q = open_[row]
                    d = sum(np.bitwise_count(a[q] ^ b[c]).astype(np.int64) for a, b in zip(words, self.words))
                    near = np.nonzero(d <= kth[q])[0]
                    q, c, d = q[near], c[near], d[near]
                    # Met first here: no segment before this one within r bits, none after it within r - 1.
                    for j, (a, b) in enumerate(zip(values, self.values)):
                        if j != i and len(q):
                            later = np.nonzero(np.bitwise_count(a[q] ^ b[c]) > (r if j < i else r - 1))[0]
                            q, c, d = q[later], c[later], d[later]
                    found.append((q, c, d))
                    held += len(q)
                    if held > HELD:
                        found, held = [merge()], 0
            found, held = [merge()], 0
            taken += len(steps)
            # Closed: k rows within the radius that is covered.
            open_ = open_[kth[open_] > taken - 1]
            if not len(open_):
                break
        return found[0]


def _joined(rows: pd.DataFrame, col: str) -> np.ndarray:
    return np.concatenate([np.asarray(x, dtype=np.int64) for x in rows[col]])


def _cell(segs: list[tuple[int, int, int]], plan: list[list[tuple[int, int]]], k: int):
    """The search of one chunk of queries in one block."""
    words = segs[-1][0] + 1

    def run(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"qid": [], "cid": [], "n": [], "dist": []}, dtype=np.int64)]
        if len(asked) and len(block):
            cid, n, qid, bound = _joined(block, "id"), _joined(block, "n"), _joined(asked, "id"), _joined(asked, "n")
            by_id = np.argsort(cid, kind="stable")  # among equal distances the smaller place is the smaller id
            cid, n = cid[by_id], n[by_id]
            index = Index(_joined(block, "code").view(np.uint64).reshape(-1, words)[by_id], n, segs)
            code = _joined(asked, "code").view(np.uint64).reshape(-1, words)
            for a in range(0, len(qid), BATCH):
                q, c, d = index.search(code[a:a + BATCH], bound[a:a + BATCH], plan, k)
                out.append(pd.DataFrame({"qid": qid[a:a + BATCH][q], "cid": cid[c], "n": n[c], "dist": d}))
        return pd.concat(out)

    return run


def _packed(df: DataFrame, key: str, parts: int, n_rows: int, cols: list[str]) -> DataFrame:
    """(key, id, n, code): the rows of (id, n, codes) dealt into ``parts`` by their codes, about ``PIECE`` in a row."""
    pieces = max(1, math.ceil(n_rows / parts / PIECE))
    one = F.struct("id", "n", F.array(*cols).alias("code"))
    return df.groupBy(key, F.pmod(F.hash(*cols), F.lit(pieces)).alias("piece")).agg(F.collect_list(one).alias("r")).select(
        key, "r.id", "r.n", F.flatten("r.code").alias("code"))


def _dealt(df: DataFrame, key: str, parts: int, cols: list[str]) -> DataFrame:
    return df.withColumn(key, F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int"))


def _each(key: str, first: int, end: int):
    return F.explode(F.sequence(F.lit(first), F.lit(end - 1))).alias(key)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, distance): the k nearest rows of ``vectors`` for each row of ``queries``."""
    spark = vectors.sparkSession
    rows, size = codes(vectors, id_col, vec_col)
    rows = materialise(rows, "topk-rows")
    asked, asked_size = codes(queries, id_col, vec_col)
    size = max(size, asked_size)
    cols = [f"c{w}" for w in range(math.ceil(size / 64))]
    pad = lambda df: df.select("id", *[F.col(c) if c in df.columns else F.lit(0).cast("long").alias(c) for c in cols])
    rows, asked = pad(rows), materialise(pad(asked), "topk-queries")
    known = materialise(rows.groupBy(*cols).agg(F.min("id").alias("cid"), F.count(F.lit(1)).alias("n")), "topk-codes")
    n_codes = known.count()
    heads = materialise(asked.groupBy(*cols).agg(F.min("id").alias("qid")), "topk-open")
    n_asked = heads.count()
    blocks = max(1, math.ceil(n_codes * len(cols) / BLOCK))
    chunks = max(CHUNKS, math.ceil(n_asked * len(cols) / CHUNK))
    segs = segments(size, math.ceil(n_codes / blocks))
    cell = _cell(segs, list(rounds(segs)), k)
    dealt = _dealt(known.select(F.coalesce("cid", F.lit(_NO_ID)).alias("id"), "n", *cols), "block", blocks, cols)
    open_ = _dealt(heads.where("qid is not null").withColumnRenamed("qid", "id"), "chunk", chunks, cols)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nearest = Window.partitionBy("qid").orderBy("dist", "cid")
    best, done = None, 0
    while done < blocks:
        end = min(blocks, max(1, 2 * done))
        bounds = open_.withColumn("n", F.lit(_FAR).cast("long"))
        if best is not None:
            held = best.withColumn("rows", F.sum("n").over(nearest)).groupBy(F.col("qid").alias("id")).agg(
                F.min(F.when(F.col("rows") >= k, F.col("dist"))).alias("kth"))
            bounds = open_.join(held, "id", "left").withColumn("n", F.coalesce("kth", F.lit(_FAR).cast("long")))
        # One cell a partition, about: block and chunk go there as a few packed rows each.
        n = max(tasks, (end - done) * chunks)
        left = _packed(bounds, "chunk", chunks, n_asked, cols).select("*", _each("block", done, end))
        right = _packed(dealt.where(F.col("block").between(done, end - 1)), "block", blocks, n_codes, cols).select(
            "*", _each("chunk", 0, chunks))
        found = left.repartition(n, "chunk", "block").groupBy("chunk", "block").cogroup(
            right.repartition(n, "chunk", "block").groupBy("chunk", "block")).applyInPandas(
            cell, "qid long, cid long, n long, dist long")
        if best is not None:
            found = found.unionByName(best)
        best = materialise(found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k).drop("place"),
                           "topk-best")
        done = end
    member = rows.withColumn("place", F.row_number().over(Window.partitionBy(*cols).orderBy("id"))).where(
        F.col("place") <= k).join(known.select(*cols, "cid"), cols).select("cid", "id")
    per_query = best.join(member, "cid").withColumn(
        "rank", F.row_number().over(Window.partitionBy("qid").orderBy("dist", "id"))).where(F.col("rank") <= k)
    who = attach(asked.select(F.col("id").alias("query_id"), *cols), heads, cols, "inner").select("query_id", "qid")
    return who.join(per_query, "qid").select("query_id", "rank", "id", F.col("dist").cast("int").alias("distance"))
