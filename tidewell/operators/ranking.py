"""Global quantile tiles without sorting the rows.

``ntile(n) OVER (ORDER BY k)`` plans ``Exchange SinglePartition``: every row in
one task. A tile is decided by ``n - 1`` cut keys alone, the last key of each
tile but the last, and those are found by selection:

1. count, smallest and largest value give the ranks of the cuts and one span
   that holds them all;
2. a histogram of every span that still holds a cut (at most ``BUCKETS`` equal
   steps, partial counts per task) leaves one bucket for each cut, with its own
   smallest and largest value as the next span;
3. a span of one value, or of few rows, ends it: ties are told apart by name the
   same way, by histograms over leading characters, until ``FEW`` names remain.

Each step is one grouped count over the stored (value, name) columns; the driver
sees at most ``BUCKETS`` rows per cut, whatever the number of rows. Every row then compares itself
with the cut keys: no range sort, no row numbers, no join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
#: Spans of so many rows are fetched instead of divided further.
FEW = 1000
#: Leading characters that a histogram of names takes at a time.
STEP = 2


@dataclass(frozen=True)
class _Span:
    """Rows whose value lies in [low, high] and whose name (with ``_name``) starts with ``prefix``."""

    low: float
    high: float
    prefix: str = ""

    def holds(self, value: Column, name: Column) -> Column:
        return value.between(F.lit(self.low), F.lit(self.high)) & F.startswith(name, F.lit(self.prefix))


def tile_ends(n: int, rows: int) -> list[int]:
    """Ranks (from 1) of the last row of every tile but the last; like SQL, the first tiles take what is over."""
    return [k * (rows // n) + min(k, rows % n) for k in range(1, n)]


def _name(c: str) -> Column:
    """Nulls sort before every name."""
    return F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(c).cast("string")))


def cut_keys(df: DataFrame, n: int, value: str, name: str) -> list[tuple[float, str]]:
    """The (value, name) keys that end the first ``n - 1`` tiles; none of an empty table.

    ``df`` is scanned once per step: pass a stored table. ``value`` is a number without nulls.
    """
    rows = df.select(F.col(value).alias("v"), _name(name).alias("k"))
    v, k = F.col("v"), F.col("k")
    total, low, high = rows.agg(F.count(F.lit(1)), F.min(v), F.max(v)).first()
    ends = tile_ends(n, total)
    found: dict[int, tuple[float, str]] = {}
    # rank of each open cut within the span that holds it
    open_ = {r: (_Span(low, high), r, total) for r in ends if r > 0}
    while open_:
        spans = list(dict.fromkeys(s for s, _, _ in open_.values()))
        sizes = {s: size for s, _, size in open_.values()}
        small = [s for s in spans if sizes[s] <= FEW]
        which = F.lit(None).cast("int")
        for i, s in enumerate(spans):
            which = F.when(s.holds(v, k), F.lit(i)).otherwise(which)
        inside = rows.withColumn("s", which).where(F.col("s").isNotNull())
        near: dict[int, list] = {}
        if small:  # at most FEW rows a cut
            at = [spans.index(s) for s in small]
            for r in inside.where(F.col("s").isin(at)).select("s", "v", "k").collect():
                near.setdefault(r["s"], []).append((r["v"], r["k"]))
        wide = [s for s in spans if s not in small]
        steps: dict[int, list] = {}
        if wide:
            part = F.lit(None).cast("string")
            for s in wide:
                if s.low < s.high:
                    step = F.floor((v - F.lit(s.low)) / F.lit(s.high - s.low) * BUCKETS).cast("string")
                else:
                    step = F.substring(k, len(s.prefix) + 1, STEP)
                part = F.when(F.col("s") == spans.index(s), step).otherwise(part)
            counts = inside.where(F.col("s").isin([spans.index(s) for s in wide])).groupBy(
                "s", part.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            for r in counts.collect():  # at most BUCKETS rows (of names: pairs of characters) a span
                steps.setdefault(r["s"], []).append(r)
        after = {}
        for end, (span, rank, _) in open_.items():
            i = spans.index(span)
            if span in small:
                found[end] = sorted(near[i])[rank - 1]
                continue
            by_value = span.low < span.high
            for r in sorted(steps[i], key=lambda r: r["low"] if by_value else r["p"]):
                if rank <= r["n"]:
                    break
                rank -= r["n"]
            if by_value:
                after[end] = (_Span(r["low"], r["high"], span.prefix), rank, r["n"])
            elif len(r["p"]) < STEP:  # names that end here are all the same
                found[end] = (span.low, span.prefix + r["p"])
            else:
                after[end] = (_Span(span.low, span.high, span.prefix + r["p"]), rank, r["n"])
        open_ = after
    return [found[r] for r in ends if r > 0]


def tile(cuts: list[tuple[float, str]], value: str, name: str) -> Column:
    """The tile (from 1) of a row, from the cut keys; rows of one key share the tile of the first of them."""
    out = F.lit(1)
    for v, k in cuts:
        beyond = (F.col(value) > F.lit(v)) | ((F.col(value) == F.lit(v)) & (_name(name) > F.lit(k)))
        out = out + beyond.cast("int")
    return out.cast("int")


def ntile(df: DataFrame, n: int, order_cols: list[str], out: str = "tile",
          partitions: int | None = None) -> DataFrame:
    """``ntile(n) OVER (ORDER BY value, name)`` of a stored table, ``order_cols`` being these two columns.

    (value, name) is unique. ``partitions`` spreads a table that is not stored over so many tasks first.
    """
    value, name = order_cols
    df = df.repartition(partitions, name) if partitions else df
    return df.withColumn(out, tile(cut_keys(df, n, value, name), value, name))
