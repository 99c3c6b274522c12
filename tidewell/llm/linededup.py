"""Operator 7: line dedup by site-relative frequency.

A page is a different text of its host, so copies of a whole document count
once, above and below the line, and make no boilerplate of their own lines. A
line's frequency is the number of the host's pages that hold it over the host's
pages. Lines that stand in more than one page and in more than ``ratio`` of them
are boilerplate and are dropped from every row of that host. A line of one page
alone repeats nowhere, so it stays however few pages its host has.

Lines are compared trimmed, by two independent hashes (96 bits), texts likewise;
blank lines are never boilerplate. Lines are reduced to distinct (line, page)
keys of fixed width before the shuffle and are counted after it in two steps, so
copies collapse in the map tasks and a hot host or line is no hot group; the
boilerplate of one host has at most (mean lines per page) / ratio digests.

Results for odd rows: null text stays null and is no page; a null host is a host
of its own; text whose lines are all dropped becomes empty; repeated rows are one
page and lose the same lines; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import SPACES, attach, materialise

#: A line in more than this share of a host's pages is boilerplate.
RATIO = 0.1


def _digests(text: str) -> str:
    """Array of (hash, hash) structs per line, null for blank lines."""
    spaces = "".join(f"\\u{ord(c):04X}" for c in SPACES)
    line = f"btrim(l, '{spaces}')"
    return (f"transform(split({text}, '\\n'), l -> if({line} = '', null, "
            f"struct(xxhash64({line}) as a, hash({line}) as b)))")


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                ratio: float = RATIO) -> DataFrame:
    """(host, lines): per host the digests of its boilerplate lines."""
    pages = docs.select(F.col(host_col).cast("string").alias("host"),
                        F.col(text_col).cast("string").alias("text")).where("text is not null")
    pages = pages.select("host", "text", F.xxhash64("text").alias("p"), F.hash("text").alias("q"))
    totals = pages.select("host", "p", "q").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("pages")).select(F.col("host").alias("site"), "pages")
    lines = pages.select("host", "p", "q", F.explode(F.expr(
        f"array_compact(array_distinct({_digests('text')}))")).alias("d"))
    held = lines.select("host", "d.a", "d.b", "p", "q").distinct()
    often = held.groupBy("host", "a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # n > ratio * pages, in whole numbers of a millionth
    found = often.join(totals, F.col("host").eqNullSafe(F.col("site"))).where(
        F.col("n") * 1_000_000 > F.col("pages") * round(ratio * 1_000_000))
    return found.groupBy("host").agg(F.collect_set(F.struct("a", "b")).alias("lines"))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                     ratio: float = RATIO) -> DataFrame:
    """``docs`` with two columns more, ``n_lines`` and ``n_dropped``, and boilerplate gone from the text."""
    known = materialise(boilerplate(docs, host_col, text_col, ratio), "line-boilerplate")
    known = known.select(F.coalesce("host", F.lit("")).alias("host__"),
                         F.isnull("host").alias("none__"), F.col("lines").alias("lines__"))
    rows = docs.select(F.struct("*").alias("row__")).select(
        "row__", F.coalesce(F.col("row__")[host_col].cast("string"), F.lit("")).alias("host__"),
        F.isnull(F.col("row__")[host_col]).alias("none__"))
    met = attach(rows, known, ["host__", "none__"])
    met = met.withColumn("text__", F.col("row__")[text_col].cast("string"))
    met = met.withColumn("hit__", F.expr(
        f"if(lines__ is null or text__ is null, null, "
        f"transform({_digests('text__')}, d -> d is not null and array_contains(lines__, d)))"))
    kept = F.expr("array_join(transform(filter(transform(split(text__, '\\n'), "
                  "(l, i) -> struct(l as l, hit__[i] as hit)), x -> not x.hit), x -> x.l), '\\n')")
    n_dropped = F.expr("size(filter(hit__, x -> x))")
    text = F.when(F.col("hit__").isNull() | (n_dropped == 0), F.col("text__")).otherwise(kept)
    return met.select(
        *[(text if c == text_col else F.col("row__")[c]).alias(c) for c in docs.columns],
        F.when(F.col("text__").isNull(), 0).otherwise(F.size(F.split("text__", "\n"))
                                                      ).cast("long").alias("n_lines"),
        F.when(F.col("hit__").isNull(), 0).otherwise(n_dropped).cast("long").alias("n_dropped"))


def clean(docs: DataFrame, **how) -> DataFrame:
    """``drop_boilerplate`` with the columns of ``docs`` only."""
    out = drop_boilerplate(docs, **how)
    names = list(docs.columns)
    return out.toDF(*names, "n_lines__", "n_dropped__").select(*names)
