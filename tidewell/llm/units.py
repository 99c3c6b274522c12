"""Operator 10: substring dedup by hashing normalised units.

A text is cut at line ends and, inside lines, at sentence ends, because shared
passages are often pasted into the middle of a line. Units are normalised (A-Z
to lower case, white space runs to one space) and hashed to 128 bits. Over the
whole corpus each digest keeps its earliest occurrence, ranked by doc_id, then
by the text's hash, then by place in the text; all others are cut out, and the
cuts are reported as offsets into the original text. Short units say little alone. With
``min_bytes`` (the registered query) a repeated unit under that many bytes is
cut only in a run of repeated units that holds a longer one, so shared passages
go whole and a lone short line stays; bytes, because a line of Chinese or Thai
is one word. Without it, units of fewer than ``min_words`` words are never cut.

Inside a document only the first occurrence leaves the map task, and a digest
is reduced to (first document, count) before the shuffle, so a unit that stands
in a third of all documents is no hot group. Cuts are grouped by (doc_id, text
hash), never by doc_id alone, so rows without an id are no group either.

Results for odd rows: null text stays null with no units; a null doc_id ranks
last; rows that share a doc_id are documents of their own, in the order of their
text hashes; of rows with the same doc_id and text one stays and the others lose
every unit (such rows alone are written with a row number to tell them apart); an empty
table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import materialise

MIN_WORDS = 6
MIN_BYTES = 30
LAST = (1 << 63) - 1
#: What ends a unit; a sentence ends at . ! or ? before white space, and at the line's end.
ENDS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n\s*\n"),
        "sentence": re.compile(r"[.!?](?=[ \t\r\f\v])|\n")}


def units(text: str, kind: str = "sentence") -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised words) of the non-blank units of a text, ends exclusive."""
    ends = [m.end() for m in ENDS[kind].finditer(text)]
    for a, b in zip([0, *ends], [*ends, len(text)]):
        piece = text[a:b]
        words = piece.split()
        if words:
            lead = len(piece) - len(piece.lstrip())
            yield a + lead, a + len(piece.rstrip()), " ".join(words)


_LOWER = {c: c + 32 for c in range(65, 91)}


def _rows(text: str | None, kind: str, min_words: int, min_bytes: int | None = None):
    """(hi, lo, start, end, first, long): the countable units; first: not seen before in this text."""
    seen, out, n = set(), [], 0
    for a, b, words in units(text or "", kind):
        n += 1
        if min_bytes is None and words.count(" ") + 1 < min_words:
            continue
        raw = words.translate(_LOWER).encode("utf-8", "surrogatepass")
        d = xxhash.xxh3_128_intdigest(raw)
        out.append(((d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63), a, b, d not in seen,
                    min_bytes is None or len(raw) >= min_bytes))
        seen.add(d)
    return n, out


def _spans(found: list[tuple], gone, copy: bool = False) -> list[tuple[int, int]]:
    """The units to cut: the repeated ones (of a copy: all) in runs of repeated units that hold a long one."""
    out: list[tuple[int, int]] = []
    run: list[tuple[int, int, bool]] = []
    for hi, lo, a, b, first, long in [*found, (0, 0, 0, 0, None, False)]:
        if first is False or (first and (copy or (hi, lo) in gone)):
            run.append((a, b, long))
            continue
        if any(x[2] for x in run):
            out += [(a, b) for a, b, _ in run]
        run = []
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, rank, h, text__): the input row, its document's key, and its text."""
    r = F.col("row")
    text = r[text_col].cast("string")
    return docs.select(F.struct("*").alias("row")).select(
        "row", F.coalesce(r[id_col].cast("long"), F.lit(LAST)).alias("rank"), F.xxhash64(text).alias("h"),
        text.alias("text__"))


def occurrences(docs: DataFrame, kind: str = "sentence", min_words: int = MIN_WORDS,
                id_col: str = "doc_id", text_col: str = "text", min_bytes: int | None = None) -> DataFrame:
    """(rank, h, hi, lo): one row for each distinct unit of each document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(r, h, u[0], u[1]) for r, h, t in zip(b["rank"], b["h"], b["text__"])
                    for u in _rows(t, kind, min_words, min_bytes)[1] if u[4]]
            yield pd.DataFrame(rows, columns=["rank", "h", "hi", "lo"]).astype("int64")

    return _keyed(docs, id_col, text_col).select("rank", "h", "text__").mapInPandas(
        run, "rank long, h long, hi long, lo long")


def later_units(docs: DataFrame, kind: str = "sentence", min_words: int = MIN_WORDS,
                id_col: str = "doc_id", text_col: str = "text", min_bytes: int | None = None) -> DataFrame:
    """(rank, h, cut): per document the digests of units that an earlier document holds."""
    found = materialise(occurrences(docs, kind, min_words, id_col, text_col, min_bytes), "units")
    key = F.struct("rank", "h")
    first = found.groupBy("hi", "lo").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")
                                          ).where("n > 1").drop("n")
    later = found.join(first, ["hi", "lo"]).where(key != F.col("first"))
    return later.groupBy("rank", "h").agg(F.collect_set(F.struct("hi", "lo")).alias("cut"))


def _with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: true for all but one of the rows with the same document key."""
    keys = ["rank", "h"]
    again = materialise(rows.groupBy(*keys).count().where("count > 1").select(*keys), "units-again")
    if again.isEmpty():
        return rows.withColumn("copy", F.lit(False))
    repeated = rows.join(again, keys, "left_semi").withColumn("rid", F.monotonically_increasing_id())
    repeated = materialise(repeated, "units-copies")
    stays = repeated.groupBy(*keys).agg(F.min("rid").alias("rid")).select("rid", F.lit(True).alias("stays"))
    marked = repeated.join(stays, "rid", "left").select(*rows.columns, F.isnull("stays").alias("copy"))
    return rows.join(again, keys, "left_anti").withColumn("copy", F.lit(False)).select(marked.columns).unionByName(marked)


def dedup(docs: DataFrame, kind: str = "sentence", min_words: int = MIN_WORDS,
          id_col: str = "doc_id", text_col: str = "text", min_bytes: int | None = None) -> DataFrame:
    """(row, text, n_units, n_removed, removed): ``row`` is the struct of the input columns, ``text``
    what remains, ``removed`` the cut spans as [start, end) code points of the original text."""
    cuts = later_units(docs, kind, min_words, id_col, text_col, min_bytes)
    met = _with_copies(_keyed(docs, id_col, text_col)).join(cuts, ["rank", "h"], "left")

    @F.pandas_udf("n_units long, removed array<struct<start:long,end:long>>, text string")
    def apply(text: pd.Series, cut: pd.Series, copy: pd.Series) -> pd.DataFrame:
        out = []
        for t, c, again in zip(text, cut, copy):
            gone = {(x["hi"], x["lo"]) for x in c} if c is not None else ()
            n, found = _rows(t, kind, min_words, min_bytes)
            spans = _spans(found, gone, again)
            out.append((n, [{"start": a, "end": b} for a, b in spans], _without(t, spans)))
        return pd.DataFrame(out, columns=["n_units", "removed", "text"])

    return met.withColumn("u", apply("text__", "cut", "copy")).select(
        "row", F.col("u.text").alias("text"), F.col("u.n_units").alias("n_units"),
        F.size("u.removed").cast("long").alias("n_removed"), F.col("u.removed").alias("removed"))


def _without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    if not spans or text is None:
        return text
    at, keep = 0, []
    for a, b in spans:
        keep.append(text[at:a])
        at = b
    keep.append(text[at:])
    return "".join(keep)
