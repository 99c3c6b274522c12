"""Operator 4: quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document. The ledger keeps the measurements
and one long with a bit per failed rule; a policy is a versioned set of bits,
so a new policy, a comparison of policies or an ablation reads the ledger and
never the text again.

Results for odd rows: null text counts as text without words (it fails
``few_words``); a null doc_id and repeated rows pass through row by row; an
empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import SPACE_CLASS, SPACES

#: Rule -> failing condition over the measurements. A rule's bit is its place here; rules are only appended.
RULES = {
    "few_words": "m.n_words < 10",
    "repeated_windows": "100 * m.n_repeat_words > 20 * m.n_words",
    "symbols": "m.n_symbols > 0.25 * m.n_words",
    "word_length": "m.word_chars < 2 * m.n_words or m.word_chars > 20 * m.n_words",
    "duplicate_lines": "m.n_lines >= 4 and m.n_dup_lines > 0.5 * m.n_lines",
    "exclamations": "m.n_exclaims > 0.5 * m.n_words",
}
BASE = ("few_words", "repeated_windows")
#: Versioned policies: the rules that reject a document.
POLICIES = {
    "base-1": BASE,
    "web-1": (*BASE, "symbols", "word_length", "duplicate_lines", "exclamations"),
}
POLICY = "web-1"
WINDOW = 5


def mask(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _covered(at: str) -> str:
    """Words covered by the windows that start at the sorted places of array ``at``."""
    return (f"aggregate(transform({at}, (x, k) -> if(k = 0, {WINDOW}L, "
            f"cast(least({WINDOW}, x - {at}[k - 1]) as bigint))), 0L, (s, x) -> s + x)")


def _measure(df: DataFrame, text: Column) -> DataFrame:
    """Adds the struct column ``m`` of measurements, via columns that end in two underscores."""
    at = ", ".join(f"h__[i + {k}]" for k in range(WINDOW))
    df = df.withColumn("t__", F.coalesce(text.cast("string"), F.lit("")))
    df = df.withColumn("w__", F.filter(F.split("t__", f"{SPACE_CLASS}+"), lambda x: x != ""))
    df = df.withColumn("l__", F.filter(F.split("t__", "\n"),
                                       lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    df = df.withColumn("h__", F.transform("w__", lambda x: F.xxhash64(x)))
    df = df.withColumn("g__", F.expr(
        f"if(size(h__) < {WINDOW}, cast(array() as array<bigint>), "
        f"transform(sequence(0, size(h__) - {WINDOW}), i -> xxhash64({at})))"))
    # Most texts repeat no window; only the others sort theirs.
    df = df.withColumn("s__", F.expr(
        "if(size(array_distinct(g__)) = size(g__), null, "
        "sort_array(transform(g__, (x, i) -> struct(x as h, i as i))))"))
    df = df.withColumn("p__", F.expr(
        "sort_array(transform(filter(s__, (x, k) -> (k > 0 and s__[k - 1].h = x.h) or "
        "(k < size(s__) - 1 and s__[k + 1].h = x.h)), x -> x.i))"))
    long = lambda c: c.cast("long")
    return df.withColumn("m", F.struct(
        # The partition id (times 0) makes this projection one that filters are not pushed through: a filter
        # on a measure would otherwise be rewritten over the text, with the splits inside its lambdas.
        long(F.size("w__") + 0 * F.spark_partition_id()).alias("n_words"),
        long(F.char_length(F.array_join("w__", ""))).alias("word_chars"),
        long(F.regexp_count("t__", F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("l__")).alias("n_lines"),
        long(F.size("l__") - F.size(F.array_distinct("l__"))).alias("n_dup_lines"),
        F.coalesce(F.expr(_covered("p__")), F.lit(0)).cast("long").alias("n_repeat_words"),
        long(F.regexp_count("t__", F.lit("!"))).alias("n_exclaims"))
    ).drop("t__", "w__", "l__", "h__", "g__", "s__", "p__")


def _failures() -> Column:
    return sum((F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
                for k, rule in enumerate(RULES.values())), F.lit(0).cast("long"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements, ``failures`` (a bit per failed rule)."""
    marked = _measure(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                      F.col("text"))
    return marked.withColumn("failures", _failures()).select("doc_id", "m.*", "failures")


def passes(failures: Column | str, policy: str = POLICY) -> Column:
    col = F.col(failures) if isinstance(failures, str) else failures
    return col.bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def apply_policy(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """Ledger rows with ``base_failed`` and ``kept`` under ``policy`` (which includes the base)."""
    base = rows["failures"].bitwiseAND(F.lit(mask(BASE))) != 0
    return rows.withColumn("base_failed", base).withColumn(
        "kept", ~base & passes("failures", policy))


def ablations(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """Per rule of ``policy``: documents that fail it, that only it rejects, and the kept share without it.

    One grouping by failure pattern (at most 2^rules rows) answers all of them.
    """
    names = POLICIES[policy]
    patterns = rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask(names))).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask([r])).cast("long").alias("bit"))
                      for r in names])
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    only = F.col("bits") == F.col("bit")
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))
    return each.groupBy("rule").agg(
        count(hit).alias("failed"), count(only).alias("only_this_rule"),
        count(F.col("bits") == 0).alias("kept"), count((F.col("bits") == 0) | only).alias("kept_without"),
        F.sum("n").alias("documents"))


def keep(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and ``policy``; all columns unchanged."""
    marked = _measure(docs.select(F.struct("*").alias("row__")), F.col("row__.text"))
    bits = mask({*BASE, *POLICIES[policy]})
    return marked.where(_failures().bitwiseAND(F.lit(bits)) == 0).select("row__.*")
