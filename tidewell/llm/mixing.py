"""Operator 2: mixing sources to target weights by temperature.

A source's share p of all tokens becomes the weight p^t / sum p^t. The exponent
t in [0, 1] is bisected (8 candidates a pass, each pass one aggregate over the
per-source table, so nothing grows with the number of sources on the driver):
the largest t whose entropy reaches ``min_entropy``, and the smallest t under
which no source is repeated more than ``max_repeats`` times. The budget in
tokens defaults to the smallest one that shows every source once as a whole.

The weights are realised as block permutations. Every source's documents are
dealt to blocks by a seeded hash, blocks of about ``BLOCK`` documents. A
source's token quota is some whole epochs and a part; the part is the longest
run of blocks (in block order) and of documents in the next block (in hash
order) that stays within the quota. So an epoch's part is one decision per
source: (last block, last hash), applied to each row on its own; no text moves.

Results for odd rows: a null source is a source of its own; documents without
words cost nothing and are given once; null ids are ordered by text; repeated
rows share their place in the order and are taken together; an empty table
gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import SPACE_CLASS, attach, materialise

SEED = 20
BLOCK = 4096
MAX_REPEATS = 2.0
FAN = 8
PASSES = 10


@dataclass(frozen=True)
class Target:
    """What the exponent has to meet; None leaves a condition out."""

    max_repeats: float | None = MAX_REPEATS
    min_entropy: float | None = None
    budget: int | None = None


def n_tokens(text: str):
    return F.expr(f"cast(size(filter(split(coalesce(cast({text} as string), ''), "
                  f"'{SPACE_CLASS}+'), x -> x <> '')) as bigint)")


def _summary(sizes: DataFrame, exponents: list[float], total: int) -> list[dict]:
    """Per exponent: its weights' normaliser, entropy, and largest and smallest weight over share."""
    p = F.col("tokens") / F.lit(float(total))
    cols = []
    for k, t in enumerate(exponents):
        w = F.pow(p, F.lit(t))
        cols += [F.sum(w).alias(f"z{k}"), F.sum(w * F.log(p)).alias(f"s{k}"),
                 F.max(w / p).alias(f"hi{k}"), F.min(w / p).alias(f"lo{k}")]
    row = sizes.agg(*cols).first().asDict()
    return [{c: row[f"{c}{k}"] for c in ("z", "s", "hi", "lo")} for k in range(len(exponents))]


def repeats_and_entropy(stats: dict, t: float, total: int, budget: int | None) -> tuple[float, float]:
    import math

    entropy = math.log(stats["z"]) - t * stats["s"] / stats["z"]
    if budget is None:
        return stats["hi"] / stats["lo"], entropy
    return budget * stats["hi"] / stats["z"] / total, entropy


def _bisect(sizes: DataFrame, total: int, target: Target, meets) -> tuple[float, float]:
    """An interval around the switch of ``meets``, which is false below and true above it."""
    lo, hi = 0.0, 1.0
    for _ in range(PASSES):
        grid = [lo + (hi - lo) * k / FAN for k in range(FAN + 1)]
        said = [meets(*repeats_and_entropy(s, t, total, target.budget))
                for s, t in zip(_summary(sizes, grid, total), grid)]
        if said[0]:
            return lo, lo
        if not said[-1]:
            return hi, hi
        k = said.index(True)
        lo, hi = grid[k - 1], grid[k]
    return lo, hi


def exponent(sizes: DataFrame, total: int, target: Target = Target()) -> float:
    """The exponent for the per-source ``tokens``, all positive, that sum to ``total``.

    Repeats fall and entropy falls as the exponent grows. Where both conditions
    are set and cannot hold together, the repetition limit wins.
    """
    out = 1.0 if target.min_entropy is not None else 0.0
    if target.min_entropy is not None:
        out = _bisect(sizes, total, target, lambda r, h: h < target.min_entropy - 1e-12)[0]
    if target.max_repeats is not None:
        out = max(out, _bisect(sizes, total, target, lambda r, h: r <= target.max_repeats + 1e-12)[1])
    return out if target != Target(None, None, target.budget) else 1.0


def plan(docs: DataFrame, target: Target = Target(), source_col: str = "source",
         text_col: str = "text", id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """One row per source: source, none, tokens, docs, weight, alpha, quota, blocks, epochs (whole ones),
    last_block and last_ord (how far the part of the next epoch goes; null: nowhere)."""
    rows = materialise(docs.select(
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src__"),
        F.isnull(source_col).alias("none__"), n_tokens(f"`{text_col}`").alias("n"),
        _row_hash(F.col(id_col), F.col(text_col)).alias("row")), "mixing-rows").where("n > 0")
    keys = ["src__", "none__"]
    sizes = materialise(rows.groupBy(*keys).agg(F.sum("n").alias("tokens"),
                                                F.count(F.lit(1)).alias("docs")), "mixing-sizes")
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    alpha = round(exponent(sizes, total, target), 9) if total else 1.0
    s = _summary(sizes, [alpha], total)[0] if total else {"z": 1.0, "lo": 1.0}
    p = F.col("tokens") / F.lit(float(max(total, 1)))
    weight = F.pow(p, F.lit(alpha)) / F.lit(s["z"])
    # Without a budget: the source with the least weight over share is shown once.
    quota = (F.floor(F.pow(p, F.lit(alpha)) / p / F.lit(s["lo"]) * F.col("tokens") + 1e-6)
             if target.budget is None else F.floor(weight * F.lit(float(target.budget)) + 1e-6))
    per = sizes.select(*keys, "tokens", "docs", weight.alias("weight"), F.lit(alpha).alias("alpha"),
                       quota.cast("long").alias("quota"),
                       F.ceil(F.col("docs") / BLOCK).cast("long").alias("blocks"))
    per = per.withColumn("epochs", F.expr("quota div tokens")).withColumn(
        "rest", F.expr("quota % tokens"))
    dealt = attach(rows, per.select(*keys, "epochs", "rest", "blocks"), keys, "inner").where("rest > 0")
    dealt = dealt.select(*keys, "rest", "n", *_place(F.col("row"), F.col("epochs"), F.col("blocks"), seed))
    blocks = dealt.groupBy(*keys, "rest", "block").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The block in which the quota ends: at most one per source, and small.
    ends = blocks.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).where(
        "before <= rest and before + n > rest").select(*keys, "block", "before")
    ends = materialise(ends, "mixing-ends")
    inside = attach(dealt, ends, [*keys, "block"], "inner")
    ordered = Window.partitionBy(*keys).orderBy("ord").rangeBetween(Window.unboundedPreceding, 0)
    last = inside.withColumn("sum", F.col("before") + F.sum("n").over(ordered)).where(
        "sum <= rest").groupBy(*keys).agg(F.max("ord").alias("last_ord"))
    out = per.join(ends.select(*keys, F.col("block").alias("last_block")), keys, "left").join(
        last, keys, "left")
    return materialise(out.drop("rest"), "mixing-plan")


def _row_hash(doc_id, text):
    return F.xxhash64(doc_id, F.xxhash64(text.cast("string")))


def _place(row, epoch, blocks, seed: int):
    """A row's block and its place inside, in one epoch's permutation."""
    return (F.pmod(F.xxhash64(F.lit(seed), epoch, row), blocks).alias("block"),
            F.xxhash64(F.lit(seed + 1), epoch, row).alias("ord"))


def mix(docs: DataFrame, target: Target = Target(), source_col: str = "source",
        text_col: str = "text", id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """(row, n_tokens, epoch, block, ord, weight, alpha): a row for each time a document is given;
    ``row`` is the struct of the document's columns. (source, epoch, block, ord) is the order."""
    keys = ["src__", "none__"]
    per = plan(docs, target, source_col, text_col, id_col, seed)
    r = F.col("row")
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.coalesce(r[source_col].cast("string"), F.lit("")).alias("src__"),
        F.isnull(r[source_col]).alias("none__"), r[text_col].alias("text__"),
        _row_hash(r[id_col], r[text_col]).alias("hash")).withColumn("n_tokens", n_tokens("text__"))
    met = attach(rows, per, keys)
    met = met.withColumns({"epochs": F.coalesce("epochs", F.lit(0)),
                           "blocks": F.coalesce("blocks", F.lit(1))})
    block, ord_ = _place(F.col("hash"), F.col("epochs"), F.col("blocks"), seed)
    part = F.coalesce((block < F.col("last_block")) | ((block == F.col("last_block"))
                                                       & (ord_ <= F.col("last_ord"))), F.lit(False))
    times = F.when(F.col("n_tokens") == 0, 1).otherwise(F.col("epochs") + part.cast("int"))
    given = met.withColumn("times", times.cast("int")).where("times > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    return given.select("row", "n_tokens", F.col("epoch").cast("long").alias("epoch"),
                        *_place(F.col("hash"), F.col("epoch").cast("long"), F.col("blocks"), seed),
                        "weight", "alpha")


def remix(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """The mixed documents with the columns of ``docs``; repeated documents are repeated rows."""
    return mix(docs, target).select("row.*")
