"""Whitening, centroid clustering and the quality classifier against brute force and held-out rows."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import fixtures
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import centroids, classifier, oracle, registry, topk, whitening

VECTORS = "vec_id long, embedding array<double>, label int, x string, id string, d string, cluster string, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z", "c", "n") for i, v in rows], VECTORS)


def odd(spark, d=64):
    """Usable rows (ties, repeats, a null id, long entries) among rows that are left out."""
    r = random.Random(5)
    good = [(i, [r.gauss(0, .2) for _ in range(d)]) for i in range(60)]
    good += [good[3], good[3], (None, good[7][1]), (200, good[7][1]), (201, [1000.0] * d)]
    bad = [(300, None), (301, []), (302, [1.0] * (d - 1)), (303, [None] + [0.0] * (d - 1)),
           (304, [math.nan] + [0.0] * (d - 1)), (305, [-math.inf] + [0.0] * (d - 1)), (None, None)]
    return vectors(spark, good + bad), good


# ------------------------------------------------------------------ clustering
def plain_clusters(rows, k=40, rounds=5):
    x = [(i, [math.floor(256 * c) for c in v]) for i, v in rows]
    mix = sorted(x, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in mix[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        at = [near(v)[1] for _, v in x]
        cs = [[sum(col) // at.count(j) for col in zip(*[v for (_, v), a in zip(x, at) if a == j])] if j in at else cs[j]
              for j in range(len(cs))]
    got = [(i, *near(v)) for i, v in x]
    own = {j: sum(d for _, d, c in got if c == j) for _, _, j in got}
    return [(i, c, d, own[c], sum(own.values()), hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest())
            for i, d, c in got]


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda r: tuple((v is None, v) for v in r))


COLS = ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_clusters_match_brute_force(spark):
    df, good = odd(spark)
    for n in (len(good), 5):
        df_n = df if n == len(good) else vectors(spark, good[:n])
        got = centroids.cluster(df_n).withColumn("centroid_sha256", centroids.digest_col())
        assert rows_of(got, *COLS) == sorted(plain_clusters(good[:n]), key=lambda r: tuple((v is None, v) for v in r))


def test_clusters_hold_far_entries_and_take_empty_tables(spark):
    df = vectors(spark, [(1, [1e300] + [0.0] * 63), (2, [0.0] * 64), (3, [-1e300] + [0.0] * 63)])
    got = {r["id"]: r["distance"] for r in centroids.cluster(df, k=1, rounds=0).collect()}
    assert sorted(got.values())[0] == 0 and max(got.values()) <= (2 * centroids.BOUND) ** 2
    assert centroids.cluster(vectors(spark, []).limit(0)).count() == 0


def test_clusters_match_sql_on_given_tables(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE VIEW embeddings AS FROM '/root/testdata/sf0.001/embeddings.parquet'")
    want = con.sql(oracle.sql()["op13_centroid_clustering"]).fetchall()
    got = registry.op13_centroid_clustering(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) == 500


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 5), st.integers(0, 2 ** 32 - 1), st.sampled_from([1, 3, 1000]))
def test_walk_meets_the_nearest(k, d, seed, reach):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-reach, reach + 1, (30, d)), rng.integers(-reach, reach + 1, (k, d))
    number, best = centroids.Walker(c.tolist()).nearest(x)
    all_ = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (number == all_.argmin(1)).all() and (best == all_.min(1)).all()


def test_walk_stops_early():
    """With lists of two dimensions most centroids are never met."""
    c = [[j * 100, j * 100] for j in range(1000)]
    walker = centroids.Walker(c)
    at, walker.order = [], walker.order
    take = walker.padded

    class Counting(np.ndarray):
        def __getitem__(self, k):
            at.append(np.size(k))
            return super().__getitem__(k)

    walker.padded = take.view(Counting)
    number, best = walker.nearest(np.array([[50_010, 49_990]]))
    assert (number[0], best[0]) == (500, 200) and sum(at) < 40


# ------------------------------------------------------------------- whitening
def plain_whitening(rows, most=32):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(0)
    deviation = [int(((n * r - s) ** 2).sum()) for r in x]
    z = np.array([[float(Fraction(int(n * a - b), n)) for a, b in zip(r, s)] for r in x])
    v = np.array([[float(sum(Fraction(int((n * p - s[i]) * (n * q - s[j])), n * n) for p, q in zip(x[:, i], x[:, j])) / n)
                   for j in range(len(s))] for i in range(len(s))])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return n, deviation, z @ u / np.sqrt(e), e / np.trace(v)


def test_whitening_matches_exact_arithmetic(spark):
    _, good = odd(spark, 6)
    bad = [(300, None), (301, []), (302, [1.0] * 5), (303, [None] + [0.0] * 5), (304, [math.inf] + [0.0] * 5)]
    got = whitening.whiten(vectors(spark, good + bad)).toPandas()
    n, deviation, white, explained = plain_whitening(good)
    assert set(got["n"]) == {n} and len(got) == n * 6
    assert sorted(got[got.component == 1].deviation.tolist()) == sorted(deviation)
    for k in range(6):
        own = got[got.component == k + 1]
        assert own.explained.iloc[0] == pytest.approx(explained[k], rel=1e-9)
        mine, theirs = np.sort(own.whitened.to_numpy(float)), np.sort(white[:, k])
        assert min(np.abs(mine - theirs).max(), np.abs(np.sort(-mine) - theirs).max()) < 1e-8
    assert 0 <= got.identity_error.iloc[0] < 1e-10 and got.identity_error.nunique() == 1


def test_whitening_of_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = whitening.whiten(df).toPandas().sort_values(["id", "component"])
    rows = [(r["vec_id"], r["embedding"]) for r in df.orderBy("vec_id").collect()]
    w = got.whitened.to_numpy(float).reshape(-1, 32)
    x = np.array([[math.floor(64 * c) for c in v] for _, v in rows], float)
    x -= x.mean(0)
    e, u = np.linalg.eigh(x.T @ x / len(x))
    want = x @ u[:, ::-1][:, :32] / np.sqrt(e[::-1][:32])
    assert np.abs(np.abs(w) - np.abs(want)).max() < 1e-8
    assert np.abs(np.cov(w.T, bias=True) - np.eye(32)).max() < 1e-9


def test_whitening_is_exact_for_far_entries():
    rng = np.random.default_rng(2)
    y = rng.integers(-(1 << 40), 1 << 40, (50, 4))
    got = whitening._squares(y)
    assert all(q == sum((int(r[i]) + (int(r[j]) if i != j else 0)) ** 2 for r in y) for (i, j), q in got.items())
    assert len(got) == 10


def test_whitening_without_variance_and_of_empty_tables(spark):
    flat = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(flat) == 4 and all(r["whitened"] is None and r["identity_error"] is None and r["deviation"] == 0
                                  for r in flat)
    line = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (None, [3.0, 2.0])])).collect()
    assert {(r["component"], r["whitened"] is None) for r in line} == {(1, False), (2, True)}
    assert sorted(abs(r["whitened"]) for r in line if r["whitened"] is not None) == pytest.approx([1, 1])
    far = whitening.whiten(vectors(spark, [(1, [1e300]), (2, [-1e300])])).collect()
    assert [r["deviation"] for r in far] == [None, None]
    assert whitening.whiten(vectors(spark, [(1, None)])).count() == 0


# ------------------------------------------------------------------ classifier
def plain_features(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\f\r" else c for c in text).split(" ") if w]
    return [(1, w) for w in words] + [(2, p) for p in zip(words, words[1:])] + [
        (3, a == b) for a, b in zip(words, words[1:])] + [
        (n, m[i:i + n]) for w in words for m in [f" {w} "] for n in (3, 4, 5) for i in range(len(m) - n + 1)]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab \n\té語🙂!", max_size=60))
def test_features_are_words_pairs_and_grams(text):
    assert classifier.features(text).sum() == len(plain_features(text))


def test_features_of_pieces_are_those_of_the_whole(monkeypatch):
    text = " ".join(f"w{k % 37} x{k % 11}\n\n" for k in range(300))
    whole = classifier.features(text)
    monkeypatch.setattr(classifier, "CHUNK", 64)
    assert (classifier.features(text) == whole).all()
    assert classifier.features("a" * 1000).sum() > 1000  # a word longer than a piece


def test_classifier_on_held_out_rows(spark):
    docs, labels = fixtures.documents(spark, "sf0.01"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = classifier.classify(docs, labels)
    got = scored.toPandas()
    assert len(got) == docs.count()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out))
    assert all(p == (s >= 0.3) and 0 <= s <= 1 for p, s in zip(got.predicted, got.score))
    assert classifier.accuracy(scored, labels)["accuracy"] > 0.95
    both = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    ranks, one = both.score.rank(), both.quality == 1
    auc = (ranks[one].sum() - one.sum() * (one.sum() + 1) / 2) / (one.sum() * (~one).sum())
    assert auc > 0.97


def test_classifier_learns_from_no_held_out_label(spark):
    docs, labels = fixtures.documents(spark), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", F.when(classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    shown = [sorted(map(tuple, classifier.classify(docs.withColumn("lang", F.lit(x)).withColumn("source", F.lit(x)), of)
                        .collect())) for of, x in ((labels, "a"), (flipped, "b"))]
    assert shown[0] == shown[1]
    ids = {r["id"] for r in classifier.examples(docs, labels).select("id").collect()}
    assert ids and not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)


def test_classifier_sample_is_bounded(spark):
    docs, labels = fixtures.documents(spark), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    assert classifier.examples(docs, labels, sample=20).count() == 20
    twice = docs.union(docs).union(docs.withColumn("text", F.concat("text", F.lit(" more"))))
    assert classifier.examples(twice, labels).count() == classifier.examples(docs, labels).count()


def test_classifier_takes_odd_rows(spark):
    docs, kind = fixtures.odd(spark), "doc_id long, quality int, text string, score string"
    labels = spark.createDataFrame([(1, 1, "t", "s"), (2, 0, "t", "s"), (9, 1, "t", "s"), (9, 0, "t", "s"), (6, None, "t", "s"),
                                    (None, 1, "t", "s"), (77, 1, "t", "s"), (7, 5, "t", "s"), (10, 0, "t", "s")], kind)
    got = classifier.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    assert len({r["score"] for r in got if r["doc_id"] in (4, 5, 8)}) == 1
    assert {r["score"] for r in classifier.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert classifier.classify(fixtures.empty(spark), labels).count() == 0


def test_training_is_stable_at_high_rates():
    r = random.Random(1)
    made = []
    for k in range(60):
        text = " ".join(r.choice("red green blue gray pink".split() if k % 2 else ["spam"]) for _ in range(50))
        c = classifier.features(text)
        at = np.nonzero(c)[0]
        made.append((at, c[at].astype(np.float32), k % 2))
    m = classifier.train(made, rate=2.0)
    score = m.scorer()
    assert np.isfinite(m.vectors).all()
    assert score(classifier.features("spam " * 9)) < 0.3 < 0.7 < score(classifier.features("blue pink red green"))


@pytest.mark.parametrize("first", [topk.FIRST, 64])
def test_top_k_over_several_rounds_matches_a_scan(spark, first, monkeypatch):
    """600 random codes without near neighbours: queries close in different rounds, whatever a round takes."""
    steps = topk.rounds
    monkeypatch.setattr(topk, "rounds", lambda segs: steps(segs, first))
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 2, (600, 64))
    rows = [(i, [float(2 * b - 1) for b in v]) for i, v in enumerate(bits)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id % 40 = 0"), 7).collect()
    want = []
    for q in range(0, 600, 40):
        near = sorted((int((bits[q] != v).sum()), i) for i, v in enumerate(bits))[:7]
        want += [(q, place + 1, i, d) for place, (d, i) in enumerate(near)]
    assert sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in got) == want


def test_top_k_rounds_take_every_step_once_and_cover_by_pigeonhole():
    segs = topk.segments(128, 5000)
    steps = [s for part in topk.rounds(segs) for s in part]
    widest = max(s[2] for s in segs)
    assert steps == [(k, r) for r in range(widest + 1) for k in range(len(segs))]
    rng = np.random.default_rng(2)
    for _ in range(200):  # a code at distance t - 1 or less is met within t steps
        flips = rng.integers(0, 2, 128) * (rng.random(128) < rng.random())
        parts = [int(flips[64 * w + a:64 * w + a + n].sum()) for w, a, n in segs]
        assert min(steps.index((k, d)) for k, d in enumerate(parts)) <= sum(parts)


def made(df):
    """Rows that the joins, generators and Python steps of a query make."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.nodeName()
        if kind == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStage"):
            todo.append(node.plan())
        if any(w in kind for w in ("Join", "Generate", "Pandas")) and node.metrics().contains("numOutputRows"):
            out += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return out


def test_top_k_makes_no_row_per_probe(spark, monkeypatch):
    """Without near neighbours a query probes about as many masks as there are codes; they are no rows."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    write, counts = topk.materialise, []

    def counted(part, name):
        counts.append(made(part))
        return write(part, name)

    monkeypatch.setattr(topk, "materialise", counted)
    assert topk.top_k(df, df.where("vec_id % 20 = 0"), 10).count() == 300
    assert 0 < sum(counts) <= 600 + 300


def test_top_k_over_several_blocks_matches_a_scan(spark, monkeypatch):
    """Blocks of about 50 codes of 100 bits, a chunk of few queries, pieces of 8: turns of 1, 1, 2, ... blocks."""
    for name, value in (("BLOCK", 100), ("CHUNK", 2), ("PIECE", 8)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(9)
    bits = rng.integers(0, 2, (260, 100))
    bits[40:80] = bits[0]  # copies
    bits[80:120] = bits[1] ^ (rng.random((40, 100)) < 0.02)  # near copies
    df = spark.createDataFrame([(i, [float(2 * b - 1) for b in v]) for i, v in enumerate(bits)],
                               "vec_id long, embedding array<double>")
    turns, write = [], topk.materialise
    monkeypatch.setattr(topk, "materialise", lambda part, name: (turns.append(name), write(part, name))[1])
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), 7).collect()
    want = []
    for q in range(0, 260, 20):
        near = sorted((int((bits[q] != v).sum()), i) for i, v in enumerate(bits))[:7]
        want += [(q, place + 1, i, d) for place, (d, i) in enumerate(near)]
    assert sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in got) == want
    assert turns.count("topk-best") == 4


@pytest.mark.parametrize("same,bound", [(0, 1 << 30), (200, 1 << 30), (200, 20)])
def test_index_holds_few_codes_at_a_time(monkeypatch, same, bound):
    """``same`` codes share a segment's value: what is met comes in parts, whatever the value's size."""
    monkeypatch.setattr(topk, "HELD", 64)
    rng = np.random.default_rng(10)
    code = rng.integers(0, 1 << 63, (300, 1), dtype=np.uint64)
    code[:same] &= ~np.uint64(0xFFFF)
    code, n = np.unique(code, axis=0), rng.integers(1, 4, 300)
    segs = topk.segments(64, 300)
    index, sizes = topk.Index(code, n, segs), []
    meet = index.met

    def met(*args):
        for row, c in meet(*args):
            sizes.append((len(row), len(set(row.tolist()))))
            yield row, c

    index.met = met
    q, c, d = index.search(code[::30], np.full(10, bound, np.int64), list(topk.rounds(segs)), 9)
    for i, own in enumerate(code[::30, 0]):
        all_ = sorted(((int(own) ^ v).bit_count(), j) for j, v in enumerate(code[:, 0].tolist()))
        mine, rows = sorted(zip(d[q == i].tolist(), c[q == i].tolist())), 0
        for near in all_:  # the codes that hold the nine nearest rows
            if rows >= 9 or near[0] > bound:
                break
            assert near in mine
            rows += n[near[1]]
    assert all(rows <= 64 or at == 1 for rows, at in sizes)
