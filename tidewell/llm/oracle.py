"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

import math

from tidewell.llm import centroids, licenses, linededup, topk

_WORDS = r"list_filter(string_split_regex({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_BLANK = r"trim({l}, E' \t\n\x0b\f\r')"


def _quality() -> str:
    words, blank = _WORDS.format(t="t"), _BLANK.format(l="x")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, {words} AS w, list_filter(string_split(t, chr(10)), lambda x: {blank} <> '') AS l FROM d),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n
        FROM (SELECT rid, u.i AS i, array_to_string(w[u.i:u.i + 4], ' ') AS k
              FROM w, unnest(range(1, len(w) - 3)) AS u(i))),
cov AS (SELECT rid, sum(least(5, gap)) AS n
        FROM (SELECT rid, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), 5) AS gap FROM win WHERE n > 1)
        GROUP BY rid),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(l) AS BIGINT) AS n_lines,
             CAST(len(regexp_extract_all(t, '!')) AS BIGINT) AS n_exclaims
      FROM w LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < 10 AS f0, 100 * n_repeat_words > 20 * n_words AS f1,
             4 * n_symbols > n_words AS f2,
             word_chars < 2 * n_words OR word_chars > 20 * n_words AS f3,
             n_lines >= 4 AND 2 * n_dup_lines > n_lines AS f4,
             2 * n_exclaims > n_words AS f5 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f0 OR f1 AS base_failed,
       NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5) AS kept, n_lines, n_exclaims,
       CAST(f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT AS BIGINT) AS failures
FROM f"""


def _topk() -> str:
    return f"""
WITH c AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '')
                  AS code FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, r.vec_id AS vec_id, hamming(q.code, r.code) AS distance
      FROM c q, c r WHERE q.vec_id % {topk.EVERY} = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
FROM o WHERE rank <= {topk.K}"""


def _lines() -> str:
    share = round(linededup.RATIO * 1_000_000)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
l AS (SELECT rid, source, u.i AS i, string_split(text, chr(10))[u.i] AS l
      FROM d, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i) WHERE text IS NOT NULL),
k AS (SELECT *, {_BLANK.format(l="l")} AS k FROM l),
n AS (SELECT k.source, k, count(DISTINCT text) AS n FROM k JOIN d USING (rid) WHERE k <> '' GROUP BY k.source, k),
h AS (SELECT source, count(DISTINCT text) AS pages FROM d WHERE text IS NOT NULL GROUP BY source),
b AS (SELECT n.source, n.k, true AS hit FROM n JOIN h ON n.source IS NOT DISTINCT FROM h.source
      WHERE n.n > 1 AND n.n * 1000000 > h.pages * {share}),
r AS (SELECT k.rid, count(*) AS n_lines, count(b.hit) AS n_dropped,
             coalesce(string_agg(k.l, chr(10) ORDER BY k.i) FILTER (WHERE b.hit IS NULL), '') AS kept
      FROM k LEFT JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.k = b.k GROUP BY k.rid)
SELECT d.doc_id, d.source, CAST(coalesce(r.n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(r.n_dropped, 0) AS BIGINT) AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL WHEN r.n_dropped = 0 THEN d.text ELSE r.kept END AS text
FROM d LEFT JOIN r USING (rid)"""


def _licenses() -> str:
    lower = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = r"list_filter(string_split_regex({t}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    hits, labels = [], []
    for k, (phrase, label) in enumerate(licenses.PHRASES.items()):
        ws = phrase.split()
        cond = " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(ws))
        hits.append(f"list_filter(range(1, len(w) + 1), lambda i: {cond}) AS p{k}")
        labels.append(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END")
    rows = []
    listed = lambda ws: f"CAST([{', '.join(repr(w) for w in ws)}] AS VARCHAR[])"
    for k, t in enumerate(licenses.TEMPLATES):
        ws = sorted(set(licenses.words_of(t.text)))
        need = len(ws) if len(ws) < licenses.WHOLE else math.ceil(licenses.THRESHOLD * len(ws) - 1e-9)
        span = len(licenses.words_of(t.text)) + len(ws) - need
        rows.append(f"({k}, '{t.label}', {listed(ws)}, {need}, {span}, {listed(t.required.split())}, {listed(t.barred.split())})")
    n = len(licenses.PHRASES)
    places = " || ".join(f"p{k}" for k in range(n))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {lower.format(t="coalesce(text, '')")} AS t FROM documents),
w AS (SELECT rid, doc_id, t, {words.format(t="t")} AS w FROM d),
p AS (SELECT rid, doc_id, len(w) AS n, {', '.join(hits)} FROM w),
q AS (SELECT rid, doc_id, n, {places} AS at, list_filter([{', '.join(labels)}], lambda x: x IS NOT NULL) AS base FROM p),
t(template, label, tw, need, span, required, barred) AS (VALUES {', '.join(rows)}),
b AS (SELECT rid, w, label, tw, need, span, required, barred FROM w, t WHERE len(list_intersect(w, tw)) >= need),
r AS (SELECT rid, label, tw, need, required, barred, w[u.i:u.i + span - 1] AS bw
      FROM b, unnest(range(1, greatest(1, len(w) - span + 1) + 1)) AS u(i)),
s AS (SELECT rid, label, len(list_intersect(bw, tw)) AS o, len(tw) AS m FROM r
      WHERE len(list_intersect(bw, tw)) >= need AND len(list_intersect(bw, required)) = len(required)
        AND len(list_intersect(bw, barred)) = 0),
g AS (SELECT rid, list_distinct(list(label)) AS more, max(o / m) AS share FROM s GROUP BY rid)
SELECT q.doc_id, CAST(q.n AS BIGINT) AS n_words, CAST(len(q.at) AS BIGINT) AS n_base,
       CAST(list_min(q.at) - 1 AS BIGINT) AS first_word, CAST(list_max(q.at) - 1 AS BIGINT) AS last_word,
       array_to_string(list_sort(list_distinct(q.base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(q.base || coalesce(g.more, []))), ',') AS labels,
       CASE WHEN len(q.at) > 0 THEN 1.0::DOUBLE ELSE coalesce(g.share, 0.0)::DOUBLE END AS score
FROM q LEFT JOIN g USING (rid)"""


def _centroids() -> str:
    near = """SELECT v.rid, arg_min(c.c, (d.d, c.c)) AS c, min(d.d) AS d FROM v, {c} c,
       LATERAL (SELECT list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d) d
       GROUP BY v.rid"""
    steps = []
    for k in range(centroids.ROUNDS):
        steps.append(f"""n{k} AS MATERIALIZED ({near.format(c=f"c{k}")}),
s{k} AS (SELECT n.c, u.i, sum(v.x[u.i]) AS s, count(*) AS n FROM n{k} n JOIN v USING (rid),
         unnest(range(1, {centroids.DIMENSIONS + 1})) AS u(i) GROUP BY n.c, u.i),
m{k} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{k} GROUP BY c),
c{k + 1} AS MATERIALIZED (SELECT c.c, CAST(coalesce(m.x, c.x) AS BIGINT[]) AS x FROM c{k} c LEFT JOIN m{k} m USING (c))""")
    last = f"c{centroids.ROUNDS}"
    return f"""
WITH w AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS e
           FROM embeddings),
v AS MATERIALIZED (SELECT rid, vec_id, list_transform(e, lambda y: CAST(floor(y * {centroids.SCALE}) AS BIGINT)) AS x
     FROM w WHERE len(e) = {centroids.DIMENSIONS} AND len(list_filter(e, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id) NULLS LAST, x) - 1 AS c, x
     FROM v QUALIFY c < {centroids.K}),
{", ".join(steps)},
z AS MATERIALIZED ({near.format(c=last)})
SELECT v.vec_id, CAST(z.c AS INTEGER) AS cluster, CAST(z.d AS BIGINT) AS distance,
       CAST(sum(z.d) OVER (PARTITION BY z.c) AS BIGINT) AS cluster_inertia, CAST(sum(z.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM z JOIN v USING (rid) JOIN {last} c ON c.c = z.c"""


def sql() -> dict[str, str]:
    return {"op4_quality_ledger": _quality(), "op5_exact_topk": _topk(), "op7_line_dedup": _lines(),
            "op8_license_scan": _licenses(), "op13_centroid_clustering": _centroids()}
