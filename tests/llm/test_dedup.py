"""SimHash, line dedup, suffix dedup and unit dedup against brute force."""

import hashlib
from collections import Counter, defaultdict

import fixtures
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.llm import linededup, simhash, suffix, units


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace(
        "\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, bits=4):
    """[(id, fingerprint)] -> component by breadth-first search over all pairs."""
    values = sorted({f for _, f in fps})
    near = {v: [u for u in values if (u ^ v).bit_count() <= bits] for v in values}
    comp, out = {}, []
    for v in values:
        if v in comp:
            continue
        comp[v], todo = v, [v]
        while todo:
            for u in near[todo.pop()]:
                if u not in comp:
                    comp[u] = v
                    todo.append(u)
    low = defaultdict(list)
    for i, f in fps:
        if i is not None:
            low[comp[f]].append(i)
    for i, f in fps:
        out.append((i, f, min(low[comp[f]], default=None)))
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_simhash_matches_all_pairs(spark, which):
    docs = getattr(fixtures, which)(spark)
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    fps = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
    assert key(got) == key(plain_components(fps))


def test_near_pairs_are_all_pairs_once(spark):
    import random

    r = random.Random(3)
    seeds = [r.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    fps = {s ^ sum(1 << r.randrange(64) for _ in range(r.randrange(5))) & ((1 << 64) - 1) for s in seeds for _ in range(25)}
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    got = [tuple(x) for x in simhash.near_pairs(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()]
    want = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) % (1 << 64)).bit_count() <= 4]
    assert sorted(got) == sorted(want) and len(want) > 50


def test_keep_first_keeps_one_row_of_each_component(spark):
    docs = fixtures.odd(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    rows = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()])
    assert ids == Counter({c: 1 for i, _, c in rows if i is not None})  # rows without an id are copies of named ones
    assert simhash.keep_first(fixtures.empty(spark)).count() == 0


def test_component_chain(spark):
    """A long chain of links is one component."""
    from tidewell.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def plain_lines(rows, ratio):
    pages, held = Counter(), Counter()
    strip = lambda x: x.strip(" \t\n\x0b\f\r")
    for text, source in {(text, source) for _, text, source in rows if text is not None}:
        pages[source] += 1
        held.update({(source, strip(x)) for x in text.split("\n")} - {(source, "")})
    out = []
    for i, text, source in rows:
        if text is None:
            out.append((i, 0, 0, None))
            continue
        lines = text.split("\n")
        gone = [held[source, strip(x)] > max(1, ratio * pages[source]) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


@pytest.mark.parametrize("which,ratio", [("odd", 0.3), ("documents", 0.05), ("documents", linededup.RATIO)])
def test_line_dedup_matches_counts(spark, which, ratio):
    docs = getattr(fixtures, which)(spark)
    out = linededup.drop_boilerplate(docs, ratio=ratio)
    got = [(r[0], r[1], r[2], r[3]) for r in out.select("doc_id", "n_lines", "n_dropped", "text").collect()]
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert key(got) == key(plain_lines(rows, ratio))
    assert which == "odd" or sum(r[2] for r in got) > 0
    assert linededup.clean(docs).columns == docs.columns
    assert linededup.clean(fixtures.empty(spark)).count() == 0


def test_line_dedup_counts_a_copied_text_once(spark):
    """Copies of a document keep their lines; menus of different pages go; a host of one page keeps all."""
    rows = [(i, "Menu\nThe same article\nin every row", "copies") for i in range(30)]
    rows += [(100 + i, f"Menu\nArticle {i}\nends {i}", "site") for i in range(30)]
    rows += [(200, "Alone\non its host", "one"), (201, "Menu\nfirst", None), (202, "Menu\nsecond", None), (203, "", "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in linededup.clean(docs).collect()}
    assert all(got[i] == text for i, text, source in rows if source in ("copies", "one"))
    assert all(got[100 + i] == f"Article {i}\nends {i}" for i in range(30))
    assert (got[201], got[202]) == ("first", "second")


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_line_dedup_drops_recurring_lines_of_the_given_tables(spark, sf):
    rows = linededup.drop_boilerplate(fixtures.documents(spark, sf)).select("n_lines", "n_dropped").collect()
    assert 0 < sum(r["n_dropped"] for r in rows) < 0.05 * sum(r["n_lines"] for r in rows)


def plain_suffix(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("which,hot", [("odd", 1000), ("documents", 1000), ("documents", 1)])
def test_suffix_dedup_matches_window_counts(spark, which, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", hot)  # 1: the way for hot anchors does everything
    docs = getattr(fixtures, which)(spark)
    got = [tuple(r) for r in suffix.dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    rows = docs.select("doc_id", "text").collect()
    want = [(r["doc_id"], *p) for r, p in zip(rows, plain_suffix([r["text"] for r in rows]))]
    assert key(got) == key(want)
    assert sum(r[2] for r in want) > 1000


def test_suffix_dedup_of_nothing(spark):
    assert suffix.dedup(fixtures.empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=40), min_size=1, max_size=6), st.integers(2, 9))
def test_run_length_index_marks_all_repeats(parts, length):
    raw = [p.encode() for p in parts]
    seen = Counter(p[i:i + length] for p in raw for i in range(len(p) - length + 1))
    want = []
    for p in raw:
        gone = [any(seen[p[i:i + length]] > 1 for i in range(max(0, k - length + 1), min(k, len(p) - length) + 1))
                for k in range(len(p))]
        want.append(gone)
    got = suffix.repeated_in(raw, length)
    assert [[any(a <= k < b for a, b in s) for k in range(len(p))] for s, p in zip(got, raw)] == want


def test_long_texts_are_scanned_whole(spark):
    """A text over the chunk size, with one far repeat on either side of the chunk's end."""
    import random

    r = random.Random(5)
    body = "".join(r.choices("abcdefgh ", k=2_300_000))
    passage = "".join(r.choices("klmnopqr ", k=260))
    text = body[:1_048_500] + passage + body[1_048_500:]
    docs = spark.createDataFrame([(1, text), (2, "zzz" + passage)], "doc_id long, text string")
    got = {x["doc_id"]: (x["n_removed"], x["n_spans"]) for x in suffix.dedup(docs).collect()}
    assert got == {1: (260, 1), 2: (260, 1)}


def plain_units(rows, least=units.MIN_WORDS):
    """Earliest by (doc_id, text hash, row, place) stays; null ids are the last."""
    last = max([i for i, _ in rows if i is not None], default=0) + 1
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    found = []
    for n, (i, text) in enumerate(rows):
        h = signed(xxhash.xxh64_intdigest((text or "").encode(), 42))
        for a, b, words in units.units(text or ""):
            if len(words.split()) >= least:
                found.append(((last if i is None else i, h, n), a, b, words.translate(units._LOWER)))
    out, seen = defaultdict(list), set()
    for rank, a, b, words in sorted(found):
        if words in seen:
            out[rank[-1]].append((a, b))
        seen.add(words)
    return [(i, out[n]) for n, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_unit_dedup_matches_brute_force(spark, which):
    docs = getattr(fixtures, which)(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    out = units.dedup(docs).select("row.doc_id", "removed", "text", "row.text").collect()
    got = [(r[0], [(s["start"], s["end"]) for s in r[1]]) for r in out]
    assert key([(i, str(s)) for i, s in got]) == key([(i, str(s)) for i, s in plain_units(rows)])
    for _, spans, kept, text in out:
        if text is None:
            assert kept is None
        else:
            gone = {k for s in spans for k in range(s["start"], s["end"])}
            cut = "".join(c for k, c in enumerate(text) if k not in gone)
            assert kept == cut
    assert units.dedup(fixtures.empty(spark)).count() == 0


def test_rows_without_or_with_the_same_id_are_documents_of_their_own(spark):
    tail = " And the ferry went home before the storm reached the harbor."
    rows = [(1, fixtures.LONG), (1, fixtures.LONG), (1, fixtures.LONG), (None, fixtures.LONG + tail), (None, fixtures.LONG + tail),
            (None, tail), (2, "A line that only the second of them has ever held so far."), (2, tail * 2), (None, None)]
    out = units.dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "row.text", "removed").collect()
    got = [(r[0], r[1], str([(s["start"], s["end"]) for s in r[2]])) for r in out]
    assert key(got) == key([(i, t, str(cut)) for (i, t), (_, cut) in zip(rows, plain_units(rows))])
    whole = [r for r in got if r[0] == 1 and r[2].count("(") == fixtures.LONG.count("light.")]
    assert len(whole) == 2  # of three equal rows one keeps its first sentence


def test_units_cover_the_text():
    text = "One two. Three\n four?  five!\n\nsix 3.5 seven."
    assert [text[a:b] for a, b, _ in units.units(text)] == ["One two.", "Three", "four?", "five!", "six 3.5 seven."]
    assert [text[a:b] for a, b, _ in units.units(text, "line")] == ["One two. Three", "four?  five!", "six 3.5 seven."]
    assert len(list(units.units(text, "paragraph"))) == 2


def test_shared_passages_go_whole_and_lone_short_lines_stay(spark):
    passage = "The mill by the river turned all through the night. No one came. It was late. Why?\nThen it stopped, and the water went on without it."
    chinese = "这是一个很长的句子它没有任何空格而且在两份文件里都出现"
    rows = [(1, "Start of one. " + passage + "\nYes.\n" + chinese), (2, "Start of two. " + passage + "\nEnd of two.\nYes.\nOnly here.\n" + chinese),
            (3, "Yes.\nAnother text that nobody else has ever written down.")]
    out = units.dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_bytes=units.MIN_BYTES)
    got = {r[0]: r[1] for r in out.select("row.doc_id", "text").collect()}
    assert got[1] == rows[0][1] and got[3] == rows[2][1]
    assert " ".join(got[2].split()) == "Start of two. End of two. Yes. Only here."


def test_registered_unit_dedup_matches_brute_force(spark):
    from tidewell.llm import registry

    rows = [tuple(r) for r in fixtures.documents(spark).select("doc_id", "text").collect()]
    texts = {i: [(a, b, w.translate(units._LOWER)) for a, b, w in units.units(t or "")] for i, t in rows}
    first = {}
    for i in sorted(texts):
        for _, _, w in texts[i]:
            first.setdefault(w, i)
    want = {}
    for i, found in texts.items():
        seen, repeated = set(), []
        for _, _, w in found:
            repeated.append(first[w] != i or w in seen)
            seen.add(w)
        want[i] = []
        for k, (a, b, _) in enumerate(found):
            lo, hi = k, k
            while lo and repeated[lo - 1]:
                lo -= 1
            while hi + 1 < len(found) and repeated[hi + 1]:
                hi += 1
            if repeated[k] and any(len(found[j][2].encode()) >= units.MIN_BYTES for j in range(lo, hi + 1)):
                want[i].append((a, b))
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["removed"]]
           for r in registry.op10_substring_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_keep_first_tells_rows_of_one_id_apart(spark):
    other = "Nine barges went down the canal before the ice closed it and nobody counted those that came back in spring. " * 5
    rows = [(1, fixtures.LONG), (2, other), (2, fixtures.LONG), (3, fixtures.LONG * 2 + other * 7), (3, "An apple fell on the old man's hat. " * 8),
            (3, "An apple fell on the old man's hat. " * 8)]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert key([tuple(r) for r in kept.collect()]) == key(rows[:2] + rows[3:5])


def test_keep_first_rows_without_an_id(spark):
    other = "Nine barges went down the canal before the ice closed it and nobody counted those that came back in spring. " * 5
    rows = [(None, fixtures.LONG), (None, fixtures.LONG), (1, fixtures.LONG), (None, other), (None, other), (None, other),
            (None, "An apple fell on the old man's hat. " * 8), (7, "Seven geese and a fox met on the road to the mill at noon.")]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert key([tuple(r) for r in kept.collect()]) == key([rows[2], rows[3], rows[6], rows[7]])
    few = simhash.keep_first(spark.createDataFrame(rows[:2], "doc_id long, text string"))
    assert [tuple(r) for r in few.collect()] == rows[:1]
