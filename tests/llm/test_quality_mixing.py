"""Quality ledger, mixing, packing, licenses, HTML and top-k against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import fixtures
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import html, licenses, mixing, packing, quality, topk


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen, cover = Counter(wins), set()
    for i, w in enumerate(wins):
        if seen[w] > 1:
            cover.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_quality_measures(spark, which):
    docs = getattr(fixtures, which)(spark)
    rows = quality.apply_policy(quality.ledger(docs)).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                  for r in rows), key=str)
    want = sorted(((r["doc_id"], *plain_measures(r["text"])) for r in docs.select("doc_id", "text").collect()), key=str)
    assert got == want
    for r in rows:
        base = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == base and not (base and r["kept"])


def test_quality_stage_ablations_and_policies(spark):
    docs = fixtures.documents(spark)
    book = quality.apply_policy(quality.ledger(docs)).cache()
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in book.where("kept").select("doc_id").collect())
    bits = [r["failures"] for r in book.collect()]
    for r in quality.ablations(book).collect():
        bit = quality.mask([r["rule"]])
        use = quality.mask(quality.POLICIES[quality.POLICY])
        assert r["failed"] == sum(bool(b & bit) for b in bits)
        assert r["only_this_rule"] == sum((b & use) == bit for b in bits)
        assert r["kept_without"] == sum(not b & use & ~bit for b in bits)
    assert quality.ledger(fixtures.empty(spark)).count() == 0 and quality.keep(fixtures.odd(spark)).count() == 1


def test_quality_keeps_good_and_rejects_junk(spark):
    """Held against the labels: beyond the base rules no good document goes, and all bad ones do."""
    book = quality.apply_policy(quality.ledger(fixtures.documents(spark, "sf0.01")))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = book.join(labels, "doc_id").select("quality", "base_failed", "kept").collect()
    assert all(r["kept"] for r in seen if r["quality"] == 1 and not r["base_failed"])
    assert not any(r["kept"] for r in seen if r["quality"] == 0)


def test_exponent_meets_its_targets(spark):
    tokens = [1_000_000, 90_000, 30_000, 500]
    sizes, total = spark.createDataFrame([(t,) for t in tokens], "tokens long"), sum(tokens)
    p = np.array(tokens) / total

    def at(t):
        w = p ** t / (p ** t).sum()
        return (w / p).max() / (w / p).min(), -(w * np.log(w)).sum()

    t = mixing.exponent(sizes, total, mixing.Target(max_repeats=3.0))
    assert at(t)[0] <= 3.0 + 1e-6 and at(t - 1e-5)[0] > 3.0
    t = mixing.exponent(sizes, total, mixing.Target(max_repeats=None, min_entropy=0.9))
    assert at(t)[1] >= 0.9 - 1e-9 and at(t + 1e-5)[1] < 0.9
    assert mixing.exponent(sizes, total, mixing.Target(max_repeats=None)) == 1.0


@pytest.mark.parametrize("which,budget", [("documents", None), ("documents", 50_000), ("odd", None), ("odd", 9_000)])
def test_mix_is_the_longest_run_within_each_quota(spark, which, budget, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    docs = getattr(fixtures, which)(spark).where(
        "(text is null or length(text) < 20000) and (source is null or source in ('a', 'b', 'c', 'src0', 'src1', 'src2'))")
    target = mixing.Target(max_repeats=2.0 if budget is None else 50.0, budget=budget)
    table = mixing.plan(docs, target)
    per = {None if r["none__"] else r["src__"]: r for r in table.collect()}
    given = defaultdict(Counter)
    for r in mixing.mix(docs, target).select("row.source", "row.doc_id", "row.text", "epoch").collect():
        given[r["source"]][r["epoch"], r["doc_id"], r["text"]] += 1
    slim = docs.select("doc_id", "text", "source", mixing.n_tokens("text").alias("t"),
                       mixing._row_hash(F.col("doc_id"), F.col("text")).alias("h"))
    place = mixing._place(F.col("h"), F.col("epochs"), F.col("blocks"), mixing.SEED)
    rows = slim.join(table.select(F.when(~F.col("none__"), F.col("src__")).alias("s"), "epochs", "blocks"),
                     F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "text", "source", "t", *place).collect()
    for source, r in per.items():
        mine = [x for x in rows if x["source"] == source]
        want, spent = Counter(), 0
        for x in mine:
            for e in range(r["epochs"] if x["t"] else 1):
                want[e, x["doc_id"], x["text"]] += 1
        part = sorted((x for x in mine if x["t"]), key=lambda x: (x["block"], x["ord"]))
        at = 0
        while at < len(part):
            tie = [x for x in part[at:] if (x["block"], x["ord"]) == (part[at]["block"], part[at]["ord"])]
            spent += sum(x["t"] for x in tie)
            if spent > r["quota"] % r["tokens"]:
                break
            for x in tie:
                want[r["epochs"], x["doc_id"], x["text"]] += 1
            at += len(tie)
        assert given[source] == want
        assert budget or r["quota"] >= r["tokens"]
    if budget is None:
        out = mixing.remix(docs, target)
        assert out.columns == docs.columns and out.distinct().count() == docs.distinct().count()
    assert mixing.remix(fixtures.empty(spark)).count() == 0


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(25))
def test_best_fit_equals_one_by_one(seed):
    import random

    r = random.Random(seed)
    cap = r.choice([10, 37, 128])
    lengths = [r.randint(1, cap - 1) for _ in range(r.randint(0, 400))] + [3] * r.randint(0, 200)
    rows = packing.best_fit(dict(Counter(lengths)), cap)
    bins, ranks = defaultdict(list), defaultdict(list)
    for length, rank, count, start, each, offset in rows:
        for k in range(count):
            bins[start + k // each].append((offset + k % each * length, length))
            ranks[length].append(rank + k)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in Counter(lengths).items()}
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= cap
    assert len(bins) == plain_best_fit(lengths, cap)


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_packing_round_trip(spark, which, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "SLOT", 7)
    coder = Tokenizer.from_file(packing.tokenizer_path())
    docs = getattr(fixtures, which)(spark)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(coder.encode(r["text"] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        n = len(ids)
        first = n if n <= 2048 else n % 2048 or 2048
        cuts = [0, *range(first, n, 2048), n]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    rows = packing.pack_documents(docs).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) == plain_best_fit([r["length"] for r in rows], 2048)
    assert packing.pack_documents(fixtures.empty(spark)).count() == 0


def test_coder_equals_the_tokenizer_on_odd_spaces():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["", " ", "a  b", " a", "a ", "a \n b", "x  y", "don't 12 345 ###!! é", "\n\n a\t\tb", "語 語  語", "a  b c"]
    got = packing.coder().encode(texts)
    assert [np.frombuffer(g, dtype="<u4").tolist() for g in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def plain_licenses(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    find = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x)
    ws, at, base, labels, score = find(low), [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
        at += hits
        if hits:
            base.add(label)
    for t in licenses.TEMPLATES:
        tw, n = set(find(t.text.lower())), len(find(t.text.lower()))
        need = next(k for k in range(len(tw) + 1) if k >= (0.8 if len(tw) >= 10 else 1) * len(tw))
        span = n + len(tw) - need
        for i in range(max(1, len(ws) - span + 1)):
            run = set(ws[i:i + span])
            share = len(tw & run) / len(tw)
            if len(tw & run) >= need and run >= set(t.required.split()) and not run & set(t.barred.split()):
                labels.add(t.label)
                score = max(score, share)
    return (len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), 1.0 if at else score)


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_licenses_match_all_pairs(spark, which):
    docs = getattr(fixtures, which)(spark)
    got = sorted((str((*r[:-1], round(r[-1], 9))) for r in licenses.scan(docs).collect()))
    want = [(r["doc_id"], *plain_licenses(r["text"])) for r in docs.select("doc_id", "text").collect()]
    assert got == sorted(str((*w[:-1], round(w[-1], 9))) for w in want)
    assert any(w[5] for w in want)
    assert licenses.scan(fixtures.empty(spark)).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><a href=/>Home</a></header>
<nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use cookies</div>
<div class="post-%d"><h1>Head &amp; shoulders</h1><p>First  para<br>goes <a href=x>on</a></p><div class="ad">Buy</div>
<p>Second &lt;b&gt; para<script>var x = "</p>";</script></p><form><p>Mail</p><input></form><ul><li>one<li>two</ul></div>
<aside>Other</aside><section id="comments"><p>I think that this is a long comment, longer than all of the text above taken
together, and nobody should read it, ever, because it only says that I was here first and that you were not.</p></section>
<footer>&copy; me</footer></body>"""


def test_html_takes_the_article_and_nothing_else():
    want = "Head & shoulders\n\nFirst para goes on\n\nSecond <b> para\n\none\n\ntwo"
    assert html.extract(PAGE % 7) == want
    assert html.extract(PAGE % 7, ">html>body.has-sidebar>div.post-#") == want
    assert html.extract("just text <b>bold") == "just text bold"
    assert html.extract("<p>a<p>b") == "a\n\nb" and html.extract("<") == "<" and html.extract(None) == ""
    assert html.extract("<div><p>cut off <i>here") == "cut off here"
    assert html.extract("<!-- x <p>no</p>") == ""


def test_html_host_vote_helps_the_odd_page(spark):
    """A page whose longest container is a list of links to stories follows its host."""
    story = "<body><div class='entry'><p>{}</p></div><div class='feed'><p>{}</p></div></body>"
    pages = [(i, "http://x.example/a%d" % i, story.format("real words " * 40, "other stories " * 5)) for i in range(9)]
    pages += [(9, "http://X.example:80/b", story.format("real words " * 9, "other stories " * 12)),
              (10, "http://y.example/b", story.format("real words " * 9, "other stories " * 12)),
              (11, None, None), (12, "no url", ""), (None, "http://x.example/a1", "<p>x"), (12, "no url", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit(2))
    rows = html.main_text(df).collect()
    got = {r["page_id"]: r["text"] for r in rows}
    assert len(rows) == len(pages) and got[9].startswith("real") and got[10].startswith("other")
    assert got[11] == got[12] == "" and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html.main_text(df.limit(0)).count() == 0


def test_html_on_given_pages(spark):
    """Articles of the given pages: all that stands between their tags, block by block."""
    import html as entities

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html.main_text(pages).collect():
        page = raw[r["page_id"]] or ""
        body = page.partition("<article>")[2].partition("</article>")[0]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", body))
        want = [" ".join(entities.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
        assert r["text"] == "\n\n".join(b for b in want if b)


def plain_top(vectors, queries, k):
    code = lambda v: sum(1 << i for i, x in enumerate(v) if x is not None and x > 0)
    codes = [(i, code(v)) for i, v in vectors if v is not None]
    out = []
    for q, v in queries:
        if v is not None:
            near = sorted(((code(v) ^ c).bit_count(), i) for i, c in codes)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("size,same", [(20, 30)])
def test_top_k_matches_a_scan(spark, size, same):
    rng = np.random.default_rng(size)
    rows = [(i, rng.normal(size=size).astype(float).tolist()) for i in range(40)]
    rows += [(300 + i, rows[0][1]) for i in range(same)] + [(900, None), (901, rows[3][1]), (901, rows[3][1]), (902, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit(1)).withColumn("qid", F.lit(2))
    asked = df.where("vec_id % 20 = 0")
    got = sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in topk.top_k(df, asked, 5).collect())
    assert got == plain_top(rows, [r for r in rows if r[0] % 20 == 0], 5)
    few = spark.createDataFrame(rows[:3], df.select("vec_id", "embedding").schema)
    assert topk.top_k(few.limit(0), few, 5).count() == 0 and topk.top_k(few, few.limit(0), 5).count() == 0


def test_html_wrappers_with_noise_names_keep_their_article():
    long = "This is the story that the page was made for, and it goes on for a while. " * 4
    want = "Title\n\n" + long.strip()
    inner = f"<h1>Title</h1><p>{long}</p>"
    menu = "<div class='sidebar'><p>Elsewhere on this site</p></div>"
    for page in (f"<body><div class='content-sidebar-wrap'><main>{inner}</main>{menu}</div></body>",
                 f"<body><div class='social-wrap'><article>{inner}</article></div>{menu}</body>",
                 f"<body><div class='post category-social'>{inner}</div>{menu}</body>",
                 f"<body><div class='elementor-widget-wrap'><div class='elementor-widget'><h1>Title</h1></div>"
                 f"<div class='elementor-widget'><p>{long}</p></div></div>{menu}</body>",
                 f"<body><div class='sidebar'>{inner}</div></body>",
                 f"<body><div class='post' data-hidden='false' data-title='Hidden id=nav'>{inner}</div>{menu}</body>"):
        assert html.extract(page) == want, page
    assert html.extract(f"<body><div class='post'>{inner}</div><div hidden><p>{long * 3}</p></div></body>") == want
    assert html.extract(f"<body><div class='post'>{inner}</div><div class='Notice'>{long[:90]}</div></body>") == want


def test_html_takes_the_article_around_the_content(spark):
    story = "What the page has to say, in a sentence that goes on. " * 20
    title, lead, after = "A headline of forty characters, no fewer", "A lead that stands before the content. " * 3, "A note after it."
    body = f"<h1>{title}</h1><p>{lead}</p><div class='entry-content'><p>{story}</p></div><p>{after}</p>"
    want = "\n\n".join([title, lead.strip(), story.strip(), after])
    links = "<div><p><a href=/1>Another story of this site</a></p></div>"
    path = ">div.entry-content"
    for around, at in (("<html><body><article>{}</article>%s</body></html>", ">html>body>article"),
                       ("<html><body><main>{}</main>%s</body></html>", ">html>body>main"),
                       ("<html><body><div class='x'>{}</div>%s</body></html>", ">html>body>div.x"),
                       ("<html><body>{}%s</body></html>", None)):
        page = (around % (links if at else "")).format(body)
        assert html.extract(page) == want, page
        assert html.extract(page, (at or ">html>body") + path) == want, page
    # a host's path that holds a third of the page's own article, inside of it
    third = f"<html><body><div class='story'><p>{story * 2}</p><p><a href=/>more</a></p><div class='b'><p>{story}</p></div></div></body></html>"
    assert html.extract(third, ">html>body>div.story>div.b") == html.extract(third)
    rows = [(k, f"http://h.example/{k}", f"<html><body><article>{body}</article>{links}</body></html>") for k in range(4)]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"] for r in got] == [want] * 4


def test_html_without_html_and_body_tags():
    para = "A paragraph that stands outside of every container. " * 3
    page = f"<h1>T</h1><p>{para}</p><p>{para}</p><div>short</div>"
    want = ["T", para.strip(), para.strip(), "short"]
    assert html.extract(page) == html.extract(page, "") == "\n\n".join(want)
    assert html.extract(page + "<nav><p>menu</p></nav><div class='ads'>Buy</div>") == "\n\n".join(want)
    assert max(html.scores(html.parse(page)).items(), key=lambda x: x[1])[0] == ""


def test_wrapped_notices_are_found(spark):
    """Each template's own words in lines of 30 to 60 characters, as in source headers and licence files."""
    import textwrap

    rows, want = [], {}
    for label, text, *_ in licenses.TEMPLATES:
        for width, mark in ((30, ""), (60, " * "), (45, "# ")):
            i = len(rows)
            lines = textwrap.wrap("Copyright (c) 2020 The Authors. " + text + ". See the file for more.", width)
            rows.append((i, "int main() {}\n\n" + "\n".join(mark + x for x in lines) + "\n\nThe end of it.\n" * 20))
            want[i] = label
    rows.append((len(rows), "Released\n" + "a b c d e f g h\n" * 9 + "under the\n" + "a b c d e f g h\n" * 9 + "MIT\nLicense"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"].split(","), r["score"]) for r in licenses.scan(docs).collect()}
    # its own label, and beside it only a base phrase's that its words hold
    base = {"apache-2.0": "apache", "gpl-3.0": "gpl", "cc-by-nc": "cc-by"}
    assert all(label in got[i][0] and got[i][1] == 1.0 for i, label in want.items())
    assert all(set(got[i][0]) <= {label, base.get(label, label)} for i, label in want.items())
    assert got[len(rows) - 1][0] == ["mit"]  # the base phrase only
    # scattered over more words than the template has: no notice
    apart = [(1, "Released\n" + "a b c d e f g h\n" * 9 + "under the\n" + "a b c d e f g h\n" * 9 + "MIT\nor other License")]
    row = licenses.scan(spark.createDataFrame(apart, "doc_id long, text string")).first()
    assert (row["labels"], row["score"]) == ("", 0.0)


GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
       "License as published by the Free Software Foundation, either version 2 of the License, or any later version.")


@pytest.mark.parametrize("text,labels", [
    ("Released under the Apache License.", "apache"),
    ("We were released from the contract under which the old license had been sold", ""),
    (GPL, "gpl"), (GPL.replace("General", "Lesser General"), "lgpl"), (GPL.replace("General", "Affero General"), "agpl"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("Licensed under CC BY 4.0", "cc-by"), ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc"),
    ("This work is licensed under the GNU General Public License, version 2", "gpl"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl,gpl-3.0"),
    ("the old mill was under repair when the license of the ferry was released and " * 9 + "MIT", ""),
])
def test_licences_are_told_apart(spark, text, labels):
    filler = "Notes on the river and the mill. " * 40
    rows = [(1, text), (2, f"{filler}{text} {filler}"), (3, "\n".join(text.split(" ")))]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["labels"] for r in got} == {labels} and len(got) == 3
    assert all(plain_licenses(t)[5] == labels for _, t in rows)


def test_licence_sql_counts_runs_like_the_operator(spark):
    """Wrapped notices, relatives and notices inside long lines through the SQL, against brute force."""
    import duckdb
    import pandas as pd

    from tidewell.llm import oracle

    texts = [None, "", GPL, "\n".join(GPL.split(" ")), GPL.replace("General", "Lesser General"), "x " * 90 + GPL + " y" * 90]
    texts += ["a b\n" * 31 + t.text.replace(" ", "\n", 3) + "\nc d" * 31 for t in licenses.TEMPLATES]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": pd.Series(texts, dtype="object")}))
    out = con.execute(oracle.sql()["op8_license_scan"]).df().astype(object)
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = {r["doc_id"]: tuple(None if pd.isna(r[c]) else r[c] for c in names) for r in out.to_dict("records")}
    assert got == {i: plain_licenses(t) for i, t in enumerate(texts)}


def test_coder_gives_the_tokenizers_ids_for_added_tokens_marks_and_spaces():
    import random

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    assert t.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    r = random.Random(1)
    bits = ["a", " ", "\n", "b.", ".", ",", "é,", "1.", "²,", "<|endoftext|>", "x<|endoftext|>y", "İ.", "語,", "\t", "ab "]
    texts = ["a <|endoftext|> b", "", *["".join(r.choice(bits) for _ in range(r.randrange(30))) for _ in range(3000)]]
    coder = packing.Coder(packing.tokenizer_path())
    want = [np.array(t.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes() for x in texts]
    assert coder.fast is not None and coder.encode(texts) == want
    coder.fast = None  # the way for other kinds of tokenizer
    assert coder.encode(texts) == want


def test_coder_gives_the_tokenizers_ids_for_every_character():
    from tokenizers import Tokenizer

    t, coder = Tokenizer.from_file(packing.tokenizer_path()), packing.coder()
    points = [c for c in [*range(0x3000), *range(0x3000, 0x110000, 61)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}1 {chr(c)}{chr(c)} {chr(c)}a .{chr(c)} \n{chr(c)}" for c in points]
    for k in range(0, len(texts), 5000):
        want = t.encode_batch(texts[k:k + 5000], add_special_tokens=False)
        assert [np.frombuffer(g, "<u4").tolist() for g in coder.encode(texts[k:k + 5000])] == [e.ids for e in want]
    for run in ("a", " ", "\n", "^", "語", "é", "ab"):
        long = run * 100_000
        assert np.frombuffer(coder.encode([long])[0], "<u4").tolist() == t.encode(long, add_special_tokens=False).ids


@pytest.mark.parametrize("page,text", [
    ("<article><p>We get <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here.</p></article>", "We get x=2 here."),
    ("<article><p>Before.</p><!-- gone --!><p>After.</p><!-- too --></article>", "Before.\n\nAfter."),
    ("<article><p>Before.</p><svg><svg><text>in</text></svg><text>out</text></svg><p>After.</p></article>", "Before.\n\nAfter."),
    ("<article><p>Before.</p><select><option>One<option>Two<p>After.</p></article>", "Before.\n\nAfter."),
    ("<article><p>Before. <button>Share</p><p>After.</p></article>", "Before.\n\nAfter."),
    ("<article><p>Before.</p><svg><text>cut</article>", "Before."),
])
def test_html_of_broken_and_nested_parts(page, text):
    assert html.extract(page) == text


@pytest.mark.parametrize("unit", ["<div class='wrap-box'>x", "<font>x", "<b>x</i></div>", "<p><span>x", "<svg>x", "<li>x", "<td>x",
                                  "<div><a href=x>y</b>", "<article><button>x"])
def test_html_time_and_memory_grow_with_the_page(unit):
    import time
    import tracemalloc

    def run(n):
        at = time.process_time()
        html.extract("<body>" + unit * n)
        return time.process_time() - at

    run(1000)
    assert run(40_000) < 10  # quadratic ways take minutes
    tracemalloc.start()
    html.extract("<body>" + unit * 10_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6
