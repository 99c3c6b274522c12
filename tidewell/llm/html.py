"""Operator 3: HTML extraction by consensus host paths.

Pass 1 parses every page, scores its containers by the text they hold, and
lets the page vote with its best containers' generalised tag-class paths
(digits in class names become ``#``). Spark sums the votes per (host, path) -
partial sums per map task, so a hot host is a few rows by then - and each host
gets the path with most votes. Pass 2 parses again and takes the blocks under
the host's path, up to the article around them; a page without it, or with
little of its text there, falls back to its own best container.

A page has an implied root container, for the text outside all others; its path is ''.

Results for odd rows: null or empty html gives an empty text, and so does a
page without text blocks; a null or unparsable url belongs to the host ``''``;
repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import attach, materialise

#: Elements whose content is never text of the page.
RAW = frozenset("script style noscript template iframe object svg canvas audio video textarea title "
                "select button option datalist annotation annotation-xml".split())
#: Of these, what runs to the page's end without an end tag; the others end at the next block.
RAW_TEXT = frozenset("script style textarea title".split())
#: Elements left out with all they hold.
LEFT_OUT = frozenset("head nav footer aside form dialog menu fieldset".split())
#: What holds the blocks outside every other container: both <html> and <body> may be left out.
ROOT = "#root"
#: Keys of the open containers and of open elements that are left out without an end tag.
HELD, SKIPPED = "#held", "#skipped"
CONTAINERS = frozenset("html body main article section div td center blockquote".split()) | {ROOT}
BLOCKS = frozenset("html body main article section div td th tr table thead tbody tfoot center blockquote p h1 h2 "
                   "h3 h4 h5 h6 ul ol li dl dt dd pre figure figcaption header footer nav aside form address hr "
                   "caption details summary fieldset dialog menu hgroup search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = BLOCKS - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "p": {"p"}}
#: Words in a class or id that mark an advert, menu, notice, comment list and the like.
NOISE = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promos "
                  "promotion banner banners sidebar sidebars sidenav nav navbar navigation menu menus submenu "
                  "breadcrumb breadcrumbs footer comment comments commentlist disqus respond replies cookie cookies "
                  "consent gdpr notice notices alert popup popups modal overlay newsletter subscribe subscription "
                  "signup login social share sharing related recommended recommendations widget widgets toolbar "
                  "pager pagination skip masthead topbar tags hidden".split())
NOISE_NAMES = frozenset("header site-header page-header header-wrapper top-header siteheader pageheader".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
NEVER = frozenset("html body main article".split())
#: Names of what readers write: it may well be longer than the article, so its share of the page says nothing.
REPLIES = frozenset("comment comments commentlist disqus respond replies".split())
HINT = frozenset("content article post entry main story body text maincontent articlebody".split())

LONG_PATH = 200
TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>"
                 r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S)
ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
READ = frozenset("class id role hidden aria-hidden style".split())
DIGITS = re.compile(r"\d+")
WORDS = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Elements (parallel lists) and text blocks in page order."""

    tags: list[str] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    holders: list[int] = field(default_factory=list)  # the innermost container, the element itself included
    out: list[bool] = field(default_factory=list)
    hints: list[float] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # container, text, link characters


def _left_out(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    if tag in LEFT_OUT:
        return True
    if tag == "header" and not inside:  # a site's header; an article's own header holds its title
        return True
    if tag in NEVER or not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I))


def _noise(tag: str, attrs: dict[str, str]) -> frozenset[str]:
    """The noise words of an element's names."""
    if tag in NEVER or not attrs:
        return frozenset()
    found: set[str] = set()
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        if name in NOISE_NAMES:
            found.add(name)
            continue
        words = WORDS.findall(name)
        if words and words[0] not in ("has", "with", "no", "without", "non"):
            found |= NOISE.intersection(words)
    return frozenset(found)


def _settle(page: Page, noise: dict[int, frozenset[str]], owners: list[int]) -> None:
    """Leave out what noise names mark, but not where the names mark the page's main text.

    A noise word is void on a page where the elements named so hold more than half of
    the text outside links (readers' comments only if they hold the page's h1); an
    element that holds a <main> or the longest <article> is no noise; and if nothing
    would be left, no name counts.
    """
    if not noise:
        return
    size = [0] * len(page.tags)
    title = [t == "h1" for t in page.tags]
    main = [t == "main" for t in page.tags]
    for e, (_, text, links) in zip(owners, page.blocks):
        size[e] += max(0, len(text) - 2 * links)
    whole = sum(max(0, len(text) - 2 * links) for _, text, links in page.blocks)
    for e in range(len(page.tags) - 1, -1, -1):
        p = page.parents[e]
        if p >= 0:
            size[p] += size[e]
            title[p] |= title[e]
            main[p] |= main[e]
    articles = [e for e, t in enumerate(page.tags) if t == "article" and size[e]]
    e = max(articles, key=lambda e: (size[e], -e), default=-1)
    while e >= 0:
        main[e], e = True, page.parents[e]
    held: dict[str, int] = defaultdict(int)
    titled: set[str] = set()
    above: list[frozenset[str]] = []
    for e, p in enumerate(page.parents):
        outer = above[p] if p >= 0 else frozenset()
        for w in noise.get(e, frozenset()) - outer:  # the outermost element of a word holds the others
            held[w] += size[e]
            titled |= {w} if title[e] else set()
        above.append(outer | noise.get(e, frozenset()))
    void = {w for w, n in held.items() if 2 * n > whole and (w not in REPLIES or w in titled)}
    named = [not main[e] and bool(noise.get(e, frozenset()) - void) for e in range(len(page.tags))]
    for e, p in enumerate(page.parents):
        named[e] |= p >= 0 and named[p]
    kept = [b for e, b in zip(owners, page.blocks) if not named[e]]
    if kept:
        page.blocks = kept
        page.out = [a or b for a, b in zip(page.out, named)]


def _skip(tag: str, text: str, at: int) -> int | None:
    """Where the element ends that was opened before ``at``, inner elements of its name included; None: nowhere."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(text, at):
        if m[1] or tag in RAW_TEXT:
            depth -= bool(m[1])
        elif not m[0].endswith("/>"):
            depth += 1
        if not depth:
            return m.end()
    return None


def parse(text: str) -> Page:
    """A forgiving reader: unclosed, misnested and cut-off markup all give blocks.

    Time and memory grow with the page's length, however deep it nests: what an element
    has from those around it is handed down, open elements are found by their tag, and
    a path of over ``LONG_PATH`` characters goes on from its hash.
    """
    page = Page([ROOT], [""], [-1], [0], [False], [1.0])
    inside = [False]  # in an article or main
    stack: list[int] = [0]  # open elements; no end tag closes the root
    opened: dict[str, list[int]] = defaultdict(list, {HELD: [0]})  # places in the stack by tag; containers; skipped ones
    endless: set[str] = set()  # left-out tags that are not all closed further on: elements like others from there
    buf: list[str] = []
    at, links, link_chars = 0, 0, 0
    noise: dict[int, frozenset[str]] = {}
    owners: list[int] = []  # the innermost element of each block

    def place(*tags: str) -> int:
        """Place in the stack of the innermost open element of these tags."""
        return max((opened[t][-1] for t in tags if opened[t]), default=-1)

    def flush() -> None:
        nonlocal link_chars
        if buf:
            raw = "".join(buf)
            buf.clear()
            clean = " ".join(entities.unescape(raw).split())
            if clean and not page.out[stack[-1]]:
                page.blocks.append((page.holders[stack[-1]], clean, link_chars))
                owners.append(stack[-1])
        link_chars = 0

    def close(upto: int) -> None:
        nonlocal links
        while len(stack) > upto:
            e = stack.pop()
            links -= page.tags[e] == "a"
            for names in (opened[page.tags[e]], opened[HELD], opened[SKIPPED]):
                if names and names[-1] == len(stack):
                    names.pop()

    size = len(text)
    while at < size:
        m = TAG.search(text, at)
        end = m.start() if m else size
        if end > at:
            piece = text[at:end]
            buf.append(piece)
            if links:
                link_chars += len(piece.strip())
        if m is None:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in VOID:
                buf.append(" ")
                continue
            k = place(tag)
            if k < 0 or (tag not in BLOCKS and place(HELD) > k):
                continue
            if tag in BLOCKS or page.out[stack[k]] or stack[k] in noise:
                flush()
            close(k)
            continue
        attrs_text = m[3] if m[2] else m[6] or ""
        if tag == "br" or tag in VOID and tag not in BLOCKS:
            buf.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if place(SKIPPED) > place(HELD):
                close(place(SKIPPED))
        if tag == "hr":
            continue
        if tag in RAW:
            if attrs_text.rstrip().endswith("/"):
                continue
            shut = None if tag in endless else _skip(tag, text, at)
            if shut is not None:
                at = shut
                continue
            if tag in RAW_TEXT:
                at = size
                continue
            endless.add(tag)
            if place(SKIPPED) > place(HELD):  # inside another one
                continue
        attrs = {}
        if attrs_text:
            for a in ATTR.finditer(attrs_text):
                name = a[1].lower()
                if name in READ:
                    attrs.setdefault(name, a[2] or a[3] or a[4] or "")
        if tag in ENDS_P:
            if place("p") > place(HELD):
                close(place("p"))
        if tag in CLOSES:
            k = place(*CLOSES[tag])
            if k >= 0 and k >= place(HELD, "ul", "ol", "dl", "table"):
                close(k)
        parent = stack[-1]
        left_out = tag in RAW or _left_out(tag, attrs, inside[parent])
        words = _noise(tag, attrs)
        out = page.out[parent] or left_out
        if (left_out or words) and tag not in BLOCKS:
            flush()
        base = page.paths[parent]
        if tag in CONTAINERS or tag in ("header",):
            names = sorted({DIGITS.sub("#", c) for c in attrs.get("class", "").lower().split()})
            base = f"{base}>{tag}" + "".join(f".{c}" for c in names)
            if len(base) > LONG_PATH:
                base = "~" + hashlib.blake2b(base.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
        hint = 2.0 if tag in ("article", "main") or attrs.get("role") == "main" else (
            1.5 if not HINT.isdisjoint(WORDS.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower())) else 1.0)
        page.tags.append(tag)
        page.paths.append(base)
        page.parents.append(parent)
        page.out.append(out)
        page.hints.append(1.0 if tag in ("html", "body") else hint)
        e = len(page.tags) - 1
        page.holders.append(e if tag in CONTAINERS else page.holders[parent])
        inside.append(inside[parent] or tag in ("article", "main"))
        if words:
            noise[e] = words
        if attrs_text.endswith("/") and tag not in BLOCKS:
            continue
        for name, holds in ((tag, True), (HELD, tag in CONTAINERS), (SKIPPED, tag in RAW)):
            if holds:
                opened[name].append(len(stack))
        stack.append(e)
        links += tag == "a"
    flush()
    _settle(page, noise, owners)
    return page


def scores(page: Page) -> dict[str, float]:
    """Path -> score: characters outside links in a container's own blocks, and 0.6 of its inner containers'."""
    own: dict[int, float] = defaultdict(float)
    for e, text, links in page.blocks:
        own[e] += max(0, len(text) - 2 * links)
    total: dict[int, float] = dict(own)
    for e in range(len(page.tags) - 1, -1, -1):  # children come after their parents
        s = total.get(e, 0.0)
        if s and e and page.tags[e] in CONTAINERS:
            p = page.holders[page.parents[e]]
            total[p] = total.get(p, 0.0) + 0.6 * s
    out: dict[str, float] = defaultdict(float)
    for e, s in total.items():
        out[page.paths[e]] += s * page.hints[e]
    return out


def best_path(page: Page) -> str | None:
    found = scores(page)
    return max(found, key=lambda k: (found[k], k)) if found else None


def _climb(page: Page, chosen: set[int]) -> set[int]:
    """The elements that hold the whole article of the chosen containers.

    Each goes up to the article (else main) around it. Where there is none it goes up
    while the parent adds only blocks that are no links, short of body, html and root;
    from there on (and for these) while the parent adds only such blocks of its own,
    a headline or lead beside the container.
    """
    size = len(page.tags)
    own_blocks, total, links = [0] * size, [0] * size, [0] * size  # blocks, links among them
    for e, text, link_chars in page.blocks:
        own_blocks[e] += 1
        total[e] += 1
        links[e] += 2 * link_chars > len(text)
    article: list[int] = []  # the outermost article around an element, else the outermost main
    for e, p in enumerate(page.parents):
        top = article[p] if p >= 0 else -1
        if page.tags[e] == "article" and (top < 0 or page.tags[top] == "main"):
            top = e
        article.append(e if page.tags[e] == "main" and top < 0 else top)
    tops = {article[e] if article[e] >= 0 else e for e in chosen}
    covered: list[bool] = []
    for e, p in enumerate(page.parents):
        covered.append(e in tops or (p >= 0 and covered[p]))
    # blocks and links that stand in no chosen container
    more = [0 if covered[e] else total[e] for e in range(size)]
    more_links = [0 if covered[e] else links[e] for e in range(size)]
    for e in range(size - 1, -1, -1):  # children come after their parents
        p = page.parents[e]
        if p >= 0:
            total[p] += total[e]
            more[p] += more[e]
            more_links[p] += more_links[e]
    out: set[int] = set()
    seen: set[tuple[int, bool]] = set()
    for e in sorted(tops):
        if not total[e]:
            continue
        own = article[e] >= 0  # only the parent's own blocks may be added
        while (e, own) not in seen:
            seen.add((e, own))
            p = page.parents[e]
            own = own or p < 0 or page.tags[p] in ("html", "body", ROOT)
            if p < 0 or more_links[p] > more_links[e] or (own and more[p] - more[e] > own_blocks[p]):
                out.add(e)
                break
            e = p
    return out


def _under(page: Page, path: str | None) -> list[int]:
    """Places of the blocks in the articles around the containers of that path, in page order."""
    if path is None:
        return list(range(len(page.blocks)))
    tops = _climb(page, {e for e, p in enumerate(page.paths) if p == path and page.tags[e] in CONTAINERS})
    inside: list[bool] = []
    for e, p in enumerate(page.parents):
        inside.append(e in tops or (p >= 0 and inside[p]))
    return [k for k, (e, _, _) in enumerate(page.blocks) if inside[e]]


def under(page: Page, path: str | None) -> list[str]:
    """Texts of those blocks."""
    return [page.blocks[k][1] for k in _under(page, path)]


def extract(text: str | None, path: str | None = None, least: float = 0.3, nearly: float = 0.95) -> str:
    """The main text; ``path`` is the host's.

    It is used if it holds ``least`` of what the page's own best holds, and ``nearly``
    all of it where it is a part of the page's own best.
    """
    if not text:
        return ""
    page = parse(text)
    size = lambda places: sum(len(page.blocks[k][1]) for k in places)
    own = _under(page, best_path(page))
    if path is not None:
        given = _under(page, path)
        if given and size(given) >= (nearly if set(given) <= set(own) else least) * size(own):
            own = given
    return "\n\n".join(page.blocks[k][1] for k in own)


def host(url):
    """Lower-case host of a url column, without port; '' if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1),
                              F.lit("")))


def votes(pages: DataFrame, url_col: str = "url", html_col: str = "html", top: int = 3) -> DataFrame:
    """(host, path, votes): each page's best paths, with shares of its score; summed over the host."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: dict[tuple[str, str], float] = defaultdict(float)
            for h, text in zip(b["host"], b["html"]):
                found = scores(parse(text)) if text else {}
                whole = sum(found.values())
                for path in sorted(found, key=lambda k: (-found[k], k))[:top]:
                    if found[path] > 0:
                        rows[h, path] += round(found[path] / whole * 1000)  # whole numbers: any order of sums
            yield pd.DataFrame([(h, p, int(v)) for (h, p), v in rows.items()],
                               columns=["host", "path", "votes"]).astype({"votes": "int64"})

    cast = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    return cast.mapInPandas(run, "host string, path string, votes long").groupBy("host", "path").agg(
        F.sum("votes").alias("votes"))


def consensus(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the path with most votes, ties to the smaller path."""
    return votes(pages, url_col, html_col).groupBy("host").agg(
        F.min_by("path", F.struct(-F.col("votes"), "path")).alias("path"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, path (the host's)."""
    paths = materialise(consensus(pages, url_col, html_col), "html-paths")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).cast("string").alias("html"), host(F.col(url_col)).alias("host"))

    @F.pandas_udf("string")
    def text(html: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([extract(h, p) for h, p in zip(html, path)], dtype=object)

    met = attach(rows, paths, ["host"]).withColumn("text", text("html", "path"))
    return met.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "path")
