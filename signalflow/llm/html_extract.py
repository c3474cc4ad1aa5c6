"""Main text of web pages: marked regions, and what the pages of a host repeat, by sorted suffixes.

A page is cut into blocks. Blocks inside ``article`` or ``main`` are its marked text, blocks in menus,
forms, adverts and the like are not text. No block is taken on its marks alone:

* The marked words of a section of a host are put behind one another and their suffixes are sorted up
  to :data:`RUN` words. Runs in more than half of the host's different articles are boilerplate, and
  a marked block that such runs cover is dropped. A section is a whole host or, of a large one, a share
  of about :data:`SECTION_PAGES` pages by a hash; it names the runs in more than a quarter of its articles,
  and their counts are added up over the host, so where a host is cut changes no text.
* Words outside the marked text are judged by the whole host: runs that two pages of it have are
  boilerplate, and on a page that marks no text only what no other page has is kept. Here the suffixes
  are grouped by a hash of their first :data:`RUN` words, by sums per host and prefix with map-side
  combine, so a host with a third of all pages is no hot spot.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from signalflow.llm.common import map_batches
from signalflow.session import written

# Words that two pages of a host must share in a row for a run to be boilerplate.
RUN = 8
# Pages and bytes of html of a section of a host, about.
SECTION_PAGES, SECTION_BYTES = 256, 1 << 24
# Different articles of a host from which on a run in most of them is boilerplate.
LEAST_ARTICLES = 10
# A section names the runs in more than this share of its articles: 1 in so many.
NAMED = 4

# What elements mean: fixed values.
RAW = {"script", "style", "title", "textarea", "template", "noscript", "iframe", "object", "svg", "select"}
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head", "label", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "gdpr", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pagination", "popup", "promo",
    "recommended", "related", "replies", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar"}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|([^<]+|<)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Za-z]+")

OUTSIDE, MAIN, ARTICLE, SKIPPED = range(4)


@dataclass
class _Open:
    tag: str
    region: int
    header: bool = False


def _hidden_or_hinted(attributes: str) -> bool:
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").strip())
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    names = {n.lower() for key in ("class", "id") for n in _NAME.findall(html.unescape(found.get(key, "")))}
    return not HINTS.isdisjoint(names)


def blocks(page: str | None) -> list[tuple[int, str]]:
    """``(region, text)`` of the blocks of a page in order, without empty ones.

    Broken markup is read as browsers do where it matters here: an end tag closes the nearest element of
    its name and what is open inside, an end tag without one is ignored, a block ends an open paragraph,
    and what is open at the end of the page ends there.
    """
    out: list[tuple[int, str]] = []
    stack = [_Open("", OUTSIDE)]
    run: list[str] = []
    text: list[str] = []

    def end_run() -> None:
        if run:
            text.append(html.unescape("".join(run)))
            run.clear()

    def flush() -> None:
        end_run()
        if text:
            words = " ".join("".join(text).split())
            text.clear()
            if words:
                top = stack[-1]
                hidden = top.header and not any(o.tag in HEADINGS for o in stack)
                out.append((SKIPPED if hidden else top.region, words))

    source, at, end = page or "", 0, len(page or "")
    while at < end:
        m = _TOKEN.match(source, at)
        at = m.end()
        if m[7] is not None:
            run.append(m[7])
            continue
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        end_run()
        if closing:
            if tag in BLOCK:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    flush()
                    del stack[i:]
                    break
            continue
        if tag in RAW:
            if attributes.rstrip().endswith("/") and tag == "svg":
                continue
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = close.end() if close else end
            text.append(" " if tag in ("textarea", "select", "iframe", "object") else "")
            continue
        if tag in BLOCK:
            flush()
            _close_implied(stack, tag)
        if tag in VOID:
            if tag == "br":
                text.append(" ")
            continue
        top = stack[-1]
        region, header = top.region, top.header
        if region != SKIPPED:
            if tag in CHROME or (tag == "article" and region == ARTICLE):
                region = SKIPPED  # an article inside an article is a reader's comment
            elif tag not in ("html", "body", "article", "main") and _hidden_or_hinted(attributes):
                region = SKIPPED
            elif tag == "article":
                region = ARTICLE
            elif tag == "main":
                region = max(region, MAIN)
            elif tag == "header":
                # of a header inside the article only the headings belong to the text
                region, header = (region, True) if region else (SKIPPED, False)
        if region != top.region:
            flush()
        stack.append(_Open(tag, region, header))
    flush()
    return out


def _close_implied(stack: list[_Open], tag: str) -> None:
    """End the elements that a new block ends without an end tag."""
    ends = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}.get(tag, set())
    for i in range(len(stack) - 1, 0, -1):
        inner = stack[i].tag
        if inner == "p" or inner in ends:
            del stack[i:]
            if inner == "p":
                continue
            return
        if inner in BLOCK:
            return


def main_text(found: list[tuple[int, str]]) -> list[str] | None:
    """Blocks of the marked text; None where a page marks none."""
    for region in (ARTICLE, MAIN):
        marked = [t for r, t in found if r == region]
        if marked:
            return marked
    return None


def _streamed(found: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The blocks outside the marked text; those inside are judged by :func:`common_blocks`."""
    chosen = next((r for r in (ARTICLE, MAIN) if any(x == r for x, _ in found)), None)
    return [(r, t) for r, t in found if r != chosen]


def run_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of :data:`RUN` words, given those of the words."""
    n = max(len(hashes) - RUN + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(RUN):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def _word_hashes(words: Iterable[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def prefixes(found: list[tuple[int, str]]) -> list[int | None]:
    """Hashes of the first :data:`RUN` words of every suffix of a page's stream.

    None for a run over the border of a long block, so that no run reaches from a menu into the first
    words of a paragraph; short blocks, as of a menu, are read as one.
    """
    words: list[str] = []
    part: list[int] = []
    number, long_before = 0, False
    for _, text in _streamed(found):
        block = text.split()
        number += long_before or len(block) >= RUN
        long_before = len(block) >= RUN
        words += block
        part += [number] * len(block)
    values = run_hashes(_word_hashes(words)).tolist()
    return [v if part[i] == part[i + RUN - 1] else None for i, v in enumerate(values)]


def suffix_ranks(words: np.ndarray) -> np.ndarray:
    """Rank of every suffix by its first :data:`RUN` words; suffixes that agree in them share one.

    Sorted by 1, 2, 4 ... words: the order by twice as many follows from that of a suffix and of the one behind its words.
    """
    ranks, known = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    while known < RUN:
        step = min(known, RUN - known)
        behind = np.full(len(ranks), -1, np.int64)
        behind[:-step] = ranks[step:]
        order = np.lexsort((behind, ranks))
        new = (np.diff(ranks[order]) != 0) | (np.diff(behind[order]) != 0)
        ranks = np.empty_like(ranks)
        ranks[order] = np.concatenate(([0], np.cumsum(new)))
        known += step
    return ranks


def named_runs(articles: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs that more than one in :data:`NAMED` of different articles have, and how many do. An article is given as its blocks."""
    numbers: dict[str, int] = {}
    words: list[int] = []
    owner: list[int] = []
    for i, found in enumerate(articles):
        for text in found:
            block = [numbers.setdefault(w, len(numbers)) for w in text.split()]
            # a border of its own, so that no run reaches over the end of a block
            words += [*block, -1 - len(words)]
            owner += [i] * (len(block) + 1)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.array(words, np.int64)
    ranks = suffix_ranks(text)
    held = np.unique(ranks * len(articles) + np.array(owner, np.int64)) // len(articles)
    counts = np.bincount(held, minlength=len(words))[ranks]
    at = np.flatnonzero(NAMED * counts > len(articles))
    borders = np.flatnonzero(text < 0)
    at = at[borders[np.searchsorted(borders, at)] - at >= RUN]
    at = at[np.unique(ranks[at], return_index=True)[1]]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # a border takes the hash of some word, but no run in ``at`` has one
    return run_hashes(_word_hashes(numbers)[np.maximum(text, 0)])[at], counts[at]


def _runs_within(article: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs within the blocks of an article, where they begin, and where the blocks end."""
    parts = [text.split() for text in article]
    ends = np.cumsum([len(p) for p in parts])
    hashes = run_hashes(_word_hashes(w for p in parts for w in p))
    own_end = np.repeat(ends, [len(p) for p in parts])
    at = np.flatnonzero(np.arange(len(hashes)) + RUN <= own_end[: len(hashes)])
    return hashes[at], at, ends


def counted_runs(articles: list[list[str]], runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the runs that any of different articles has, and how many do."""
    held = [np.zeros(0, np.int64)]
    for article in articles:
        own = _runs_within(article)[0]
        held.append(np.unique(own[np.isin(own, runs)]))
    return np.unique(np.concatenate(held), return_counts=True)


def common_blocks(article: list[str], runs: np.ndarray) -> list[bool]:
    """Which blocks of an article are covered by the runs. An article of which nothing would stay keeps all."""
    if not len(runs):
        return [False] * len(article)
    hashes, at, ends = _runs_within(article)
    covered = np.zeros(ends[-1] + 1, np.int64)
    starts = at[np.isin(hashes, runs)]
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + RUN, -1)
    bare = np.flatnonzero(np.cumsum(covered)[:-1] == 0)
    gone = np.ones(len(article), bool)
    gone[np.searchsorted(ends, bare, "right")] = False
    return [False] * len(gone) if gone.all() else gone.tolist()


def _keyed(pages: DataFrame) -> DataFrame:
    """Pages with ``size``, ``host``, ``key``, a hash of the whole row, and ``at``, a number of the row."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("page_id", "url", "html")]
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    key = F.unhex(F.md5(F.concat_ws("\x01", *parts).cast("binary")))
    own = [F.octet_length("html").alias("size"), host.alias("host"), key.alias("key"), F.monotonically_increasing_id().alias("at")]
    return pages.select("page_id", "url", "html", *own)


def _sections(keyed: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``section``, the share of the host that a row is in, and ``parts`` where it is of a row repeated more often than a section has pages.

    Such a row has sections of its own, numbered from ``section`` on.
    """
    sizes = keyed.groupBy("host").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    cut = F.ceil(F.greatest(F.col("n") / SECTION_PAGES, F.coalesce("size", F.lit(0)) / SECTION_BYTES)).cast("long")
    # hosts of one section and rows of few copies are left out, so both tables are small beside the pages
    large = written(sizes.select("host", cut.alias("cut")).filter("cut > 1"), "html-hosts")
    copies = keyed.groupBy("key").agg(F.ceil(F.count("*") / SECTION_PAGES).cast("long").alias("parts")).filter("parts > 1")
    copies = written(copies, "html-copies")
    # below 2^40 a share of the host, from there on sections of one row
    own = F.shiftleft(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) + 1, 40)
    section = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("key"), F.coalesce("cut", F.lit(1)))).otherwise(own)
    return lambda rows: rows.join(large, "host", "left").join(copies, "key", "left").select(*rows.columns, section.alias("section"), "parts")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows with the ``section`` they are worked on in."""
    section = F.col("section") + F.coalesce(F.pmod(F.xxhash64("at"), "parts"), F.lit(0))
    return rows.select("page_id", "url", "html", "host", "key", section.alias("section"))


def _packed(found: list[tuple[int, str]]) -> str:
    """Blocks as one text, a line each; a block itself has no line breaks."""
    return "\n".join(f"{region}{text}" for region, text in found)


def _unpacked(lines: str) -> list[tuple[int, str]]:
    return [(int(line[0]), line[1:]) for line in lines.split("\n") if line]


def page_streams(keyed: DataFrame) -> DataFrame:
    """``(host, key, size, article, prefixes)`` of every page: a hash of its marked text, NULL without one, and its stream outside of it."""

    def compute(batch):
        found = [blocks(p.as_py()) for p in batch.column("html")]
        marked = [main_text(f) for f in found]
        return {
            "article": [m and xxhash.xxh128_digest("\n".join(m).encode()) for m in marked],
            "prefixes": [prefixes(f) for f in found],
        }

    new = [StructField("article", BinaryType()), StructField("prefixes", ArrayType(LongType()))]
    return written(map_batches(keyed, compute, new).select("host", "key", "size", "article", "prefixes"), "html-streams")


def repeated_positions(streams: DataFrame) -> DataFrame:
    """``(host, key, starts)``: where in a page's stream a run of :data:`RUN` words begins that another page of its host has."""
    suffixes = streams.select("host", "key", F.posexplode("prefixes").alias("at", "prefix")).filter("prefix IS NOT NULL")
    shared = suffixes.groupBy("host", "prefix").agg(F.min("key").alias("one"), F.max("key").alias("other")).filter("one <> other")
    hits = suffixes.join(shared.select("host", "prefix"), ["host", "prefix"])
    return hits.groupBy("host", "key").agg(F.collect_set("at").alias("starts"))


def different_articles(streams: DataFrame) -> DataFrame:
    """``(host, key)``: of the pages with equal marked text one, for hosts with at least :data:`LEAST_ARTICLES` of them."""
    one = streams.filter("article IS NOT NULL").groupBy("host", "article").agg(F.min("key").alias("key"))
    one = written(one.select("host", "key"), "html-articles")
    # a table of its own, so that a small one is broadcast and no host is brought together
    enough = written(one.groupBy("host").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_ARTICLES), "html-hosts")
    return one.join(enough, "host", "left_semi")


def common_runs(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """``(host, run)``: runs in more than half of a host's different articles, which ``firsts`` names by ``(host, key, section)``.

    Each section names the runs in more than 1 of :data:`NAMED` of its articles. A section that doesn't name a run has it in at most
    ``spare`` of them, so what can't reach the half is left out by sums alone; the rest is counted in all sections of the host.
    """
    places = firsts.groupBy("host", "section").agg(F.count("*").alias("n"))
    sizes = places.groupBy("host").agg(F.sum("n").alias("articles"), F.sum(F.floor(F.col("n") / NAMED)).alias("all_spare"))
    schema = StructType([rows.schema["host"], StructField("run", LongType()), StructField("n", LongType()), StructField("spare", LongType())])

    def articles(some: pa.Table, asked: pa.Table) -> list[list[str]]:
        keys = set(asked.column("key").to_pylist()) - {None}
        once = dict(zip(some.column("key").to_pylist(), some.column("blocks"))) if keys else {}
        return [main_text(_unpacked(once[k].as_py())) for k in sorted(keys)]

    def table(some: pa.Table, runs: np.ndarray, counts: np.ndarray, spare: int) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        host = some.column("host").to_pylist()[:1] * len(runs)
        columns = [pa.array(host, pa.string()), pa.array(runs, pa.int64()), pa.array(counts, pa.int64()), pa.array([spare] * len(runs), pa.int64())]
        return pa.Table.from_arrays(columns, schema=to_arrow_schema(schema))

    def name(some: pa.Table, asked: pa.Table) -> pa.Table:
        found = articles(some, asked)
        return table(some, *named_runs(found), len(found) // NAMED)

    def count(some: pa.Table, asked: pa.Table) -> pa.Table:
        runs = np.array([r for r in asked.column("run").to_pylist() if r is not None], np.int64)
        return table(some, *counted_runs(articles(some, asked) if len(runs) else [], runs), 0)

    grouped = rows.groupBy("host", "section")
    named = grouped.cogroup(firsts.groupBy("host", "section")).applyInArrow(name, schema)
    sums = named.groupBy("host", "run").agg(F.sum("n").alias("n"), F.sum("spare").alias("spare")).join(sizes, "host")
    possible = sums.filter(2 * (F.col("n") + F.col("all_spare") - F.col("spare")) > F.col("articles")).select("host", "run")
    asked = possible.join(places, "host").select("host", "section", F.lit(None).cast("binary").alias("key"), "run")
    asked = asked.unionByName(firsts.select("host", "section", "key", F.lit(None).cast("long").alias("run")))
    counted = grouped.cogroup(asked.groupBy("host", "section")).applyInArrow(count, schema)
    exact = counted.groupBy("host", "run").agg(F.sum("n").alias("n")).join(sizes, "host")
    return exact.filter(2 * F.col("n") > F.col("articles")).select("host", "run")


def unique_runs(found: list[tuple[int, str]], starts: list[int] | None) -> tuple[list[str], int]:
    """Of the unmarked blocks what the repeated runs don't cover, and how many words of the stream they do."""
    stream = _streamed(found)
    size = sum(len(t.split()) for _, t in stream)
    covered = np.zeros(size + 1, np.int64)
    for at in starts or ():
        covered[at] += 1
        covered[min(at + RUN, size)] -= 1
    covered = np.cumsum(covered[:size]) > 0
    kept, at = [], 0
    for region, text in stream:
        words = text.split()
        if region != SKIPPED:
            rest = [w for w, c in zip(words, covered[at : at + len(words)]) if not c]
            if rest:
                kept.append(" ".join(rest))
        at += len(words)
    return kept, int(covered.sum())


def page_text(found: list[tuple[int, str]], starts: list[int] | None, common: np.ndarray) -> tuple[str, int]:
    """Text of a page, and how many of its words are dropped as runs of the host."""
    runs, repeated = unique_runs(found, starts)
    article = main_text(found)
    if article:
        gone = common_blocks(article, common)
        runs = [t for t, g in zip(article, gone) if not g]
        repeated += sum(len(t.split()) for t, g in zip(article, gone) if g)
    return "\n".join(runs), repeated


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars, n_repeated)`` of every page.

    ``n_repeated`` counts the words in dropped blocks of the marked text, and those outside it that lie in
    runs of the host. NULL or empty html has an empty text. Pages of no host form one group of their own.
    Rows that are repeated are one page to each other and get the same text; many copies of a row are sections
    of their own. The pages are read twice: for the streams outside the marked text, with all that is narrow,
    and to be brought together by section, one shuffle that the named runs, their counts and the texts all read.
    """
    keyed = _keyed(pages)
    streams = page_streams(keyed)
    sections = _sections(streams)

    def pack(batch):
        pages = batch.column("html").to_pylist()
        once = {p: _packed(blocks(p)) for p in set(pages)}
        return {"blocks": [once[p] for p in pages]}

    rows = map_batches(dealt(sections(keyed)), pack, [StructField("blocks", StringType())]).select("page_id", "url", "host", "section", "key", "blocks")
    firsts = written(sections(different_articles(streams)).select("host", "section", "key"), "html-firsts")
    common = common_runs(rows, firsts)

    own = F.explode(F.sequence("section", F.col("section") + F.coalesce("parts", F.lit(1)) - 1)).alias("section")
    places = sections(streams.select("host", "key")).select("host", "section", "parts").distinct().select("host", own)
    known = sections(repeated_positions(streams)).select("host", own, "key", "starts", F.lit(None).cast("long").alias("run"))
    of_host = common.join(places, "host").select("host", "section", "run")
    known = known.unionByName(of_host, allowMissingColumns=True)
    made = StructType([keyed.schema["page_id"], keyed.schema["url"], StructField("text", StringType()), StructField("n_repeated", LongType())])

    def compute(some: pa.Table, found: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        begins = dict(zip(found.column("key").to_pylist(), found.column("starts").to_pylist()))
        runs = np.array([r for r in found.column("run").to_pylist() if r is not None], np.int64)
        rows = zip(some.column("key").to_pylist(), some.column("blocks"))
        texts = [page_text(_unpacked(b.as_py()), begins.get(k), runs) for k, b in rows]
        columns = [some.column("page_id"), some.column("url"), pa.array([t for t, _ in texts], pa.string()), pa.array([n for _, n in texts], pa.int64())]
        return pa.Table.from_arrays(columns, schema=to_arrow_schema(made))

    texts = rows.groupBy("host", "section").cogroup(known.groupBy("host", "section")).applyInArrow(compute, made)
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_repeated")
