"""Main text of web pages by site template removal.

Every page is parsed to elements; the subtree of every element with text is hashed from the bottom up, by its tags and texts (so an id or token in a template
doesn't hide it), whatever it is named and wherever it stands, and Spark counts on how many pages of its host each subtree recurs.  Subtrees that recur across many pages of a host are its template and are deleted first.  What tags and class names tell by themselves
(menus, footers, forms, scripts, adverts, comments and the like) goes too; where a page marks an article or main part and that has text left, the text is taken from there.
No name and no form takes what holds the article, or most of a page without one; a name that only has such a word in it
(`has-sidebar`) takes nothing by itself, but lets a subtree in an article count as a template at the lower share.

An article that many pages copy is no template: pages with the same main part count once.  Within an article a subtree must
recur on most pages of the host, elsewhere on a fair share of them; the two are counted apart.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import materialise, prepare, tidy

#: A template recurs on this many distinct pages of the host at least, and on this share of them: in an article, elsewhere.
MIN_PAGES, ARTICLE_SHARE, OTHER_SHARE = 8, 0.5, 0.1
#: Up to so many templates are sent to all executors; beyond that they are joined.
MOST_SENT = 200_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|select|textarea|title|audio|video"
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Dropped whatever their names; a form counts as a name, as pages can stand in one.
DROPPED = frozenset("head nav footer aside button dialog menu label fieldset header".split())
#: Words of class, id or role that mark what isn't main text.
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus replies respond share sharing social related recommended login signup search skip complementary contentinfo dialog".split())
#: A name made of a word of MARKS and these, as ad-box, counts as one of MARKS; with any other word, as has-sidebar, it is doubtful.
PLAIN = frozenset("box block unit slot widget list area form section buttons links posts items bar google".split())
#: Never dropped by name.
PAGE = frozenset("html body main article".split())
#: What a wrapper of a whole page has in it.
PAGE_PARTS = frozenset("h1 nav header footer main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the first closes open elements of the second, up to the third.
CLOSES = {"li": ("li", "ul ol"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}

_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z0-9]+")
#: Names of readers' comments begin with one of the first, and go on with nothing but these or numbers; an article of such a name is a comment.
COMMENT = frozenset("comment comments reply replies disqus respond".split())
COMMENT_PARTS = COMMENT | frozenset("list body item content text thread entry area section box wrapper reader user".split())
#: Words that a paragraph's name can have for what it says; they mark other elements only.
SAID = frozenset("alert menu".split())
#: An article has this share of the page's text at least, and one whose name has a word of MARKS, as related-item, the other.
SHARE, MARKED_SHARE = 0.25, 0.5
_AD = re.compile(r"ads?(?:box|slot|unit|sense|wrap|wrapper|block|banner|container|holder|zone|space)")
DOUBTFUL, SURE = 1, 2
#: Where a subtree stands, which its key tells: links and the like in menus take none in a text.
ELSEWHERE, IN_ARTICLE, INLINE_DROPPED = 0, 1, 2


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


@functools.lru_cache(10_000)
def mark_of(name: str) -> int:
    """What a whole class, id or role tells: SURE, DOUBTFUL or nothing."""
    parts = ["ad" if _AD.fullmatch(p) else p for p in _PART.findall(name)]
    if MARKS.isdisjoint(parts):
        return 0
    return SURE if all(p in MARKS or p in PLAIN for p in parts) else DOUBTFUL


@functools.lru_cache(10_000)
def comment_of(name: str) -> bool:
    """Whether a whole class, id or role is a comment's, as comment-body or comment-17, not comments-open."""
    parts = _PART.findall(name)
    return bool(parts) and parts[0] in COMMENT and all(p in COMMENT_PARTS or p.isdigit() for p in parts)


class Element:
    __slots__ = ("tag", "parent", "mark", "article", "hash", "dropped", "main", "heading", "in_header", "text", "held", "size", "whole", "tagged", "nested", "parts", "block", "gone", "named", "comment", "in_p")

    def __init__(self, tag, parent, mark, article):
        """mark: what its names tell; article: whether it is one, or a main part."""
        self.tag, self.parent, self.mark, self.article = tag, parent, mark, article
        self.dropped = self.main = self.heading = self.in_header = self.text = self.held = self.tagged = self.parts = self.block = self.gone = False
        self.size = self.whole = self.nested = self.hash = self.named = 0
        self.comment = self.in_p = False

    def take(self, part: int) -> None:
        """Adds what the element holds next, a text or a subtree, to its hash."""
        self.hash = (self.hash * 0x9E3779B97F4A7C15 + part + 1) & 0xFFFFFFFFFFFFFFFF

    def close(self) -> None:
        """Ends the hash, and adds it to that of the element around."""
        if self.text:
            self.hash = xxhash.xxh64_intdigest(f"{self.tag} {self.hash}".encode())
            self.parent.take(self.hash)

    def counted(self) -> bool:
        """Whether the subtree may be a template: not what holds the article, and no empty one."""
        return self.text and not self.held and self.tag not in ("html", "body") and not (self.main and self.article)

    def key(self) -> int:
        """The hash of the subtree, with where it stands in the two lowest bits."""
        if self.dropped:
            place = ELSEWHERE if self.tag in BLOCK else INLINE_DROPPED
        else:
            place = IN_ARTICLE if self.main and self.mark != DOUBTFUL else ELSEWHERE
        return self.hash >> 3 << 2 | place  # under 2**63


def parse(page: str) -> tuple[list[Element], list[tuple[str, Element, bool]]]:
    """The elements, and the texts in order: each with the element that holds it, and whether a block boundary comes before it."""
    root = Element("", None, 0, False)
    elements, pieces, stack, at, boundary = [], [], [root], 0, True

    open_ = Counter()

    def close(depth: int) -> bool:
        block = False
        while len(stack) > depth:
            e = stack.pop()
            e.close()
            open_[e.tag] -= 1
            block |= e.tag in BLOCK
        return block

    def text(upto: int) -> None:
        nonlocal boundary
        if upto > at and (found := page[at:upto]):
            if not found.isspace():
                e = stack[-1]
                e.take(xxhash.xxh64_intdigest(" ".join(found.split()).encode()))
                while e is not None and not e.text:
                    e.text = True
                    e = e.parent
            pieces.append((found, stack[-1], boundary))
            boundary = False

    for m in _TAG.finditer(page):
        text(m.start())
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            for depth in range(len(stack) - 1, 0, -1) if open_[tag] else ():
                if stack[depth].tag == tag:
                    boundary |= close(depth)
                    break
            continue
        boundary |= tag in BLOCK
        if tag in VOID:
            continue
        if tag in CLOSES:
            shut, stop = CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in stop:
                    break
                if stack[depth].tag in shut:
                    close(depth)
                    break
        elif tag in BLOCK:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in BLOCK:
                    break
        names = {w for a, b, c in _NAMES.findall(m[4]) for w in (a or b or c).lower().split()} if m[4] and "=" in m[4] else ()
        mark = max((mark_of(n) for n in names if tag != "p" or SAID.isdisjoint(_PART.findall(n))), default=0)
        article = tag in ("article", "main") or "main" in names and "role" in m[4].lower()
        comment = tag not in ("html", "body", "main") and any(map(comment_of, names))
        e = Element(tag, stack[-1], SURE if tag == "form" or article and comment else 0 if tag in PAGE or article else mark, article)
        e.named, e.comment = mark, comment
        elements.append(e)
        if not m[4].endswith("/") or tag not in ("path",):
            stack.append(e)
            open_[tag] += 1
    text(len(page))
    close(1)
    settle(root, elements, pieces)
    return elements, pieces


def settle(root: Element, elements: list[Element], pieces: list[tuple[str, Element, bool]]) -> None:
    """Finds the page's article, then what is dropped by tag or name and what is main; elements come after those that hold them.

    The article is the article or main part with the most text outside of others in it, if that is a fair share of the page's; a comment, or what stands in one, is none as long as
    the page has other text.  What holds the article is kept, and so are a marked element and a form that hold all the text of the article, or of a page without one, or
    most of it with parts of a page.
    """
    within = {root: False}
    for e in elements:
        within[e] = within[e.parent] or e.article
        e.tagged = e.parent.tagged or (e.tag in DROPPED and not (e.tag in ("header", "label") and within[e.parent]))
        e.comment = e.comment or e.parent.comment
        e.in_p = e.tag == "p" or (e.parent.in_p and e.tag not in BLOCK)
    for t, e, _ in pieces:
        n = len(t.strip())
        e.whole += n
        if not e.tagged:
            e.size += n
    for e in reversed(elements):
        up = e.parent
        up.whole += e.whole
        up.size += e.size
        up.nested += e.size if e.article else e.nested
        up.parts |= e.parts or e.tag in PAGE_PARTS
        up.block |= e.text and (e.block or e.tag in BLOCK)
    commented = sum(len(t.strip()) for t, e, _ in pieces if e.comment and not e.tagged)
    found = [e for e in elements if e.article and (not e.comment or root.size <= commented)]
    fair = lambda e: e.size - e.nested >= (MARKED_SHARE if e.named and e.tag == "article" else SHARE) * (root.size - commented)
    own = max((e for e in found if e.size > e.nested), key=lambda e: e.size - e.nested, default=None)
    own = None if own and not fair(own) else own or max((e for e in found if 2 * e.whole > root.whole), key=lambda e: e.whole, default=None)
    e = own
    while e is not None:
        e.held, e = True, e.parent
    base = own or root
    size = (lambda e: e.size) if base.size else (lambda e: e.whole)
    inside = {base}
    for e in elements:
        up = e.parent
        if up in inside:
            inside.add(e)
            if e.mark == SURE and not (e.comment and root.size > commented) and (2 * size(e) > size(base) and e.parts or 0 < size(e) == size(base) and e.block):
                e.mark = 0
        by_tag = e.tag in DROPPED and not (e.tag in ("header", "label") and up.main)
        e.dropped = not e.held and (up.dropped or by_tag or e.mark == SURE or (own is None and e.article and e.named > 0 and e.tag == "article"))
        e.main = up.main or (not e.dropped and e.article and own is not None)
        e.heading = e.tag in HEADINGS or (up.heading and not (e.tag == "header" and not e.dropped))
        e.in_header = up.in_header or (e.tag == "header" and not e.held)


def main_text_of(elements: list[Element], pieces: list[tuple[str, Element, bool]]) -> str:
    """The text that templates (`gone`) and names leave: of the article or main part, if that has any."""
    pieces = [(t, e, b) for t, e, b in pieces if not e.dropped and (e.heading or e.in_p or not e.in_header)]  # of an article's header headings and paragraphs stay
    if any(e.main and not e.gone and not t.isspace() for t, e, _ in pieces):
        pieces = [x for x in pieces if x[1].main]
    out = [" " if e.gone else " " + t if boundary else t for t, e, boundary in pieces]
    return " ".join(entities.unescape("".join(out)).split())


def subtrees(page: str) -> tuple[int, list[int]]:
    """A hash of the main text, and the distinct keys of all subtrees."""
    elements, pieces = parse(page)
    return xxhash.xxh64_intdigest(main_text_of(elements, pieces).encode()) >> 1, sorted({e.key() for e in elements if e.counted()})


def extract(page: str, is_template) -> str:
    elements, pieces = parse(page)
    for e in elements:
        e.gone = e.parent.gone or (e.counted() and is_template(e.key()))
    return main_text_of(elements, pieces)


def _with_host(key: int, host: str) -> int:
    return key ^ (xxhash.xxh64_intdigest(host.encode()) & 0x7FFFFFFFFFFFFFFC)


def templates(found: DataFrame, min_pages: int = MIN_PAGES, article_share: float = ARTICLE_SHARE, other_share: float = OTHER_SHARE) -> DataFrame:
    """found(host, main, hashes) -> the keys of templates: subtrees of a host, hashed with it.  Of pages with one main part the least hashes count."""
    distinct = found.groupBy("host", "main").agg(F.min("hashes").alias("hashes"))
    counted = distinct.select("host", F.explode("hashes").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n"))
    pages = distinct.groupBy("host").agg(F.count("*").alias("pages"))
    share = F.when(F.col("key").bitwiseAND(3) == IN_ARTICLE, F.lit(article_share)).otherwise(F.lit(other_share))
    return counted.where(F.col("n") >= min_pages).join(pages, "host").where(F.col("n") >= share * F.col("pages")).select("key").distinct()


def main_text(pages: DataFrame, most_sent: int = MOST_SENT, **options) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each page.

    A null or empty html has an empty text.  Pages with a null or broken url are one host of their own.  Repeated rows give repeated results;
    equal page_ids don't matter.  Other columns don't matter; an empty table gives no rows; very long pages are read whole, in time that grows with their length.  Unclosed and wrongly nested tags are closed as browsers mostly do; an unclosed comment or script goes on to the end.
    """
    spark = pages.sparkSession
    prepare(spark)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))

    def look(batches):
        for batch in batches:
            out = []
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                host = host_of(url)
                main, hashes = subtrees(page)
                out.append((host, main, sorted(_with_host(h, host) for h in hashes)))
            cols = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.string(), pa.int64(), pa.list_(pa.int64())), strict=True)], ["host", "main", "hashes"])

    kind = "host string, main long, hashes array<long>"
    keys = materialise(templates(rows.select("url", "html").mapInArrow(tidy(look), kind), **options), "templates")
    schema = "page_id long, url string, text string, n_chars long"

    def result(batch, all_texts):
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(all_texts, pa.string()), pa.array(map(len, all_texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    if keys.count() <= most_sent:
        shared = spark.sparkContext.broadcast(np.array(sorted(r["key"] for r in keys.collect()), np.int64))  # most_sent numbers at most

        def cut(batches):
            known = set(shared.value.tolist())
            for batch in batches:
                hosts = map(host_of, batch.column(1).to_pylist())
                yield result(batch, [extract(page, lambda h, host=host: _with_host(h, host) in known) for page, host in zip(batch.column(2).to_pylist(), hosts, strict=True)])

        return rows.mapInArrow(tidy(cut), schema)

    def name(batches):
        for batch in batches:
            out = []
            for row, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                host = host_of(url)
                out += [(row, _with_host(h, host)) for h in subtrees(page)[1]]
            cols = list(zip(*out, strict=True)) or [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], ["row", "key"])

    row = F.xxhash64("url", "html").alias("row")
    own = rows.select(row, "url", "html").mapInArrow(tidy(name), "row long, key long").distinct().join(keys, "key").groupBy("row").agg(F.collect_set("key").alias("keys"))  # no more than a page has elements

    def cut_own(batches):
        for batch in batches:
            hosts = map(host_of, batch.column(1).to_pylist())
            yield result(batch, [extract(page, lambda h, host=host, known=known: _with_host(h, host) in known) for page, host, known in zip(batch.column(2).to_pylist(), hosts, (set(k or ()) for k in batch.column(3).to_pylist()), strict=True)])

    return rows.withColumn("row", F.xxhash64("url", "html")).join(own, "row", "left").select("page_id", "url", "html", "keys").mapInArrow(tidy(cut_own), schema)
