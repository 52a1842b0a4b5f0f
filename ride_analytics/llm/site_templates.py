"""Main text of web pages: element subtrees that recur over a site's pages are its template and go, then page furniture."""

from __future__ import annotations

import functools
import hashlib
import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.llm.common import U64, mix
from ride_analytics.sources.storage import written

# fixed values: element names of HTML, and names that sites give to furniture
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
FURNITURE = frozenset("head nav header footer aside form script style noscript template iframe svg math button select input textarea title "
                      "object embed audio video canvas dialog menu".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
PROSE = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th article main body html".split())
CELLS = frozenset("li dt dd tr td th option".split())  # one alone may repeat by chance
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|banner|promo\w*|cookies?|consent|notice|gdpr|popup|modal|overlay|newsletter|subscribe|"
                   r"sidebar|side-?bar|menu|nav\w*|breadcrumbs?|toolbar|pagination|pager|share|sharing|social|related|recommend\w*|comments?|"
                   r"replies|disqus|footer|skip-?link|login|signup|search|widget|tags)(?:$|[\s_-])", re.I)
# a header is furniture outside an article only; inside it holds the title
HEADERS = re.compile(r"(?:^|[\s_-])(?:masthead|header)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
# end of fixed values

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WHITE_RUN = re.compile(r"\s+")
IN_BODY = 1  # marks of an element, as bits
DROPPED = 2
BLOCK = 1  # kinds of a digest, in its last bits: block that may go by the number of its pages alone, running text of an article
RUNNING = 2


class Element:
    __slots__ = ("tag", "begin", "end", "up", "marks", "digest")

    def __init__(self, tag, begin, up, marks):
        self.tag, self.begin, self.end, self.up, self.marks, self.digest = tag, begin, begin, up, marks, None


def furniture(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is no part of a main text by its name, class, id or role. An article's own header stays."""
    if tag in FURNITURE:
        return not (tag == "header" and in_article)
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = "".join(values), name.lower()
        if name in ("class", "id") and (NAMES.search(value) or not in_article and HEADERS.search(value)) or name == "role" and value.lower() in ROLES or name == "hidden" \
                or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def parse(page: str) -> tuple[list[Element], list[tuple[int, str]]]:
    """Elements of a page in order, and its texts, each with the number of its element. Broken markup is read as browsers
    do in the common cases: raw elements, void elements, paragraphs and items ended by the next one, missing ends."""
    root = Element("#root", 0, -1, 0)
    elements, texts, stack = [root], [], [0]
    at, n = 0, len(page)

    def close(until: int, where: int) -> None:
        while len(stack) > until:
            elements[stack.pop()].end = where

    while at < n:
        token = TOKEN.search(page, at)
        begin = token.start() if token else n
        if begin > at:
            texts.append((stack[-1], page[at:begin]))
        if not token:
            break
        at = token.end()
        tag = token[2]
        if tag is None:
            continue
        tag = tag.lower()
        if token[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if elements[stack[depth]].tag == tag:
                    close(depth, at)
                    break
            if tag not in INLINE:
                texts.append((stack[-1], "\n"))
            continue
        if tag not in INLINE:
            for depth in range(len(stack) - 1, 0, -1):
                above = elements[stack[depth]].tag
                if above == "p" and tag not in VOID or above in ENDED_BY.get(tag, ()):
                    close(depth, begin)
                    break
                if above not in INLINE:
                    break
        up = stack[-1]
        if tag == "br" or tag not in INLINE:
            texts.append((up, "\n"))  # words on both sides of a block or a line break stay apart
        marks = elements[up].marks
        if not marks & DROPPED and furniture(tag, token[3], bool(marks & IN_BODY)):
            marks |= DROPPED
        if tag in ("article", "main"):
            marks |= IN_BODY
        elements.append(Element(tag, begin, up, marks))
        if tag in VOID or token[3].endswith("/") and tag in ("svg", "math"):
            elements[-1].end = at
        elif tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else n
            elements[-1].end = at
        else:
            stack.append(len(elements) - 1)
    close(0, n)
    return elements, texts


def subtree_digests(page: str, elements: list[Element]) -> None:
    """Set the digest of every subtree that may be a site's template: all but inline elements of an article."""
    for e in elements[1:]:
        if e.tag in ("html", "body", "head", "article", "main", "br"):
            continue
        inside = e.marks & IN_BODY and e.tag in PROSE
        if inside and e.tag in INLINE:
            continue
        alone = e.tag in INLINE or e.tag in CELLS or inside and re.fullmatch("h[1-6]", e.tag)
        kind = (RUNNING if inside else 0) | (0 if alone else BLOCK)
        e.digest = int.from_bytes(hashlib.blake2b(page[e.begin:e.end].encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) & ~3 | kind


@functools.lru_cache(maxsize=1 << 16)
def word_hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) + 1


def surroundings(elements: list[Element], texts: list[tuple[int, str]]) -> dict[int, int]:
    """For each digest of running text, the least hash of three words in a row of the rest of the article; 0 without a rest.

    Articles that differ have different ones; copies of an article with a few words changed mostly share theirs.
    """
    none, n = 1 << 32, len(elements)
    least, last = [none] * n, list(range(n))
    owners, begin, hashes = [], [], []
    for k, text in texts:
        if elements[k].marks & IN_BODY and not elements[k].marks & DROPPED and (w := text.split()):
            owners.append(k)
            begin.append(len(hashes))
            hashes += map(word_hash, w)
            hashes += [0] * (3 - len(w))  # a shorter text counts whole
    if owners:
        h = np.array(hashes, np.uint64)
        three = np.full(len(h), none, np.uint64)
        three[:-2] = mix((h[:-2] * U64(0x9E3779B1) + h[1:-1]) * U64(0x85EBCA6B) + h[2:]) >> U64(32)
        ends = np.array([*begin[1:], len(h)])
        three[ends - 1] = three[ends - 2] = none
        for k, x in zip(owners, np.minimum.reduceat(three, begin).tolist()):
            least[k] = min(least[k], x)
    before, after = [none] * (n + 1), [none] * (n + 1)
    for k in range(n):
        before[k + 1] = min(before[k], least[k])
    for k in range(n - 1, 0, -1):
        after[k] = min(after[k + 1], least[k])
        last[elements[k].up] = max(last[elements[k].up], last[k])
    out = {}
    for k, e in enumerate(elements):
        if e.digest is not None and e.digest & RUNNING:
            rest = min(before[k], after[last[k] + 1])
            out[e.digest] = 0 if rest == none else rest + 1
    return out


def main_text(elements: list[Element], texts: list[tuple[int, str]], templates: frozenset[int]) -> str:
    """Text of the blocks that remain without templates and furniture: only those of the article if they hold half of that text."""
    dropped, block = [False] * len(elements), [0] * len(elements)
    for k, e in enumerate(elements):
        up = e.up
        dropped[k] = bool(e.marks & DROPPED) or up >= 0 and dropped[up] or e.digest in templates
        block[k] = block[up] if up >= 0 and e.tag in INLINE else k
    out, last, parts, inside = [], None, [], False
    for k, text in texts:
        if dropped[k]:
            continue
        if block[k] != last:
            out.append((inside, "".join(parts)))
            parts, last, inside = [], block[k], bool(elements[block[k]].marks & IN_BODY)
        parts.append(text)
    out.append((inside, "".join(parts)))
    blocks = [(i, t) for i, b in out if (t := WHITE_RUN.sub(" ", html.unescape(b)).strip())]
    if 2 * sum(len(t) for i, t in blocks if i) >= sum(len(t) for _, t in blocks) > 0:
        blocks = [(i, t) for i, t in blocks if i]
    return " ".join(t for _, t in blocks)


def extract_main_text(pages: DataFrame, min_pages: int = 5, min_share: float = 0.2, many_pages: int = 50) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_templates.

    Subtrees are hashed by their markup and counted per host over pages of
    distinct html, so copies count once; those on at least ``min_pages`` pages
    and ``min_share`` of the host's pages are its template and are deleted, as
    are blocks (not single cells, items or inline elements) on ``many_pages``
    pages of a host of any size, together with furniture (menus, headers,
    footers, sidebars, notices, adverts, forms, scripts, styles, comments).
    Paragraphs, headings, items and cells inside an article go by the same
    counts, but only over articles that differ elsewhere: at least ``min_pages``
    and half of those that hold them. Of what remains, text outside an article
    goes only where the article holds at least half of it. Null html counts as
    empty and gives an empty text; pages without url form one host; repeated
    rows give a row each; an empty table gives no rows.

    A page is parsed twice: once for its digests, which are written, counted and
    matched with the templates, and once for its text. The lists of templates
    meet the pages by key in one shuffle, which no hot host makes uneven.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = rows.withColumn("page_key", F.xxhash64("page_id", "url", "html"))

    def digests(reader):
        for batch in reader:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                found, rests = [], []
                for page in part.column("html").to_pylist():
                    elements, pieces = parse(page or "")
                    subtree_digests(page or "", elements)
                    own = {e.digest: 0 for e in elements if e.digest is not None} | surroundings(elements, pieces)
                    found.append(list(own))
                    rests.append(list(own.values()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *(pa.array(x, pa.list_(pa.int64())) for x in (found, rests))],
                                                 [*names, "digests", "rests"])

    # hosts and contents stand for themselves by 64 bits
    names = ["host", "page_key", "content"]
    keys = rows.select(F.xxhash64(host).alias("host"), "page_key", F.xxhash64(F.coalesce("html", F.lit(""))).alias("content"), "html")
    marks = written(keys.mapInArrow(digests, "host long, page_key long, content long, digests array<long>, rests array<long>"), "page-digests")
    total = marks.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    seen = marks.select("host", "content", F.explode(F.arrays_zip("digests", "rests")).alias("d")).select("host", "content", "d.digests", "d.rests")
    # contents that share a digest and its surroundings are counted once each; then surroundings, then the digest
    counts = (seen.groupBy("host", F.col("digests").alias("digest"), F.col("rests").alias("rest"), "content").agg(F.lit(1).alias("one"))
              .groupBy("host", "digest", "rest").agg(F.count("*").alias("n"))
              .groupBy("host", "digest").agg(F.sum("n").alias("n"), F.count(F.when(F.col("rest") != 0, 1)).alias("rests")))
    running, block = F.col("digest").bitwiseAND(RUNNING) != 0, F.col("digest").bitwiseAND(BLOCK) != 0
    common = counts.where(F.col("n") >= min_pages).where(~running | (F.col("rests") >= min_pages) & (F.col("rests") * 2 >= F.col("n")))
    templates = written(common.join(total, "host").where((F.col("n") >= min_share * F.col("host_pages")) | block & (F.col("n") >= many_pages))
                        .select("host", "digest"), "host-templates")
    held = marks.select("host", "page_key", F.explode("digests").alias("digest")).join(templates, ["host", "digest"], "left_semi")
    lists = written(held.groupBy("page_key").agg(F.collect_set("digest").alias("templates")), "page-templates")

    def texts(reader):
        for batch in reader:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                out, numbers = [], []
                for page, found in zip(part.column("html").to_pylist(), part.column("templates").to_pylist()):
                    elements, pieces = parse(page or "")
                    if found:
                        subtree_digests(page, elements)
                    out.append(main_text(elements, pieces, frozenset(found or ())))
                    numbers.append(len(found or ()))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64()),
                                                  pa.array(numbers, pa.int64())], ["page_id", "url", "text", "n_chars", "n_templates"])

    # lists grow with the pages, so they are never broadcast
    joined = rows.join(lists.hint("merge"), "page_key", "left").select("page_id", "url", "html", "templates")
    return joined.mapInArrow(texts, "page_id long, url string, text string, n_chars long, n_templates long")


def query(spark, sf_dir):
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
