"""Main text of web pages, without what a site repeats on them.

Every page is parsed where it is read, and the digest of each element's subtree is counted per host
in Spark. A subtree found on many pages of its host is template and is deleted, on all
pages, with everything in it. Pages of a host whose bodies are equal count once, so that copies of an
article do not turn it into template, and a host of few pages has none. What is left is
the text of the article, by what elements mean: menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments go by their tag, role, class or id.

Counting is partial before the shuffle and keyed by host and digest, so a host with a third of all pages
is spread over as many tasks as it has subtrees. A host's templates are at most `1 / MIN_SHARE`
times the subtrees of its average page, and reach its pages by a join without hint.

Blocks (paragraphs, headings, list items, cells) are joined by a line feed; white space in a block
becomes one space, a line break too. Character references are decoded.

Defined results: NULL or empty html gives an empty text, as does a page of template only. A NULL url, or one
without a host, belongs to the host ''. Broken markup is read as browsers do for common cases: open
elements end with their parent, a paragraph ends where the next begins, stray end tags are
ignored. Very long and broken pages take time in proportion to their length. Repeated rows give repeated rows. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, small_batches

MIN_PAGES = 10
MIN_SHARE = 0.5

# fixed values: what HTML says of its elements
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split())
# element -> open elements that it ends, and where the search for them stops
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
}
# what is not the article
NOT_TEXT = frozenset(
    "head nav footer aside form script style template noscript iframe object embed svg math canvas audio video button select "
    "textarea input label dialog menu noembed noframes xmp title".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog status menu menubar toolbar form".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner promo promos promotion sponsor sponsored "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars footer header masthead topbar comment comments "
    "commentlist reply replies disqus cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup share sharing social related recommended recommendations widget widgets toolbar search login "
    "pagination pager".split())
# an article may bear words such as "header"; it is only left out as one of these
NOT_ARTICLE_WORDS = frozenset("ad ads advert advertisement comment comments reply replies related recommended sponsored promo".split())

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
COMMENT_END = re.compile(r"--!?>|\Z")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"']|\Z)""", re.I)
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
WORDS = re.compile(r"[a-z]+", re.I)


@dataclass
class Page:
    """Elements in page order: the subtree of element i is the elements from i to end[i]."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)
    digests: list[int] = field(default_factory=list)     # 0 for a subtree without text
    texts: list[tuple[int, int, str]] = field(default_factory=list)  # element, number of the block, text


class Tags:
    """Tags of a page in order, each character looked at a fixed number of times whatever the page is.

    A `>` inside quotes does not end a tag, unless the quotes are never closed. What follows a quote is the same for every
    tag that gets there, so it is found out once.
    """

    def __init__(self, source: str):
        self.source, self.known = source, {}
        self.last = {c: source.rfind(c) for c in ">\"'"}

    def _unquoted_end(self, at: int) -> int:
        """Place of the first `>` from `at` on that is not quoted, -1 if quotes are left open."""
        source, passed, end = self.source, [], -1
        while m := STOP.search(source, at):
            q = m.start()
            if source[q] == ">":
                end = q
                break
            if q in self.known:
                end = self.known[q]
                break
            passed.append(q)
            if q >= self.last[source[q]]:
                break
            at = source.index(source[q], q + 1) + 1
        self.known.update(dict.fromkeys(passed, end))
        return end

    def next(self, at: int) -> tuple[int, int, str, str, bool] | None:
        """(start, end, name, attributes, whether it closes) of the first tag from `at` on; comments and the like have no name."""
        source, last = self.source, self.last[">"]
        while (lt := source.find("<", at)) >= 0:
            if source.startswith("<!--", lt):
                return lt, COMMENT_END.search(source, lt + 4).end(), "", "", False
            if source.startswith("<![CDATA[", lt):
                stop = source.find("]]>", lt)
                return lt, len(source) if stop < 0 else stop + 3, "", "", False
            if lt < last:
                if source[lt + 1] in "!?":
                    return lt, source.index(">", lt) + 1, "", "", False
                if m := NAME.match(source, lt + 1):
                    end = self._unquoted_end(m.end())
                    end = source.index(">", m.end()) if end < 0 else end
                    return lt, end + 1, m.group(2), source[m.end(): end], m.group(1) == "/"
            at = lt + 1
        return None


def parse(source: str) -> Page:
    import xxhash
    page, at, block = Page(), 0, 0
    stack: list[int] = []
    open_at: dict[str, list[int]] = {}  # depths of the open elements of a tag
    open_blocks: list[int] = []         # and of all open blocks
    inside: list[list[str]] = []   # what the digest of each open element is made of
    filled: list[bool] = []        # whether it holds text

    def begin(tag: str, marks: str) -> None:
        nonlocal block
        block += tag in BLOCK
        page.tags.append(tag)
        page.parents.append(stack[-1] if stack else -1)
        page.ends.append(0)
        page.marks.append(marks)
        page.digests.append(0)
        open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            open_blocks.append(len(stack))
        stack.append(len(page.tags) - 1)
        inside.append([tag, marks])
        filled.append(False)

    def end() -> None:
        nonlocal block
        i, parts, full = stack.pop(), inside.pop(), filled.pop()
        open_at[page.tags[i]].pop()
        if page.tags[i] in BLOCK:
            block += 1
            open_blocks.pop()
        page.ends[i] = len(page.tags)
        digest = xxhash.xxh64_intdigest("\x1f".join(parts))
        if full:
            page.digests[i] = digest or 1
        if inside:
            inside[-1].append(f"{digest:x}")
            filled[-1] = filled[-1] or full

    def innermost(tags) -> int:
        if tags is BLOCK:
            return open_blocks[-1] if open_blocks else -1
        return max([d[-1] for d in map(open_at.get, tags) if d], default=-1)

    def close(tags, until=()) -> None:
        depth = innermost(tags)
        if depth >= 0 and depth >= innermost(until):
            while len(stack) > depth:
                end()

    def text(value: str) -> None:
        if value and stack:
            page.texts.append((stack[-1], block, value))
            squeezed = " ".join(value.split())
            if squeezed:
                inside[-1].append(squeezed)
                filled[-1] = True

    begin("html", "")
    tags = Tags(source)
    while at < len(source):
        found = tags.next(at)
        text(source[at: found[0] if found else len(source)])
        if not found:
            break
        _, at, name, attributes, closes = found
        if not name:
            continue
        tag = name.lower()
        if closes:
            if tag != "html" and tag != "body":
                # an inline element does not end the block it is left open in
                close((tag,), () if tag in BLOCK else BLOCK)
            continue
        if tag in ("html", "body") and tag in page.tags[:8]:
            continue
        if tag in ENDS_P:
            close(("p",), ("article", "div", "section", "td", "table", "button"))
        if tag in ENDS:
            close(*ENDS[tag])
        if tag == "br":
            text(" ")
            continue
        if tag == "body":
            close(("head",))
        begin(tag, attributes.strip())
        if tag in VOID:
            end()
        elif tag in RAW:
            stop = RAW_END[tag].search(source, at)
            inside[-1].append(source[at: stop.start() if stop else len(source)])
            at = stop.start() if stop else len(source)
    while stack:
        end()
    return page


def _left_out(tag: str, marks: str, holds_article: bool, in_article: bool) -> bool:
    if tag in NOT_TEXT or (tag == "header" and not in_article):
        return True
    if not marks:
        return False
    words: set[str] = set()
    for m in ATTRIBUTE.finditer(marks):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and "display:none" in value.replace(" ", "")):
            return True
        if name == "role" and value in NOT_TEXT_ROLES:
            return True
        if name in ("class", "id"):
            words.update(WORDS.findall(value))
    if tag in ("article", "main", "body", "html") or holds_article:
        return tag == "article" and bool(words & NOT_ARTICLE_WORDS)
    return bool(words & NOT_TEXT_WORDS)


def main_text(page: Page, template=frozenset()) -> str:
    """Text of the page's article without what is left out and without template subtrees."""
    n = len(page.tags)
    main = [t in ("article", "main") for t in page.tags]
    holds = main.copy()
    for i in range(n - 1, 0, -1):
        holds[page.parents[i]] |= holds[i]
    out, inside = [False] * n, {"article": [False] * n, "main": [False] * n}
    for i, (tag, parent) in enumerate(zip(page.tags, page.parents)):
        up = parent >= 0
        in_article = up and (inside["article"][parent] or inside["main"][parent])
        out[i] = (up and out[parent]) or page.digests[i] in template or _left_out(
            tag, page.marks[i], holds[i] and not main[i], in_article)
        for kind, flags in inside.items():
            flags[i] = (up and flags[parent]) or (tag == kind and not out[i])
    within = next((f for f in inside.values() if any(f)), None)
    blocks: list[str] = []
    current, parts = -1, []

    def flush() -> None:
        text = " ".join(references.unescape("".join(parts)).split())
        if text:
            blocks.append(text)
        parts.clear()

    for i, block, text in page.texts:
        if out[i] or (within is not None and not within[i]):
            continue
        if block != current:
            flush()
            current = block
        parts.append(text)
    flush()
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES,
              min_share: float = MIN_SHARE) -> DataFrame:
    """(host, digests): per host the subtrees that stand on many of its pages."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [parse(h or "") for h in b["html"]]
            yield pd.DataFrame({
                "host": b["host"], "page": [str(p.digests[0]) for p in found],
                "digests": [sorted({d - (1 << 63) for t, d in zip(p.tags, p.digests) if d and t not in ("html", "body", "head")})
                            for p in found]})

    rows = small_batches(pages).select(host_of(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").alias("html")).mapInPandas(
        run, "host string, page string, digests array<long>")
    # equal pages of a host have equal subtrees
    once = rows.groupBy("host", "page").agg(F.first("digests").alias("digests"))
    # the pages are counted along with their subtrees, as one more of them
    counts = once.select("host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "digests")).alias("digest")).groupBy(
        "host", "digest").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    counts = Scratch(pages.sparkSession, "templates").store(counts)
    n_pages = counts.where("digest IS NULL").select(F.col("host").alias("of"), F.col("n").alias("n_pages"))
    return counts.where("digest IS NOT NULL").join(n_pages, F.col("host") == F.col("of")).where(
        F.col("n") >= min_share * F.col("n_pages")).groupBy("host").agg(F.collect_set("digest").alias("digests"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    known = Scratch(pages.sparkSession, "html").store(templates(pages, url_col, html_col, min_pages, min_share))
    known = known.withColumnRenamed("host", "of")
    url = pages.schema[url_col].dataType.simpleString()
    key = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [main_text(parse(h or ""), frozenset(int(x) + (1 << 63) for x in d) if d is not None else frozenset())
                     for h, d in zip(b["html"], b["digests"])]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = small_batches(pages).select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").alias("html"), host_of(F.col(f"`{url_col}`")).alias("host"))
    return rows.join(known, F.col("host") == F.col("of"), "left").select("page_id", "url", "html", "digests").mapInPandas(
        run, f"page_id {key}, url {url}, text string, n_chars long")
