"""Main text of web pages: structure of the page and differencing against the nearest page of the same host."""

from __future__ import annotations

import hashlib
import pickle
import re
import tempfile
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_of, stage

# fixed values: elements of HTML by what they do
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "title", "object", "canvas", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "br",
}
SIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
SIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
SIDE_NAMES = {
    "ad", "ads", "adsense", "advert", "adverts", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notices", "notification", "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related",
    "replies", "respond", "responses", "share", "sharing", "sidebar", "signup", "skyscraper", "social", "sponsor", "sponsored", "subscribe", "toolbar",
    "topbar", "widget", "widgets",
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SIDE_KIND, OPEN_KIND, MAIN_KIND = 0, 1, 2
#: ``lines`` is a hash of all lines of a page: pages where it is equal are copies of each other.
KEY = "host string, path string, page_id long, lines long"
#: Of each range of keys the first and last, and the first and last of their hosts whose lines differ from these.
EDGES = f"part int, first struct<{KEY}>, first_other struct<{KEY}>, last struct<{KEY}>, last_other struct<{KEY}>"
LINES = f"{KEY}, part int, guest boolean, url string, kinds array<tinyint>, marks array<long>, texts array<string>"
RESULT = "page_id long, url string, text string, n_chars long, n_shared long, paired_with long"


def role_of(tag: str, attributes: str, inside_main: bool) -> int | None:
    """SIDE_KIND, MAIN_KIND, or None where an element says nothing about its part of the page."""
    if tag in SIDE or tag == "header" and not inside_main:
        return SIDE_KIND
    if attributes.strip("/ \n\t"):
        a = {m[0].lower(): next((x for x in m[1:] if x), "") for m in ATTRIBUTE.findall(attributes)}
        role = a.get("role", "").lower()
        style = a.get("style", "").replace(" ", "").lower()
        if role in SIDE_ROLES or "hidden" in a or a.get("aria-hidden", "") == "true" or "display:none" in style:
            return SIDE_KIND
        if tag not in ("html", "body"):
            names = {x.lower() for x in NAME.findall(a.get("class", "") + " " + a.get("id", ""))}
            if names & SIDE_NAMES:
                return SIDE_KIND
        if role == "main" or a.get("itemprop", "").lower() == "articlebody":
            return MAIN_KIND
    return MAIN_KIND if tag in ("article", "main") else None


def lines_of(html: str) -> list[tuple[int, str]]:
    """Text blocks of a page in order, each with the kind of its place; white space is one blank."""
    lines: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    kind = OPEN_KIND

    def flush() -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            lines.append((kind, text))

    at, n = 0, len(html)
    lower = None
    while at < n:
        m = TOKEN.match(html, at)
        if m is None:  # an opening bracket whose tag never ends
            held.append(html[at])
            at += 1
            continue
        at = m.end()
        text, tag = m[4], m[2]
        if text is not None:
            held.append(text)
            continue
        if tag is None:
            if m[0].startswith("<![CDATA["):
                held.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[1]:
            if tag not in INLINE:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    kind = stack[k][1]
                    del stack[k:]
                    break
            continue
        if tag in RAW:
            if not m[3].endswith("/") or tag not in ("svg", "math"):
                lower = lower if lower is not None else html.lower()
                end = lower.find(f"</{tag}", at)
                close = html.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else n
            held.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                held.append(" ")
            continue
        if tag not in INLINE:
            flush()
            if stack and stack[-1][0] in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack[-1][0] == tag:
                kind = stack.pop()[1]
        role = role_of(tag, m[3], kind == MAIN_KIND) if kind != SIDE_KIND else None
        if role is not None and role != kind:
            flush()
        stack.append((tag, kind))
        kind = kind if role is None else role
    flush()
    return lines


def mark(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def marked(html: list[str | None]) -> Iterator[tuple[list[tuple[int, str]], list[int], int]]:
    """Lines of pages, their marks, and the mark of all these."""
    for h in html:
        page = lines_of(h or "")
        marks = [mark(t.encode("utf-8", "surrogatepass")) for _, t in page]
        yield page, marks, mark(np.array(marks, "<i8").tobytes())


def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over pages: what they are sorted by."""
    for batch in batches:
        for at in range(0, len(batch), 512):
            part = batch.slice(at, 512)
            lines = [x for _, _, x in marked(part.column("html").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("host", "path", "page_id")), pa.array(lines, pa.int64())], names=["host", "path", "page_id", "lines"])


def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over one range of sorted keys: one row of ``EDGES``, none for an empty range."""
    first = first_other = last = last_other = None
    part = 0
    for batch in batches:
        for key in batch.to_pylist():
            part = key.pop("part")
            first = first or key
            if key["host"] == first["host"] and key["lines"] != first["lines"]:
                first_other = first_other or key
            if last is not None and last["host"] != key["host"]:
                last_other = None
            elif last is not None and last["lines"] != key["lines"]:
                last_other = last
            last = key
    if first is not None:
        key = pa.struct([("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()), ("lines", pa.int64())])
        names = ("first", "first_other", "last", "last_other")
        found = dict(zip(names, (first, first_other, last, last_other)))
        yield pa.RecordBatch.from_pylist([{"part": part} | found], schema=pa.schema([("part", pa.int32()), *((c, key) for c in names)]))


def sort_key(key) -> tuple:
    """Key of a page in the order of Spark."""
    return key["host"].encode(), key["path"].encode(), key["page_id"] is not None, key["page_id"] or 0, key["lines"]


def borders(ranges: list) -> tuple[list[tuple], dict[tuple, list[int]]]:
    """First keys of all ranges, and which pages other ranges need too: from either side of each border inside a host
    the next page, and the next one that is no copy of the page at the border."""

    def other(parts, near: str, key) -> tuple | None:
        for r in parts:
            if r[near]["host"] != key["host"]:
                return None
            if r[near]["lines"] != key["lines"]:
                return sort_key(r[near])
            if r[f"{near}_other"] is not None:
                return sort_key(r[f"{near}_other"])
        return None

    guests = defaultdict(set)
    for k in range(len(ranges) - 1):
        last, first = ranges[k]["last"], ranges[k + 1]["first"]
        if last["host"] == first["host"]:
            guests[sort_key(last)].add(k + 1)
            guests[sort_key(first)].add(k)
            guests[other(reversed(ranges[: k + 1]), "last", first)].add(k + 1)
            guests[other(ranges[k + 1 :], "first", last)].add(k)
    return [sort_key(r["first"]) for r in ranges], {key: sorted(parts) for key, parts in guests.items() if key is not None}


def parsed(firsts: list[tuple], guests: dict[tuple, list[int]]):
    """mapInArrow function over pages: their lines and range, and again for ranges that need them as guests.

    Lines beside the content travel as marks alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                pages = list(marked(part.column("html").to_pylist()))
                main = [any(k == MAIN_KIND for k, _ in p) for p, _, _ in pages]
                texts = [[t if k == MAIN_KIND or k == OPEN_KIND and not m else "" for k, t in p] for (p, _, _), m in zip(pages, main)]
                sorted_by = [sort_key(r | {"lines": p[2]}) for r, p in zip(part.select(["host", "path", "page_id"]).to_pylist(), pages)]
                own = [max(0, bisect_right(firsts, key) - 1) for key in sorted_by]
                lines = pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in ("host", "path", "page_id")), pa.array([x for _, _, x in pages], pa.int64()),
                    pa.array(own, pa.int32()), pa.array([False] * len(pages)), part.column("url"),
                    pa.array([[k for k, _ in p] for p, _, _ in pages], pa.list_(pa.int8())),
                    pa.array([m for _, m, _ in pages], pa.list_(pa.int64())), pa.array(texts, pa.list_(pa.string())),
                ], names=["host", "path", "page_id", "lines", "part", "guest", "url", "kinds", "marks", "texts"])
                yield lines
                again = [(i, k) for i, key in enumerate(sorted_by) for k in guests.get(key, ())]
                if again:
                    of, to = zip(*again)
                    copy = lines.take(pa.array(of, pa.int32()))
                    yield copy.set_column(4, "part", pa.array(to, pa.int32())).set_column(5, "guest", pa.array([True] * len(to)))

    return run


def table_row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Last row of the table of longest common subsequences of ``a`` with each beginning of ``b``."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of ``a`` in one longest common subsequence with ``b``, in memory proportional to both."""
    n = min(len(a), len(b))
    if not n:
        return np.zeros(0, np.int64)
    head = int(np.argmax(np.append(a[:n] != b[:n], True)))
    n -= head
    tail = int(np.argmax(np.append(a[::-1][:n] != b[::-1][:n], True)))
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    edge = np.concatenate((np.arange(head), np.arange(len(a) - tail, len(a))))
    keep = np.flatnonzero(np.isin(x, y))
    x, y = x[keep], y[np.isin(y, x)]
    if not len(x) or not len(y):
        return edge
    if len(x) == 1:
        inner = np.zeros(1, np.int64)
    else:
        half = len(x) // 2
        cut = int(np.argmax(table_row(x[:half], y) + table_row(x[half:][::-1], y[::-1])[::-1]))
        inner = np.concatenate((common_lines(x[:half], y[:cut]), half + common_lines(x[half:], y[cut:])))
    return np.sort(np.concatenate((edge, head + keep[inner])))


def prefix_length(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def content(kinds: np.ndarray) -> tuple[np.ndarray, bool]:
    """Lines that the structure leaves, and whether the page marks its article."""
    main = bool((kinds == MAIN_KIND).any())
    return kinds == (MAIN_KIND if main else OPEN_KIND), main


def text_of(page: dict, others: list[dict]) -> tuple[str, int, int | None]:
    """Text, number of lines shared with the paired page, and that page.

    Lines beside the content and shared lines go; inside an article element
    the structure alone decides, as articles may repeat passages of others. A
    page that would lose everything that could be content to its pair is a
    copy of it and is held against the next one, or left whole.
    """
    near = sorted(others, key=lambda o: -prefix_length(page["path"], o["path"]))
    marks = np.array(page["marks"], np.int64)
    keep, main = content(np.array(page["kinds"], np.int64))
    shared_lines, pair = 0, None
    for other in near:
        shared = np.zeros(len(marks), bool)
        shared[common_lines(marks, np.array(other["marks"], np.int64))] = True
        shared_lines, pair = int(shared.sum()), other["page_id"]
        if main:
            break
        if (keep & ~shared).any():
            keep &= ~shared
            break
    return "\n".join(page["texts"][i] for i in np.flatnonzero(keep)), shared_lines, pair


def differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over the pages of a range, sorted: each is paired with its nearer neighbour by path.

    Where differencing decides, the neighbours are those beyond the run of copies that the page lies in. Such a
    page waits for the end of the run without its lines, on disk if there are many; four pages are held.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_shared", pa.int64()), ("paired_with", pa.int64())])
    texts: list[str] = []  # of all lines of the run that any page of it keeps

    def row(page: dict, others: list[dict | None]) -> dict:
        text, shared, pair = text_of(page, [x for x in others if x is not None])
        return {"page_id": page["page_id"], "url": page["url"], "text": text, "n_chars": len(text), "n_shared": shared, "paired_with": pair}

    def place(page: dict | None) -> dict | None:
        return page and {c: page[c] for c in ("path", "page_id")}

    def ended(waiting: int, page: dict, before: dict | None, after: dict | None) -> Iterator[dict]:
        """Rows of the pages that wait, all of them copies of ``page``."""
        held.seek(0)
        alike = {"marks": page["marks"], "texts": texts}
        for _ in range(waiting):
            own, *beside = pickle.load(held)
            sides = [far or near and near | alike for far, near in zip((before, after), beside)]
            yield row(own | alike, sides)
        held.seek(0)
        held.truncate()

    def rows() -> Iterator[dict]:
        nonlocal texts
        before = other = page = None  # ``other`` is the page in front of the run of copies
        waiting = 0
        for following in stream():
            if page is not None:
                after = following if following is not None and following["host"] == page["host"] else None
                copy = after is not None and after["lines"] == page["lines"]
                keep, main = content(np.array(page["kinds"], np.int64))
                if not page["guest"]:
                    if main or not keep.any():
                        yield row(page, [before, after])
                    elif not copy:
                        yield row(page, [other or before, after])
                    else:
                        texts = [x or y for x, y in zip(texts, page["texts"])] if waiting else page["texts"]
                        pickle.dump(({c: page[c] for c in ("page_id", "url", "path", "kinds")}, place(before), place(after)), held)
                        waiting += 1
                if not copy:
                    yield from ended(waiting, page, other, after)
                    waiting, other = 0, page if after is not None else None
                before = page if after is not None else None
            page = following

    def stream() -> Iterator[dict | None]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                yield from batch.slice(at, 512).to_pylist()
        yield None

    with tempfile.SpooledTemporaryFile(1 << 22) as held:
        out = []
        for found in rows():
            out.append(found)
            if len(out) == 512:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group: int = 512, hosts: int = 1024) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars, n_shared, paired_with.

    Each page is paired, within its host, with the page next to it in the
    order of URL paths (the one with the longer common beginning, else the one
    before); their text lines are aligned by longest common subsequence.
    Shared lines and what stands in menus, headers, footers, sidebars,
    notices, adverts, forms and reader comments go; if the page marks its
    article, that is kept whole. A page that does not is paired beyond its
    copies, however many lie next to it. Null html gives an empty text, a null url
    counts as a host of its own name "". Repeated rows each get a row, which
    are copies of each other; an empty table gives none.

    Pages are dealt by ranges of (host, path), so a host of any size has many
    tasks. Both sides of a border get the pages that they need from the other one,
    at most two, so the result does not depend on where borders are. They are found on the sorted
    keys, for which pages are parsed once more: 8 bytes beside the path. A range has about ``group`` pages
    or more; there are at most ``hosts`` ranges, whose first keys every task gets.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^?#]*)"
    known = pages.select(
        F.lower(F.regexp_extract(url, pattern, 1)).alias("host"), F.regexp_extract(url, pattern, 2).alias("path"),
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"),
    )
    order = ["host", "path", "page_id", "lines"]
    light = stage(known.drop("url").mapInArrow(keys, KEY), "page-keys")
    parts = max(1, min(partitions_of(spark), light.count() // group, hosts))
    dealt = light.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    firsts, guests = borders(dealt.mapInArrow(edges, EDGES).orderBy("part").collect())  # a row for each range
    lines = known.mapInArrow(parsed(firsts, guests), LINES)
    ordered = lines.repartitionById(max(1, len(firsts)), F.col("part")).sortWithinPartitions("part", *order)
    return ordered.mapInArrow(differenced, RESULT)
