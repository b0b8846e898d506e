"""Main text of HTML pages by differencing nearest URLs.

A page becomes a list of lines, one per block.  Scripts, styles, forms, menus and other parts
that the markup itself names are not lines.  Pages are ordered by host and URL path; each is
paired with its neighbours before and behind on the same host.  The two lists are aligned by
longest common subsequence, and the shared lines, the site's template, are deleted from both.
Lines inside an article or main element are the page's own by its markup and are not deleted,
so that mirrored articles and quoted passages stay.  Without such an element, two pages that are
equal or nearly so say nothing about a template: the pair deletes nothing, and the next of the
NEIGHBOURS nearest different pages takes its place.  Equal pages in a row count as one.

Only hashes of lines are shuffled for the pairing.  Pages are dealt out by ranges of (host,
path), so a large host is spread over tasks; the pairs across the edges of ranges are made from
two rows per range.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import spill

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "select", "title", "object", "canvas", "audio", "video"}
DROPPED = {"head", "nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
#: Words in class, id or role that name parts beside the article.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|masthead|menu|nav|navbar|"
    r"navigation|newsletter|notice|pagination|popup|promo\w*|related|replies|search|share|sharing|sidebar|signup|social|sponsor\w*|"
    r"subscribe|complementary|contentinfo|toolbar|widget)(?:$|[\s_-])",
    re.I,
)
#: Those that are no part of an article inside of it either.
NAMED_INSIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|comments?|disqus|newsletter|promo\w*|replies|signup|sponsor\w*|subscribe)(?:$|[\s_-])", re.I
)
#: Headers inside an article hold its title.
IN_ARTICLE = {"header"}
OWN = {"article", "main"}
SPACE = re.compile(r"\s+")
#: Lists whose table would have more than the square of this are halved first.
TABLE = 1000
#: A pair is evidence if the lines that only one page has are this share of its characters, on
#: both; a page whose markup shows its own lines can lose no more than the others anyway.
OWN_SHARE = 0.1
#: Different pages on each side that are tried, nearest first, within a task's range.
NEIGHBOURS = 8


def beside(tag: str, attributes: str, inside: bool) -> bool:
    if tag in DROPPED:
        return not (inside and tag in IN_ARTICLE)
    if not attributes or tag in OWN or tag in ("body", "html"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true" and tag not in INLINE):
            return True
        if name in ("class", "id", "role") and (NAMED_INSIDE if inside else NAMED).search(value):
            return True
    return False


def lines(page: str) -> list[tuple[str, bool]]:
    """(text, own) per block with text: references decoded, white space single.  ``own`` lies
    inside an article or main element.  Elements left open end with their parent."""
    out: list[tuple[str, bool]] = []
    text: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # tag, dropped, own
    at = 0

    def end_block(own: bool) -> None:
        joined = SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if joined:
            out.append((joined, own))

    def take(piece: str) -> None:
        if piece and not (open_ and open_[-1][1]):
            text.append(piece)

    while True:
        found = TOKEN.search(page, at)
        take(page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        dropped, own = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
        if found[1]:
            if tag not in INLINE:
                end_block(own)
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag:
                    if tag not in INLINE or all(o[0] in INLINE for o in open_[k:]):
                        if tag not in INLINE:
                            end_block(own)
                        del open_[k:]
                    break
            continue
        if tag == "br" or (tag in VOID and tag in INLINE):
            take(" ")
            continue
        if tag not in INLINE:
            end_block(own)
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or re.fullmatch(r"h[1-6]", tag):
                close_implied(open_, tag)
                dropped, own = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
        if tag in VOID or found[3].endswith("/"):
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            take(" ")
            continue
        open_.append((tag, dropped or beside(tag, found[3], own), own or tag in OWN))
    end_block(open_[-1][2] if open_ else False)
    return out


def close_implied(open_: list, tag: str) -> None:
    """A new paragraph, item or cell ends an open one of its kind."""
    ends = {"p"} if tag[0] in "hp" else {"td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}}.get(tag, {tag, "p"})
    for k in range(len(open_) - 1, -1, -1):
        if open_[k][0] in ends:
            del open_[k:]
            return
        if open_[k][0] not in INLINE:
            return


def shared(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Positions of a longest common subsequence in both.  Common ends are taken off first,
    then lines that only one of them has."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    tail = 0
    while tail < min(len(a), len(b)) - start and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    p, q = list(range(start)), list(range(start))
    x, y = a[start : len(a) - tail], b[start : len(b) - tail]
    common = set(x) & set(y)
    i = [k for k, v in enumerate(x) if v in common]
    j = [k for k, v in enumerate(y) if v in common]
    for u, v in pairs([x[k] for k in i], [y[k] for k in j]):
        p.append(start + i[u])
        q.append(start + j[v])
    p += range(len(a) - tail, len(a))
    q += range(len(b) - tail, len(b))
    return p, q


def pairs(x: list[int], y: list[int]) -> list[tuple[int, int]]:
    """Longest common subsequence in linear memory (divide and conquer over score rows)."""
    if not x or not y:
        return []
    if len(x) * len(y) <= TABLE * TABLE:
        return by_table(x, y)
    if len(x) < 2:
        return [(0, y.index(x[0]))] if x[0] in y else []
    half = len(x) // 2
    yy = np.array(y)
    up = last_row(x[:half], yy)
    down = last_row(x[half:][::-1], yy[::-1])[::-1]
    cut = int((up + down).argmax())
    return pairs(x[:half], y[:cut]) + [(half + u, cut + v) for u, v in pairs(x[half:], y[cut:])]


def last_row(x: list[int], y: np.ndarray) -> np.ndarray:
    row = np.zeros(len(y) + 1, np.int32)
    for value in x:
        row[1:] = np.maximum(row[1:], row[:-1] + (y == value))
        np.maximum.accumulate(row, out=row)
    return row


def by_table(x: list[int], y: list[int]) -> list[tuple[int, int]]:
    yy = np.array(y)
    rows = np.zeros((len(x) + 1, len(y) + 1), np.int32)
    for k, value in enumerate(x):
        row = rows[k + 1]
        row[1:] = np.maximum(rows[k, 1:], rows[k, :-1] + (yy == value))
        np.maximum.accumulate(row, out=row)
    out, i, j = [], len(x), len(y)
    while i and j:
        if rows[i, j] == rows[i - 1, j]:
            i -= 1
        elif rows[i, j] == rows[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def place(url: str | None) -> tuple[str, str]:
    """Host (without www.) and path of a URL; what cannot be read has neither."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").removeprefix("www."), parts.path
    except ValueError:
        return "", ""


def line_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def template_of(a: tuple, b: tuple) -> tuple[list[int], list[int]] | None:
    """Of two pages (hashes, sizes; own lines have theirs negative): what to delete from each, or None if
    the pair is no evidence."""
    out = []
    for (_, sizes), hit in zip((a, b), shared(a[0], b[0])):
        if min(sizes, default=0) >= 0 and sum(sizes[k] for k in hit) > (1 - OWN_SHARE) * sum(sizes):
            return None
        out.append([k for k in hit if sizes[k] > 0])
    return tuple(out)


class Different:
    """A page, the keys of the rows that are equal to it, and what the pairs so far delete."""

    def __init__(self, key: int, hashes: list[int], sizes: list[int]):
        self.keys, self.page, self.behind, self.ahead = [key], (hashes, sizes), None, None


def met(near: deque[Different], key: int, hashes: list[int], sizes: list[int]) -> Iterator[tuple[int, list[int]]]:
    """Pair a page with the different ones before it, nearest first, until it and each of them
    has a pair that is evidence; (row, lines to delete) for all rows concerned."""
    for same in near:
        if min(sizes, default=0) >= 0 and same.page == (hashes, sizes):
            same.keys.append(key)
            yield from ((key, cut) for cut in (same.behind, same.ahead) if cut)
            return
    here = Different(key, hashes, sizes)
    for other in reversed(near):
        if here.behind is not None and other.ahead is not None:
            continue
        found = template_of(other.page, here.page)
        if found is None:
            continue
        if other.ahead is None:
            other.ahead = found[0]
            yield from ((k, found[0]) for k in other.keys)
        if here.behind is None:
            here.behind = found[1]
            yield key, found[1]
    near.append(here)


def template(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """(row_key, cut): positions of the lines of a page that a neighbour on its host shares."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for link, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                host, path = place(link)
                if host:
                    found = lines(text or "")
                    rows.append((host, path, [line_hash(t) for t, _ in found], [-len(t) if own else len(t) for t, own in found]))
                else:
                    rows.append((None, None, [], []))
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = (pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["row_key", "host", "path", "hashes", "sizes"]
            )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        count = 0
        near: deque[Different] = deque(maxlen=NEIGHBOURS)
        for batch in batches:
            rows: list[tuple[int, list[int]]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                count += 1
                if last is not None and last[1] != row[1]:
                    near.clear()
                first = first or row
                last = row
                rows += met(near, row[0], row[3], row[4])
            yield made([(k, None, None, None, cut, None, None) for k, cut in rows if cut])
        if last is not None:
            yield made([(r[0], r[1], r[3], r[4], None, e, count) for r, e in ((first, 0), (last, 1))])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        names = ["row_key", "host", "hashes", "sizes", "cut", "edge", "count"]
        kinds = (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.int64())
        columns = list(zip(*rows)) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = template_of((a["hashes"], a["sizes"]), (b["hashes"], b["sizes"]))
                rows += [(r["row_key"], cut) for r, cut in zip((a, b), found or ()) if cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int64()), pa.array([c for _, c in rows], pa.list_(pa.int32()))], ["row_key", "cut"]
            )

    narrow = pages.select("row_key", url, page).mapInArrow(
        parse, "row_key long, host string, path string, hashes array<long>, sizes array<int>"
    )
    narrow = spill(narrow.filter("host is not null").dropDuplicates(["row_key"]))
    ordered = narrow.repartitionByRange("host", "path", "row_key").sortWithinPartitions("host", "path", "row_key")
    aligned = spill(
        ordered.mapInArrow(
            align,
            "row_key long, host string, hashes array<long>, sizes array<int>, cut array<int>, edge int, count long",
        ).withColumn("task", F.spark_partition_id())
    )
    # Two rows per range: the last of each and the first of the next that has rows.
    step = Window.partitionBy(F.lit(1)).orderBy("task", "edge")
    row = F.struct("row_key", "host", "hashes", "sizes")
    edges = aligned.filter("edge is not null").select("task", "edge", row.alias("a"), F.lead(row).over(step).alias("b"))
    edges = edges.filter("edge = 1 and a.host = b.host").select("a", "b").mapInArrow(across, "row_key long, cut array<int>")
    cut = aligned.filter("cut is not null").select("row_key", "cut").unionByName(edges)
    return cut.groupBy("row_key").agg(F.array_distinct(F.flatten(F.collect_list("cut"))).alias("cut"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars) per row.

    A null page is the empty one and gives the empty text.  Pages whose URL is null or has no
    host have no neighbours and keep all their lines.  Rows equal in key, url and page are one
    page for the pairing and come out as often as they came in.  The neighbours are those next
    in (host, path, hash of the row), so ties in the path have a fixed order.  Other columns are not looked at.
    """
    table = pages.select(key, url, page).withColumn("row_key", F.xxhash64(F.lit(11), key, url, page))
    cut = template(table, key, url, page).withColumnRenamed("row_key", "cut_key")
    joined = table.join(cut, F.col("row_key") == F.col("cut_key"), "left").select(key, url, page, "cut")
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                gone = set(gone or ())
                texts.append("\n\n".join(t for k, (t, _) in enumerate(lines(text or "")) if k not in gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [key, url, "text", "n_chars"],
            )

    return joined.mapInArrow(run, f"`{key}` {kind}, `{url}` string, text string, n_chars long")
