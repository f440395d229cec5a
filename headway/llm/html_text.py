"""Main text of web pages by differencing against the pages with the nearest urls.

A page becomes lines, one for each block of text, each with the zone of the page it stands
in (the nearest enclosing container). Pages are put in order of host and url path; a page
is compared with the four neighbours of the same host on either side of it there: their lines are aligned by longest
common subsequence, and lines that are shared are template, not text. A page loses the lines
that it shares with a neighbour itself, and no others: what else stands in their zone stays,
on this page and on others. Two things are known beforehand. Zones that markup itself names as furniture (menus, headers, footers,
forms, adverts, comments ...) go even if no neighbour shows them. And the zone of the article
(``article``, ``main``, or else the one with most text) is no template as a whole: copies of
an article share its lines with their neighbours; nothing of it is deleted.

Defined results: null and empty pages, and pages without text, give an empty text. A page
without neighbours of its host is judged by its markup alone. Rows that repeat a page
in id, url and content are one page and give the same text. Broken markup is read in one pass
of the page, tags that never end and quotes that never close included; a tag ends at the next
``<`` at the latest.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.ordering import MOST_RANGES
from headway.llm.url_templates import url_host, url_path
from headway.llm.wordbytes import slices

# Names of HTML elements and of the roles that class and id attributes tell.
_RAW = ("script", "style", "noscript", "template", "svg", "textarea", "title", "iframe", "select")
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body br button center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol"
    " option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_FURNITURE = frozenset(
    "nav header footer aside form menu button dialog fieldset head select".split()
)
_CONTENT = ("article", "main")
_ZONES = frozenset("div section article main td body ul ol table center".split()) | _FURNITURE
_ROLES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|menu|nav\w*|breadcrumbs?"
    r"|(?:site|page|top|main)[_-]?header|footer|sidebar|side|aside|widget|cookies?|consent|notice|notification|alert|popup|modal"
    r"|newsletter|subscri\w+|signup|login|search|share|sharing|social|related|recommend\w*"
    r"|comments?|commentlist|replies|reply|respond|responses|discussion|disqus|toolbar|pager"
    r"|pagination|copyright|legal|disclaimer)(?:$|[\s_-])",
    re.IGNORECASE,
)
_REMARKS = re.compile(r"comment|repl(?:y|ies)|respon|discuss|disqus|related|recommend|aside", re.IGNORECASE)
_ROLE_ATTRIBUTES = re.compile(
    r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE
)
_HIDDEN = re.compile(r"\shidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.IGNORECASE)
# Attributes: whole quoted strings, then whatever ends no tag. Nothing taken is given back, and
# a tag ends before the next one begins, so a page is passed once however it is broken.
_INSIDE = r"(?:\"[^\"]*\"|'[^']*'|[^'\"<>]|[\"'])*+"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(_RAW)})\b{_INSIDE}(?:>.*?(?:</\1\s*>|\Z)|\Z|(?=<))"
    rf"|<(/?)([a-zA-Z][^\s/<>]*+)({_INSIDE})(?:>|\Z|(?=<))"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
# Names of zones longer than this, as deep nesting makes them, go by a digest of their front.
_ZONE_LENGTH = 1000
_SPACE = re.compile(r"\s+")

NEIGHBOURS = 4
_NONE, _KNOWN, _ARTICLE = 0, 1, 2


def page_lines(page: str) -> list[tuple[str, int, str]]:
    """Blocks of text in page order: (zone, what is known of it, text)."""
    lines: list[tuple[str, int, str]] = []
    stack: list[tuple[str, str, int]] = [("body", "body", _NONE)]
    opened: Counter[str] = Counter()
    parts: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(map(html.unescape, parts))).strip()
        parts.clear()
        if text:
            lines.append((stack[-1][1], stack[-1][2], text))

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in _BLOCK:
            flush()
        if name in _VOID:
            continue
        if m[2]:
            if opened[name]:
                i = len(stack) - 1
                while stack[i][0] != name:
                    i -= 1
                flush()
                _leave(stack, opened, i)
            continue
        _open(stack, opened, name, m[4] or "")
    if at < len(page):
        parts.append(page[at:])
    flush()
    return lines


def _leave(stack: list[tuple[str, str, int]], opened: Counter[str], at: int) -> None:
    """Close the elements from a place of the stack on."""
    for name, _, _ in stack[at:]:
        opened[name] -= 1
    del stack[at:]


def _open(
    stack: list[tuple[str, str, int]], opened: Counter[str], name: str, attributes: str
) -> None:
    """Enter an element, closing paragraphs and list items that it ends."""
    if name in _BLOCK and (opened["p"] or name == "li" and opened["li"]):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == "p" or stack[i][0] == name == "li":
                _leave(stack, opened, i)
                break
            if stack[i][0] in _BLOCK:
                break
    _, zone, known = stack[-1]
    roles = " ".join(a or b or c for a, b, c in _ROLE_ATTRIBUTES.findall(attributes))
    remark = name == "article" and (_REMARKS.search(roles) or _REMARKS.search(zone))
    content = name in _CONTENT and not remark
    named = (
        remark
        or _HIDDEN.search(attributes)
        or (name in _FURNITURE and not (known == _ARTICLE and name == "header"))
        or (name not in ("body", "html") and (f" {roles} " == " header " or _ROLES.search(roles)))
    )
    if content:
        zone, known = f"{zone}>{name}", _ARTICLE
    elif named and known != _KNOWN:
        zone, known = f"{zone}>{name}.{roles}", _KNOWN
    elif name in _ZONES and known == _NONE:
        zone = f"{zone}>{name}.{roles}" if roles else f"{zone}>{name}"
    if len(zone) > _ZONE_LENGTH and zone is not stack[-1][1]:
        front, back = zone[: -_ZONE_LENGTH // 2], zone[-_ZONE_LENGTH // 2 :]
        zone = f"#{hashlib.blake2b(front.encode(), digest_size=8).hexdigest()}{back}"
    stack.append((name, zone, known))
    opened[name] += 1


def aligned_lines(one: list, other: list) -> list[tuple[int, int]]:
    """Places (in `one`, in `other`) that a longest common subsequence of both aligns."""
    first, ends = 0, (len(one), len(other))
    while first < min(ends) and one[first] == other[first]:
        first += 1
    last = 0
    while last < min(ends) - first and one[-1 - last] == other[-1 - last]:
        last += 1
    pairs = [(i, i) for i in range(first)]
    pairs += [(len(one) - i, len(other) - i) for i in range(1, last + 1)]
    a, b = one[first : len(one) - last], other[first : len(other) - last]
    # Lines that the other side does not have at all cannot be aligned.
    in_b, in_a = set(b), set(a)
    left = [(i, x) for i, x in enumerate(a) if x in in_b]
    right = [(j, y) for j, y in enumerate(b) if y in in_a]
    found = _common([x for _, x in left], [y for _, y in right])
    return pairs + [(first + left[i][0], first + right[j][0]) for i, j in found]


# Cells of a table of lengths that is kept whole; larger ones are halved first.
_CELLS = 1 << 20


def _common(one: list, other: list) -> list[tuple[int, int]]:
    """Places that a longest common subsequence pairs, in memory linear in the lines.

    A large pair of lists is split: the first half of `one` goes with that front of the other
    list for which both parts together have most in common.
    """
    numbers: dict = {}
    lists = [np.array([numbers.setdefault(x, len(numbers)) for x in xs], np.int64) for xs in (one, other)]
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(one), 0, len(other))]
    while todo:
        a, b, c, d = todo.pop()
        if b - a == 0 or c == d:
            continue
        if b - a == 1:
            places = np.flatnonzero(lists[1][c:d] == lists[0][a])
            pairs += [(a, c + int(places[-1]))] if len(places) else []
        elif (b - a) * (d - c) <= _CELLS:
            pairs += _traced(lists[0][a:b].tolist(), lists[1][c:d].tolist(), a, c)
        else:
            middle = (a + b) // 2
            front = _last_row(lists[0][a:middle], lists[1][c:d])
            back = _last_row(lists[0][middle:b][::-1], lists[1][c:d][::-1])[::-1]
            cut = c + int(np.argmax(front + back))
            todo += [(a, middle, c, cut), (middle, b, cut, d)]
    return pairs


def _last_row(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequence of `one` and every front of `other`."""
    row = np.zeros(len(other) + 1, np.int64)
    for x in one.tolist():
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (other == x)))
    return row


def _traced(one: list, other: list, a: int, c: int) -> list[tuple[int, int]]:
    """The pairs of two short lists, by the whole table of lengths."""
    lengths = [[0] * (len(other) + 1)]
    for x in one:
        above, row = lengths[-1], [0]
        for j, y in enumerate(other):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
        lengths.append(row)
    pairs, i, j = [], len(one), len(other)
    while i and j:
        if one[i - 1] == other[j - 1]:
            pairs.append((a + i - 1, c + j - 1))
            i, j = i - 1, j - 1
        elif lengths[i - 1][j] >= lengths[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return pairs


def common_lines(one: list, other: list) -> set[int]:
    """Places in `one` that a longest common subsequence of both aligns."""
    return {i for i, _ in aligned_lines(one, other)}


def _article_zone(lines: list[tuple[str, int, str]]) -> str | None:
    """The zone with most text among those nothing is known of, if none is an article."""
    if any(k == _ARTICLE for _, k, _ in lines):
        return None
    sizes: dict[str, int] = {}
    for zone, known, text in lines:
        if known == _NONE:
            sizes[zone] = sizes.get(zone, 0) + len(text)
    return max(sizes, key=sizes.get) if sizes else None


def _compared(lines: list[tuple[str, int, str]]) -> list[tuple[int, tuple[str, str]]]:
    """Place and key of the lines that may be template: those of an article never are."""
    return [(i, (z, t)) for i, (z, k, t) in enumerate(lines) if k != _ARTICLE]


def _share(one: list, other: list, shared_one: set[int], shared_other: set[int]) -> None:
    """Add the places of the lines that two pages share."""
    for i, j in aligned_lines([k for _, k in one], [k for _, k in other]):
        shared_one.add(one[i][0])
        shared_other.add(other[j][0])


def _main_text(lines: list[tuple[str, int, str]], shared: set[int]) -> str:
    main = _article_zone(lines)
    return " ".join(
        text
        for i, (zone, known, text) in enumerate(lines)
        if known == _ARTICLE or zone == main or (known == _NONE and i not in shared)
    )


def difference(pages: list[list[tuple[str, int, str]]], reach: int) -> list[str]:
    """Texts of neighbouring pages of one host, in url order."""
    keys = [_compared(lines) for lines in pages]
    shared: list[set[int]] = [set() for _ in pages]
    for i in range(len(pages)):
        for j in range(i + 1, min(i + 1 + reach, len(pages))):
            _share(keys[i], keys[j], shared[i], shared[j])
    return [_main_text(lines, found) for lines, found in zip(pages, shared, strict=True)]


def extract_text(
    pages: DataFrame, partitions: int | None = None, reach: int = NEIGHBOURS
) -> DataFrame:
    """page_id, url, text: the main text of each page.

    Pages are dealt out by ranges of host and path, so that a hot host is spread over many
    tasks. A range also gets the `reach` pages before and behind it, so that every page meets
    all its neighbours wherever ranges end; a task holds `reach` pages at a time. Markup, in
    practice most of a page, is cut away before the shuffle.
    """
    conf = pages.sparkSession.conf
    rows = pages.select(
        F.col("page_id"), F.col("url"), F.coalesce(F.col("html"), F.lit("")).alias("html")
    )
    kind = dict(rows.dtypes)["page_id"]
    placed = rows.withColumn("host", url_host(F.col("url"))).withColumn(
        "path", url_path(F.col("url"))
    )
    keys = placed.select(*_KEY)
    n = keys.count()
    # A range of few pages would mostly hold the pages around it.
    most = 2 * int(conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(MOST_RANGES, partitions or min(most, n // _LEAST_PAGES)))
    bounds = _bounds(keys, n, ranges)
    copies = _copies(_edges(keys, bounds, reach, kind), reach)
    line = "array<struct<zone:string,known:int,text:string>>"
    cut = placed.mapInArrow(
        _cut_pages(bounds, copies),
        f"part int, own boolean, mark long, page_id {kind}, url string, host string,"
        f" path string, lines {line}",
    )
    near = cut.repartition(ranges, "part") if partitions else cut.repartition("part")
    near = near.sortWithinPartitions("part", *_KEY, "mark")
    return near.mapInArrow(_differences(reach), f"page_id {kind}, url string, text string")


# The order of pages. Rows that agree in all of it are in one range.
_KEY = ("host", "path", "page_id", "url")
_LEAST_PAGES = 64


def _ordered(row: tuple) -> tuple:
    """A key that compares in Python as its columns do in Spark: nulls first."""
    return tuple((x is not None, x) if x is not None else (False,) for x in row)


def _bounds(keys: DataFrame, n: int, ranges: int) -> list[tuple]:
    """Keys at which a new range begins, from a sample of 40 rows for each range at most."""
    if ranges < 2:
        return []
    if n > 20 * ranges:
        share = int((1 << 30) * 20 * ranges / n)
        drawn = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < share
        # Hashes that repeat, as rows that repeat a page have, must not fill the driver.
        keys = keys.filter(drawn).limit(40 * ranges)
    sample = sorted({_ordered(r) for r in keys.collect()})
    places = (len(sample) * i // ranges for i in range(1, ranges))
    return sorted({sample[at] for at in places}) if sample else []


def _edges(keys: DataFrame, bounds: list[tuple], reach: int, kind: str) -> list[tuple[int, tuple]]:
    """(range, key) of the first and last `reach` different keys of each range."""
    if not bounds:
        return []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            part = pa.array([bisect_right(bounds, _ordered(r)) for r in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([part, *batch.columns], names=["part", *_KEY])

    schema = f"part int, host string, path string, page_id {kind}, url string"
    parts = keys.mapInArrow(place, schema).distinct()
    found = set()
    for order in (_KEY, tuple(F.col(k).desc() for k in _KEY)):
        ranked = parts.withColumn(
            "place", F.row_number().over(Window.partitionBy("part").orderBy(*order))
        )
        for row in ranked.filter(F.col("place") <= reach).drop("place").collect():
            found.add((row["part"], _ordered(row[1:])))
    return sorted(found)


def _copies(edges: list[tuple[int, tuple]], reach: int) -> dict[tuple, list[int]]:
    """The ranges, beside its own, that need the page of a key as a neighbour."""
    out: dict[tuple, list[int]] = {}
    for i in range(len(edges)):
        part, key = edges[i]
        if i == 0 or edges[i - 1][0] != part:
            for _, other in edges[max(0, i - reach) : i]:
                if other[0] == key[0]:
                    out.setdefault(other, []).append(part)
        if i + 1 == len(edges) or edges[i + 1][0] != part:
            for _, other in edges[i + 1 : i + 1 + reach]:
                if other[0] == key[0]:
                    out.setdefault(other, []).append(part)
    return out


_LINES = pa.list_(
    pa.struct([("zone", pa.string()), ("known", pa.int32()), ("text", pa.string())])
)


def _cut_pages(bounds: list[tuple], copies: dict[tuple, list[int]]):
    """Pages as lines, each in its range and, marked as not its own, in those that need it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handed: set[tuple] = set()
        for whole in batches:
            for batch in slices(whole, "html"):
                rows, part, own, marks, lines = [], [], [], [], []
                keys = zip(*(batch.column(k).to_pylist() for k in _KEY), strict=True)
                for i, (row, page) in enumerate(
                    zip(keys, batch.column("html").to_pylist(), strict=True)
                ):
                    key = _ordered(row)
                    digest = hashlib.blake2b(page.encode(), digest_size=8).digest()
                    mark = int.from_bytes(digest, "big", signed=True)
                    needed = copies.get(key, [])
                    if needed and (key, mark) in handed:
                        needed = []
                    elif needed:
                        handed.add((key, mark))
                    cut = [{"zone": z, "known": k, "text": t} for z, k, t in page_lines(page)]
                    for p in (bisect_right(bounds, key), *needed):
                        own.append(not rows or rows[-1] != i)
                        rows.append(i)
                        part.append(p)
                        marks.append(mark)
                        lines.append(cut)
                names = ["page_id", "url", "host", "path"]
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.int32()), pa.array(own, pa.bool_()),
                        pa.array(marks, pa.int64()), *(batch.column(n).take(taken) for n in names),
                        pa.array(lines, _LINES),
                    ],
                    names=["part", "own", "mark", *names, "lines"],
                )

    return run


@dataclass
class _Page:
    """A page in reach, with the rows it stands for and what it shares so far."""

    page_id: object
    url: str | None
    lines: list[tuple[str, int, str]]
    rows: int = 0
    shared: set[int] = field(default_factory=set)

    def __post_init__(self) -> None:
        self.compared = _compared(self.lines)


# Texts that a task hands on together, and their characters, at most.
_OUT, _OUT_SIZE = 256, 4 << 20


def _differences(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: deque[_Page] = deque()
        done: list[tuple] = []
        place, last, size = None, None, 0

        def finish() -> int:
            page = held.popleft()
            if not page.rows:
                return 0
            text = _main_text(page.lines, page.shared)
            done.append((page.page_id, page.url, text, page.rows))
            return len(text)

        def handed() -> Iterator[pa.RecordBatch]:
            # Rows that repeat a page were held once.
            rows = ((i, u, t) for i, u, t, n in done for _ in range(n))
            while some := list(islice(rows, _OUT)):
                ids, urls, texts = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, kind), pa.array(urls, pa.string()), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )
            done.clear()

        for whole in batches:
            kind = whole.schema.field("page_id").type
            names = ("part", "host", "path", "page_id", "url", "mark", "own", "lines")
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                    if last != row[:6]:
                        if place != row[:2]:
                            while held:
                                size += finish()
                        elif len(held) > reach:
                            size += finish()
                        place, last = row[:2], row[:6]
                        lines = [(x["zone"], x["known"], x["text"]) for x in row[7]]
                        page = _Page(row[3], row[4], lines)
                        for other in held:
                            _share(other.compared, page.compared, other.shared, page.shared)
                        held.append(page)
                    held[-1].rows += row[6]
                    if len(done) >= _OUT or size >= _OUT_SIZE:
                        yield from handed()
                        size = 0
        while held:
            finish()
        if done:
            yield from handed()

    return run
