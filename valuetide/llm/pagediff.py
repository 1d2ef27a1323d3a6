"""Main text of web pages by nearest-URL page differencing.

Pages of one host whose URL paths are closest carry the same menus, notices
and footers.  Pages are put in order of (host, path); each is compared with
the neighbour that shares the longer path prefix.  The text lines of the two
are aligned by their longest common subsequence, and what they share is
deleted.  Inside an element that the page marks as its article, chance makes
equal sentences too: there headings, paragraphs and what an article element
holds stay, and of other lines those go that stand at the beginning or end of
the marked part, in the neighbours as well.  Elements that are page furniture by
name, class or role go before, since a host may have one page only, and take no
part in the comparison.  Pages of a host with equal lines are one in the order,
so their neighbours are other pages, and share the result.

Only line hashes are put in order, by ranges of (host, path), so no host is
held by one task; the first and last pages of a range, whose neighbours are
elsewhere, are settled in a second small step.  The pages themselves are read
twice and joined once by id.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from os.path import commonprefix
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

# Elements by their role in a page.
RAW = "script|style|textarea|title|noscript|template|iframe|xmp"
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main"))
FURNITURE = frozenset(
    "aside button dialog fieldset footer form head header input menu nav search select svg".split()
)
FURNITURE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
FURNITURE_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment commentlist comments "
    "consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notices pager pagination popup promo promotion promoted related reply replies responses search share "
    "sharing sidebar signup social sponsor sponsored sponsors subscribe subscription toolbar topbar widget "
    "widgets".split()
)
# An element of these kinds ends an open one of the kinds beside it.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
SCOPES = frozenset("ul ol dl table select body article main div section aside nav footer header form".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
HEADED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
NAME_PART = re.compile(r"[a-z]+")

# PROSE: inside, and in an element that holds the text itself.
OUTSIDE, INSIDE, DROPPED, PROSE = 0, 1, 2, 3
MARKED = (INSIDE, PROSE)
PROSE_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre article".split())
# What part of its lines a page may share before the other one may be a copy.
COPY_SHARE = 0.9


def is_furniture(tag: str, attributes: str, inside: bool) -> bool:
    """Whether the element is no part of the text by its name, role or class.

    Inside an article only whole class names and ids count, and no ids of
    headings and sections, which name what stands there.
    """
    if tag in FURNITURE and not (inside and tag == "header"):
        return True
    if tag in ("html", "body", "main") or "=" not in attributes:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if name.lower() == "role":
            if value in FURNITURE_ROLES:
                return True
        elif inside:
            named = name.lower() == "id" and tag in HEADED
            if not named and not FURNITURE_NAMES.isdisjoint(value.split()) and "header" not in value:
                return True
        elif not FURNITURE_NAMES.isdisjoint(NAME_PART.findall(value)):
            return True
    return False


def page_lines(html: str) -> list[tuple[str, int]]:
    """The text lines of a page in order, each with its zone.

    A line is what stands between two block borders, character references
    decoded, white space made single, trimmed; blank ones are left out.  Zones:
    INSIDE a marked part or PROSE there, OUTSIDE, or DROPPED as furniture.
    """
    lines: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    zone, at, buffer = OUTSIDE, 0, []

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            if text:
                prose = zone == INSIDE and not PROSE_TAGS.isdisjoint(name for name, _ in stack)
                lines.append((text, PROSE if prose else zone))
            buffer.clear()

    def close(names: tuple[str, ...], scopes: frozenset[str]) -> int:
        """Pop the innermost open element of ``names``, unless a scope shuts it off."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                outer = stack[k][1]
                del stack[k:]
                return outer
            if stack[k][0] in scopes:
                break
        return zone

    for token in TOKEN.finditer(html):
        buffer.append(html[at : token.start()])
        at = token.end()
        ending, tag, attributes = token.group(2, 3, 4)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            buffer.append(" ")
        if ending:
            if any(name == tag for name, _ in stack):
                zone = close((tag,), frozenset())
            continue
        if tag in BLOCKS:
            zone = close(("p",), SCOPES)
        if tag in CLOSES:
            zone = close(CLOSES[tag], SCOPES)
        if tag in VOID:
            continue
        outer = zone
        if zone != DROPPED:
            if is_furniture(tag, attributes, zone == INSIDE):
                if tag not in BLOCKS:
                    flush()
                zone = DROPPED
            elif tag in ARTICLE:
                zone = INSIDE
        if not attributes.endswith("/") or tag in BLOCKS:
            stack.append((tag, outer))
        else:
            zone = outer
    buffer.append(html[at:])
    flush()
    return lines


def content(html: str) -> list[tuple[str, int]]:
    """The lines of a page without its furniture."""
    return [line for line in page_lines(html) if line[1] != DROPPED]


def article_copied(inside: list[bool], shared: set[int]) -> bool:
    """Whether so much of the marked article is shared that it is a copy."""
    own = [k for k, marked in enumerate(inside) if marked]
    return bool(own) and sum(k in shared for k in own) >= COPY_SHARE * len(own)


def main_text(lines: list[tuple[str, int]], shared: set[int]) -> str:
    """The lines that are not furniture and not shared; a copied article stays.

    ``shared`` counts the lines without furniture.
    """
    lines = [line for line in lines if line[1] != DROPPED]
    copied = article_copied([zone in MARKED for _, zone in lines], shared)
    return "\n".join(
        text for k, (text, zone) in enumerate(lines) if k not in shared or (copied and zone in MARKED)
    )


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Equal ends are taken as they are; between them each line of ``a`` may meet
    its equals in ``b``, and the longest rising chain of meetings is kept.
    """
    low, high = 0, min(len(a), len(b))
    while low < high and a[low] == b[low]:
        low += 1
    end = 0
    while end < high - low and a[-1 - end] == b[-1 - end]:
        end += 1
    places = defaultdict(list)
    for k in range(len(b) - end - 1, low - 1, -1):
        places[b[k]].append(k)
    tails: list[int] = []
    last: list[tuple] = []
    for k in range(low, len(a) - end):
        for place in places.get(a[k], ()):
            rank = bisect_left(tails, place)
            node = (k, last[rank - 1] if rank else None)
            if rank == len(tails):
                tails.append(place)
                last.append(node)
            else:
                tails[rank], last[rank] = place, node
    chain, node = [], last[-1] if last else None
    while node:
        chain.append(node[0])
        node = node[1]
    return [*range(low), *reversed(chain), *range(len(a) - end, len(a))]


def common_rims(page: list[int], others: list[list[int]]) -> set[int]:
    """Places of marked lines at the beginning and the end that all ``others`` have there too.

    Prose ends a rim.  Nothing counts where no line would be left.
    """
    marked = [k for k, x in enumerate(page) if x & 1]
    found: list[int] = []
    for step in (1, -1):
        sides = [[x for x in other if x & 1][::step] for other in others]
        for n, k in enumerate(marked[::step]):
            if page[k] & 2 or any(n >= len(side) or side[n] != page[k] for side in sides):
                break
            found.append(k)
    return set(found) if len(found) < len(marked) else set()


def shared_with(page: dict, before: dict | None, after: dict | None) -> list[int]:
    """Lines of the page that go because its neighbours have them.

    The lowest bits of a line tell whether it is inside a marked part and
    prose.  Lines outside are settled by the neighbour of the longer common
    path.  A neighbour that may be a copy, of the article or of nearly all
    lines, tells nothing about furniture, so the other one is asked then; where
    both may be copies, the lines that both have count as shared.
    """
    near = [p for p in (before, after) if p and p["host"] == page["host"]]
    near.sort(key=lambda p: -len(commonprefix((p["path"], page["path"]))))
    own = [x >> 2 for x in page["lines"]]
    inside = [x & 1 == 1 for x in page["lines"]]
    told: list[tuple[set[int], list[int]]] = []
    copies: list[tuple[set[int], list[int]]] = []
    for other in near:
        shared = set(common_lines(own, [x >> 2 for x in other["lines"]]))
        alike = len(shared) >= COPY_SHARE * max(len(own), len(other["lines"]), 1)
        (copies if alike or article_copied(inside, shared) else told).append((shared, other["lines"]))
    if not told and not copies:
        return []
    outside = told[0][0] if told else set.intersection(*(shared for shared, _ in copies))
    edges = common_rims(page["lines"], [lines for _, lines in told or copies])
    return sorted({k for k in outside if not inside[k]} | edges)


def host_and_path(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").removeprefix("www."), parts.path
    except ValueError:
        return "", url or ""


OUTLINE = "page_id long, key long, host string, path string, outline long, lines array<long>"
PAIRED = "page_id long, key long, host string, path string, lines array<long>, shared array<int>, role int"
# Rows of PAIRED: settled, at the edge of a range, or next to an edge.
SETTLED, EDGE, NEXT = 0, 1, 2


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _arrow(ddl_names: list[str]) -> pa.Schema:
    kinds = {
        "host": pa.string(),
        "path": pa.string(),
        "lines": pa.list_(pa.int64()),
        "shared": pa.list_(pa.int32()),
        "role": pa.int32(),
    }
    return pa.schema([(n, kinds.get(n, pa.int64())) for n in ddl_names])


def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(["page_id", "key", "host", "path", "outline", "lines"])
    for batch in batches:
        rows = []
        for page, key, url, html in zip(*(c.to_pylist() for c in batch.columns)):
            host, path = host_and_path(url)
            hashes = [
                ((xxhash.xxh64_intdigest(text) - (1 << 63)) & ~3) | zone for text, zone in content(html or "")
            ]
            outline = xxhash.xxh64_intdigest(",".join(map(str, hashes))) - (1 << 63)
            rows.append(
                {"page_id": page, "key": key, "host": host, "path": path, "outline": outline, "lines": hashes}
            )
        yield _batch(rows, schema)


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict]:
    for batch in batches:
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            yield dict(zip(names, values))


def pair_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the pages of one range, three of them in memory at a time."""
    names = ["page_id", "key", "host", "path", "lines"]
    schema = _arrow([*names, "shared", "role"])
    out: list[dict] = []
    number, before, page = 0, None, None
    held: list[dict] = []

    def settle(row: dict, previous: dict, following: dict) -> None:
        shared = shared_with(row, previous, following)
        out.append(row | {"lines": None, "shared": shared, "role": SETTLED})

    def context(row: dict, role: int) -> None:
        out.append(row | {"shared": None, "role": role})

    for row in _rows(batches, names):
        number += 1
        if number == 1:
            context(row, EDGE)
        elif number == 2:
            held = [row]
        if number >= 3:
            settle(page, before, row)
        before, page = page, row
        if len(out) >= 1000:
            yield _batch(out, schema)
            out = []
    if number >= 2:
        context(page, EDGE)
        # Pages beside an edge are settled themselves; here they are context.
        if number >= 3:
            context(held[0], NEXT)
        if number >= 4:
            context(before, NEXT)
    yield _batch(out, schema)


def pair_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the edge pages of all ranges, in order, with their neighbours."""
    names = ["page_id", "key", "host", "path", "lines", "shared", "role"]
    rows = list(_rows(batches, names))
    around = zip([None, *rows], rows, [*rows[1:], None])
    found = [
        {"page_id": row["page_id"], "key": row["key"], "shared": shared_with(row, before, after)}
        for before, row, after in around
        if row["role"] == EDGE
    ]
    yield _batch(found, _arrow(["page_id", "key", "shared"]))


def shared_lines(pages: DataFrame) -> DataFrame:
    """(page_id, key, shared): places of the lines each page shares with its neighbour."""
    order = ["host", "path", "page_id", "key"]
    own = store(pages.mapInArrow(outlines, OUTLINE), "outlines")
    # Pages of equal lines stand together at the first of their places.
    place = F.min(F.struct("path", F.col("page_id").isNull().alias("none"), "page_id", "key")).alias("place")
    distinct = own.groupBy("host", "outline").agg(place, F.first("lines").alias("lines"))
    distinct = distinct.select("place.page_id", "place.key", "host", "place.path", "lines")
    dealt = distinct.repartitionByRange(*order).sortWithinPartitions(*order)
    paired = store(dealt.mapInArrow(pair_range, PAIRED), "paired")
    # At most four pages of each range; their number is that of the partitions.
    edges = paired.filter(F.col("role") != SETTLED).coalesce(1).sortWithinPartitions(*order)
    settled = paired.filter(F.col("role") == SETTLED).select("page_id", "key", "shared")
    found = settled.union(edges.mapInArrow(pair_edges, "page_id long, key long, shared array<int>"))
    # (page_id, key) stands for one page and so for one host and outline.
    names = own.select("page_id", "key", "host", "outline").distinct()
    heads = found.select(F.col("page_id").alias("__head"), F.col("key").alias("__of"), "shared")
    known = names.join(
        heads, F.col("page_id").eqNullSafe(F.col("__head")) & (F.col("key") == F.col("__of"))
    ).select(F.col("host").alias("__host"), F.col("outline").alias("__outline"), "shared")
    return names.join(
        known, (F.col("host") == F.col("__host")) & (F.col("outline") == F.col("__outline"))
    ).select("page_id", "key", "shared")


def page_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for html, shared in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            lines = page_lines(html or "")
            texts.append(main_text(lines, set(shared or ())))
            counts.append(len(shared or ()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
                pa.array(counts, pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars", "n_shared"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_shared) of every page.

    NULL html is empty, as is its text.  A NULL or broken URL is of host '',
    whose pages are neighbours like those of any other host.  Rows that repeat
    page_id, url and html are one page in the order, and each gives a row.
    Extra columns are left out; an empty table gives no rows.
    """
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.xxhash64(F.col("url").isNull(), F.col("url"), F.col("html").isNull(), F.col("html")).alias("key"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    shared = shared_lines(keyed).select(F.col("page_id").alias("__id"), F.col("key").alias("__key"), "shared")
    joined = keyed.join(
        shared, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left"
    )
    return joined.select("page_id", "url", "html", "shared").mapInArrow(
        page_texts, "page_id long, url string, text string, n_chars long, n_shared long"
    )
