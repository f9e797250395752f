"""Main text of web pages: declared regions, and nearest-URL page differencing for the rest.

The text lines of a page are its blocks, without what markup declares to be menus, headers,
footers, sidebars, notices, adverts, forms or comments. Names of classes say so by their last word
('cookie-notice', 'sidebar-left'), not by a state ('has-sidebar') or a title ('post-header'). An
article inside an element that only its name excludes is kept if the page declares no other one
and it is longer than the lines outside. Where a page declares its article, only those lines go on.

Every page is then compared with its nearest neighbours of the same host in URL path order, among
the pages that declare an article or among those that do not: the one that shares more leading
directories of the path, or both where they share equally many. Their lines are aligned by longest
common subsequence, and the lines that all these neighbours share with the page are its template;
one that shares none has another template and says nothing. Between two pages of its directory a
page thus keeps a paragraph that only one of them has, too (quotes, licences, near copies). Pages of
a host with equal lines are copies, which say nothing about the template: they stand once in the
order, at their first path, so that every neighbour is a different page, and lose the same lines.

A page that declares no article loses its template. Differencing alone would also delete the
paragraphs that an article shares with neighbours on both sides. So a declared article loses a line
of its template only if that line is in the template of every different page of the host that
declares an article, of 20 at least, and if the lines that stay are at least as long as those that
go: articles that share more are near copies.

Nulls: a null or empty page has an empty text; pages with a null or odd URL stand under an empty
host, each with its URL as path; a null page_id sorts last. Repeated rows give repeated rows. A
host whose pages are all alike has no neighbours and loses nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.llm.common import with_position
from stratiscore.sources.staging import Workspace

_ROWS_IN_MEMORY = 1 << 29  # bits of alignment rows kept at once
_AGREEING_PAGES = 20  # different pages that a host needs to tell the template of declared articles

# Fixed values of HTML: elements without content of their own, and elements that begin a block.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements that are not the article, and words in class, id or role that say the same.
_DROPPED = frozenset(
    "aside button canvas datalist dialog footer form head iframe input label math menu nav noscript "
    "object option script select style svg template textarea title".split()
)
_DROPPED_WORDS = frozenset(
    "ad ads adv advert advertisement alert banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies dialog disqus footer form header masthead menu "
    "modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo "
    "promoted related replies reply respond search share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split()
)
# Of these, elements that hold articles of others.
_FOREIGN_WORDS = frozenset(
    "comment comments disqus promoted related replies reply respond sponsored".split()
)
# Words of a name that say nothing after one of the words above; that turn it into a state of a
# wrapper; and whose header is a title.
_NEUTRAL_WORDS = frozenset(
    "area author bar block body bottom box button buttons container content group icon icons inner "
    "item items label left link links list main media meta outer panel placeholder posts primary "
    "right row secondary section signup slot text title top trail unit widgets wrap wrapper "
    "zone".split()
)
_STATE_WORDS = frozenset("has hide is no not show with without".split())
_TITLED_WORDS = frozenset("article blog content entry news page post section story".split())
_ARTICLE = frozenset(("article", "main"))
_BY_NAME, _FOR_GOOD = 1, 2  # how an element is dropped
_DECLARED, _RESCUED = 1, 2  # kinds of articles
_SPACES = re.compile(r"\s+")
_PARTS = re.compile(r"[^a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# An open element of the first kind ends where one of the second kind begins.
_ENDED_BY = {
    "p": _BLOCK,
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "tbody", "tfoot")),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
    "option": frozenset(("option",)),
}


def _dropped_word(name: str, inside: int) -> str | None:
    """The word of one class name, id or role that says that its element is not the article."""
    parts = [p for p in _PARTS.split(name.lower()) if p and not p[0].isdigit()]
    if not _STATE_WORDS.isdisjoint(parts):
        return None
    while parts and parts[-1] in _NEUTRAL_WORDS:
        parts.pop()
    if not parts or parts[-1] not in _DROPPED_WORDS:
        return None
    if parts[-1] == "header" and (inside or not _TITLED_WORDS.isdisjoint(parts)):
        return None
    return parts[-1]


class _Blocks(HTMLParser):
    """Collects (line, kind of the article it is in or 0)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self._open: list[tuple[str, int, int]] = []  # tag, dropped so far, in an article so far
        self._text: list[str] = []

    def _flush(self) -> None:
        if self._text:
            line = _SPACES.sub(" ", "".join(self._text)).strip()
            self._text = []
            if line:
                self.lines.append((line, self._state()[1]))

    def _state(self) -> tuple[int, int]:
        return self._open[-1][1:] if self._open else (0, 0)

    def _dropped(self, tag: str, attrs: list[tuple[str, str | None]], inside: int) -> int:
        if tag in _DROPPED or (tag == "header" and not inside):
            return _FOR_GOOD
        found = 0
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return _FOR_GOOD
            if value and name == "style" and _HIDDEN.search(value):
                return _FOR_GOOD
            if value and name in ("class", "id", "role") and tag not in ("html", "body"):
                words = {_dropped_word(x, inside) for x in value.split()} - {None}
                if tag in _ARTICLE:
                    if name != "role" and words & {"comment", "comments", "reply", "ad", "ads"}:
                        return _FOR_GOOD
                elif words and (name == "role" or inside or words & _FOREIGN_WORDS):
                    return _FOR_GOOD
                elif words:
                    found = _BY_NAME
        return found

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._flush()
        elif tag == "br":
            self._text.append(" ")
        if tag in _VOID:
            return
        if self._open and tag in _ENDED_BY.get(self._open[-1][0], ()):
            self._open.pop()
        elif tag == "p":
            self._close_paragraph()
        dropped, inside = self._state()
        new = self._dropped(tag, attrs, inside)
        if tag in _ARTICLE and dropped == _BY_NAME and not new:
            dropped, inside = 0, _RESCUED
        dropped = max(dropped, new)
        if dropped:
            inside = 0
        elif not inside and tag in _ARTICLE:
            inside = _DECLARED
        self._open.append((tag, dropped, inside))

    def _close_paragraph(self) -> None:
        """A new paragraph also ends one that only inline elements, left open, keep open."""
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == "p":
                del self._open[i:]
                return
            if self._open[i][0] in _BLOCK:
                return

    def handle_startendtag(self, tag, attrs):
        if tag in _BLOCK:
            self._flush()
        elif tag == "br":
            self._text.append(" ")

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self._flush()
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                self._flush_if_state_changes(i)
                del self._open[i:]
                return

    def _flush_if_state_changes(self, i: int) -> None:
        before = self._open[i - 1][1:] if i else (0, 0)
        if before != self._state():
            self._flush()

    def handle_data(self, data):
        if not self._state()[0]:
            self._text.append(data)

    def close(self):
        super().close()
        self._flush()


def text_lines(html: str | None) -> tuple[list[str], bool]:
    """Lines of a page, and whether they are those of its declared article."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    kinds: dict[int, list[str]] = {0: [], _DECLARED: [], _RESCUED: []}
    for line, inside in parser.lines:
        kinds[inside].append(line)
    plain, declared, rescued = kinds.values()
    if declared:
        return declared, True
    if sum(map(len, rescued)) > sum(map(len, plain)):
        return rescued, True
    return plain, False


def _place(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").removeprefix("www.").removeprefix("m.")
    except ValueError:
        return "", url or ""
    return (host, parts.path) if host else ("", url or "")


# --- alignment --------------------------------------------------------------------------------


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Bit-parallel alignment rows: bit j of row i is 0 where the length grows at b[j]."""
    places: dict[int, int] = {}
    for j, value in enumerate(b):
        places[value] = places.get(value, 0) | (1 << j)
    full = (1 << len(b)) - 1
    row = full
    for value in a:
        taken = row & places.get(value, 0)
        row = ((row + taken) | (row - taken)) & full
        yield row


def _lengths(row: int, n: int) -> list[int]:
    """Common length with each prefix of b, from the last row."""
    out, total = [0], 0
    for bit in bin(row | (1 << n))[:2:-1]:
        total += bit == "0"
        out.append(total)
    return out


def common_lines(a: list[int], b: list[int], in_memory: int = _ROWS_IN_MEMORY) -> list[int]:
    """Places in ``a`` of one longest common subsequence with ``b``."""
    if not a or not b:
        return []
    lead = 0
    while lead < min(len(a), len(b)) and a[lead] == b[lead]:
        lead += 1
    trail = 0
    while trail < min(len(a), len(b)) - lead and a[-1 - trail] == b[-1 - trail]:
        trail += 1
    head, tail = list(range(lead)), list(range(len(a) - trail, len(a)))
    a, b = a[lead : len(a) - trail], b[lead : len(b) - trail]
    if not a or not b:
        return head + tail
    if len(a) * len(b) > in_memory and len(a) > 1:  # halve a, cut b where the lengths add up best
        half = len(a) // 2
        *_, down = _rows(a[:half], b)
        *_, up = _rows(a[half:][::-1], b[::-1])
        before, after = _lengths(down, len(b)), _lengths(up, len(b))[::-1]
        cut = max(range(len(b) + 1), key=lambda j: before[j] + after[j])
        first = common_lines(a[:half], b[:cut], in_memory)
        second = common_lines(a[half:], b[cut:], in_memory)
        middle = first + [half + i for i in second]
    else:
        rows = list(_rows(a, b))
        i, j, middle = len(a), len(b), []
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                middle.append(i)
                j -= 1
        middle.reverse()
    return head + [lead + i for i in middle] + tail


# --- Spark ------------------------------------------------------------------------------------

_LINES = pa.schema(
    [
        ("host", pa.string()),
        ("path", pa.string()),
        ("declared", pa.bool_()),
        ("lines", pa.list_(pa.string())),
        ("hashes", pa.list_(pa.int64())),
    ]
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        urls = batch.column("url").to_pylist()
        for url, html in zip(urls, batch.column("html").to_pylist()):
            lines, declared = text_lines(html)
            hashes = [xxhash.xxh64_intdigest(x) - (1 << 63) for x in lines]
            rows.append((*_place(url), declared, lines, hashes))
        new = [pa.array(c, t) for c, t in zip(zip(*rows), _LINES.types)]
        if not rows:
            new = [pa.array([], t) for t in _LINES.types]
        kept = [batch.column("page_id"), batch.column("url")]
        names = ["page_id", "url", *_LINES.names]
        yield pa.RecordBatch.from_arrays([*kept, *new], names=names)


_SHARED = pa.schema(
    [
        ("host", pa.string()),
        ("declared", pa.bool_()),
        ("copies", pa.int64()),
        ("shared", pa.list_(pa.int32())),
        ("template", pa.list_(pa.int64())),
    ]
)


def _common_directories(a: str, b: str) -> int:
    pairs = zip(a.split("/")[:-1], b.split("/")[:-1])
    return next((i for i, (x, y) in enumerate(pairs) if x != y), min(a.count("/"), b.count("/")))


def template_lines(path: str, lines: list, neighbours: list[tuple[str, list]]) -> list[int]:
    """Places of the lines of a page that its nearest neighbours share, each aligned by itself."""
    nearness = [_common_directories(path, other) for other, _ in neighbours]
    nearest = [n for n, near in zip(neighbours, nearness) if near == max(nearness)]
    shared = [set(common_lines(lines, others)) for _, others in nearest]
    told = [s for s in shared if s]
    return sorted(set.intersection(*told)) if told else []


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page: the lines shared with its neighbours in the order of paths."""
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            group = row["host"], row["declared"]
            sides = [n for n in (row["before"], row["after"]) if n]
            near = [(n["path"], n["hashes"]) for n in sides if (n["host"], n["declared"]) == group]
            shared = template_lines(row["path"], row["hashes"], near)
            if shared:
                template = [row["hashes"][i] for i in shared]
                found.append((*group, row["copies"], shared, template))
        columns = list(zip(*found)) or [()] * len(_SHARED)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _SHARED)], schema=_SHARED
        )


def _agreed(workspace: Workspace, marked: DataFrame, different: DataFrame) -> DataFrame:
    """Template of declared articles that all different pages of their host have in common.

    ``marked`` has the template of each such page, ``different`` the pages themselves.
    """
    pages = different.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    pages = pages.filter(f"n_pages >= {_AGREEING_PAGES}")
    lines = marked.select("host", F.explode(F.array_distinct("template")).alias("line"))
    common = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).join(pages, "host")
    common = common.filter("n = n_pages").select("host", "line")
    places = marked.select(
        "host", "declared", "copies", F.explode(F.arrays_zip("shared", "template")).alias("at")
    ).select("host", "declared", "copies", "at.shared", F.col("at.template").alias("line"))
    joined = workspace.small(common, "agreed-lines").attach(places, ["host", "line"], "inner")
    return joined.groupBy("host", "declared", "copies").agg(
        F.collect_list("shared").alias("shared")
    )


def extract(workspace: Workspace, pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    kind = dict(pages.dtypes)["page_id"]
    schema = (
        f"page_id {kind}, url string, host string, path string, declared boolean, "
        "lines array<string>, hashes array<long>"
    )
    parsed = pages.select("page_id", "url", "html").mapInArrow(_parse, schema)
    path = workspace.path("lines")
    # Pages of one host with equal lines are copies; pages without lines have none.
    numbered = parsed.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "copies", F.when(F.size("hashes") > 0, F.xxhash64("hashes"))
    )
    numbered.write.option("compression", "zstd").parquet(path)
    table = workspace.spark.read.schema(numbered.schema).parquet(path)
    group = ["host", "declared", "copies"]
    first = F.min(F.struct("path", "url", "page_id", "row", "hashes")).alias("first")
    different = table.filter("copies is not null").groupBy(*group).agg(first)
    order = ["host", "declared", "path", "url", "page_id", "row"]
    placed = with_position(
        workspace, different.select(*group, "first.*"), [F.col(c) for c in order], "paths"
    )
    near = placed.select(
        "position", F.struct("host", "declared", "path", "hashes").alias("near")
    )
    before = near.select((F.col("position") + 1).alias("position"), F.col("near").alias("before"))
    after = near.select((F.col("position") - 1).alias("position"), F.col("near").alias("after"))
    neighbours = (
        placed.select("position", *group, "path", "hashes")
        .join(before, "position", "left")
        .join(after, "position", "left")
        .drop("position")
    )
    marks = neighbours.mapInArrow(
        _difference,
        "host string, declared boolean, copies long, shared array<int>, template array<long>",
    )
    marks = workspace.stage(marks, "template")
    agreed = _agreed(workspace, marks.filter("declared"), placed.filter("declared"))
    shared = marks.filter("not declared").select(*group, "shared").unionByName(agreed)
    deletions = workspace.small(shared, "shared-lines")
    joined = deletions.attach(table.select("page_id", "url", "lines", *group), group)
    left = F.expr(
        "if(shared is null, lines, filter(lines, (x, i) -> not array_contains(shared, i)))"
    )
    size = "aggregate({}, 0L, (n, x) -> n + length(x))"
    kept = F.expr(
        f"if(declared and shared is not null and 2 * {size.format('remaining')} < {size.format('lines')}, "
        "lines, remaining)"
    )
    text = F.array_join(kept, "\n\n").alias("text")
    rows = joined.withColumn("remaining", left).select("page_id", "url", text)
    return rows.withColumn("n_chars", F.length("text").cast("long"))
