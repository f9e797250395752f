"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into segments, and windows overlap the cuts: a verbatim excerpt of at least
``SEGMENT_CHARS`` characters, from whatever place in an item, holds all of one window but what its
budget allows to miss. If a segment or window of length n occurs in a text with at most e
edits, at least n - q + 1 - q * e of its q-grams occur there too, all within e + 1 neighbouring
diagonals (place in the text minus place in the segment). Shared q-grams are therefore counted in
overlapping diagonal bands: bands twice as wide as needed begin at every multiple of the needed
width, so that one of them holds the whole match. Bands that reach the bound are verified by a
banded alignment of the segment with that region of the text.

The q-grams of an item are kept once; those found in a text are dealt to all segments around them.

Texts are compared in lower case with single spaces. The benchmark is read in blocks of bounded
size. Each block goes to all tasks, is one pass over the documents whose few results are staged, and
is dropped before the next one is made: a benchmark of any size costs passes, not memory. Documents
are never shuffled. A segment's budget is a share of its length, at most what keeps its bound positive.

Nulls: null texts and items are empty; items shorter than q characters have no q-grams and are not
searched. Ids may have any type; null ids are carried. Repeated documents give repeated rows; a repeated row of the benchmark
counts once, and equal items are found each under its own id. ``segments`` and ``edits`` add up over
the segments and windows found, which overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.sources.staging import Workspace

Q = 8
EDIT_SHARE = 0.1
SEGMENT_CHARS = 120
BLOCK_CHARS = 4_000_000
_BASE = 0x9E3779B97F4A7C15
_FILTER_BITS = 22
_PIECE = 1 << 16  # characters of a text whose q-grams are looked up at once


def normalized(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def segments(text: str, size: int) -> list[tuple[int, str]]:
    """Equal parts of at least ``size`` characters, or the whole of a shorter text."""
    n = max(1, len(text) // size)
    cuts = [len(text) * i // n for i in range(n + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def window_starts(length: int, size: int, most: int) -> list[int]:
    """Where windows of ``size`` characters begin, so that every place is near one.

    No place is further from a begin than ``most`` edits, or a tenth of a window for the sake of
    their number.
    """
    if length < size:
        return []
    stride = max(1, size // 10, 2 * most)
    return [*range(0, length - size, stride), length - size]


def budget(length: int, q: int, share: float) -> int:
    """Edits allowed in a segment; its least number of shared q-grams stays positive."""
    return max(0, min(int(length * share), (length - q) // q))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, joined from those of runs of 1, 2, 4 ... characters."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run, size, rest = codes.astype(np.uint64) + np.uint64(1), 1, q
    hashes, width = np.zeros(n, np.uint64), 0
    while True:
        scale = np.uint64(pow(_BASE, size, 1 << 64))
        if rest & 1:
            hashes = hashes * scale + run[width : width + n]
            width += size
        rest >>= 1
        if not rest:
            return hashes ^ (hashes >> np.uint64(29))
        run = run[:-size] * scale + run[size:]
        size *= 2


@dataclass
class Index:
    """The q-grams of a block of benchmark items, and their segments, then their windows.

    Places are those in all items of the block, one behind the other.
    """

    items: list  # of each segment
    texts: list[str]
    budgets: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    n_cut: int  # segments; windows of ``size`` characters follow
    size: int
    longest: int
    least: np.ndarray  # lowest bound of a segment of each item
    hashes: np.ndarray  # distinct, ascending; those of one hash stand at first, first + count
    first: np.ndarray
    count: np.ndarray
    item: np.ndarray
    place: np.ndarray
    filled: np.ndarray
    q: int


def build_index(items: list[tuple], q: int, share: float, size: int) -> Index:
    cut, windows, grams, offsets, offset = [], [], [], [], 0
    for number, (item_id, text) in enumerate(items):
        text = normalized(text)
        parts = [(a, part) for a, part in segments(text, size) if len(part) >= q]
        known = {(a, len(part)) for a, part in parts}
        cut += [(number, item_id, offset + a, part) for a, part in parts]
        for a in window_starts(len(text), size, budget(size, q, share)) if parts else []:
            if (a, size) not in known:
                windows.append((number, item_id, offset + a, text[a : a + size]))
        grams.append(gram_hashes(_codes(text), q) if parts else np.zeros(0, np.uint64))
        offsets.append(offset)
        offset += len(text)
    every = cut + windows
    texts = [part for *_, part in every]
    lengths = np.array([len(t) for t in texts], np.int64)
    budgets = np.array([budget(n, q, share) for n in lengths], np.int64)
    bounds = lengths - q + 1 - q * budgets
    least = np.full(len(items), np.iinfo(np.int64).max)
    np.minimum.at(least, np.array([number for number, *_ in every], np.int64), bounds)
    hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
    place = np.concatenate([o + np.arange(len(g)) for o, g in zip(offsets, grams)] or [item])
    order = np.argsort(hashes, kind="stable")
    filled = np.zeros(1 << _FILTER_BITS, bool)
    filled[_slot(hashes)] = True
    distinct, first, count = np.unique(hashes[order], return_index=True, return_counts=True)
    starts = np.array([start for _, _, start, _ in every], np.int64)
    return Index(
        [item_id for _, item_id, _, _ in every], texts, budgets, bounds, starts, len(cut), size,
        int(lengths.max(initial=0)), least, distinct, first, count, item[order].astype(np.int64), place[order].astype(np.int64),
        filled, q,
    )


def _around(place: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(which place, segment) of all segments and windows that hold the q-grams at the places."""
    cut, windows = index.starts[: index.n_cut], index.starts[index.n_cut :]
    inside = np.searchsorted(cut, place, "right") - 1
    ends = cut[inside] + index.bounds[inside] + index.q * index.budgets[inside]
    which = np.flatnonzero(place < ends)
    low = np.searchsorted(windows, place - (index.size - index.q), "left")
    n = np.searchsorted(windows, place, "right") - low
    n = np.maximum(n, 0)
    more = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n)
    return (
        np.concatenate([which, np.repeat(np.arange(len(place)), n)]),
        np.concatenate([inside[which], index.n_cut + more]),
    )


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _FILTER_BITS)


def regions(codes: np.ndarray, index: Index) -> list[tuple[int, int, int]]:
    """(segment, first diagonal, last diagonal) of the bands that reach the bound."""
    hashes = gram_hashes(codes, index.q)
    at = np.flatnonzero(index.filled[_slot(hashes)])
    if not len(at):
        return []
    found = np.minimum(np.searchsorted(index.hashes, hashes[at]), len(index.hashes) - 1)
    real = index.hashes[found] == hashes[at]
    at, found = at[real], found[real]
    if not len(at):
        return []
    low, counts = index.first[found], index.count[found]
    offsets = np.cumsum(counts) - counts
    hit = np.arange(counts.sum()) - np.repeat(offsets - low, counts)
    item, place, at = index.item[hit], index.place[hit], np.repeat(at, counts)
    # An item and a segment need as many shared q-grams in the whole text, too.
    some = (np.bincount(item, minlength=len(index.least)) >= index.least)[item]
    if not some.any():
        return []
    place, at = place[some], at[some]
    which, segment = _around(place, index)
    some = (np.bincount(segment, minlength=len(index.bounds)) >= index.bounds)[segment]
    which, segment = which[some], segment[some]
    place = place[which] - index.starts[segment]
    diagonal = at[which] - place
    if not len(segment):
        return []
    width = index.budgets[segment] + 1
    band = diagonal // width  # each diagonal lies in the band that begins at it and the one before
    segment, place = np.tile(segment, 2), np.tile(place, 2)
    band = np.concatenate([band, band - 1])
    spread = index.longest
    keys = (segment * (2 * len(codes) + 4 * spread) + band + 2 * spread) * spread + place
    keys = np.unique(keys) // spread  # a place of the segment counts once in a band
    bands, n = np.unique(keys, return_counts=True)
    segment, band = np.divmod(bands, 2 * len(codes) + 4 * spread)
    good = n >= index.bounds[segment]
    found = []
    for s, b in zip(segment[good].tolist(), (band[good] - 2 * spread).tolist()):
        width = int(index.budgets[s]) + 1
        found.append((s, b * width, (b + 2) * width - 1))
    return found


def _all_regions(codes: np.ndarray, index: Index) -> Iterator[tuple[int, int, int]]:
    """Regions of a text of any length, by pieces that overlap by the longest possible match."""
    reach = index.longest + int(index.budgets.max())
    for at in range(0, max(1, len(codes) - reach), _PIECE):
        for segment, first, last in regions(codes[at : at + _PIECE + reach], index):
            yield segment, first + at, last + at


def align(segment: np.ndarray, text: np.ndarray, first: int, last: int, limit: int) -> tuple | None:
    """Fewest edits that turn the segment into part of the text within the diagonals.

    Returns (edits, end in the text), or None beyond the limit. Cell k of row i stands for the
    text place i + first + k; a path may begin and end anywhere in the band.
    """
    width = last - first + 1
    steps = np.arange(width)
    far = limit + 1
    padded = np.full(len(segment) + width + 1, -1, np.int64)
    lo, hi = max(0, first), min(len(text), first + len(padded))
    if hi > lo:
        padded[lo - first : hi - first] = text[lo:hi]
    inside = (np.arange(len(padded) + 1) + first >= 0) & (np.arange(len(padded) + 1) + first <= len(text))
    row = np.where(inside[:width], 0, far)
    for i, code in enumerate(segment):
        same = row + (padded[i : i + width] != code)
        skip = np.append(row[1:], far) + 1  # a character of the segment is missing in the text
        row = np.minimum(same, skip)
        row = np.where(inside[i + 1 : i + 1 + width], row, far)
        row = np.minimum.accumulate(row - steps) + steps  # extra characters of the text
        if row.min() > limit:
            return None
    best = int(row.argmin())
    return (int(row[best]), len(segment) + first + best) if row[best] <= limit else None


def matches(text: str, index: Index) -> list[tuple]:
    """(segment, edits, end) of the segments found in a normalised text."""
    if len(text) < index.q or not index.texts:
        return []
    codes = _codes(text)
    best: dict[int, tuple[int, int]] = {}
    for segment, first, last in _all_regions(codes, index):
        part = index.texts[segment]
        limit = int(index.budgets[segment])
        if segment in best and best[segment][0] == 0:
            continue
        at = text.find(part, max(0, first), max(0, last + 1 + len(part)))
        if at >= 0:  # the alignment without edits
            best[segment] = (0, at + len(part))
            continue
        found = align(_codes(part).astype(np.int64), codes, first, last, limit)
        if found and (segment not in best or found < best[segment]):
            best[segment] = found
    return [(s, *found) for s, found in sorted(best.items())]


def _search(broadcast, schema: pa.Schema):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = broadcast.value
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("text")):
                by_item: dict = {}
                for segment, edits, end in matches(normalized(text.as_py()), index):
                    by_item.setdefault(index.items[segment], []).append((edits, end))
                for item, hits in by_item.items():
                    rows.append(row)
                    found.append((item, len(hits), sum(e for e, _ in hits), min(end for _, end in hits)))
            columns = list(zip(*found)) or [()] * (len(schema) - 1)
            arrays = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
            arrays += [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return search


def _found(texts: pa.Array, index: Index) -> pa.Array:
    return pa.array([bool(matches(normalized(t.as_py()), index)) for t in texts], pa.bool_())


def _clean(broadcast):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pc.invert(_found(batch.column("text"), broadcast.value)))

    return clean


def _hits(broadcast):
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(_found(batch.column("text"), broadcast.value)).select(["row_id"])

    return hits


class _Benchmark:
    """The items of a benchmark, in blocks of bounded size."""

    def __init__(self, benchmark: DataFrame, q: int, share: float, size: int, block_chars: int):
        self.spark = benchmark.sparkSession
        self.items = benchmark.select("item_id", "text").distinct()
        self.options = (q, share, size)
        total = self.items.agg(F.sum(F.length("text"))).first()[0] or 0
        self.n_blocks = max(1, -(-total // block_chars))

    def shared(self, block: int):
        """The index of one block, sent to all tasks."""
        number = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n_blocks))
        rows = self.items.filter(number == block).orderBy("item_id", "text").collect()  # a bounded block
        index = build_index([tuple(r) for r in rows], *self.options)
        return self.spark.sparkContext.broadcast(index)

    def one_by_one(self) -> Iterator:
        """The index of each block, dropped when the next one is asked for."""
        for block in range(self.n_blocks):
            index = self.shared(block)
            try:
                yield index
            finally:
                index.destroy()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    q: int = Q,
    edit_share: float = EDIT_SHARE,
    segment_chars: int = SEGMENT_CHARS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """doc_id, item_id, segments, edits, first_end: one row per document and item found in it."""
    workspace = Workspace(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    ids = [(df, df.schema[name].dataType.simpleString(), name) for df, name in ((docs, "doc_id"), (benchmark, "item_id"))]
    schema = ", ".join(f"{name} {kind}" for _, kind, name in ids) + ", segments long, edits long, first_end long"
    fields = [df.select(name).limit(0).toArrow().schema.field(0) for df, _, name in ids]
    fields += [(name, pa.int64()) for name in ("segments", "edits", "first_end")]
    blocks = _Benchmark(benchmark, q, edit_share, segment_chars, block_chars)
    found = [
        workspace.stage(rows.mapInArrow(_search(index, pa.schema(fields)), schema), "found")
        for index in blocks.one_by_one()
    ]
    return reduce(DataFrame.union, found)


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    q: int = Q,
    edit_share: float = EDIT_SHARE,
    segment_chars: int = SEGMENT_CHARS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents in which no item is found, with all their columns.

    One block filters them in the pass that reads them. Several blocks look at numbered rows, one
    after the other, and the rows found by any of them are taken out in the end.
    """
    blocks = _Benchmark(benchmark, q, edit_share, segment_chars, block_chars)
    if blocks.n_blocks == 1:
        return docs.mapInArrow(_clean(blocks.shared(0)), docs.schema)
    workspace = Workspace(docs.sparkSession)
    number = F.monotonically_increasing_id().alias("row_id")
    numbered = workspace.stage(docs.select(F.struct(*docs.columns).alias("row"), number), "numbered")
    texts = numbered.select("row_id", F.col("row.text").alias("text"))
    hits = [
        workspace.stage(texts.mapInArrow(_hits(index), "row_id long"), "hits")
        for index in blocks.one_by_one()
    ]
    gone = workspace.small(reduce(DataFrame.union, hits).distinct(), "contaminated-rows")
    return gone.attach(numbered, ["row_id"], "left_anti").select("row.*")
