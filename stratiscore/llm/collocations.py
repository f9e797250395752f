"""Collocations from lossless phrase counts in counting quotient filters.

1. Texts become chunks of word numbers, each chunk with its own short vocabulary; a long text goes
   on in the next chunk behind its last two words.
2. Vocabularies are dealt by word and counted together, a compressed row for each chunk and part of
   the words. Words frequent enough for a candidate get an id; all parts of a frequent phrase are
   frequent. Each chunk gets the ids of its own words back, so no vocabulary of the corpus is sent
   to all tasks.
3. The ids of a phrase are packed into one number, which a Feistel network permutes invertibly. The
   leading bits, its quotient, say which shard counts it; a filter holds the permuted numbers sorted,
   as gaps, with counts. Nothing is hashed away, so every count is exact and every phrase comes
   back from its filter. Filters of chunks meet by quotient and are merged as sorted runs.
4. Phrases that reach the least count are scored by joins of their parts.

Every chunk sends a row to every part and shard, so chunks and shards are large: their rows stay
long while the corpus grows, and the fixed cost of a row stays small.

Numbers use just the bits of the largest id, three times at most: up to 2^32 ids.

Words are those of the contract, A-Z in lower case, by language; a null language is ``und``, a
null text is empty. Repeated rows count as often as they stand there. Other columns than lang and
text are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiscore.llm.common import byte_values, pieces
from stratiscore.sources.staging import Workspace

MIN_COUNT = 10
COVERED_PERCENT = 50
TOP = 2000
LONGEST = 3
CHUNK_WORDS = 1 << 21
SHARD_PHRASES = 1 << 22  # phrases, repeats included, that a shard of the filters counts
_TEXT_PIECE = 1 << 18
_SEGMENT = 1 << 20  # bytes of text that are split into words at once
_SALTS = 64

# A-Z in lower case, every separator a full stop, a tab a space.
_FOLDED = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz......... "
)
_SPACE, _STOP = ord(" "), ord(".")


# --- numbers as bytes ----------------------------------------------------------------------------


def packed_bytes(*columns: np.ndarray, tail: bytes = b"") -> bytes:
    """Columns of equal length by byte planes, as many as the largest number needs, compressed."""
    widths, planes = [], []
    for values in columns:
        width = -(-int(values.max(initial=0)).bit_length() // 8)
        widths.append(width)
        planes.append(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    body = b"".join(planes) + tail
    return bytes(widths) + len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def unpacked_bytes(data: bytes, n: int, columns: int) -> tuple[list[np.ndarray], bytes]:
    """The columns of ``n`` numbers, and the tail."""
    size = int.from_bytes(data[columns : columns + 8], "little")
    body = pa.decompress(data[columns + 8 :], decompressed_size=size, codec="zstd", asbytes=True)
    out, at = [], 0
    for width in data[:columns]:
        planes = np.zeros((n, 8), np.uint8)
        planes[:, :width] = np.frombuffer(body, np.uint8, width * n, at).reshape(width, n).T
        out.append(planes.reshape(-1).view("<u8"))
        at += width * n
    return out, body[at:]


def _mixed(x: np.ndarray, turn: int, bits: int) -> np.ndarray:
    """``bits`` pseudo-random bits of each number."""
    start = (turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    x = (x + np.uint64(start)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x >> np.uint64(64 - bits)


# --- words ---------------------------------------------------------------------------------------


def split_words(data: bytes) -> tuple[pa.Array, np.ndarray]:
    """Words in lower case; and of each word, and of the end, whether separators stand before it."""
    found = np.frombuffer(data.translate(_FOLDED), np.uint8)
    stops = found == _STOP
    inside = np.zeros(len(found) + 2, bool)
    np.logical_not(stops | (found == _SPACE), out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    words = _byte_strings(ends - starts, found[inside[1:-1]])
    breaks = np.zeros(len(starts) + 1, bool)
    breaks[np.searchsorted(starts, np.flatnonzero(stops))] = True
    return words, breaks


def _byte_strings(lengths: np.ndarray, data) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _lengths_and_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of byte strings without nulls: their lengths, and all bytes one after the other."""
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1]
    return np.diff(offsets), np.frombuffer(strings.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]


def part_of(keys: pa.Array, parts: int) -> np.ndarray:
    """The part of each key, by a hash of its bytes."""
    if not len(keys):
        return np.zeros(0, np.int64)
    lengths, data = _lengths_and_bytes(keys)
    starts = np.cumsum(lengths) - lengths
    places = np.arange(len(data)) - np.repeat(starts, lengths)
    weights = _mixed(np.arange(256, dtype=np.uint64), 0, 64)[places & 255] | np.uint64(1)
    sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * weights, starts)
    return (_mixed(sums, 1, 32) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _last_words(data: bytes) -> bytes:
    """The last words of a text that a phrase behind it can begin with, and the stops among them."""
    folded = data.translate(_FOLDED).replace(b".", b" . ")
    return b" ".join(folded.rsplit(None, LONGEST - 1)[1 - LONGEST :])


_ENTRIES = pa.struct([("part", pa.int32()), ("entries", pa.int32()), ("data", pa.binary())])
_TOTAL = pa.struct([("lang", pa.string()), ("n", pa.int64())])
_CHUNK = pa.schema(
    [("chunk", pa.int64()), ("vocabulary", pa.list_(_ENTRIES)), ("totals", pa.list_(_TOTAL)),
     ("length", pa.int32()), ("sequence", pa.binary()), ("fresh", pa.int32())]
)
_CHUNK_NAMES = (
    "chunk long, vocabulary array<struct<part: int, entries: int, data: binary>>, "
    "totals array<struct<lang: string, n: long>>, length int, sequence binary, fresh int"
)


class _Chunk:
    """Neighbouring texts by language. ``before`` are words that an earlier chunk has counted."""

    def __init__(self, segment: int, lang: str | None = None, before: bytes = b""):
        self.segment = segment
        self.waiting: dict[str, list[bytes]] = {}
        self.n_waiting = self.n_words = 0
        self.segments: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
        self.before = bool(before)
        if before:
            self.segments[lang] = [split_words(before)]

    def add(self, lang: str, data: bytes) -> None:
        self.waiting.setdefault(lang, []).append(data)
        self.n_waiting += len(data)
        if self.n_waiting >= self.segment:
            self.split()

    def split(self) -> None:
        for lang, data in self.waiting.items():
            words, breaks = split_words(b"".join(data))
            self.segments.setdefault(lang, []).append((words, breaks))
            self.n_words += len(words)
        self.waiting, self.n_waiting = {}, 0

    def row(self, number: int, parts: int) -> pa.RecordBatch:
        self.split()
        sequences, keys, counts, totals = [], [], [], []
        first, fresh = 1, 0
        for at, (lang, segments) in enumerate(self.segments.items()):
            encoded = pa.chunked_array([words for words, _ in segments]).combine_chunks().dictionary_encode()
            codes, n = encoded.indices.to_numpy(), len(encoded)
            breaks, start = np.zeros(n + 1, bool), 0
            for words, some in segments:
                breaks[start : start + len(some)] |= some
                start += len(words)
            breaks[n] = True
            places = np.arange(n) + np.cumsum(breaks[:n])
            sequence = np.zeros(n + np.count_nonzero(breaks), np.int32)
            sequence[places] = codes + first
            known = len(segments[0][0]) if self.before and not at else 0
            if self.before and not at:
                fresh = int(places[known]) if known < n else len(sequence)
            sequences.append(sequence)
            keys.append(
                pa.compute.binary_join_element_wise(
                    encoded.dictionary, pa.scalar(lang.encode(), pa.binary()), pa.scalar(b" ", pa.binary())
                )
            )
            counts.append(np.bincount(codes[known:], minlength=len(encoded.dictionary)))
            totals.append({"lang": lang, "n": n - known})
            first += len(encoded.dictionary)
        sequence = np.concatenate(sequences)
        columns = [
            pa.array([number]),
            pa.array([_dealt(pa.concat_arrays(keys), np.concatenate(counts), parts)], pa.list_(_ENTRIES)),
            pa.array([totals], pa.list_(_TOTAL)),
            pa.array([len(sequence)], pa.int32()),
            pa.array([packed_bytes(sequence)], pa.binary()),
            pa.array([fresh], pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_CHUNK)


def _dealt(keys: pa.Array, counts: np.ndarray, parts: int) -> list[dict]:
    """A vocabulary by parts: lengths, numbers as gaps, counts and bytes of the keys."""
    part = part_of(keys, parts)
    order = np.argsort(part, kind="stable")
    lengths, data = _lengths_and_bytes(keys.take(pa.array(order)))
    ends = np.cumsum(lengths)
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    rows = []
    for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            text = data[ends[a] - lengths[a] : ends[b - 1]].tobytes()
            gaps = np.diff(order[a:b] + 1, prepend=0)
            packed = packed_bytes(lengths[a:b], gaps, counts[order[a:b]], tail=text)
            rows.append({"part": number, "entries": int(b - a), "data": packed})
    return rows


def _chunks(size: int, parts: int):
    # A word and what ends it take two bytes: no segment has more words than a chunk should have.
    segment = min(_SEGMENT, 2 * size)
    piece_size = min(_TEXT_PIECE, segment)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(segment)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), byte_values(batch.column(1))):
                before = b""
                for piece in pieces(text, piece_size):
                    if chunk.n_words >= size:
                        yield chunk.row(number, parts)
                        number += 1
                        chunk = _Chunk(segment, lang, before)
                    chunk.add(lang, piece)
                    if len(piece) < len(text):
                        before = _last_words(before + piece)
                chunk.add(lang, b".")
        if chunk.waiting or chunk.n_words:
            yield chunk.row(number, parts)

    return run


# A part of the words: one row with its frequent words, and for each chunk one with their numbers.
_WORD = pa.struct([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("at", pa.int64())])
_PART = pa.schema(
    [("part", pa.int32()), ("words", pa.list_(_WORD)), ("owner", pa.int64()), ("entries", pa.int32()),
     ("data", pa.binary())]
)
_PART_NAMES = (
    "part int, words array<struct<lang: string, word: string, n: long, at: long>>, owner long, "
    "entries int, data binary"
)


def _count_part(least: int):
    """Of a part of all vocabularies: the words that reach the least count, and their places."""

    def run(table: pa.Table) -> pa.Table:
        entries = table.column("entries").to_numpy()
        read = [unpacked_bytes(d, n, 3) for n, d in zip(entries, table.column("data").to_pylist())]
        lengths, counts = (np.concatenate([columns[i] for columns, _ in read]) for i in (0, 2))
        keys = _byte_strings(lengths, b"".join(text for _, text in read)).dictionary_encode()
        codes = keys.indices.to_numpy()
        totals = np.zeros(len(keys.dictionary), np.int64)
        np.add.at(totals, codes, counts.astype(np.int64))
        frequent = np.flatnonzero(totals >= least)
        places = np.zeros(len(totals), np.int64)
        places[frequent] = np.arange(1, len(frequent) + 1)
        # A word holds no space, so the first one ends it.
        named = [key.split(b" ", 1) for key in keys.dictionary.take(pa.array(frequent)).to_pylist()]
        words = [
            {"lang": lang.decode(), "word": word.decode(), "n": n, "at": at}
            for at, ((word, lang), n) in enumerate(zip(named, totals[frequent].tolist()))
        ]
        part, found, start = table.column("part")[0].as_py(), [], 0
        for owner, n, (columns, _) in zip(table.column("chunk").to_pylist(), entries, read):
            at = places[codes[start : start + n]]
            start += n
            kept = at > 0
            if kept.any():
                local = np.cumsum(columns[1])[kept]
                data = packed_bytes(np.diff(local, prepend=np.uint64(0)), at[kept] - 1)
                found.append((part, None, owner, len(local), data))
        columns = zip(*[(part, words, None, None, None), *found])
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _PART)], schema=_PART)

    return run


# --- filters -------------------------------------------------------------------------------------


class PackedPhrases:
    """Phrases of ``words`` ids of ``bits`` bits as permuted numbers, and back.

    A number is (high, low): its first 64 bits at most, and what is beyond them.
    """

    _ROUNDS = 4

    def __init__(self, words: int, bits: int):
        self.left, self.right = bits, bits * (words - 1)
        self.words, self.bits = words, bits
        self.beyond = max(self.left + self.right - 64, 0)
        self.high_bits = self.left + self.right - self.beyond

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        left, right = ids[0].astype(np.uint64), ids[1].astype(np.uint64)
        for column in ids[2:]:
            right = right << np.uint64(self.bits) | column.astype(np.uint64)
        for turn in range(self._ROUNDS):
            if turn % 2:
                right = right ^ _mixed(left, turn, self.right)
            else:
                left = left ^ _mixed(right, turn, self.left)
        beyond = np.uint64(self.beyond)
        high = left << np.uint64(self.right - self.beyond) | right >> beyond
        return high, right & ((np.uint64(1) << beyond) - np.uint64(1))

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        kept = np.uint64(self.right - self.beyond)
        left = high >> kept
        right = (high & ((np.uint64(1) << kept) - np.uint64(1))) << np.uint64(self.beyond) | low
        for turn in reversed(range(self._ROUNDS)):
            if turn % 2:
                right = right ^ _mixed(left, turn, self.right)
            else:
                left = left ^ _mixed(right, turn, self.left)
        mask, ids = (np.uint64(1) << np.uint64(self.bits)) - np.uint64(1), []
        for place in range(self.words - 2, -1, -1):
            ids.append(right >> np.uint64(self.bits * place) & mask)
        return [left, *ids]

    def shard_limits(self, shards: int) -> np.ndarray:
        """The least ``high`` of each shard but the first: equal ranges of quotients."""
        return np.array([(i << self.high_bits) // shards for i in range(1, shards)], np.uint64)


def _ordered(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in order. A few bits beyond 64 take the place of the leading ones, one value of those at a time."""
    beyond = int(low.max(initial=0)).bit_length()
    if not beyond:
        return np.sort(high), low
    if beyond > 6:
        order = np.lexsort((low, high))
        return high[order], low[order]
    shift, rest = np.uint64(beyond), np.uint64(64 - beyond)
    leading, highs, lows = high >> rest, [], []
    for lead in range(1 << beyond):
        some = leading == lead
        keys = np.sort(high[some] << shift | low[some])
        highs.append(keys >> shift | np.uint64(lead) << rest)
        lows.append(keys & ((np.uint64(1) << shift) - np.uint64(1)))
    return np.concatenate(highs), np.concatenate(lows)


def counted(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> tuple:
    """Distinct numbers in order with the sums of their counts."""
    if counts is None:
        high, low = _ordered(high, low)
        counts = np.ones(len(high), np.int64)
    else:
        order = np.lexsort((low, high)) if low.any() else np.argsort(high, kind="stable")
        high, low, counts = high[order], low[order], counts[order]
    new = np.ones(len(high), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return high, low, counts
    return high[first], low[first], np.add.reduceat(counts, first)


_FILTER = pa.schema(
    [("shard", pa.int32()), ("words", pa.int32()), ("entries", pa.int64()), ("data", pa.binary())]
)
_FILTER_NAMES = "shard int, words int, entries long, data binary"


def filter_rows(packed: PackedPhrases, high, low, counts, shards: int) -> list[tuple]:
    """A filter as one row for each shard that it has entries in."""
    cuts = [0, *np.searchsorted(high, packed.shard_limits(shards)), len(high)]
    rows = []
    for shard, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            gaps = np.diff(high[a:b], prepend=np.uint64(0))
            rows.append((shard, packed.words, int(b - a), packed_bytes(gaps, low[a:b], counts[a:b])))
    return rows


def read_filter(entries: int, data: bytes) -> tuple:
    (gaps, low, found), _ = unpacked_bytes(data, entries, 3)
    return np.cumsum(gaps, dtype=np.uint64), low, found.astype(np.int64)


def _count_chunk(bits: int, shards: int, parts: int):
    """Of a chunk and the places of its frequent words in their parts: its filters."""

    def run(chunk: pa.Table, places: pa.Table) -> pa.Table:
        rows = []
        names = ("length", "sequence", "fresh")
        for length, sequence, fresh in zip(*(chunk.column(n).to_pylist() for n in names)):
            (local,), _ = unpacked_bytes(sequence, length, 1)
            ids = np.zeros(int(local.max(initial=0)) + 1, np.uint32)
            for part, entries, data in zip(*(places.column(n).to_pylist() for n in ("part", "entries", "data"))):
                (gaps, at), _ = unpacked_bytes(data, entries, 2)
                ids[np.cumsum(gaps)] = _word_id(at, part, parts)
            found = ids[local]  # 0 for ends of pieces and rare words
            del local
            for words in range(2, LONGEST + 1):
                first = max(fresh - words + 1, 0)
                columns = [found[first + i : len(found) - words + 1 + i] for i in range(words)]
                whole = np.logical_and.reduce([c > 0 for c in columns])
                packed = PackedPhrases(words, bits)
                numbers = counted(*packed.pack([c[whole] for c in columns]))
                rows += filter_rows(packed, *numbers, shards)
        columns = list(zip(*rows)) or [[] for _ in _FILTER]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _FILTER)], schema=_FILTER)

    return run


def _word_id(at, part, parts: int):
    """From 1; ``at`` is the place of the word in its part. Numbers or columns."""
    return at * parts + part + 1


_PHRASE = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("w3", pa.int64()), ("a", pa.int64())])


def _merge_shard(bits: int, least: int):
    """Of the filters of a shard: phrases that reach the least count."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        for words in range(2, LONGEST + 1):
            part = table.filter(pa.compute.equal(table.column("words"), words))
            if not part.num_rows:
                continue
            filters = [read_filter(*row) for row in zip(*(part.column(n).to_pylist() for n in ("entries", "data")))]
            high, low, counts = counted(*(np.concatenate(c) for c in zip(*filters)))
            enough = counts >= least
            ids = PackedPhrases(words, bits).unpack(high[enough], low[enough])
            ids += [np.zeros_like(ids[0])] * (LONGEST - words)
            out.append([i.astype(np.int64) for i in ids] + [counts[enough]])
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.table([pa.array(c) for c in columns], schema=_PHRASE)

    return run


# --- phrases -------------------------------------------------------------------------------------


def phrase_counts(
    workspace: Workspace, docs: DataFrame, least: int = MIN_COUNT, chunk_words: int = CHUNK_WORDS,
    shard_phrases: int = SHARD_PHRASES, min_shards: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (id, lang, word, n), phrases (w1, w2, w3, a) that reach ``least``, and words per lang.

    ``w3`` is 0 in a phrase of two words. ``n`` and ``a`` are exact over all texts.
    """
    spark = workspace.spark
    floor = int(spark.conf.get("spark.sql.shuffle.partitions")) if min_shards is None else min_shards
    parts = max(1, floor)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    chunks = workspace.stage(texts.mapInArrow(_chunks(chunk_words, parts), _CHUNK_NAMES), "chunks")
    sums = chunks.select(F.inline("totals")).groupBy("lang").agg(F.sum("n").alias("total"))
    totals = workspace.stage(sums.filter("total > 0"), "totals")
    numbered = workspace.stage(
        chunks.select("chunk", F.inline("vocabulary"))
        .groupBy("part")
        .applyInArrow(_count_part(least), _PART_NAMES),
        "numbered",
    )
    frequent = numbered.filter("owner is null").select("part", F.inline("words"))
    word_id = _word_id(F.col("at"), F.col("part"), parts).alias("id")
    words = workspace.stage(frequent.select("lang", "word", "n", word_id), "ids")
    largest = words.agg(F.max("id")).first()[0] or 0
    if largest >> 32:
        raise ValueError(f"the largest id is {largest}, more than 32 bits number")
    bits = max(largest.bit_length(), 1)
    all_words = totals.agg(F.sum("total")).first()[0] or 0
    shards = max(1, floor, -(-all_words * (LONGEST - 1) // shard_phrases))
    returned = numbered.filter("owner is not null").select("owner", "part", "entries", "data")
    filters = (
        chunks.select("chunk", "length", "sequence", "fresh")
        .groupBy("chunk")
        .cogroup(returned.groupBy("owner"))
        .applyInArrow(_count_chunk(bits, shards, parts), _FILTER_NAMES)
    )
    phrases = filters.groupBy("shard").applyInArrow(
        _merge_shard(bits, least), "w1 long, w2 long, w3 long, a long"
    )
    return words, workspace.stage(phrases, "phrases"), totals


def _scored(words: DataFrame, phrases: DataFrame, covered_percent: int) -> DataFrame:
    """lang, w1, w2, w3, a, l, r, score of the candidates that no longer one covers."""
    pairs, triples = phrases.filter("w3 = 0").drop("w3"), phrases.filter("w3 > 0")

    def count_of(place: str, name: str) -> DataFrame:
        return words.select(F.col("id").alias(place), F.col("n").alias(name))

    def pair(first: str, second: str, name: str) -> DataFrame:
        return pairs.select(F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name))

    def score(left: str, right: str) -> str:
        # a below 10^15: the products then fit 38 digits
        square = "cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))"
        return f"({square}) div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0)))"

    sides = triples.select("w1", "w2", "a").union(triples.select("w2", "w3", "a"))
    longer = sides.groupBy("w1", "w2").agg(F.max("a").alias("_longer"))
    two = (
        pairs.join(longer, ["w1", "w2"], "left")
        .filter(f"_longer is null or 100 * _longer < {covered_percent} * a")
        .join(count_of("w1", "l"), "w1")
        .join(count_of("w2", "r"), "w2")
        .selectExpr("w1", "w2", "0L as w3", "a", "l", "r", f"{score('l', 'r')} as score")
    )
    cuts = f"array(struct({score('l1', 'r1')} as score, 1 as k, l1 as l, r1 as r), struct({score('l2', 'r2')} as score, 2 as k, l2 as l, r2 as r))"
    three = (
        triples.join(pair("w1", "w2", "l2"), ["w1", "w2"])
        .join(pair("w2", "w3", "r1"), ["w2", "w3"])
        .join(count_of("w1", "l1"), "w1")
        .join(count_of("w3", "r2"), "w3")
        .selectExpr("w1", "w2", "w3", "a", f"array_min({cuts}) as _cut")
        .selectExpr("w1", "w2", "w3", "a", "_cut.l", "_cut.r", "_cut.score")
    )
    langs = words.select(F.col("id").alias("w1"), "lang")
    return two.union(three).join(langs, "w1")


def _first_rows(df: DataFrame, order: list, limit: int) -> DataFrame:
    """The first rows of each language with their ``rank``; salted, so that none is one task's."""
    salt = F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(_SALTS))
    near = W.partitionBy("lang", "_salt").orderBy(*order)
    some = df.withColumn("_salt", salt).withColumn("rank", F.row_number().over(near))
    some = some.filter(F.col("rank") <= limit).drop("_salt", "rank")
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= limit)


def collocations(
    workspace: Workspace, docs: DataFrame, least: int = MIN_COUNT, top: int = TOP,
    covered_percent: int = COVERED_PERCENT, **sizes,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each language."""
    words, phrases, totals = phrase_counts(workspace, docs, least, **sizes)
    scored = workspace.stage(_scored(words, phrases, covered_percent), "scored")
    order = [F.desc("score"), F.desc("a")]
    last = _first_rows(scored, order, top).groupBy("lang").agg(
        F.min(F.struct("score", "a")).alias("_last")
    )
    # Ties of the last place go on to the order by phrase.
    near = workspace.small(last, "last").attach(scored, ["lang"]).filter(F.struct("score", "a") >= F.col("_last"))
    for place in ("w1", "w2", "w3"):
        side = words.select(F.col("id").alias(place), F.col("word").alias(f"_{place}"))
        near = near.join(side, place, "left")
    named = near.withColumn("phrase", F.concat_ws(" ", "_w1", "_w2", "_w3"))
    ranked = _first_rows(named, [*order, F.asc("phrase")], top)
    result = workspace.small(totals, "totals").attach(ranked, ["lang"])
    return result.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), "score",
    )
