"""Packing of documents into token windows by minimum bin slack.

Tokens of a document, and an end token, are cut into whole windows and one shorter rest. Rests
meet as a multiset of lengths, a histogram of at most ``window`` - 1 entries whatever the corpus
size. The longest length left opens a window, and a subset-sum over the lengths left, with a bit
for each reachable sum, finds the multiset that comes closest to the capacity; backtracking
gives the count of each length in it. The window is repeated as often as the counts last: a
closest filling stays the closest when the multiset shrinks. Each step at least halves the count
of one length, so windows of all sizes of corpora come as some thousand patterns.

Rests are numbered by length in one distributed order; the patterns say which numbers go where.

Equal texts are tokenised alike and packed as often as they stand there. A null or empty text is
its end token alone. Null ids are carried, repeated ids are separate documents, other columns are
left out, an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.llm.common import with_position
from stratiscore.sources.staging import Workspace

WINDOW = 2048
END_ID = 1
_BATCH_CHARS = 1 << 20  # characters of the texts whose pieces leave a task together

# What byte-level tokenizers split by, and how their JSON says that they do.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = {
    "normalizer": None,
    "truncation": None,
    "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
}


def tokenizer_file() -> str:
    """The byte-level vocabulary of the contract."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """A byte-level vocabulary by bytes; its alphabet shows bytes as visible characters.

    Visible characters of Latin-1 stand for their own byte, the others take the characters from
    256 on in turn.
    """
    visible = {b for b in range(256) if 33 <= b <= 126 or 161 <= b and b != 173}
    hidden = [b for b in range(256) if b not in visible]
    alphabet = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return {bytes(alphabet[c] for c in token): rank for token, rank in vocabulary.items()}


class Encoder:
    """Ids of whole texts by a tokenizer's JSON.

    A plain byte-level vocabulary, whose ids are its merge ranks, is also given to the library that
    is fastest at it. Texts which that one refuses (very long white space) and those that hold the
    name of an added token go to the tokenizer itself; the ids are the same.
    """

    def __init__(self, definition: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(definition)
        parts = json.loads(definition)
        self.added = [token["content"] for token in parts.get("added_tokens") or ()]
        self.ranked = None
        if parts["model"].get("merges") and all(parts.get(k) == v for k, v in _PLAIN.items()):
            import tiktoken

            self.ranked = tiktoken.Encoding(
                "corpus", pat_str=_PATTERN, special_tokens={},
                mergeable_ranks=byte_ranks(parts["model"]["vocab"]),
            )

    def encode(self, text: str) -> np.ndarray:
        if self.ranked is not None and not any(name in text for name in self.added):
            try:
                return self.ranked.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # its pattern gives up on a run of white space
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


_PIECE = pa.schema(
    [("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
)
_PIECE_NAMES = "start long, length int, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=1)
def _encoder(definition: bytes) -> Encoder:
    """One encoder for the tasks of a worker."""
    return Encoder(definition)


def _portions(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts of bounded size together, with the row of the first one."""
    first, portion, held = 0, [], 0
    for row, text in enumerate(texts):
        portion.append(text.as_py() or "")
        held += len(portion[-1])
        if held >= _BATCH_CHARS:
            yield first, portion
            first, portion, held = row + 1, [], 0
    if portion:
        yield first, portion


def _cut(definition: bytes, window: int, end_id: int, schema: pa.Schema, with_ids: bool):
    """Pieces of each document: whole windows, then the rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition)
        for batch in batches:
            for first, texts in _portions(batch.column(1)):
                rows, found, pieces = [], [], []
                for row, text in enumerate(texts, first):
                    ids = np.append(encoder.encode(text), np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        rows.append(row)
                        found.append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                        pieces.append(piece)
                columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
                columns += [pa.array(c, f.type) for c, f in zip(zip(*found), _PIECE)]
                if with_ids:
                    columns.append(pa.array([p.astype(np.int32) for p in pieces], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return cut


@dataclass(frozen=True)
class Pattern:
    """Windows of one filling: lengths with their counts, longest first, and how many windows."""

    filling: tuple[tuple[int, int], ...]
    windows: int


def closest_filling(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, whose sum is closest to ``capacity``.

    Bit s of ``sums`` says whether s can be reached by the lengths so far, from long to short. The
    way back takes as few of the shorter lengths as it can.
    """
    mask = (1 << (capacity + 1)) - 1
    sums, steps = 1, []
    for length in sorted((n for n in counts if n <= capacity), reverse=True):
        steps.append((length, sums))
        left, part = min(counts[length], capacity // length), 1
        while left:
            part = min(part, left)
            sums |= (sums << (part * length)) & mask
            left -= part
            part *= 2
        if sums >> capacity:
            break
    at, filling = sums.bit_length() - 1, {}
    for length, before in reversed(steps):
        used = 0
        while not before >> at & 1:
            at -= length
            used += 1
        if used:
            filling[length] = used
    return filling


def minimum_slack(histogram: dict[int, int], window: int) -> list[Pattern]:
    """Windows for all pieces of a histogram of lengths."""
    left = {n: c for n, c in histogram.items() if c}
    patterns = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        filling = closest_filling({n: c for n, c in rest.items() if c}, window - longest)
        filling[longest] = filling.get(longest, 0) + 1
        windows = min(left[n] // k for n, k in filling.items())
        for n, k in filling.items():
            left[n] -= k * windows
            if not left[n]:
                del left[n]
        patterns.append(Pattern(tuple(sorted(filling.items(), reverse=True)), windows))
    return patterns


@dataclass(frozen=True)
class Places:
    """Where the pieces go that are numbered by length: runs of numbers that share a pattern.

    Run i holds the numbers from ``starts[i]`` on. Each window of its pattern takes ``each[i]`` of
    them, beginning with window ``windows[i]``, at ``offsets[i]`` of the window.
    """

    starts: np.ndarray
    each: np.ndarray
    windows: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.starts, numbers, side="right") - 1
        which = numbers - self.starts[run]
        window = self.windows[run] + which // self.each[run]
        return window, self.offsets[run] + which % self.each[run] * self.lengths[run]


def places(histogram: dict[int, int], patterns: list[Pattern]) -> Places:
    first, total = {}, 0
    for length in sorted(histogram):
        first[length] = total
        total += histogram[length]
    runs, window = [], 0
    for pattern in patterns:
        offset = 0
        for length, count in pattern.filling:
            runs.append((first[length], count, window, offset, length))
            first[length] += count * pattern.windows
            offset += count * length
        window += pattern.windows
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return Places(*(np.ascontiguousarray(column) for column in table.T))


_PLACED = "sequence_id long, offset long"


def _place(found: Places, schema: pa.Schema):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            window, offset = found.of(batch.column("position").to_numpy())
            columns = [batch.column(f.name) for f in list(schema)[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(window), pa.array(offset)], schema=schema)

    return place


def pack(
    workspace: Workspace,
    docs: DataFrame,
    window: int = WINDOW,
    definition: bytes | None = None,
    end_id: int = END_ID,
    with_ids: bool = False,
    fill: Callable[[dict[int, int], int], list[Pattern]] = minimum_slack,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ``ids``.

    ``definition`` is the tokenizer's JSON, sent along with the tasks. The driver holds the number
    of pieces of each length and some thousand runs of places.
    """
    if definition is None:
        with open(tokenizer_file(), "rb") as file:
            definition = file.read()
    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    arrow_id = pa.schema(source.select("doc_id").limit(0).toArrow().schema).field(0)
    fields, names = [arrow_id, *_PIECE], f"doc_id {kind}, {_PIECE_NAMES}"
    if with_ids:
        fields, names = [*fields, pa.field("ids", pa.list_(pa.int32()))], f"{names}, ids array<int>"
    cut = source.mapInArrow(_cut(definition, window, end_id, pa.schema(fields), with_ids), names)
    pieces = workspace.stage(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = {r["length"]: r["n"] for r in counts}  # at most ``window`` lengths
    numbered = with_position(workspace, pieces, ["length", "_row"], "numbered")
    placed = pa.schema([*fields, ("sequence_id", pa.int64()), ("offset", pa.int64())])
    found = places(histogram, fill(histogram, window))
    result = numbered.mapInArrow(_place(found, placed), f"{names}, {_PLACED}")
    return result.withColumn("length", F.col("length").cast("long"))


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """sequence_id, ``ids`` filled up to the window, and ``n_tokens`` without the filling.

    Takes the rows of ``pack(..., with_ids=True)``. A sequence whose tokens are a power of two
    stays as it is.
    """
    whole = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"),
    )
    is_power = F.expr("n_tokens & (n_tokens - 1)") == 0
    missing = F.when(is_power, 0).otherwise(window - F.col("n_tokens")).cast("int")
    return whole.select(
        "sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), missing)).alias("ids"), "n_tokens"
    )
