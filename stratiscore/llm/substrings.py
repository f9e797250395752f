"""Substring removal: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Documents are dealt into blocks of neighbouring ids and about equal bytes. Each block sends its distinct window hashes,
sorted and cut by hash range, to Spark's shuffle; the task of a hash range finds the hashes that
several blocks hold and returns them to all but the first. Since blocks follow the order of ids,
every window of a later block that an earlier block holds starts in a smaller document too; inside
a block that is decided directly. A window found in a third of all documents sends one hash per
block. Repeated windows merge into intervals, and the words under them are removed.

Hashes have 64 bits and are not compared with the texts: with n distinct windows, a window is
removed wrongly with probability n / 2^64.

Nulls: a null text has no words. A null doc_id is neither smaller nor greater than another: its
windows remove nothing and are never removed. Rows that repeat a doc_id do not remove each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiscore.llm.common import byte_values, pieces
from stratiscore.sources.staging import Workspace

WINDOW = 50
BLOCK_BYTES = 8 << 20
_PIECE = 1 << 21

# Odd multipliers of the two rolling hashes and of the finishing step. Any odd numbers do.
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(steps)
    return have[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _finish(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(_MIX[0])
    values = (values ^ (values >> np.uint64(27))) * np.uint64(_MIX[1])
    return values ^ (values >> np.uint64(31))


def _rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of values[start:end], from one running sum of scaled values."""
    scaled = values * _powers(_inverse(base), len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(scaled, out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(base, len(values) + 1)[ends]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """One 64-bit hash for each word of a text, and the place of its first byte."""
    found, places, at = [], [], 0
    for piece in pieces(data, _PIECE):
        codes = np.frombuffer(piece, np.uint8)
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = ~_IS_SPACE[codes]
        edges = np.flatnonzero(np.diff(inside))
        if len(edges):
            values = codes.astype(np.uint64) + np.uint64(1)
            found.append(_finish(_rolled(values, edges[::2], edges[1::2], _BYTE_BASE)))
            places.append(edges[::2] + at)
        at += len(piece)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(places)


def block_windows(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per document, first word of each window, and the windows' hashes, in text order."""
    joined, counts, batch, held = [], [], [], 0

    def flush():
        nonlocal batch, held
        if not batch:
            return
        hashes, places = word_hashes(b"\n".join(batch))
        joined.append(hashes)
        ends = np.cumsum([len(t) + 1 for t in batch])
        counts.extend(np.diff(np.searchsorted(places, ends), prepend=0))
        batch, held = [], 0

    for text in texts:
        if held + len(text) > _PIECE:
            flush()
        batch.append(text)
        held += len(text)
    flush()
    words = np.concatenate(joined) if joined else np.zeros(0, np.uint64)
    counts = np.array(counts, np.int64)
    ends = np.cumsum(counts)
    per_text = np.maximum(counts - window + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(per_text)])
    starts = np.arange(offsets[-1]) + np.repeat(ends - counts - offsets[:-1], per_text)
    if not len(starts):
        return counts, starts, np.zeros(0, np.uint64)
    return counts, starts, _finish(_rolled(words, starts, starts + window, _WORD_BASE))


def _packed(hashes: np.ndarray) -> bytes:
    """Sorted hashes as gaps, by byte planes, which compress."""
    gaps = np.diff(hashes, prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=np.uint64)


_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("hashes", pa.binary())])


def _send(window: int, n_buckets: int):
    """Of a block: its distinct window hashes, one row for each hash range."""
    limits = np.array([i * (1 << 64) // n_buckets for i in range(1, n_buckets)], np.uint64)

    def send(table: pa.Table) -> pa.Table:
        _, _, hashes = block_windows(byte_values(table.column("text")), window)
        hashes = np.unique(hashes)
        parts = np.split(hashes, np.searchsorted(hashes, limits))
        sent = [(i, _packed(p)) for i, p in enumerate(parts) if len(p)]
        block = table.column("block")[0].as_py()
        return pa.table(
            [[i for i, _ in sent], [block] * len(sent), [p for _, p in sent]], schema=_SENT
        )

    return send


_RETURNED = pa.schema([("block", pa.int32()), ("hashes", pa.binary())])


def _find_repeated(table: pa.Table) -> pa.Table:
    """Of a hash range: the hashes of earlier blocks that each block repeats."""
    table = table.sort_by("block")
    blocks = table.column("block").to_numpy()
    parts = [_unpacked(data) for data in table.column("hashes").to_pylist()]
    hashes = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(hashes, kind="stable")  # merges the sorted runs
    hashes, owner = hashes[order], owner[order]
    again = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
    hashes, owner = hashes[again], owner[again]
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(1, len(parts)))
    found = [(b, p) for b, p in zip(blocks, np.split(hashes[order], cuts)) if len(p)]
    return pa.table(
        [[b for b, _ in found], [_packed(p) for _, p in found]], schema=_RETURNED
    )


def removed_words(
    ids: np.ndarray, counts: np.ndarray, starts: np.ndarray, hashes: np.ndarray,
    known: np.ndarray, window: int,
) -> np.ndarray:
    """For all words of a block, whether a removed window covers them.

    ``ids`` are the documents' ids in ascending order, ``known`` the sorted hashes that smaller
    documents of other blocks hold.
    """
    n_words = int(counts.sum())
    owner = np.repeat(ids, np.maximum(counts - window + 1, 0))
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))
    drop = np.zeros(len(hashes), bool)
    drop[order] = owner[order] > owner[order][first]  # the stable order starts with the smallest id
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        drop |= known[at] == hashes
    change = np.zeros(n_words + 1, np.int32)
    np.add.at(change, starts[drop], 1)
    np.add.at(change, starts[drop] + window, -1)
    return np.cumsum(change[:-1]) > 0


def _remove(window: int, schema: pa.Schema, with_text: bool):
    def remove(docs: pa.Table, returned: pa.Table) -> pa.Table:
        known = [_unpacked(data) for data in returned.column("hashes").to_pylist()]
        known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        docs = docs.sort_by("doc_id")
        ids, texts = docs.column("doc_id"), byte_values(docs.column("text"))
        plain = np.array([i for i in ids.to_pylist()], np.int64)
        counts, starts, hashes = block_windows(texts, window)
        covered = removed_words(plain, counts, starts, hashes, known, window)
        kept, removed, at = [], [], 0
        for text, n in zip(texts, counts):
            words, mask = text.split(), covered[at : at + n]
            gone = int(mask.sum())
            if gone:
                words = compress(words, ~mask)
            kept.append(b" ".join(words))
            removed.append(gone)
            at += n
        columns = [ids, pa.array(counts), pa.array(removed, pa.int64())]
        columns.append(pa.array([hashlib.sha256(k).hexdigest() for k in kept]))
        if with_text:
            columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
        return pa.table([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns],
                        schema=schema)

    return remove


def _whole(schema: pa.Schema, with_text: bool):
    """Rows without id keep all their words."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [text.split() for text in byte_values(batch.column("text"))]
            kept = [b" ".join(w) for w in words]
            columns = [batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64())]
            columns.append(pa.array([0] * len(words), pa.int64()))
            columns.append(pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()))
            if with_text:
                columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return whole


def block_starts(
    workspace: Workspace, rows: DataFrame, block_bytes: int, min_blocks: int
) -> tuple[int, list]:
    """Number of blocks, and the first ids of all but the first: ranges of about equal bytes.

    A block exceeds its share by one document at most, the documents of one id as one. The driver
    holds a number for each partition and one id for each block.
    """
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("bytes")
    sizes = rows.filter("doc_id is not null").groupBy("doc_id").agg(size)
    ordered = sizes.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    staged = workspace.stage(ordered.withColumn("part", F.spark_partition_id()), "sizes")
    total, before = 0, []
    for row in staged.groupBy("part").agg(F.sum("bytes").alias("bytes")).orderBy("part").collect():
        before.append((row["part"], total))
        total += row["bytes"]
    n_blocks = max(1, min_blocks, -(-total // block_bytes))
    if n_blocks == 1:
        return n_blocks, []
    table = workspace.spark.createDataFrame(before, "part int, before long")
    running = F.sum("bytes").over(
        W.partitionBy("part").orderBy("doc_id").rowsBetween(W.unboundedPreceding, -1)
    )
    start = F.col("before") + F.coalesce(running, F.lit(0))
    block = F.floor(start * F.lit(n_blocks) / F.lit(max(total, 1)))
    blocks = staged.join(F.broadcast(table), "part").select("doc_id", block.alias("block"))
    firsts = blocks.groupBy("block").agg(F.min("doc_id").alias("first")).filter("block > 0")
    return n_blocks, sorted(r["first"] for r in firsts.collect())


def remove_repeated(
    docs: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    min_blocks: int | None = None,
    with_text: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept text of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    floor = int(spark.conf.get("spark.sql.shuffle.partitions")) if min_blocks is None else min_blocks
    n_blocks, found = block_starts(Workspace(spark), rows, block_bytes, floor)
    splits = [float("-inf"), *sorted({float(i) for i in found}), float("inf")]
    named = rows.filter("doc_id is not null").withColumn("_id", F.col("doc_id").cast("double"))
    if len(splits) > 2:
        named = Bucketizer(splits=splits, inputCol="_id", outputCol="_block").transform(named)
    else:
        named = named.withColumn("_block", F.lit(0))
    dealt = named.select("doc_id", "text", F.col("_block").cast("int").alias("block"))
    sent = dealt.groupBy("block").applyInArrow(
        _send(window, n_blocks), "bucket int, block int, hashes binary"
    )
    returned = sent.groupBy("bucket").applyInArrow(_find_repeated, "block int, hashes binary")
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64())]
    fields += [("kept_sha256", pa.string())] + [("kept_text", pa.string())] * with_text
    names = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    names += ", kept_text string" * with_text
    schema = pa.schema(fields)
    cut = (
        dealt.groupBy("block")
        .cogroup(returned.groupBy("block"))
        .applyInArrow(_remove(window, schema, with_text), names)
    )
    unnamed = rows.filter("doc_id is null").mapInArrow(_whole(schema, with_text), names)
    return cut.union(unnamed)
