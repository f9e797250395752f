"""SimHash near-duplicates under a Hamming distance, by pigeonring filtering.

A fingerprint is cut into m equal segments that form a ring. If two fingerprints differ in at most
t bits, some segment starts a chain along the ring whose first l segments differ in at most
floor(l * t / m) bits, for every l. The first segments of such a chain have budget 0, so they are
equal and serve as join key, one for each start; the budgets of the longer chains prune the pairs,
and the chain of all m segments is the full Hamming check.

A key shared by many fingerprints would give all their pairs. Beyond ``bucket_limit`` its members
link instead through the fingerprints within t / 2 bits of them: two fingerprints share such a
middle exactly when they differ in at most t bits, and every member is linked to the smallest one
of each middle. The components are the same; the links made grow linearly.

Nulls: a null text has no words and fingerprint 0, which links like any other. A null doc_id never
names a component unless all its members are null. Repeated rows are members like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiscore.llm.common import byte_values, document_key, free_name, pieces
from stratiscore.llm.components import components
from stratiscore.sources.staging import Workspace

SHINGLE = 3
MAX_DISTANCE = 2
SEGMENTS = 8
BUCKET_LIMIT = 64
SEED = 42
_BITS = 64
_PIECE = 1 << 21


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text: a bit is 1 if set in over half the shingle hashes."""
    ones, n = np.zeros(_BITS, np.int64), 0
    tail: list[bytes] = []
    for piece in pieces(data, _PIECE):
        words = tail + piece.lower().split()  # bytes.lower changes A-Z only
        if len(words) >= shingle:
            grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            hashes = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], "<u8")
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            n += len(hashes)
            tail = words[len(words) - shingle + 1 :]
        else:
            tail = words
    if n == 0 and tail:  # fewer words than a shingle: the whole sequence
        hashed = np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], "<u8")
        ones, n = np.unpackbits(hashed.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(data) for data in byte_values(batch.column("text"))]
        kept = batch.drop_columns(["text"])
        yield kept.append_column("fp", pa.array(values, pa.int64()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, key (see ``document_key``), fp."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", document_key().alias("key"), "text")
    return rows.mapInArrow(_fingerprints, f"doc_id {kind}, key string, fp long")


def _rotated(value: str, start: str, width: int) -> str:
    """The ring read from segment ``start``; a shift by 64 is one by 0."""
    return (
        f"(shiftrightunsigned({value}, {start} * {width})"
        f" | shiftleft({value}, {_BITS} - {start} * {width}))"
    )


def _signed(mask: int) -> str:
    return f"{mask - (1 << _BITS) if mask >> (_BITS - 1) else mask}L"


def _low(bits: int) -> str:
    return _signed((1 << bits) - 1)


def _chain(max_distance: int, segments: int) -> tuple[int, Column]:
    """Number of equal segments a chain starts with, and the budgets of the longer chains."""
    width = _BITS // segments
    budget = {n: n * max_distance // segments for n in range(1, segments + 1)}
    equal = max((n for n in budget if budget[n] == 0), default=0)
    if not equal:
        raise ValueError("more segments than differing bits are needed")
    ring = _rotated("(a.fp ^ b.fp)", "start", width)
    tests = [
        f"bit_count({ring} & {_low(n * width)}) <= {budget[n]}"
        for n in range(equal + 1, segments + 1)
    ]
    return equal, F.expr(" and ".join(tests))


def links(
    workspace: Workspace,
    distinct: DataFrame,
    max_distance: int = MAX_DISTANCE,
    segments: int = SEGMENTS,
    bucket_limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within the distance."""
    if _BITS % segments or max_distance % 2 or not max_distance:
        raise ValueError("segments must divide 64 and the distance be even and positive")
    width = _BITS // segments
    equal, budgets = _chain(max_distance, segments)
    key = f"{_rotated('fp', 'start', width)} & {_low(equal * width)}"
    starts = f"explode(sequence(0, {segments - 1})) as start"
    keys = distinct.selectExpr("fp", starts).selectExpr("fp", "start", f"{key} as bucket")
    keys = workspace.stage(keys, "segment-keys")
    sizes = keys.groupBy("start", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = workspace.stage(sizes, "shared-keys")
    few = keys.join(sizes.filter(F.col("n") <= bucket_limit), ["start", "bucket"], "left_semi")
    pairs = (
        few.alias("a")
        .join(few.alias("b"), ["start", "bucket"])
        .filter("a.fp < b.fp")
        .filter(budgets)
        .selectExpr("a.fp as a", "b.fp as b")
    )
    crowd = keys.join(sizes.filter(F.col("n") > bucket_limit), ["start", "bucket"], "left_semi")
    flips = [
        sum(1 << bit for bit in bits)
        for n in range(max_distance // 2 + 1)
        for bits in combinations(range(_BITS), n)
    ]
    masks = ", ".join(_signed(mask) for mask in flips)
    middles = crowd.select("fp").distinct().selectExpr("fp", f"explode(array({masks})) as mask")
    middles = middles.selectExpr("fp", "fp ^ mask as middle")
    least = middles.groupBy("middle").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n"))
    crowded = (
        middles.join(least.filter("n > 1"), "middle")
        .filter("fp <> b")
        .selectExpr("b as a", "fp as b")
    )
    return pairs.union(crowded)


def near_duplicates(
    workspace: Workspace,
    docs: DataFrame,
    max_distance: int = MAX_DISTANCE,
    segments: int = SEGMENTS,
    bucket_limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """doc_id, key, fp, component_id, first: is this the document of its component that stays?"""
    prints = workspace.stage(fingerprints(docs), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key"))
    distinct = prints.groupBy("fp").agg(first.alias("first"))
    distinct = workspace.stage(distinct, "distinct-fingerprints")
    edges = links(workspace, distinct.select("fp"), max_distance, segments, bucket_limit)
    roots = components(workspace, edges)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    rooted = workspace.stage(rooted, "rooted")
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    owner = rooted.join(heads, "root").select(
        "fp", F.col("head.doc_id").alias("component_id"), F.col("head.key").alias("head")
    )
    return prints.join(owner, "fp").select(
        "doc_id", "key", "fp", "component_id", (F.col("key") == F.col("head")).alias("first")
    )


def keep_first(workspace: Workspace, docs: DataFrame, **options) -> DataFrame:
    """One document of each component, with all its columns."""
    name = free_name(docs, "document_key")
    marked = near_duplicates(workspace, docs, **options)
    rows = marked.filter("first").groupBy(F.col("key").alias(name)).agg(F.count(F.lit(1)).alias("n"))
    stay = workspace.stage(rows, "stay").hint("merge")  # its size has no bound at any size of input
    named = docs.withColumn(name, document_key())
    # Only the rows that share their key are grouped; all others keep their place.
    single = named.join(stay.filter("n = 1"), name, "left_semi")
    shared = named.join(stay.filter("n > 1"), name, "left_semi").dropDuplicates([name])
    return single.union(shared).drop(name)
