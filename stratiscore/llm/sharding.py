"""Sharding: the contiguous partition of ordered groups whose largest shard is smallest.

Documents are ordered by the SHA-256 of their text, so that equal texts stand together and form
one atomic group. The smallest capacity for which greedy filling needs no more than the wanted
shards is found by binary search; the cuts are those of the greedy filling at that capacity.

All documents stay in Spark. The driver holds the sums of stretches of the order, a bounded number
of them. Greedy filling over stretches gives bounds: no cut can lie beyond the place where it would
lie if stretches could be cut anywhere, nor before the place where it would lie if they could not
be cut at all. Where cuts may lie, one Spark job per round splits the stretches into 64 parts,
until they are single groups and both bounds agree.

Nulls: a null text is its own group with no bytes and CRC 0; a null doc_id is put like any other.
Repeated rows are separate members of their group. Without rows there are no shards to fill, and
shards may stay empty when there are fewer groups than shards.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.llm.common import with_position
from stratiscore.sources.staging import Workspace

N_SHARDS = 24
ROW_OVERHEAD = 8
MAX_STRETCHES = 16_384
_PARTS = 64


class Order:
    """Sums along the order of groups at uneven resolution, and greedy filling over them.

    A stretch is (first document position, size, width): it holds the groups that start within
    that many positions, or one group if the width is 1. Places are cumulative sizes.
    """

    def __init__(self, stretches: list[tuple[int, int, int]]):
        self.stretches = sorted(stretches)
        self.ends = list(accumulate(size for _, size, _ in self.stretches))
        self.total = self.ends[-1] if self.ends else 0

    def _start(self, i: int) -> int:
        return self.ends[i - 1] if i else 0

    def fill(self, capacity: int, n_shards: int, divide: bool) -> tuple[list[int], bool]:
        """Places of the cuts, and whether the shards suffice.

        ``divide`` lets a stretch of several groups be cut anywhere, else it cannot be cut.
        """
        place, cuts = 0, []
        while place + capacity < self.total:
            i = bisect_right(self.ends, place + capacity)
            following = place + capacity if divide and self.stretches[i][2] > 1 else self._start(i)
            if following <= place or len(cuts) + 1 == n_shards:
                return cuts, False
            cuts.append(following)
            place = following
        return cuts, True

    def capacity(self, n_shards: int, least: int, divide: bool) -> int:
        """The smallest capacity that suffices."""
        low, high = least - 1, max(self.total, least)
        while low + 1 < high:
            middle = (low + high) // 2
            if self.fill(middle, n_shards, divide)[1]:
                high = middle
            else:
                low = middle
        return high

    def open_stretches(self, n_shards: int, least: int) -> list[int]:
        """Stretches of several groups in which a cut may lie, as indexes."""
        low = self.capacity(n_shards, least, divide=True)
        high = self.capacity(n_shards, least, divide=False)
        first, enough = self.fill(low, n_shards, divide=False)
        last, _ = self.fill(high, n_shards, divide=True)
        found = set()
        for j in range(n_shards - 1):
            if j < len(first):
                begin = first[j]
            elif enough:
                break  # no capacity in question needs this cut
            else:
                begin = first[-1] if first else 0
            until = last[j] if j < len(last) else self.total
            i = bisect_right(self.ends, begin)
            while i < len(self.stretches) and self._start(i) <= until:
                if self.stretches[i][2] > 1:
                    found.add(i)
                i += 1
        return sorted(found)

    def cuts(self, n_shards: int, least: int) -> tuple[int, list[int]]:
        """The smallest capacity and the document positions of its cuts, once nothing is open."""
        capacity = self.capacity(n_shards, least, divide=False)
        places, _ = self.fill(capacity, n_shards, divide=False)
        return capacity, [self.stretches[bisect_right(self.ends, p)][0] for p in places]


def minimax_cuts(groups: DataFrame, n_shards: int, max_stretches: int) -> tuple[int, list[int]]:
    """Capacity and cuts of a table of groups (start, group_size), in order of ``start``."""
    top = groups.agg(F.max("start").alias("last"), F.max("group_size").alias("largest")).first()
    if top["last"] is None:
        return 0, []
    width = 1
    while (top["last"] + 1) / width > max_stretches:
        width *= _PARTS

    def stretches(rows: DataFrame, width: int) -> list[tuple[int, int, int]]:
        sums = rows.groupBy(F.floor(F.col("start") / width).alias("stretch")).agg(
            F.min("start").alias("start"),
            F.sum("group_size").alias("size"),
            F.count(F.lit(1)).alias("n"),
        )
        return [(r["start"], r["size"], 1 if r["n"] == 1 else width) for r in sums.collect()]

    order = Order(stretches(groups, width))
    spark = groups.sparkSession
    while wanted := order.open_stretches(n_shards, top["largest"]):
        width = max(order.stretches[i][2] for i in wanted)
        split = {i for i in wanted if order.stretches[i][2] == width}
        numbers = [(order.stretches[i][0] // width,) for i in split]
        chosen = F.broadcast(spark.createDataFrame(numbers, "_stretch long"))  # a bounded number
        inside = groups.join(chosen, F.floor(F.col("start") / width) == F.col("_stretch"), "left_semi")
        kept = [x for i, x in enumerate(order.stretches) if i not in split]
        order = Order(kept + stretches(inside, width // _PARTS))
    return order.cuts(n_shards, top["largest"])


def assign_shards(
    workspace: Workspace,
    docs: DataFrame,
    n_shards: int = N_SHARDS,
    max_stretches: int = MAX_STRETCHES,
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: the shard of each row and its place there."""
    data = F.col("text").cast("binary")
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(data), F.lit(0)).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(data, 256)), F.unhex(F.lit(""))).alias("_group"),
    )
    rows = workspace.stage(narrow, "shard-rows")
    placed = with_position(workspace, rows, [F.col("_group"), F.col("doc_id")], "ordered-rows")
    groups = placed.groupBy("_group").agg(
        F.min("position").alias("start"), F.sum("size").alias("group_size")
    )
    groups = workspace.stage(groups.drop("_group"), "groups")
    _, cuts = minimax_cuts(groups, n_shards, max_stretches)
    firsts = F.array(*[F.lit(c).cast("long") for c in [0, *cuts]])
    shard = F.size(F.filter(firsts, lambda c: c <= F.col("position"))) - 1
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        (F.col("position") - F.element_at(firsts, F.col("shard") + 1)).alias("slot"),
    )
