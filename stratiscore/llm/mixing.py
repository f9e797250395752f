"""Mixing sources to target token shares by entropy balancing.

Every document d gets a rate q_d. Among all rates that give each source its target tokens, the
balanced ones are nearest to 1 in token-weighted relative entropy, sum of size * (q ln q - q).
Their convex dual has one multiplier per source, and the solution is an exponential tilt,
q_d = exp(dual of its source). Newton steps on the dual run as Spark jobs on the table of sources;
documents enter through their token sums only, because the tilt is shared inside a source. Rates
then become whole copies: each document is rounded by a hash of its id and text. Rows with equal id and
text, of which a source may have any number, would all be rounded alike; they are rounded together,
and some of them take a copy more or fewer. What a source has too much or too little in the end is
mended on a few of its rows from each size class.

Nulls: a null source is a source of its own and comes last; a null text has size 0; rows with a null
doc_id are told apart by their texts. Rows that repeat a doc_id count one by one; which of several
equal rows takes more is open, how many do is not. An empty table gives an empty mix; a source
without words has target 0.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiscore.llm.common import key_text, with_position, word_count
from stratiscore.sources.staging import Workspace

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEAT = 3
TOLERANCE = 1e-10
_MENDERS = 16  # rows of each source and size class that may be mended


def source_sizes(sizes: DataFrame) -> DataFrame:
    """One row per source: ``key``, ``source``, ``source_size``, ``n``."""
    return sizes.groupBy("key").agg(
        F.first("source").alias("source"),
        F.sum("size").alias("source_size"),
        F.count(F.lit(1)).alias("n"),
    )


def fill_targets(
    workspace: Workspace, sources: DataFrame, weights: tuple[float, ...], max_repeat: int
) -> DataFrame:
    """Share all tokens by weight, stop at ``max_repeat`` times a source, reshare the excess.

    Each round is one aggregation over the sources; only sums reach the driver. A round settles
    every source whose share exceeds its limit, and the last one finds none.
    """
    picked = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("position") % len(weights) + 1).cast("int"),
    )
    order = [F.col("source").isNull(), F.col("source")]
    ranked = with_position(workspace, sources, order, "ranked-sources")
    table = ranked.withColumn("weight", picked).withColumn("limit", F.col("source_size") * max_repeat)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    unit = None  # tokens per unit of weight; shares only grow, so settled sources stay settled
    settled = F.lit(False)
    while True:
        sums = table.agg(
            F.sum(F.when(settled, F.col("limit")).otherwise(0)).alias("stopped"),
            F.sum(F.when(~settled, F.col("weight")).otherwise(0.0)).alias("free"),
        ).first()
        new = (total - (sums["stopped"] or 0)) / sums["free"] if sums["free"] else unit
        if new is None or new == unit:
            break
        unit = new
        settled = F.col("weight") * F.lit(unit) > F.col("limit")
    share = F.col("weight") * F.lit(unit or 0.0)
    return table.select(
        "key", "source", "source_size", "n",
        F.when(settled, F.col("limit").cast("double")).otherwise(share).alias("target"),
    )


def balance(
    workspace: Workspace, targets: DataFrame, tolerance: float = TOLERANCE, max_iterations: int = 60
) -> DataFrame:
    """Newton's method on the dual: adds ``dual`` and ``rate`` to the targets.

    Per source, gradient = source_size * exp(dual) - target and curvature = source_size * exp(dual).
    The dual separates over sources, so its Hessian is diagonal and a step is a projection.
    """
    mass = F.col("source_size") * F.exp("dual")
    table = workspace.stage(
        targets.withColumn("dual", F.lit(0.0)), "duals"
    )
    for step in range(max_iterations):
        worst = table.agg(
            F.max(F.when(F.col("source_size") > 0, F.abs(mass - F.col("target")) / F.col("source_size")))
        ).first()[0]
        if worst is None or worst <= tolerance:
            return table.withColumn("rate", F.exp("dual"))
        stepped = F.when(F.col("source_size") > 0, F.col("dual") - (mass - F.col("target")) / mass)
        moved = table.withColumn("dual", F.coalesce(stepped, F.lit(0.0)))
        table = workspace.stage(moved, f"duals-{step}")
    raise RuntimeError(f"the dual has not converged in {max_iterations} steps")


def _identity() -> Column:
    """Equal for rows with equal id and text."""
    return F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull())


def _uniform(seed: int) -> Column:
    """A number in [0, 1) from the identity of a row."""
    hashed = F.xxhash64(F.lit(seed), F.col("same"))
    return F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))


def _rounded_together(workspace: Workspace, drawn: DataFrame, limit: int, seed: int) -> DataFrame:
    """``row_id`` and ``change`` of rows that have equals, which together take their rate.

    Each of m equal rows already takes the same ``copies``; as many of them take one more, or one
    fewer, as the rounded sum of their rates asks for.
    """
    wanted = F.floor(F.col("rate") * F.col("m") + _uniform(seed + 2))
    groups = (
        drawn.filter("size > 0")
        .groupBy("key", "same")
        .agg(F.count(F.lit(1)).alias("m"), F.first("rate").alias("rate"), F.first("copies").alias("copies"))
        .filter("m > 1")
        .withColumn("delta", F.least(wanted, F.col("m") * limit) - F.col("m") * F.col("copies"))
        .filter("delta <> 0")
        .select("key", "same", "delta")
    )
    equal = workspace.small(groups, "equal-rows").attach(
        drawn.select("key", "same", "row_id"), ["key", "same"], "inner"
    )
    # Places in one order of all such rows: no group is numbered in one task.
    numbered = with_position(workspace, equal, ["key", "same", "row_id"], "equal-rows")
    first = numbered.groupBy("key", "same").agg(F.min("position").alias("_first"))
    placed = workspace.small(first, "first-equal").attach(numbered, ["key", "same"], "inner")
    chosen = placed.filter(F.col("position") - F.col("_first") < F.abs("delta"))
    return chosen.select("row_id", F.signum("delta").cast("int").alias("change"))


def _mend(limit: int):
    """Per source: single copies more or fewer, largest documents first, until the sum is near."""

    def mend(group: pd.DataFrame) -> pd.DataFrame:
        left = float(group["target"].iloc[0]) - float(group["taken"].iloc[0])
        changes = []
        for row in group.sort_values(["size", "order", "copies"], ascending=[False, True, True]).itertuples():
            change = 0
            while row.size and abs(left) > row.size / 2:
                one = 1 if left > 0 else -1
                if not 0 <= row.copies + change + one <= limit:
                    break
                change += one
                left -= one * row.size
            if change:
                changes.append((row.row_id, change))
        return pd.DataFrame(changes, columns=["row_id", "change"])

    return mend


def mix(
    workspace: Workspace,
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    seed: int = 42,
    with_rows: bool = False,
) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken; and, if asked for, ``row``,
    the whole document."""
    sized = docs.select(
        "doc_id", "source", key_text("source").alias("key"), word_count("text").alias("size"),
        _identity().alias("same"), F.monotonically_increasing_id().alias("row_id"),
        *([F.struct(*docs.columns).alias("row")] if with_rows else []),
    )
    # Written once: the numbers of the rows hold from here on.
    rows = workspace.stage(sized, "sizes")
    sizes = rows.select("doc_id", "source", "key", "size", "same", "row_id")
    targets = fill_targets(workspace, source_sizes(sizes), weights, max_repeat)
    rates = workspace.stage(balance(workspace, targets), "rates")
    small = workspace.small(
        rates.select("key", "source_size", "target", F.least("rate", F.lit(max_repeat)).alias("rate")),
        "rates",
    )
    copies = F.least(F.floor(F.col("rate") + _uniform(seed)).cast("int"), F.lit(max_repeat))

    def drawn(some: DataFrame) -> DataFrame:
        return small.attach(some, ["key"]).withColumn("copies", copies)

    together = workspace.small(
        _rounded_together(workspace, drawn(sizes), max_repeat, seed), "rounded-together"
    )
    settled = together.attach(drawn(sizes), ["row_id"]).withColumn(
        "copies", F.col("copies") + F.coalesce("change", F.lit(0))
    )
    sums = settled.groupBy("key").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"),
        F.first("target").alias("target"),
    )
    klass = F.floor(F.log2(F.col("size").cast("double")))
    order = F.xxhash64(F.lit(seed + 1), F.col("same")).alias("order")
    menders = (
        settled.filter("size > 0")
        .groupBy("key", klass.alias("class"), F.pmod(F.xxhash64("same"), F.lit(_MENDERS)).alias("slot"))
        .agg(F.min(F.struct(order, "size", "copies", "row_id")).alias("m"))
        .select("key", "m.*")
        .join(sums, "key")
    )
    mended = menders.groupBy("key").applyInPandas(_mend(max_repeat), "row_id long, change int")
    changes = workspace.small(
        together.df.select("row_id", "change").union(mended).groupBy("row_id").agg(F.sum("change").alias("change")),
        "changes",
    )
    final = F.col("copies") + F.coalesce("change", F.lit(0)).cast("int")
    return changes.attach(drawn(rows), ["row_id"]).select(
        "doc_id", "source", "size", "source_size", "target", "rate", final.alias("copies"),
        (final * F.col("size")).alias("taken"), *(["row"] if with_rows else []),
    )


def repeat(mixed: DataFrame) -> DataFrame:
    """The mixed documents themselves, from a mix with rows: each as often as it has copies."""
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return mixed.select("row", times).select("row.*")
