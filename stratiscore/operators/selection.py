"""Exact order statistics and exact first-n selection inside large groups.

A handful of clusters can hold all clients, so a window or an exact percentile per cluster would
put a large part of the data into one task. Groups whose counted size fits a task take that short
way. For larger ones a sketch first brackets the wanted rank, the rows outside the bracket are only
counted, and the few inside it are ordered. The bracket is checked against the counts and opened
wherever it misses, so the result is exact either way.

A row may stand for several equal ones: ``weight`` names the column with their number. Ranks,
counts and quotas then count the rows it stands for, and a row at the border is kept for the part
of them that still belongs to the selection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiscore.sources.staging import SmallTable, Workspace

_HASH_DIGITS = 4
_ONE_GROUP = "_all_rows"
_EACH_ONCE = "1"
# In the sketch, which only narrows the search, a row counts for at most so many.
_SKETCH_COPIES = 64


@dataclass(frozen=True)
class Position:
    """A position in the ascending order of a column.

    ``at`` is SQL over the row count ``n``; it counts from 0 and may be fractional. ``share`` says
    roughly where that is.
    """

    name: str
    column: str
    share: float
    at: str


def quantile(name: str, column: str, share: float) -> Position:
    """Quantile by linear interpolation between neighbours."""
    return Position(name, column, share, f"(n - 1) * {share}D")


def top_count(share: float) -> str:
    """How many of ``n`` rows make up their top share: rounded down, at least one."""
    return f"greatest(1, cast(floor(n * {share}D) as bigint))"


def top_threshold(name: str, column: str, share: float) -> Position:
    """The smallest value among the top share of a group."""
    return Position(name, column, 1 - share, f"cast(n - {top_count(share)} as double)")


def group_quantiles(
    df: DataFrame,
    group: str,
    quantiles: list[Position],
    largest_group: int,
    workspace: Workspace,
    weight: str = _EACH_ONCE,
) -> SmallTable:
    """One row per group with the wanted quantiles. The columns must not hold NULL or NaN."""
    if largest_group <= workspace.settings.group_rows_in_task:
        # One aggregate per column: each keeps a map of the values of its group.
        columns = list(dict.fromkeys(q.column for q in quantiles))
        shares = {c: [q.share for q in quantiles if q.column == c] for c in columns}
        exact = [
            F.expr(f"percentile({c}, array({', '.join(f'{p}D' for p in shares[c])}), {weight}) as _{c}")
            for c in columns
        ]
        picked = [f"_{q.column}[{shares[q.column].index(q.share)}] as {q.name}" for q in quantiles]
        found = df.groupBy(group).agg(*exact).selectExpr(group, *picked)
        return workspace.small(found, "quantiles")
    return bracketed_positions(df, group, quantiles, workspace, weight)


def bracketed_positions(
    df: DataFrame,
    group: str,
    positions: list[Position],
    workspace: Workspace,
    weight: str = _EACH_ONCE,
) -> SmallTable:
    """One row per group with the values at the wanted positions, for groups of any size."""
    accuracy = workspace.settings.sketch_accuracy
    margin = 2.0 / accuracy
    numbered = list(enumerate(positions))

    def bracket(p: Position) -> str:
        low, high = max(p.share - margin, 0.0), min(p.share + margin, 1.0)
        return f"percentile_approx({p.column}, array({low}D, {high}D), {accuracy})"

    sketched, first = df, "true"
    if weight != _EACH_ONCE:
        columns = list(dict.fromkeys([group, *[p.column for p in positions], weight]))
        copies = f"sequence(1, cast(least({weight}, {_SKETCH_COPIES}) as int))"
        sketched, first = df.selectExpr(*columns, f"explode({copies}) as _copy"), "_copy = 1"
    sketch = workspace.small(
        sketched.groupBy(group).agg(
            F.expr(f"sum(if({first}, {weight}, 0)) as n"),
            *[F.expr(f"{bracket(p)} as bracket_{i}") for i, p in numbered],
        ),
        "sketch",
    )

    def total(condition: str, name: str) -> Column:
        return F.expr(f"sum(if({condition}, {weight}, 0)) as {name}")

    counts = (
        sketch.attach(df, [group], "inner")
        .groupBy(group)
        .agg(
            *[total(f"{p.column} < bracket_{i}[0]", f"below_{i}") for i, p in numbered],
            *[total(f"{p.column} <= bracket_{i}[1]", f"upto_{i}") for i, p in numbered],
        )
    )

    def value_range(i: int, p: Position) -> str:
        """Bracket, opened on the side where a wanted neighbour lies outside it."""
        holds_first = f"floor({p.at}) >= below_{i}"
        skipped = f"if({holds_first}, below_{i}, 0)"
        return (
            f"struct(if({holds_first}, bracket_{i}[0], null) as low, "
            f"if(ceil({p.at}) < upto_{i}, bracket_{i}[1], null) as high, "
            f"floor({p.at}) - {skipped} as first, ceil({p.at}) - {skipped} as last, "
            f"{p.at} as at) as range_{i}"
        )

    bounds = workspace.small(
        sketch.df.join(counts, group).selectExpr(group, *[value_range(i, p) for i, p in numbered]),
        "ranges",
    )
    inside = ", ".join(
        f"if((range_{i}.low is null or {p.column} >= range_{i}.low) and "
        f"(range_{i}.high is null or {p.column} <= range_{i}.high), "
        f"struct({i} as position, cast({p.column} as double) as value, range_{i}.first as first, "
        f"range_{i}.last as last, range_{i}.at as at, {weight} as weight), null)"
        for i, p in numbered
    )
    ascending = (
        W.partitionBy(group, "position").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    )
    found = (
        bounds.attach(df, [group], "inner")
        .selectExpr(group, f"inline(filter(array({inside}), c -> c is not null))")
        .groupBy(group, "position", "first", "last", "at", "value")
        .agg(F.sum("weight").alias("count"))
        .withColumn("seen", F.sum("count").over(ascending))
        .groupBy(group, "position", "at")
        .agg(
            F.expr("min(if(seen > first, value, null)) as low"),
            F.expr("min(if(seen > last, value, null)) as high"),
        )
        .selectExpr(
            group,
            "position",
            "if(low = high, low, (1 - at % 1) * low + (at % 1) * high) as v",
        )
    )
    wide = [F.expr(f"max(if(position = {i}, v, null)) as {p.name}") for i, p in numbered]
    return workspace.small(found.groupBy(group).agg(*wide), "positions")


def top_rows(
    df: DataFrame,
    group: str,
    score: str,
    share: float,
    tie_key: str,
    tie_columns: list[str],
    sizes: SmallTable,
    largest_group: int,
    workspace: Workspace,
    weight: str = _EACH_ONCE,
) -> DataFrame:
    """The top share of each group by score.

    Ties go by the hash of ``tie_key`` and then by ``tie_columns``. ``sizes`` holds the group and
    its row count ``n``, which counts a row ``weight`` times.
    """
    hashed = df.selectExpr("*", f"{hash_of(tie_key)} as _hash")
    if largest_group <= workspace.settings.group_rows_in_task:
        order = W.partitionBy(group).orderBy(F.desc(score), "_hash", *_nulls_last(tie_columns))
        ranked = sizes.attach(_with_places(hashed, order, weight), [group])
        return _within(ranked, top_count(share), weight).drop("_hash", "n")

    threshold = bracketed_positions(
        df, group, [top_threshold("_threshold", score, share)], workspace, weight
    )
    above = (
        threshold.attach(df, [group], "inner")
        .groupBy(group, "_threshold")
        .agg(F.expr(f"sum(if({score} > _threshold, {weight}, 0)) as above"))
    )
    quota = workspace.small(
        above.join(sizes.df, group).selectExpr(
            group, "_threshold", f"{top_count(share)} - above as _quota"
        ),
        "tie-quota",
    )
    placed = quota.attach(hashed, [group], "inner").drop("_quota")
    tied = placed.filter(f"{score} = _threshold")
    kept = placed.filter(f"{score} > _threshold").unionByName(
        _first_by_hash(tied, group, quota, tie_columns, workspace, weight)
    )
    return kept.drop("_hash", "_threshold")


def _with_places(df: DataFrame, order: W, weight: str) -> DataFrame:
    """Rows with ``_place``: how many rows the ones up to and with it stand for."""
    if weight == _EACH_ONCE:
        return df.withColumn("_place", F.row_number().over(order))
    running = order.rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("_place", F.sum(weight).over(running))


def _within(ranked: DataFrame, limit: str, weight: str) -> DataFrame:
    """Rows up to a limit by ``_place``; the row at the border for the part up to it."""
    if weight == _EACH_ONCE:
        return ranked.filter(f"_place <= {limit}").drop("_place")
    part = F.expr(f"least({weight}, {limit} - (_place - {weight}))")
    return ranked.withColumn(weight, part).filter(f"{weight} > 0").drop("_place")


def hash_of(key: str) -> str:
    """A missing key hashes like an empty one, so that both ways place its rows alike."""
    return f"md5(coalesce({key}, ''))"


def _nulls_last(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def sample_by_hash(
    df: DataFrame, key: str, n: int, tie_columns: list[str], workspace: Workspace
) -> DataFrame:
    """Exactly min(n, rows) rows: those of smallest hash of ``key``."""
    hashed = df.selectExpr("*", f"{hash_of(key)} as _hash")
    if n <= workspace.settings.small_table_rows:
        return hashed.orderBy("_hash", *_nulls_last(tie_columns)).limit(n).drop("_hash")
    rows = hashed.withColumn(_ONE_GROUP, F.lit(0))
    quota = workspace.small(
        workspace.spark.range(1).selectExpr(f"0 as {_ONE_GROUP}", f"{n}L as _quota"),
        "sample-quota",
    )
    return _first_by_hash(rows, _ONE_GROUP, quota, tie_columns, workspace).drop(
        "_hash", _ONE_GROUP
    )


def _first_by_hash(
    df: DataFrame,
    group: str,
    quota: SmallTable,
    tie_columns: list[str],
    workspace: Workspace,
    weight: str = _EACH_ONCE,
) -> DataFrame:
    """The first ``_quota`` rows of each group by ``_hash``.

    Hashes spread evenly, so counts by leading digits show the one bucket where the quota runs
    out; only its rows have to be ordered.
    """
    bucket = f"cast(conv(substring(_hash, 1, {_HASH_DIGITS}), 16, 10) as int)"
    rows = df.selectExpr("*", f"{bucket} as _bucket")
    ascending = W.partitionBy(group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    histogram = rows.groupBy(group, "_bucket").agg(F.expr(f"sum({weight}) as count"))
    running = histogram.withColumn("seen", F.sum("count").over(ascending))
    cut = workspace.small(
        quota.derive(group, "_quota")
        .attach(running, [group], "inner")
        .groupBy(group, "_quota")
        .agg(
            F.expr("min(if(seen > _quota, _bucket, null)) as _cut"),
            F.expr("max(if(seen <= _quota, seen, null)) as _taken"),
        )
        .selectExpr(group, "_cut", "_quota - coalesce(_taken, 0) as _left"),
        "hash-cut",
    )
    placed = cut.attach(rows, [group], "inner")
    order = W.partitionBy(group).orderBy("_hash", *_nulls_last(tie_columns))
    edge = _within(_with_places(placed.filter("_bucket = _cut"), order, weight), "_left", weight)
    whole = placed.filter("_cut is null or _bucket < _cut")
    return whole.unionByName(edge).drop("_bucket", "_cut", "_left")
