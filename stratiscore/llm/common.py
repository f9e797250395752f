"""What the operators share: words, whole-table order, and iteration over staged tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiscore.sources.staging import Workspace

# White space and words of the contracts, as patterns and as plain characters.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"

_SPACE_BYTE = re.compile(rb"[\x20\x09-\x0D]")
_INDEX_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key_text(column: str) -> Column:
    """A join key without nulls that keeps null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def with_position(workspace: Workspace, df: DataFrame, keys: list, name: str) -> DataFrame:
    """Rows with ``position``, their place from 0 in the whole order by ``keys``, staged.

    The order is a range partitioning, so a key held by any share of the rows is cut wherever
    later keys differ. Only the row counts of the partitions reach the driver.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    staged = workspace.stage(
        ordered.withColumn("_at", F.monotonically_increasing_id()), name
    )
    part = F.shiftright("_at", _INDEX_BITS).alias("_part")
    counts = staged.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["_part"], total))
        total += row["n"]
    table = workspace.spark.createDataFrame(offsets, "_part long, _offset long")
    return (
        staged.withColumn("_part", part)
        .join(F.broadcast(table), "_part")  # one row per shuffle partition
        .withColumn("position", F.col("_offset") + F.col("_at").bitwiseAND((1 << _INDEX_BITS) - 1))
        .drop("_part", "_offset", "_at")
    )


def document_key() -> Column:
    """Names a document by its id and its text, by the digest of its text where the id is null.

    Rows that repeat an id with another text are documents of their own.
    """
    text = F.coalesce("text", F.lit(""))
    named = F.concat(F.col("doc_id").cast("string"), F.lit("#"), F.hex(F.xxhash64(text)))
    return F.coalesce(named, F.concat(F.lit("#"), F.sha2(text, 256)))


def pieces(data: bytes, size: int) -> Iterator[bytes]:
    """The bytes in pieces of about ``size``, cut only before white space."""
    at = 0
    while len(data) - at > size:
        cut = _SPACE_BYTE.search(data, at + size)
        if cut is None:
            break
        yield data[at : cut.start()]
        at = cut.start()
    yield data[at:] if at else data


def byte_values(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, empty for nulls."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have."""
    while wanted in df.columns:
        wanted = f"_{wanted}"
    return wanted
