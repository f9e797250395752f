"""Coercion and column-resolution expressions, as SQL text.

Text keeps wide projections short to build: one call to the JVM per expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stratiscore.config import NON_CLUSTERED

# Texts that stand for a missing cluster label.
MISSING_LABELS = ("", "nan", "None", "null")

NULL_NUMBER = "cast(null as double)"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values) -> str:
    return ", ".join(text(v) for v in values)


def number_or_null(df: DataFrame, name: str) -> str:
    """The column as double; what is not a number becomes NULL, and so does NaN."""
    column = quoted(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        # The JVM reads '12d' and '12f' as numbers; a data file does not mean that.
        number = f"if({column} rlike '(?i)[0-9.][df] *$', null, {column})"
        return f"nanvl(try_cast({number} as double), {NULL_NUMBER})"
    return f"nanvl(cast({column} as double), {NULL_NUMBER})"


def number_or_zero(df: DataFrame, name: str) -> str:
    return f"coalesce({number_or_null(df, name)}, 0D)"


def resolve_column(df: DataFrame, expected: str) -> str | None:
    """The exact name if the frame has it, else the first name equal but for case."""
    if expected in df.columns:
        return expected
    for name in df.columns:
        if name.lower() == expected.lower():
            return name
    return None


def resolved_number(df: DataFrame, expected: str) -> str:
    """Number under a name matched without regard to case; 0 when there is none."""
    name = resolve_column(df, expected)
    return "0D" if name is None else number_or_zero(df, name)


def require_columns(df: DataFrame, names: list[str], what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def clean_label(df: DataFrame, name: str) -> str:
    """Cluster label as text; missing ones become NON_CLUSTERED, arrays give their first entry."""
    column = quoted(name)
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return f"coalesce(cast(try_element_at({column}, 1) as string), '{NON_CLUSTERED}')"
    label = f"cast({column} as string)"
    missing = f"{label} is null or {label} in ({texts(MISSING_LABELS)})"
    return f"if({missing}, '{NON_CLUSTERED}', {label})"


def rounded_percent(share: str) -> str:
    """Share in [0, 1] as a whole percentage, halves to the even neighbour."""
    return f"cast(rint(({share}) * 100) as int)"
