"""Rows of tables with different columns as text, so that one query can show them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOTHING = "∅"


def texts(df: DataFrame, like: DataFrame | None = None) -> Column:
    """A row's values in order; doubles to six digits. Columns are first brought to the types of ``like``."""
    like = df if like is None else like
    shown = []
    for name, kind in like.dtypes:
        value = F.col(f"`{name}`").cast(kind)
        value = value.cast("decimal(38,6)") if kind in ("double", "float") else value
        shown.append(F.coalesce(value.cast("string"), F.lit(NOTHING)))
    return F.concat_ws("|", *shown)


def texts_sql(columns: Sequence[str], dates: Sequence[str] = ()) -> str:
    """The same in DuckDB, for columns of any type."""
    shown = []
    for name in columns:
        value = f'cast("{name}" as date)' if name in dates else f'"{name}"'
        plain = f"cast({value} as varchar)"
        double = f"cast(cast(try_cast({plain} as double) as decimal(38,6)) as varchar)"
        shown.append(f"coalesce(case when typeof({value}) in ('DOUBLE', 'FLOAT') then {double} else {plain} end, '{NOTHING}')")
    return f"concat_ws('|', {', '.join(shown)})"
