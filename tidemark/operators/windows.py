"""Changes between rows, running totals and the month spine.

The running operators have no partition key. They are for month-grain tables
only, whose row count is the number of calendar months; raw rows are always
aggregated to months first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import safe_ratio


def with_previous(df: DataFrame, values: Mapping[str, str], partition: Sequence[str], order: Sequence[str], ranges: int = 64) -> DataFrame:
    """Add each row's values of the row before it in its partition; {value column: new column}.

    The same as ``lag`` over the whole partition, but no partition is gathered in
    one task. Quantiles of the first ``order`` column (a number, date or time) cut
    all rows into ``ranges``; the lag runs inside (partition, range), and the last
    row of each is carried to the next range that the partition has, so at most
    ``ranges`` rows of a partition are ever ordered together. Rows are read once
    for the lag, beside the narrow read of the quantiles: rows and carried rows
    share one shuffle, because both branches take whole rows out of it.
    """
    if not values or not order:
        raise ValueError("with_previous needs values and an order")
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = df.agg(F.percentile_approx(order[0], shares, ranges * 100).alias("cuts")).scalar()
    keys = [f"__key{i}" for i in range(len(partition))]
    rows = df.withColumn("__cuts", cuts).select(
        *[F.col(name).alias(key) for name, key in zip(partition, keys, strict=True)],
        F.coalesce(F.size(F.filter("__cuts", lambda cut: cut < F.col(order[0]))), F.lit(0)).alias("__range"),
        F.struct(*[F.col(name) for name in df.columns]).alias("__row"),
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(*[F.col(f"__row.{name}") for name in order])
    placed = rows.select(
        *keys, "__range", "__row", F.lag("__row").over(inside).alias("__before"), F.lead(F.lit(True)).over(inside).isNull().alias("__last")
    )
    along = Window.partitionBy(*[f"{key}_" for key in keys]).orderBy("__range_")
    ends = placed.where("__last").select(*[F.col(c).alias(f"{c}_") for c in (*keys, "__range", "__row")])
    carried = ends.select(*[f"{c}_" for c in (*keys, "__range")], F.lag("__row_").over(along).alias("__carried"))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in (*keys, "__range")]
    joined = placed.join(carried, reduce(lambda a, b: a & b, same), "left")
    before = F.coalesce("__before", "__carried")
    return joined.select("__row.*", before.alias("__before")).select(
        *[F.col(name) for name in df.columns], *[F.col(f"__before.{name}").alias(new) for name, new in values.items()]
    )


def with_changes(df: DataFrame, values: Mapping[str, str], partition: Sequence[str], order: Sequence[str], ranges: int = 64) -> DataFrame:
    """Add the differences to the row before in the partition; {value column: new column}, NULL for the first row."""
    found = with_previous(df, values, partition, order, ranges)
    return found.withColumns({new: F.col(value) - F.col(new) for value, new in values.items()})


def _by(order: str):
    return Window.orderBy(order)


def running_total(value: Column | str, order: str) -> Column:
    frame = _by(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(value).over(frame)


def delta_vs_previous(value: str, order: str) -> Column:
    """Difference to the previous row, 0 for the first."""
    return F.coalesce(F.col(value) - F.lag(value).over(_by(order)), F.lit(0)).cast("long")


def growth_vs_previous(value: str, order: str) -> Column:
    """Relative change; 0 for the first row and after a zero."""
    before = F.lag(value).over(_by(order))
    return safe_ratio(F.col(value) - before, before)


def running_weighted_mean(mean: str, weight: str, order: str) -> Column:
    """Mean over everything up to and including the row, from per-row means and their weights."""
    return safe_ratio(running_total(F.col(mean) * F.col(weight), order), running_total(weight, order))


def month_spine(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Every non-null month that occurs in any of the frames."""
    months = reduce(DataFrame.union, [df.select(key) for df in frames])
    return months.where(F.col(key).isNotNull()).distinct()


def spread_on_months(frames: Sequence[DataFrame], key: str, fill: Mapping[str, float]) -> DataFrame:
    """All frames side by side on every month that occurs in any of them, gaps filled.

    The same rows as left joins onto the month spine, but without computing a
    frame once for the spine and again for its join: the frames, which have one
    row per month each, are stacked and folded by month in a single aggregate.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    names = [name for name in stacked.columns if name != key]
    dated = stacked.where(F.col(key).isNotNull())
    return dated.groupBy(key).agg(*[F.max(name).alias(name) for name in names]).fillna(dict(fill))
