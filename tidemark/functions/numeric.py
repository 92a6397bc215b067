"""Ratios, clipping and bucketing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import col


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; 0 when either side is NULL or the denominator is 0."""
    return F.coalesce(F.try_divide(col(numerator).cast("double"), col(denominator).cast("double")), F.lit(0.0))


def clip_unit(c: Column | str) -> Column:
    """Into [0, 1]; NULL stays NULL."""
    value = col(c)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def bucket(c: Column | str, bounds: Sequence[tuple[float, str]], top: str, unknown: str) -> Column:
    """Label of the first exclusive upper bound above the value."""
    labelled = F.when(col(c).isNull(), F.lit(unknown))
    for bound, label in bounds:
        labelled = labelled.when(col(c) < bound, F.lit(label))
    return labelled.otherwise(F.lit(top))


def count_if(test: Column | str) -> Column:
    """How many rows satisfy the test, NULL counting as no; NULL for no rows at all, like any SQL sum."""
    return F.sum(F.when(col(test), 1).otherwise(0))


def rounded(c: Column, digits: int = 2) -> Column:
    return F.round(c.cast("double"), digits)
