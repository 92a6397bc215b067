"""Row and column cleaning, and the declarative recipe the table loads are written in."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates, lexicon, text


def normalize_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(name) for name in df.columns])


def rename_synonyms(df: DataFrame, synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """Give each target column the first non-null of itself and its synonyms."""
    for target, names in synonyms.items():
        present = [name for name in (target, *names) if name in df.columns]
        extra = [name for name in present if name != target]
        if not extra:
            continue
        if len(present) == 1:
            df = df.withColumnRenamed(extra[0], target)
        else:
            merged = F.coalesce(*[F.col(name) for name in present])
            df = df.withColumn("__merged", merged).drop(*present).withColumnRenamed("__merged", target)
    return df


def ensure_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    return df.withColumns({name: F.lit(None).cast("string") for name in missing}) if missing else df


def strip_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """A projection of its own, so that what follows reads each stripped text instead of stripping it per use."""
    return df.withColumns({name: text.strip_text(name) for name in names})


def clean_text_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return strip_columns(df, names).withColumns({name: text.blank_markers_to_null(name) for name in names})


def parse_date_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return strip_columns(df, names).withColumns({name: dates.parse_mixed(name) for name in names})


def parse_us_datetime_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({name: dates.parse_us_datetime(name) for name in names})


def boolean_of(c: Column | str) -> Column:
    """For text that is already stripped."""
    word = F.lower(text.col(c))
    return F.when(word.isin(*lexicon.TRUE_WORDS), True).when(word.isin(*lexicon.FALSE_WORDS), False)


def parse_boolean_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return strip_columns(df, names).withColumns({name: boolean_of(name) for name in names})


def current_flag(end: Column | str) -> Column:
    return text.col(end).isNull()


def drop_blank_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    for name in required:
        df = df.where(~text.is_blank(name))
    return df


def deduplicate(df: DataFrame, keys: Sequence[str] | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, NULL keys equal to each other.

    Without keys whole rows are compared, in hash aggregates with a map-side step.
    With keys the row that is smallest by ``order_by`` (then by its remaining
    columns) is kept: the first of a ranking whose limit Spark applies before the
    shuffle, so that a task sends one row per key. Either way a hot group of copies
    shrinks before the shuffle and never sits whole in one task.
    """
    if keys is None:
        return df.dropDuplicates()
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    ranked = [*order_by, *[name for name in rest if name not in order_by]]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))
    return df.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


@dataclass(frozen=True)
class Recipe:
    """What turns one raw export table into its cleaned form.

    Steps run in a fixed order: names, synonyms, missing columns, text, dates,
    derived columns, blank rows, duplicates, column list. Duplicates go before
    the column list, so rows that differ only in a dropped column both stay.
    """

    columns: tuple[str, ...]
    synonyms: Mapping[str, Sequence[str]] = field(default_factory=dict)
    text_columns: tuple[str, ...] = ()  # include the required ones
    mixed_dates: tuple[str, ...] = ()
    us_datetimes: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()
    derive: Callable[[DataFrame], DataFrame] | None = None
    required: tuple[str, ...] = ()
    distinct: bool = False

    def __call__(self, df: DataFrame) -> DataFrame:
        df = rename_synonyms(normalize_columns(df), self.synonyms)
        df = ensure_columns(df, [*self.text_columns, *self.mixed_dates, *self.us_datetimes, *self.booleans])
        df = strip_columns(df, [*self.text_columns, *self.mixed_dates, *self.booleans])
        cleaned = {name: text.blank_markers_to_null(name) for name in self.text_columns}
        cleaned |= {name: dates.parse_mixed(name) for name in self.mixed_dates}
        cleaned |= {name: dates.parse_us_datetime(name) for name in self.us_datetimes}
        cleaned |= {name: boolean_of(name) for name in self.booleans}
        df = df.withColumns(cleaned)
        if self.derive is not None:
            df = self.derive(df)
        for name in self.required:  # cleaned text columns, so blank is NULL by now
            df = df.where(F.col(name).isNotNull())
        if self.distinct:
            df = deduplicate(df)
        return select_columns(df, self.columns)
