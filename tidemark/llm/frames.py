"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: A word is a run of anything but ASCII blanks.
BLANKS = r"[ \t-\r]+"
WORD = r"[^ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage in a place every executor can read, and gives the planner
    the real size of the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    for paths in _OPEN:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_OPEN: list[list[str]] = []


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of all tables that ``stored`` writes inside the block."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield paths
    finally:
        _OPEN[:] = [p for p in _OPEN if p is not paths]


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` names it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def packed(docs: DataFrame, keep: list[str] | None = None, **needed: str) -> DataFrame:
    """The columns ``keep`` (all; none for an empty list) as one struct ``row`` plus the needed columns under fixed names.

    Whatever other columns ``docs`` has, none can clash with a name an operator adds.
    """
    kept = [docs[f"`{c}`"] for c in (docs.columns if keep is None else keep)]
    named = [docs[f"`{c}`"].alias(n) for n, c in needed.items()]
    return docs.select(*([F.struct(*kept).alias("row")] if kept else []), *named)
