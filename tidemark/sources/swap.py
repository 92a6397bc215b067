"""Replacing a stored directory without a moment in which a failed job has emptied it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def write_then_switch(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a fresh directory beside ``path``, then put it in the old one's place.

    Until all of it is written the old directory stays as it is, so a failing
    job changes nothing and a table may be replaced by what is read from it. The
    old files go only after the new ones are in place. Between the two renames
    the path is absent, so readers must not run at that moment; on object stores,
    where a rename copies, the moment is as long as the copy of the new files.
    """
    path = path.rstrip("/")
    folder, _, name = path.rpartition("/")
    mark = uuid.uuid4().hex
    # A name with "_" in front is skipped by readers, unless it looks like a partition's.
    hidden = "_" + name.replace("=", "-")
    fresh, old = f"{folder}/{hidden}.new-{mark}", f"{folder}/{hidden}.old-{mark}"
    Path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: N806
    fs = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write(fresh)
    except BaseException:
        fs.delete(Path(fresh), True)
        raise
    there = fs.exists(Path(path))
    if there and not fs.rename(Path(path), Path(old)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(Path(fresh), Path(path)):
        if there:
            fs.rename(Path(old), Path(path))
        raise OSError(f"cannot move {fresh} to {path}")
    if there:
        fs.delete(Path(old), True)


@contextmanager
def fresh_directory(spark: SparkSession, root: str) -> Iterator[str]:
    """A new directory below ``root`` that readers skip by its name, removed at the end."""
    path = f"{root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        yield path
    finally:
        fs.delete(at, True)


def side_by_side(work: Callable[[Item], Result], items: Iterable[Item], at_once: int = 4) -> list[Result]:
    """The results of independent writes, in the order of the items; while one job plans or ends in a few tasks, others use the cores."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(work, items))
