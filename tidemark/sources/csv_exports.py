"""Reading export CSVs: always all-string, never inferred."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: The text of a record that has more fields than its file's header; NULL in all other rows.
REJECTED = "_rejected"


def _csv_options(reader, multiline: bool):
    return reader.option("multiLine", multiline).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")


def csv_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files behind paths, directories and globs, from directory listings; names with ``_`` or ``.`` in front are skipped."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for given in [path] if isinstance(path, str) else path:
        at = jvm.org.apache.hadoop.fs.Path(given)
        fs = at.getFileSystem(conf)
        matched = fs.globStatus(at)
        if not matched:
            raise FileNotFoundError(given)
        for status in matched:
            entries = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += sorted(e.getPath().toString() for e in entries if e.isFile() and e.getPath().getName()[0] not in "_.")
    return found


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The column names in a file's first line that is not empty; a few bytes are read, no job runs.

    A compressed file is known by its name's ending, as to Spark's reader.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    stream = at.getFileSystem(conf).open(at)
    try:
        if codec:
            stream = codec.createInputStream(stream)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = lines.readLine()
        while line is not None and not line.strip("\ufeff \t"):
            line = lines.readLine()
    finally:
        stream.close()
    names = next(csv.reader([(line or "").lstrip("\ufeff")]), [])
    return tuple(name or f"_c{i}" for i, name in enumerate(names))


def read_csv(spark: SparkSession, path: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """Headered UTF-8 CSVs (byte-order mark allowed), every column a string.

    Columns are found by each file's own header: files are read in groups of
    equal headers, and a column that a file lacks is NULL. A row with more
    fields than its header, empty ones too, is an error that shows the row; a
    short row ends with NULLs. Quoted line breaks need ``multiline``, which makes
    a file one task; files without them can be split by turning it off. Empty
    files have no columns and add no rows.
    """
    return whole_records(read_records(spark, path, multiline))


def read_records(spark: SparkSession, path: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """As ``read_csv``, but records with surplus fields are rows too, with their text in ``REJECTED``."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in csv_files(spark, path):
        groups.setdefault(header_of(spark, file), []).append(file)
    parts = [_read_alike(spark, files, header, multiline) for header, files in groups.items() if header]
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(REJECTED, T.StringType())]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def whole_records(records: DataFrame) -> DataFrame:
    """The rows without ``REJECTED``; a rejected one is an error."""
    said = F.concat(F.lit("a row has more fields than the header: "), F.col(REJECTED))
    fits = F.when(F.col(REJECTED).isNull(), F.lit(True)).otherwise(F.raise_error(said).cast("boolean"))
    return records.where(fits).drop(REJECTED)


def accepted_records(records: DataFrame) -> DataFrame:
    """The rows without the rejected ones, which ``rejected_records`` has."""
    return records.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_records(records: DataFrame) -> DataFrame:
    """(record): the text of each rejected record."""
    return records.where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("record"))


def _read_alike(spark: SparkSession, files: list[str], header: tuple[str, ...], multiline: bool) -> DataFrame:
    if len(set(header)) < len(header):
        raise ValueError(f"{files[0]} names a column twice: {list(header)}")
    if REJECTED in header:
        raise ValueError(f"{files[0]} names a column {REJECTED}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*header, REJECTED)])
    # Spark hands over the text of every record whose number of fields is not the schema's, if all columns are parsed.
    reader = _csv_options(spark.read.schema(schema), multiline).option("columnNameOfCorruptRecord", REJECTED)
    rows = reader.option("columnPruning", False).option("header", True).csv(files)
    commas = F.regexp_count(F.regexp_replace(REJECTED, '"[^"]*"', ""), F.lit(","))
    # Spark wants a field to be read beside the text.
    text = F.coalesce(F.col(REJECTED), F.col(f"`{header[0]}`"))
    return rows.withColumn(REJECTED, F.when(commas >= len(header), text))


def read_csv_after_preamble(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], max_columns: int = 32
) -> DataFrame:
    """As ``read_records_after_preamble``; a row with more fields than its file's header is an error that shows the row."""
    return whole_records(read_records_after_preamble(spark, path, columns, max_columns))


def read_records_after_preamble(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], max_columns: int = 32
) -> DataFrame:
    """CSV files whose header follows a few note lines; columns are found by header name.

    Files are read headerless into ``max_columns`` strings. One Arrow pass per
    scan task then drops everything up to each file's header row and picks the
    columns by that file's own header (a missing one is NULL). A file is always
    read in order within one task, so this needs no shuffle and no second scan.
    A row with more fields than its file's header has them all, joined, in
    ``REJECTED``. A file without a recognised header, and a header that fills all
    ``max_columns``, are errors that name the file; a row that fills them is
    rejected, so nothing is cut off or left out.
    """
    wide = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(max_columns)])
    raw = _csv_options(spark.read.schema(wide), True).csv(path)
    tagged = raw.select(F.col("_metadata.file_path").alias("__file"), *wide.fieldNames())
    wanted = list(columns)
    out_schema = T.StructType([T.StructField(name, T.StringType()) for name in (*wanted, REJECTED)])

    def after_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, places, width = None, None, 0
        for batch in batches:
            runs = pc.run_end_encode(batch.column(0))
            start = 0
            for end, name in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
                if name != file:
                    if file is not None and places is None:
                        raise ValueError(f"no header that names half of {wanted} in {file}")
                    file, places = name, None
                part = batch.slice(start, end - start)
                start = end
                if places is None:
                    found = _find_header(part, wanted)
                    if found is None:
                        continue
                    at, places, width = found
                    part = part.slice(at + 1)
                if part.num_rows:
                    nothing = pa.nulls(part.num_rows, pa.string())
                    picked = [nothing if i is None else part.column(i).cast(pa.string()) for i in places]
                    yield pa.RecordBatch.from_arrays([*picked, _surplus(part, width)], names=[*wanted, REJECTED])
        if file is not None and places is None:
            raise ValueError(f"no header that names half of {wanted} in {file}")

    return tagged.mapInArrow(after_header, out_schema)


def _surplus(part: pa.RecordBatch, width: int) -> pa.Array:
    """The fields of the rows that have any beyond ``width``, joined; NULL for the other rows."""
    beyond = [pc.is_valid(part.column(i)) for i in range(width + 1, part.num_columns)]
    if not beyond or not pc.any(reduce(pc.or_, beyond)).as_py():
        return pa.nulls(part.num_rows, pa.string())
    fields = [pc.fill_null(part.column(i).cast(pa.string()), "") for i in range(1, part.num_columns)]
    joined = pc.utf8_rtrim(pc.binary_join_element_wise(*fields, ","), characters=",")
    return pc.if_else(reduce(pc.or_, beyond), joined, pa.scalar(None, pa.string()))


def _find_header(part: pa.RecordBatch, wanted: Sequence[str]) -> tuple[int, list[int | None], int] | None:
    """Row that names at least half of the wanted columns, where each of them is, and how many columns there are."""
    hits = None
    for i in range(1, part.num_columns):
        known = pc.is_in(pc.utf8_trim_whitespace(part.column(i)), pa.array(list(wanted))).cast(pa.int32())
        hits = known if hits is None else pc.add(hits, known)
    at = pc.index(pc.greater_equal(hits, (len(wanted) + 1) // 2), True).as_py()
    if at < 0:
        return None
    names = [part.column(i)[at].as_py() for i in range(part.num_columns)]
    if names[-1] is not None:
        raise ValueError(f"a header has {part.num_columns - 1} columns or more; raise max_columns")
    stripped = [name.strip().lstrip("﻿") if name else None for name in names]
    width = max(i for i, name in enumerate(names) if name is not None)
    return at, [stripped.index(name, 1) if name in stripped[1:] else None for name in wanted], width
