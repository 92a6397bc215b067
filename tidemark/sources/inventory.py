"""Technical inventory of export files: size, rows, columns, encoding, readability."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.export_dirs import path_exists, relative_path
from tidemark.sources.swap import write_then_switch

# The encodings told apart, files with a preamble, files read line-wise when irregular.
ENCODINGS = ("utf-8", "latin-1")
PREAMBLE_LINES = {"connections.csv": 3}
LINEWISE_FILES = ("searchqueries.csv",)

INVENTORY_COLUMNS = (
    "export_name",
    "export_type",
    "relative_path",
    "file_name",
    "file_stem",
    "folder_name",
    "file_size_bytes",
    "file_size_kb",
    "row_count",
    "column_count",
    "column_names",
    "detected_encoding",
    "read_success",
    "error_message",
    "inventory_timestamp",
)
HEAD_SCHEMA = "path string, size long, names array<string>, names_latin array<string>, skipped int"
#: Lines that a header with quoted line breaks may have.
MOST_HEADER_LINES = 1000


def _heads(spark: SparkSession, directory: str) -> tuple[DataFrame, list[str]]:
    """(path, size, names, names_latin, skipped) of each CSV file, and the texts of all lines before headers.

    From directory listings and the first lines of each file, which the driver
    reads as bytes: names in either encoding, and how many records come before
    them. A file without a header has no names.
    """
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(directory)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    listed, rows, before = fs.listFiles(at, True), [], set()
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().getName()
        if not name.endswith(".csv") or name[0] in "_.":
            continue
        stream = fs.open(status.getPath())
        try:
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "ISO-8859-1"))
            skipped = [lines.readLine() or "" for _ in range(PREAMBLE_LINES.get(name.lower(), 0))]
            head, n = lines.readLine(), 0
            while head is not None and n < MOST_HEADER_LINES and (not head.strip("\r\n") or head.count('"') % 2):
                more, n = lines.readLine(), n + 1
                head = more if more is None or not head.strip("\r\n") else f"{head}\n{more}"
        finally:
            stream.close()
        names = [_names(head, encoding) for encoding in ("utf-8", "latin-1")]
        n_before = sum(1 for record in csv.reader(skipped) if record)
        before |= {line for line in skipped if line}
        rows.append((status.getPath().toString(), status.getLen(), *names, n_before))
    return spark.createDataFrame(rows, HEAD_SCHEMA), sorted(before)


def _names(head: str | None, encoding: str) -> list[str] | None:
    """The names in a header whose bytes are given as characters; None without any, or in another encoding."""
    try:
        text = (head or "").encode("latin-1").decode(encoding).removeprefix("\ufeff")
    except UnicodeDecodeError:
        return None
    return next(csv.reader([text]), None)


def _path(uri: Column) -> Column:
    """A file's path as directory listings have it, from the encoded one of a scan."""
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def _files(spark: SparkSession, directory: str):
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")


def _records(spark: SparkSession, directory: str, before: list[str]) -> DataFrame:
    """(path, n_records, most_fields, irregular): records of each file, parsed by Spark one after the other.

    Read as one column, all records of more fields come with their text. A field
    that goes on after its closing quote, or never closes, is irregular.
    """
    reader = _files(spark, directory).schema("_field string, _text string").option("columnNameOfCorruptRecord", "_text")
    rows = reader.option("multiLine", True).option("quote", '"').option("escape", '"').option("columnPruning", False).csv(directory)
    marked = F.regexp_replace(F.regexp_replace("text", r"\r?\n$", ""), '"[^"]*"', "\u0001")
    # A record of one field has nothing to count, but Spark wants a field to be read beside the text.
    text = F.coalesce(F.col("_text"), F.substring("_field", 1, 0), F.lit(""))
    rows = rows.select(_path(F.col("_metadata.file_path")).alias("path"), text.alias("text")).withColumn("marked", marked)
    own = ~F.col("text").isin(before) if before else F.lit(True)
    return rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.max(F.when(own, F.regexp_count("marked", F.lit(",")) + 1)).alias("most_fields"),
        F.max(F.when(own, F.col("marked").rlike('(?:^|,)\u0001*(?:\u0001[^,\u0001]|")'))).alias("irregular"),
    )


def _lines(spark: SparkSession, directory: str) -> DataFrame:
    """(path, is_utf8, n_lines): whether all bytes of a file are UTF-8, and its lines that are not blank. Large files are split."""
    rows = _files(spark, directory).text(directory).select(_path(F.col("_metadata.file_path")).alias("path"), "value")
    return rows.groupBy("path").agg(F.min(F.is_valid_utf8("value")).alias("is_utf8"), F.count(F.when(F.trim("value") != "", 1)).alias("n_lines"))


def probed(spark: SparkSession, directory: str) -> DataFrame:
    """(path, size, row_count, column_count, column_names, detected_encoding, read_success, error_message) of each CSV below a directory.

    Records and lines are counted where Spark reads them; no file has to fit a row.
    """
    heads, before = _heads(spark, directory)
    found = heads.join(_records(spark, directory, before), "path", "left").join(_lines(spark, directory), "path", "left")
    utf8 = F.coalesce("is_utf8", F.lit(True))
    names = F.when(utf8, F.col("names")).otherwise(F.col("names_latin"))
    found = found.withColumns({"encoding": F.when(utf8, F.lit(ENCODINGS[0])).otherwise(F.lit(ENCODINGS[-1])), "names": names})
    wide = F.col("most_fields") > F.size("names")
    error = (
        F.when(F.col("names").isNull() | F.col("n_records").isNull(), F.lit("No columns to parse from file"))
        .when(wide, F.format_string("Expected %d fields, saw %d", F.size("names"), F.col("most_fields")))
        .when(F.col("irregular"), F.lit("A quoted field does not end at its closing quote"))
    )
    name = F.lower(F.substring_index("path", "/", -1))
    linewise = error.isNotNull() & name.isin(*LINEWISE_FILES)
    good = error.isNull() | linewise
    whole = F.concat_ws(",", "names")
    first = F.array(F.substring_index(whole, ",", 1), F.expr("substr(concat_ws(',', names), instr(concat_ws(',', names), ',') + 1)"))
    shown = F.when(linewise, F.when(F.instr(whole, ",") > 0, first).otherwise(F.array(whole))).otherwise(F.col("names"))
    quoted = F.concat(F.lit("["), F.concat_ws(", ", F.transform(shown, _json_text)), F.lit("]"))
    rows = F.when(linewise, F.greatest(F.col("n_lines") - 1, F.lit(0))).otherwise(F.greatest(F.col("n_records") - F.col("skipped") - 1, F.lit(0)))
    return found.select(
        "path",
        "size",
        F.when(good, rows).cast("long").alias("row_count"),
        F.when(good, F.size(shown)).cast("long").alias("column_count"),
        F.when(good, quoted).alias("column_names"),
        F.when(good, F.col("encoding")).alias("detected_encoding"),
        good.alias("read_success"),
        F.when(~good, error).alias("error_message"),
    )


def _json_text(name: Column) -> Column:
    """A name as JSON text."""
    return F.regexp_extract(F.to_json(F.struct(name.alias("n"))), r'^\{"n":(.*)\}$', 1)


def build_inventory(spark: SparkSession, exports: Mapping[str, tuple[str, str]], inventoried_at: Column) -> DataFrame:
    """One row per CSV of each export, given as {export_type: (export_name, directory)}.

    A missing directory yields a single failed row.
    """
    parts = []
    for export_type, (export_name, directory) in exports.items():
        if path_exists(spark, directory):
            parts.append(_inventory_of(spark, export_type, export_name, directory.rstrip("/")))
        else:
            parts.append(_missing_directory(spark, export_type, export_name, directory))
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    stamped = united.withColumn("inventory_timestamp", inventoried_at)
    return stamped.select(*INVENTORY_COLUMNS)


def sort_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.orderBy("export_type", "folder_name", "file_name", "relative_path")


def file_counts(inventory: DataFrame, key: str) -> DataFrame:
    """Files per export type or folder; the row of a missing directory names no file and counts as none."""
    return inventory.groupBy(key).agg(F.count("file_name").alias("files"))


def _inventory_of(spark: SparkSession, export_type: str, export_name: str, directory: str) -> DataFrame:
    relative = relative_path(spark, directory)
    name = F.substring_index(relative, "/", -1)
    folder = F.when(relative.contains("/"), F.substring_index(relative, "/", 1)).otherwise(F.lit("root"))
    return probed(spark, directory).select(
        F.lit(export_name).alias("export_name"),
        F.lit(export_type).alias("export_type"),
        relative.alias("relative_path"),
        name.alias("file_name"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("file_stem"),
        folder.alias("folder_name"),
        F.col("size").alias("file_size_bytes"),
        F.round(F.col("size") / 1024, 2).alias("file_size_kb"),
        "row_count",
        "column_count",
        "column_names",
        "detected_encoding",
        "read_success",
        "error_message",
    )


def _missing_directory(spark: SparkSession, export_type: str, export_name: str, directory: str) -> DataFrame:
    kinds = {
        "file_size_bytes": "long",
        "file_size_kb": "double",
        "row_count": "long",
        "column_count": "long",
    }
    known = {
        "export_name": F.lit(export_name),
        "export_type": F.lit(export_type),
        "read_success": F.lit(False),
        "error_message": F.lit(f"Caminho não encontrado: {directory}"),
    }
    names = [name for name in INVENTORY_COLUMNS if name != "inventory_timestamp"]
    return spark.range(1).select(
        *[known.get(name, F.lit(None).cast(kinds.get(name, "string"))).alias(name) for name in names]
    )


def save_inventory(inventory: DataFrame, directory: str, stamp: str) -> dict[str, str]:
    """A stamped and a ``latest`` copy, each as CSV and Parquet.

    The probe runs once: the other copies are made from the first Parquet one.
    """
    spark = inventory.sparkSession
    stamped = f"{directory}/file_inventory_{stamp}"
    latest = f"{directory}/file_inventory_latest"
    write_then_switch(spark, f"{stamped}.parquet", inventory.write.parquet)
    stored = spark.read.parquet(f"{stamped}.parquet")
    write_then_switch(spark, f"{latest}.parquet", stored.write.parquet)
    for base in (stamped, latest):
        write_then_switch(spark, f"{base}.csv", stored.write.option("header", True).option("escape", '"').csv)
    return {
        "csv": f"{stamped}.csv",
        "parquet": f"{stamped}.parquet",
        "latest_csv": f"{latest}.csv",
        "latest_parquet": f"{latest}.parquet",
    }


def preview_inventory(summary: DataFrame) -> DataFrame:
    """Inventory summary, largest groups first."""
    return summary.orderBy(
        F.desc_nulls_last("total_arquivos"),
        F.desc_nulls_last("total_linhas"),
        "export_type",
        "categoria_dado",
        "status_leitura",
        "volume_categoria",
    )
