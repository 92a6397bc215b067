"""Finding the newest export directory of a type below a root."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Directory-name date shape and the files that identify each export type.
DATED_DIRECTORY = r"(?i)^{type}_export_(\d{{4}})_(\d{{2}})_(\d{{2}})$"
MARKERS = {
    "basic": ("Profile.csv", "Positions.csv"),
    "complete": ("Connections.csv", "Jobs/Job Applications.csv"),
}
FALLBACK_DIRECTORY = "{type}_export_latest"


@dataclass(frozen=True)
class ExportDirectory:
    export_type: str
    path: str
    label: str
    source: str
    exists: bool
    warning: str | None


def list_csv_files(spark: SparkSession, root: str, manual: bool = False) -> DataFrame:
    """(root, manual, path, relative_path, modified, size) of every CSV below the root; contents are not read.

    ``manual`` marks a root whose directories were put there by hand, so that
    they qualify without a dated name.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(root)
    )
    return files.select(
        F.lit(root.rstrip("/")).alias("root"),
        F.lit(manual).alias("manual"),
        "path",
        relative_path(spark, root).alias("relative_path"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
    )


def relative_path(spark: SparkSession, root: str) -> Column:
    """A file listing's ``path`` below the root, whatever the file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    qualified = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return F.substr(F.col("path"), F.lit(len(qualified) + 2))


def rank_export_dirs(files: DataFrame) -> DataFrame:
    """Candidate directories per export type, best first.

    A directory qualifies when it holds a marker file of the type. Those with a
    dated name of the type, or put there by hand, come first: by date, then
    modification time, then name. Directories named for something else follow
    as a fallback.
    """
    top = F.regexp_extract("relative_path", r"^([^/]+)/", 1)
    inside = F.regexp_replace("relative_path", r"^[^/]+/", "")
    # Spark writes a table as a directory of part files, so a marker may be a prefix.
    held = [
        F.when((inside == name) | inside.startswith(name + "/"), F.lit(export_type))
        for export_type, names in MARKERS.items()
        for name in names
    ]
    types = F.explode(F.array_distinct(F.array_compact(F.array(*held)))).alias("export_type")
    marked = files.select("root", "manual", top.alias("label"), "modified", types)
    dirs = marked.groupBy("export_type", "root", "manual", "label").agg(F.max("modified").alias("modified"))
    named = []
    for export_type in MARKERS:
        pattern = DATED_DIRECTORY.format(type=export_type)
        parts = [F.regexp_extract("label", pattern, i) for i in (1, 2, 3)]
        of_type = (F.col("export_type") == export_type) & F.col("label").rlike(pattern)
        named.append(F.when(of_type, F.try_to_date(F.concat_ws("-", *parts))))
    ranked = dirs.withColumn("export_date", F.coalesce(*named))
    typed = F.col("export_date").isNotNull() | F.col("manual")
    order = [F.desc(typed), F.desc_nulls_last("export_date"), F.desc("modified"), F.desc(F.lower("label"))]
    window = Window.partitionBy("export_type").orderBy(*order)  # one row per directory
    source = F.when(typed, "dated_raw_dir").otherwise("cross_type_fallback")
    return ranked.select(
        "export_type", "root", "label", "export_date", source.alias("source"), F.row_number().over(window).alias("rank")
    )


def resolve_export_dir(
    spark: SparkSession,
    root: str,
    export_type: str,
    overrides: Mapping[str, str] | None = None,
    manual_roots: Sequence[str] = (),
) -> ExportDirectory:
    """The directory to load: explicit override, newest dated or manual, any qualifying, or a missing default."""
    chosen = (overrides or {}).get(export_type)
    if chosen:
        exists = path_exists(spark, chosen)
        warning = None if exists else f"the configured {export_type} directory does not exist"
        return ExportDirectory(export_type, chosen, chosen.rstrip("/").rsplit("/", 1)[-1], "override", exists, warning)
    places = [(root, False), *[(manual, True) for manual in manual_roots]]
    listed = [list_csv_files(spark, place, manual) for place, manual in places if path_exists(spark, place)]
    best = None
    if listed:
        ranked = rank_export_dirs(reduce(DataFrame.union, listed))
        best = ranked.where((F.col("rank") == 1) & (F.col("export_type") == export_type)).first()
    if best is None:
        label = FALLBACK_DIRECTORY.format(type=export_type)
        path = f"{root.rstrip('/')}/{label}"
        return ExportDirectory(
            export_type, path, label, "legacy_default", path_exists(spark, path), f"no {export_type} export under {root}"
        )
    warning = None
    if best["source"] != "dated_raw_dir":
        warning = f"no dated {export_type} export; using {best['label']}, which holds the required files"
    return ExportDirectory(export_type, f"{best['root']}/{best['label']}", best["label"], best["source"], True, warning)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
