"""Quality rules with cross-document line frequency.

Lines are normalised (case and blanks folded) and hashed, distinct documents per host and line are
counted, lines above the limits are removed, and documents that lose most of
their words are rejected. Built-in functions only.

Defined results: a null text has no words and fails the base rules; a null host
is a host of its own; exact copies of a text count as one document, so that a
page is not taken for boilerplate because it was crawled often; repeated rows
get one result each; lines without a word are never removed; an empty table
gives an empty result. Columns of the input other than the named ones play no
role.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import BLANKS, let, packed, stored


@dataclass(frozen=True)
class LineLimits:
    """A line is removed where more than ``min_documents`` documents and more than ``host_percent`` of its host's have it.

    So that a large host does not raise its own limit, two counts remove by
    themselves: more than ``most_documents`` documents of a host, and for a line of at
    least ``long_words`` words more than ``most_across`` documents of all hosts
    together. Either may be None.

    A document is depleted when less than ``least_percent_left`` of its words remain.
    """

    min_documents: int = 5
    host_percent: int = 8
    least_percent_left: int = 30
    most_documents: int | None = 1000
    most_across: int | None = 100
    long_words: int = 8


WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def repeated_words(all_words: Column) -> Column:
    """Words inside windows of eight words that occur at least twice in the text, first ones included.

    Windows are compared by hash. Where a window repeats, so do its first,
    fourth and eighth word at their distances: only texts in which some such
    triple repeats build whole windows, and only texts in which a window
    repeats sort them. The covered words follow from the distances of the
    repeated windows.
    """
    zero = F.lit(0).cast("long")

    def triples(h: Column) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 3), F.get(h, i + 7)))

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[h[i + k] for k in range(WINDOW)]))

    def covered(w: Column) -> Column:
        ordered = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: ((k > 0) & (s[k - 1]["h"] == x["h"])) | ((k < F.size(s) - 1) & (s[k + 1]["h"] == x["h"])))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def spread(p: Column) -> Column:
            steps = F.transform(p, lambda v, k: F.when(k == F.size(p) - 1, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), p[k + 1] - v)))
            return F.aggregate(steps, zero, lambda total, step: total + step)

        return let(ordered, lambda s: let(starts(s), spread))

    def unless_repeated(w: Column, found: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), zero).otherwise(found)

    def of_hashes(h: Column) -> Column:
        found = let(windows(h), lambda w: unless_repeated(w, covered(w)))
        return F.when(F.size(h) < WINDOW, zero).otherwise(let(triples(h), lambda t: unless_repeated(t, found)))

    return let(F.transform(all_words, lambda w: F.xxhash64(w)), of_hashes)


def measured(docs: DataFrame, text: str = "text", host: str = "source", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep`` (all) as ``row``, the host, the base measures and the line hashes.

    The only pass over the texts; what follows works on its result.
    """
    rows = packed(docs, keep, text=text, host=host).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("split", F.split("text", "\n"))
    rows = rows.withColumn("parts", F.transform("split", lambda line: F.filter(F.split(line, BLANKS), lambda w: w != "")))
    rows = rows.withColumn("words", F.flatten("parts"))
    long = lambda c: c.cast("long")
    with_word = F.filter("split", lambda line, i: F.size(F.col("parts")[i]) > 0)
    return rows.select(
        *[c for c in ("row",) if c in rows.columns],
        "host",
        F.xxhash64("text").alias("copy"),
        long(F.size("words")).alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        long(F.regexp_count("text", F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        let(with_word, lambda found: long(F.size(found) - F.size(F.array_distinct(found)))).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.transform("parts", lambda line: F.when(F.size(line) > 0, F.xxhash64(F.lower(F.concat_ws(" ", line))))).alias("hashes"),
        F.transform("parts", lambda line: F.size(line)).alias("line_words"),
    )


def frequent_lines(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """(of, line): the hashes of each host's lines above its limits, from ``measured`` rows.

    The counts are combined before each shuffle.
    """
    each = F.explode(F.array_distinct(F.filter("hashes", lambda h: h.isNotNull())))
    lines = rows.select("host", "copy", each.alias("line")).distinct()
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    least = limits.min_documents if limits.most_documents is None else min(limits.min_documents, limits.most_documents)
    sizes = rows.select("host", "copy").distinct().groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("all"))
    counts = counts.filter(F.col("n") > least).join(sizes, F.col("host").eqNullSafe(F.col("of")))
    above = (F.col("n") > limits.min_documents) & (100 * F.col("n") > limits.host_percent * F.col("all"))
    if limits.most_documents is not None:
        above |= F.col("n") > limits.most_documents
    return counts.filter(above).select("of", "line")


def spread_lines(rows: DataFrame, most_across: int, long_words: int) -> DataFrame:
    """(line): the hashes of long lines that more than ``most_across`` different texts of all hosts have."""
    long = F.transform("hashes", lambda h, i: F.when(F.col("line_words")[i] >= long_words, h))
    lines = rows.select("copy", F.explode(F.array_distinct(F.filter(long, lambda h: h.isNotNull()))).alias("line")).distinct()
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_across).select("line")


def removals(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """(of, in, gone): positions and word numbers of the lines above the limits, in order, for each host and text that has any.

    Lines meet the frequent ones as rows, so no list of a host's lines has to fit one row.
    """
    found = stored(frequent_lines(rows, limits), "frequent-lines")
    at = F.posexplode(F.arrays_zip("hashes", "line_words")).alias("pos", "at")
    places = rows.select("host", "copy", at).select("host", "copy", "pos", F.col("at.hashes").alias("hash"), F.col("at.line_words").alias("n"))
    hits = places.join(found, F.col("host").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("line"))).select("host", "copy", "pos", "n")
    if limits.most_across is not None:
        spread = stored(spread_lines(rows, limits.most_across, limits.long_words), "spread-lines")
        hits = hits.union(places.join(spread, F.col("hash") == F.col("line")).select("host", "copy", "pos", "n"))
    return hits.groupBy(F.col("host").alias("of"), F.col("copy").alias("in")).agg(F.array_sort(F.collect_set(F.struct("pos", "n"))).alias("gone"))


def judged(docs: DataFrame, limits: LineLimits = LineLimits(), text: str = "text", host: str = "source", keep: list[str] | None = None) -> DataFrame:
    """``docs`` as ``row`` with the base measures, ``base_failed``, numbers and ``removed`` positions of lines, and ``kept``.

    The removed lines are stored first, so Spark knows their size when it
    plans the join: a broadcast below its threshold, else a sort-merge join
    whose hot texts it splits.
    """
    rows = stored(measured(docs, text, host, keep), "line-measures")
    gone = stored(removals(rows, limits), "line-removals")
    joined = rows.drop("hashes", "line_words").join(gone, F.col("host").eqNullSafe(F.col("of")) & (F.col("copy") == F.col("in")), "left")
    none = F.array().cast("array<int>")
    joined = joined.withColumn("removed", F.coalesce(F.transform("gone", lambda g: g["pos"]), none))
    lost = F.coalesce(F.aggregate("gone", F.lit(0).cast("long"), lambda n, g: n + g["n"]), F.lit(0).cast("long"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    result = joined.select(
        *[c for c in joined.columns if c in ("row", "host", "copy")],
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        base_failed.alias("base_failed"),
        F.size("removed").cast("long").alias("n_lines_removed"),
        lost.alias("n_words_removed"),
        "removed",
    )
    depleted = 100 * (F.col("n_words") - F.col("n_words_removed")) < limits.least_percent_left * F.col("n_words")
    return result.withColumn("kept", ~F.col("base_failed") & ~depleted)


def cleaned(docs: DataFrame, limits: LineLimits = LineLimits(), text: str = "text", host: str = "source") -> DataFrame:
    """The kept rows of ``docs`` as ``row``, with ``clean_text``: the text without its removed lines, itself where none is.

    A judgement depends on host and text alone, so it is kept once for each such
    pair, without the text, and meets the rows by the pair's hashes.
    """
    found = judged(docs, limits, text, host, keep=[]).filter("kept").select(F.col("host").alias("of"), F.col("copy").alias("in"), "removed")
    found = stored(found.dropDuplicates(["of", "in"]), "line-judgements")
    rows = packed(docs, text=text, host=host).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("copy", F.xxhash64("text"))
    met = rows.join(found, F.col("host").eqNullSafe(F.col("of")) & (F.col("copy") == F.col("in")))
    text_left = F.when(F.size("removed") > 0, without_lines(F.col("text"), F.col("removed"))).otherwise(F.col("text"))
    return met.select("row", text_left.alias("clean_text"), (F.size("removed") > 0).alias("changed"))


def without_lines(text: Column, removed: Column) -> Column:
    """A text without the lines at the given positions."""

    def left(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
        return F.concat_ws("\n", F.transform(places, lambda i: lines[i]))

    return let(F.split(text, "\n"), left)
