"""Mixing sources to target weights by entropy balancing. Built-in functions only.

Each source gets a token target. Among all document rates between zero and a
cap that take the target's tokens from a source, the ones that stray least from
rate one (in relative entropy) are ``min(cap, exp(lambda * tokens))``, with one
multiplier per source. The multipliers solve the convex dual, one distributed
Newton step for all sources at a time. Rates become whole copies so that each
source's taken tokens come within about one small document of its target.

Rates depend on a document only through source and size, so every iteration
works on counts per (source, size), never on documents.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a source without words has target 0; rows that repeat id, source
and text share the copies that fall to them, as evenly as whole copies allow; an
empty table gives an empty result; other columns of the input play no role.
Multipliers that do not converge are an error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import n_words, packed, stored

#: Rates are rounded to millionths, so that everything after them is exact.
PARTS = 1_000_000
#: Documents of one source and size are numbered in this many cells, so that no such group is sorted in one task.
CELLS = 64
#: Newton steps in one job, and the relative error at which they end.
STEPS, ERROR, MOST_JOBS = 4, 1e-9, 40


@dataclass(frozen=True)
class MixPlan:
    """Sources in code-point order, null last, weigh ``weights``, repeating; together they give ``percent`` of all tokens.

    A source gives at most ``cap`` times its own size, a document at most ``cap`` copies.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    percent: int = 150
    cap: int = 2


def source_key(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def targets(sizes: DataFrame, plan: MixPlan) -> DataFrame:
    """(key, source_size, target): the weighted shares, where none is above its cap.

    Sources in order of cap over weight reach their caps one after the other as
    the common level rises; the level is right where the next source's ratio is
    above it. Works on one row per source, all of which one task orders: sources
    are corpora, not hosts or pages.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in plan.weights]), (F.pmod(F.col("place") - 1, len(plan.weights)) + 1).cast("int"))
    sources = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.when(F.col("key") == "", 1).otherwise(0), "key")
    every = Window.partitionBy()
    placed = sources.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight)
    placed = placed.withColumn("most", plan.cap * F.col("source_size")).withColumn("all", F.sum("source_size").over(every) * plan.percent / 100)
    filling = Window.orderBy(F.col("most") / F.col("weight"), "key")
    placed = placed.withColumn("capped", F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.withColumn("open", F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    level = (F.col("all") - F.col("capped")) / F.col("open")
    placed = placed.withColumn("level", F.max(F.when(F.col("most") / F.col("weight") > level, level)).over(every))
    shared = F.col("weight") * F.col("level")
    target = F.when(F.col("level").isNull() | (F.col("most") <= shared), F.col("most").cast("double")).otherwise(shared)
    return placed.select("key", "source_size", target.alias("target"))


def _rate(cap: int) -> Column:
    exponent = F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(math.log(cap)))
    return F.when(F.col("full"), F.lit(float(cap))).when(F.col("multiplier").isNull(), F.lit(0.0)).otherwise(F.exp(exponent))


def _newton_step(counts: DataFrame, state: DataFrame, cap: int) -> DataFrame:
    """One safeguarded Newton step on the logarithm of each source's taken tokens.

    The taken tokens rise with the multiplier, so the bracket (low, high) shrinks with each step; a step that leaves
    it is replaced by the bracket's middle.
    """
    at = counts.join(state, "key").withColumn("rate", _rate(cap)).withColumn("x", F.col("size") / F.col("mean"))
    taken = F.col("n") * F.col("x") * F.col("rate")
    free = F.when(F.col("rate") < cap, taken * F.col("x")).otherwise(0.0)
    held = ["target", "source_size", "mean", "full", "multiplier", "low", "high"]
    sums = at.groupBy("key", *held).agg((F.sum(taken) * F.first("mean")).alias("taken"), F.sum(free).alias("slope"))
    ratio = F.when(F.col("target") > 0, F.col("taken") / F.col("target"))
    sums = sums.withColumn("low", F.when(ratio < 1, F.col("multiplier")).otherwise(F.col("low")))
    sums = sums.withColumn("high", F.when(ratio >= 1, F.col("multiplier")).otherwise(F.col("high")))
    step = F.when(F.col("slope") > 0, F.col("multiplier") - F.log(ratio) * F.col("taken") / (F.col("slope") * F.col("mean")))
    middle = (F.col("low") + F.col("high")) / 2
    moved = F.when((step > F.col("low")) & (step < F.col("high")), step).otherwise(middle)
    off = F.abs(ratio - 1)
    stays = F.col("full") | F.col("multiplier").isNull() | (off <= ERROR)
    return sums.select(
        "key",
        *[c for c in held if c not in ("multiplier",)],
        F.when(stays, F.col("multiplier")).otherwise(moved).alias("multiplier"),
        F.when(F.col("full") | F.col("multiplier").isNull(), 0.0).otherwise(off).alias("off"),
    )


def multipliers(counts: DataFrame, goals: DataFrame, cap: int) -> DataFrame:
    """(key, source_size, target, mean, full, multiplier): the solved dual, one row per source.

    ``full`` sources are at their cap; a source with target 0 has no multiplier. Each job makes a few steps for all
    sources and writes one row per source; the driver reads the largest error alone.
    """
    shape = counts.filter(F.col("size") > 0).groupBy("key").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least")
    )
    start = goals.join(shape, "key", "left").withColumn("mean", F.coalesce("mean", F.lit(1.0)))
    scale = F.col("mean") / F.col("least")
    start = start.select(
        "key",
        "target",
        "source_size",
        "mean",
        (F.col("target") >= cap * F.col("source_size")).alias("full"),
        # exp(low * x) takes at most the target, exp(high * x) is at the cap for every document
        F.when(F.col("target") > 0, scale * F.least(F.log(F.col("target") / F.col("source_size")), F.lit(0.0)) - 1.0).alias("low"),
        (scale * math.log(cap) + 1.0).alias("high"),
        F.when(F.col("target") > 0, F.lit(0.0)).alias("multiplier"),
    )
    state = stored(start, "mix-start")
    for _ in range(MOST_JOBS):
        for _ in range(STEPS):
            state = _newton_step(counts, state.drop("off"), cap)
        state = stored(state, "mix-step")
        worst = state.agg(F.max("off")).first()[0]
        if worst is None or worst <= ERROR:
            return state.drop("off", "low", "high")
    raise ArithmeticError(f"the multipliers are still off by {worst:.3g} after {MOST_JOBS * STEPS} steps")


def copies_per_size(counts: DataFrame, solved: DataFrame, cap: int) -> DataFrame:
    """(key, size, n, copies, ...): how many copies all documents of a source and size give together.

    Fractions of equal sizes add up to whole copies; the remaining fractions are
    rounded along the sizes in descending order, each source's running sum
    deciding where the next whole copy falls, so errors cancel. What is left
    of the target is filled with, or taken from, the smallest documents.
    """
    by_size = Window.partitionBy("key").orderBy(F.desc("size"))
    rated = counts.join(solved, "key").withColumn("per_document", F.round(_rate(cap) * PARTS).cast("long"))
    rated = rated.withColumn("rate", F.col("per_document") / PARTS).withColumn("parts", F.col("n") * F.col("per_document"))
    rated = rated.withColumn("run", F.sum(F.pmod(F.col("parts"), F.lit(PARTS))).over(by_size.rowsBetween(Window.unboundedPreceding, 0)) + PARTS // 2)
    before = F.col("run") - F.pmod(F.col("parts"), F.lit(PARTS))
    whole = F.floor(F.col("parts") / PARTS) + F.floor(F.col("run") / PARTS) - F.floor(before / PARTS)
    rated = rated.withColumn("copies", F.least(whole, cap * F.col("n")))
    of_source = Window.partitionBy("key")
    rated = rated.withColumn("short", F.col("target") - F.sum(F.col("copies") * F.col("size")).over(of_source))
    room = F.when(F.col("short") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
    rated = rated.withColumn("room", F.when(F.col("size") > 0, room).otherwise(0))
    smaller = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    open_ = F.abs("short") - F.coalesce(F.sum(F.col("room") * F.col("size")).over(smaller), F.lit(0))
    moved = F.when(F.col("size") > 0, F.least(F.col("room"), F.greatest(F.floor(open_ / F.greatest("size", F.lit(1))), F.lit(0)))).otherwise(0)
    copies = F.col("copies") + F.when(F.col("short") > 0, moved).otherwise(-moved)
    return rated.select("key", "size", "n", copies.cast("long").alias("copies"), "source_size", "target", "rate")


def decided(docs: DataFrame, plan: MixPlan, text: str, source: str, doc_id: str) -> DataFrame:
    """(doc_id, key, size, code, n_rows, copies, ...): the copies of all rows that share id, source and text.

    Which documents of a source and size give the extra copies is decided by a
    hash of id and text, so reruns agree. A group is numbered in cells of that
    hash; each cell's share of the extra copies comes from the running count of
    the cells, at most ``CELLS`` rows. Repeated rows are one row with their number,
    combined before the shuffle.
    """
    rows = packed(docs, [doc_id], text=text, source=source, doc_id=doc_id)
    same = ["doc_id", "key", "size", "code"]
    rows = rows.select("doc_id", source_key(F.col("source")).alias("key"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("code"))
    rows = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("draw", F.xxhash64("doc_id", "code"))
    rows = stored(rows.withColumn("cell", F.pmod("draw", F.lit(CELLS))), "mix-sizes")
    cells = stored(rows.groupBy("key", "size", "cell").agg(F.sum("n_rows").alias("in_cell")), "mix-cells")
    counts = stored(cells.groupBy("key", "size").agg(F.sum("in_cell").alias("n")), "mix-counts")
    solved = multipliers(counts, targets(counts.select("key", (F.col("n") * F.col("size")).alias("size")), plan), plan.cap)
    shares = copies_per_size(counts, solved, plan.cap)
    upto = Window.partitionBy("key", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    split = cells.join(shares, ["key", "size"]).withColumn("upto", F.sum("in_cell").over(upto))
    extra = F.pmod("copies", "n")
    part = lambda count: F.floor(extra * count / F.col("n"))
    split = split.select(
        *["key", "size", "cell", "source_size", "target", "rate"],
        F.floor(F.col("copies") / F.col("n")).alias("each"),
        (part(F.col("upto")) - part(F.col("upto") - F.col("in_cell"))).alias("extra"),
    )
    before = Window.partitionBy("key", "size", "cell").orderBy("draw", "doc_id", "code").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(split, ["key", "size", "cell"])
    left = F.col("extra") - F.coalesce(F.sum("n_rows").over(before), F.lit(0))
    own = F.least(F.greatest(left, F.lit(0)), F.col("n_rows"))
    return placed.select(*same, "n_rows", "source_size", "target", "rate", (F.col("each") * F.col("n_rows") + own).cast("long").alias("copies"))


def mixed(docs: DataFrame, plan: MixPlan = MixPlan(), text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, key, size, source_size, target, rate, copies): one row per row of ``docs``."""
    found = decided(docs, plan, text, source, doc_id)
    place = F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")).alias("place")
    found = found.select("*", place)
    copies = F.floor(F.col("copies") / F.col("n_rows")) + F.when(F.col("place") <= F.pmod("copies", "n_rows"), 1).otherwise(0)
    return found.select("doc_id", "key", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"))


def mixture(docs: DataFrame, plan: MixPlan = MixPlan(), text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Of rows that repeat id, source and text, what is left after each was taken
    equally often falls to one of them.
    """
    found = decided(docs, plan, text, source, doc_id).filter(F.col("copies") > 0)
    names = {"doc_id": "of", "key": "of_key", "size": "of_size", "code": "of_code"}
    found = found.select(*[F.col(c).alias(n) for c, n in names.items()], F.floor(F.col("copies") / F.col("n_rows")).alias("each"), F.pmod("copies", "n_rows").alias("rest"))
    found = stored(found, "mix-copies")
    rows = packed(docs, text=text, source=source, doc_id=doc_id)
    rows = rows.select("row", "doc_id", source_key(F.col("source")).alias("key"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("code"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")) & (F.col("size") == F.col("of_size")) & (F.col("code") == F.col("of_code"))

    def repeated(met: DataFrame, times: str) -> DataFrame:
        return met.select("row", F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select("row.*")

    taken = repeated(rows.join(found.filter(F.col("each") > 0), same), "each")
    odd = found.filter(F.col("rest") > 0)
    if odd.isEmpty():
        return taken
    return taken.union(repeated(rows.join(odd, same).dropDuplicates(list(names.values())), "rest"))
