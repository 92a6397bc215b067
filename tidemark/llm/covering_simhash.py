"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit set where over half of the text's shingle hashes have
it. For a radius r every bit position gets a nonzero vector m of r + 1 bits, and
each nonzero v of r + 1 bits is one table whose mask keeps the positions with
odd <m, v>. The vectors of any r differing positions span at most r dimensions,
so some v is orthogonal to all of them and that table's mask hides every
difference: all pairs within the radius meet in at least one of the 2^(r+1) - 1
tables, each of which still compares about half of the bits.

Defined results: a text without words, null included, has fingerprint zero and
links like any other; a component's id is the smallest doc_id of its rows, null
where all are null; repeated rows get one result each; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.frames import packed, stored

BITS = 64
#: A bucket up to this many different fingerprints is compared directly; larger ones go through midpoints.
DIRECT = 1024


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - shingle + 1)
    last = ends[min(shingle, len(found)) - 1 :]
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None, hashed: bool = False
) -> DataFrame:
    """(row, doc_id, fp): one row per row of ``docs``, ``row`` with the columns ``keep`` (all), absent for an empty list.

    Where ``hashed``, a column ``key`` of the id and the text is added.
    """
    rows = packed(docs, keep, doc_id=doc_id, text=text)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    if hashed:
        rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    carried = [c for c in rows.columns if c != "text"]
    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint_of(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(fps, pa.int64())], [*carried, "fp"])

    return rows.mapInArrow(run, f"{types}, fp long")


def masks(radius: int) -> list[int]:
    """The covering masks, as signed 64-bit numbers."""
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(BITS)]
    kept = ((i for i in range(BITS) if (vectors[i] & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1)))
    return [int(np.uint64(sum(1 << i for i in bits)).astype(np.int64)) for bits in kept]


def spanning_links(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within the radius that join what any links within the radius join: a spanning forest of one bucket."""
    near = np.bitwise_count((members[:, None] ^ members[None, :]).view(np.uint64)) <= radius
    free = np.ones(len(members), dtype=bool)
    links = []
    for first in range(len(members)):
        if not free[first]:
            continue
        free[first] = False
        reached = [first]
        while reached:
            at = reached.pop()
            for other in np.flatnonzero(near[at] & free).tolist():
                free[other] = False
                reached.append(other)
                links.append((int(members[at]), int(members[other])))
    return links


def _ball(radius: int) -> np.ndarray:
    """All 64-bit numbers with at most ``radius`` bits set, fewest bits first."""
    layers = [np.zeros(1, dtype=np.uint64)]
    single = np.left_shift(np.uint64(1), np.arange(BITS, dtype=np.uint64))
    for _ in range(radius):
        grown = np.unique((layers[-1][:, None] | single[None, :]).ravel())
        layers.append(grown[np.bitwise_count(grown) == len(layers)])
    return np.concatenate(layers)


def _direct_links(buckets: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [x for fps in batch.column("fps") for x in spanning_links(fps.values.to_numpy(zero_copy_only=False), radius)]
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return buckets.mapInArrow(run, "a long, b long")


def _midpoint_links(hot: DataFrame, radius: int) -> DataFrame:
    """Links among the fingerprints of oversized buckets without comparing them with each other.

    Two numbers within the radius have a midpoint z that is within half the
    radius, rounded down, of one and rounded up of the other. Each fingerprint
    names the z around it, and at each z all are linked to the smallest of the
    nearer ones. At most as many different fingerprints meet at one z as the
    ball around it holds, so no group grows with the data.
    """
    near, far = radius // 2, radius - radius // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = _ball(far)
        close = np.bitwise_count(offsets) <= near
        for batch in batches:
            for fp in batch.column("fp").to_numpy(zero_copy_only=False):
                z = (offsets ^ np.int64(fp).view(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(z), pa.array(close), pa.array(np.full(len(z), fp))], ["z", "close", "fp"])

    at = hot.mapInArrow(run, "z long, close boolean, fp long")
    met = at.groupBy("z").agg(F.min(F.when(F.col("close"), F.col("fp"))).alias("hub"), F.collect_set("fp").alias("fps"))
    met = met.filter(F.col("hub").isNotNull() & (F.size("fps") > 1))
    return met.select(F.explode("fps").alias("a"), F.col("hub").alias("b")).filter(F.col("a") != F.col("b")).distinct()


def links(prints: DataFrame, radius: int = 3, direct: int = DIRECT) -> DataFrame:
    """(a, b): links between different fingerprints ``fp`` within ``radius`` bits, enough to join all that any link joins.

    Bucket sizes come from counts that combine before the shuffle, so an
    oversized bucket is known before anybody gathers it.
    """
    tables = F.explode(F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for v, m in enumerate(masks(radius))]))
    rows = prints.select("fp").distinct().select("fp", tables.alias("t")).select("fp", "t.v", "t.key")
    sizes = rows.groupBy("v", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    shared = stored(rows.join(sizes, ["v", "key"]), "simhash-buckets")
    small = shared.filter(F.col("n") <= direct).groupBy("v", "key").agg(F.collect_list("fp").alias("fps"))
    hot = shared.filter(F.col("n") > direct).select("fp").distinct()
    return _direct_links(small.select("fps"), radius).union(_midpoint_links(hot, radius)).distinct()


def components(prints: DataFrame, radius: int, direct: int, first: Column) -> DataFrame:
    """(fp, first): for each fingerprint of ``prints`` the least ``first`` of all rows in its component.

    Equal fingerprints are one node, and only nodes with a link take part in the
    component search. The result is written before it meets any rows, so that
    nothing but a join stands between the shuffle and the result and Spark can
    split a fingerprint that very many rows share.
    """
    classes = prints.groupBy("fp").agg(F.min(first).alias("first"))
    roots = connected_components(links(prints, radius, direct)).withColumnRenamed("node", "fp")
    linked = classes.join(roots, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    joined = stored(linked.join(least, "root").select("fp", "least"), "simhash-components")
    return stored(classes.join(joined, "fp", "left").select("fp", F.coalesce("least", "first").alias("first")), "simhash-ids")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text", doc_id: str = "doc_id", direct: int = DIRECT) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``."""
    prints = stored(fingerprints(docs, shingle, text, doc_id, keep=[]), "simhash")
    ids = components(prints, radius, direct, F.col("doc_id"))
    return prints.join(ids, "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def deduplicated(docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text", doc_id: str = "doc_id", direct: int = DIRECT) -> DataFrame:
    """The rows of ``docs`` with one row of each component: that of the smallest doc_id, null ids last, once where rows repeat it.

    Texts are read twice and shuffled at most once: ids, fingerprints and one
    hash of id and text are all that the search has of a document.
    """
    prints = stored(fingerprints(docs, shingle, text, doc_id, keep=[], hashed=True), "simhash")
    kept = components(prints, radius, direct, F.struct(F.col("doc_id").isNull(), "doc_id", "key")).select("first.key").distinct()
    rows = packed(docs, doc_id=doc_id, text=text).select("row", F.xxhash64(F.col("doc_id").cast("long"), "text").alias("key"))
    return rows.join(stored(kept, "simhash-kept"), "key").dropDuplicates(["key"]).select("row.*")


def hex_digits(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
