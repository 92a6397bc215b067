"""Homomorphic multiset fingerprints of documents. Built-in functions only.

Each paragraph (a sentence, or what else of a line there is, with anything but
blanks, trimmed; a sentence ends at a stop before a blank) is hashed to a wide
vector of small odd numbers, one for each hexadecimal digit of two SHA-256
digests, and a document's fingerprint is the sum of its paragraphs' vectors
modulo 2^16. Sums do not depend on order, and a paragraph is added or taken
away by adding or subtracting its vector. The entries are symmetric about zero,
so the squared distance of two fingerprints estimates by how many paragraphs the
documents differ, and likeness is one minus its ratio to the distance that two
documents of these sizes without a common paragraph have.

Defined results: a null text is the empty text; a text without paragraphs has
the zero vector, like any other such text; documents follow each other by
doc_id, then a hash of the text, null ids last, and the last one is followed by
the first; rows that repeat id and text are one document; an empty table gives an empty result. Columns
of the input other than the named ones play no role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import let, packed, stored

#: Vector entries, and bits of each.
WIDTH, BITS = 128, 16
MODULUS = 1 << BITS


def paragraph_vector(paragraph: Column) -> Column:
    """``WIDTH`` odd numbers from -15 to 15."""
    digits = F.split(F.concat(F.sha2(paragraph, 256), F.sha2(F.concat(F.lit("#"), paragraph), 256)), "")
    return F.transform(F.slice(digits, 1, WIDTH), lambda c: 2 * F.position(c, F.lit("0123456789abcdef")) - 17)


def _wrapped(x: Column) -> Column:
    """The number from -2^15 to 2^15 - 1 that is congruent modulo 2^16."""
    return F.pmod(x + MODULUS // 2, F.lit(MODULUS)) - MODULUS // 2


def vector(text: Column) -> Column:
    """The sum of the vectors of a text's paragraphs."""
    cut = F.regexp_replace(F.coalesce(text, F.lit("")), "([.!?]) ", "$1\n")
    paragraphs = F.filter(F.transform(F.split(cut, "\n"), lambda p: F.trim(p)), lambda p: p != "")
    zero = F.array_repeat(F.lit(0), WIDTH)
    # no text has so many paragraphs that sums of numbers up to 15 pass 31 bits
    total = F.aggregate(paragraphs, zero, lambda total, p: F.zip_with(total, paragraph_vector(p), lambda a, b: a + b))
    return F.transform(total, _wrapped).cast("array<smallint>")


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The vector after adding (``sign`` 1) or removing (-1) the paragraphs behind ``b``."""
    return F.zip_with(a, b, lambda x, y: _wrapped(x.cast("int") + sign * y.cast("int")).cast("smallint"))


def printed(v: Column) -> Column:
    """The fingerprint: four hexadecimal digits per entry."""
    return F.concat_ws("", F.transform(v, lambda x: F.lower(F.lpad(F.hex(F.pmod(x.cast("int"), F.lit(MODULUS))), BITS // 4, "0"))))


def _squares(v: Column) -> Column:
    return F.aggregate(v, F.lit(0).cast("long"), lambda total, x: total + x.cast("long") * x)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal vectors; for others the estimated share of common paragraphs, 0 to 1."""
    apart = let(combined(a, b, -1), _squares)
    scale = F.greatest(_squares(a) + _squares(b), F.lit(1))
    return F.greatest(F.lit(0.0), F.lit(1.0) - apart.cast("double") / scale.cast("double"))


def followers(rows: DataFrame) -> DataFrame:
    """(id, code, size, next_id, next_code): the follower of each row in the order of (id, code), ids null last.

    Works on fixed-width columns. Rows are dealt by ranges of that order and
    written, so a row's range is fixed; inside a range the follower is a
    window's next row, and the last row of a range is followed by the first of
    the next range, from a table with one row per range.
    """
    order = [F.col("id").asc_nulls_last(), F.col("code")]
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "print-order")
    ahead = F.lead(F.struct("id", "code")).over(Window.partitionBy("part").orderBy(*order))
    first = dealt.groupBy("part").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "code")).alias("head"))
    by_part = Window.orderBy("part")
    begin = F.first("head").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = first.select(F.col("part").alias("of"), F.coalesce(F.lead("head").over(by_part), begin).alias("head"))
    found = dealt.withColumn("ahead", ahead).join(F.broadcast(heads), F.col("part") == F.col("of"))  # a row per partition
    given = lambda name: F.when(F.col("ahead").isNull(), F.col(f"head.{name}")).otherwise(F.col(f"ahead.{name}"))
    return found.select("id", "code", "size", given("id").alias("next_id"), given("code").alias("next_code"))


def compared(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Vectors of each document, its edited text and the next document, and the edited text's digest.

    In the edited text the last half of the code points is replaced by as many
    from the start of the next document. Each document meets the row before it
    in the order, which tells how much of its start that one needs; then that
    start and each document's own first half are sent to where the edited text
    is put together. Rows that repeat both id and text are one document until
    they are returned as often as they came.
    """
    base = packed(docs, [doc_id], text=text, doc_id=doc_id)
    base = base.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("code", F.xxhash64("text"))
    order = followers(base.select("id", "code", F.length("text").alias("size")).distinct())
    before = stored(order.withColumnsRenamed({"id": "prev_id", "code": "prev_code", "size": "prev_size"}), "print-links")
    met = base.join(before, F.col("id").eqNullSafe(F.col("next_id")) & (F.col("code") == F.col("next_code")))
    met = met.withColumn("size", F.length("text")).withColumn("vector", vector(F.col("text")))
    half = lambda size: F.floor(F.col(size) / 2).cast("int")
    own = F.struct(
        *[F.col("id"), F.col("code"), F.lit(1).alias("own"), F.col("size"), F.col("vector").alias("v")],
        F.left("text", F.col("size") - half("size")).alias("part"),
    )
    start = F.struct(
        *[F.col("prev_id").alias("id"), F.col("prev_code").alias("code"), F.lit(0).alias("own"), F.lit(0).alias("size"), F.col("vector").alias("v")],
        F.left("text", half("prev_size")).alias("part"),
    )
    sent = met.select(F.explode(F.array(own, start)).alias("r")).select("r.*")
    mine, other = F.col("own") == 1, F.col("own") == 0
    pick = lambda c, side: F.first(F.when(side, F.col(c)), ignorenulls=True)
    built = sent.groupBy("id", "code").agg(
        F.sum("own").alias("times"),
        F.max("size").alias("n_chars"),
        F.concat(pick("part", mine), pick("part", other)).alias("edited"),
        pick("v", mine).alias("vector"),
        pick("v", other).alias("next_vector"),
    )
    built = built.withColumn("edited_vector", vector(F.col("edited")))
    found = built.select(
        F.col("id").alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        *["vector", "edited_vector"],
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"),
    )
    return found.drop("copy")
