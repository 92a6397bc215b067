"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept and returns documents; the
last one returns the pieces of the sequences. Stages handle null and empty
texts, repeated rows, further columns and empty tables as the operators that
they call say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import best_fit, covering_simhash, entropy_mixing, line_rules, ordinal_toxicity
from tidemark.llm.frames import noted, removed, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and the others lose their lines above the limits; ``n_chars`` follows the text."""
    found = line_rules.cleaned(docs)
    changed = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return found.select(
        *[F.when(F.col("changed"), changed[c]).otherwise(F.col(f"row.{c}")).alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns]
    )


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go."""
    model = ordinal_toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return ordinal_toxicity.graded(docs, model).filter(~F.col("toxic")).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of op2 stays: three-word shingles, fingerprints that differ in at most three bits."""
    return covering_simhash.deduplicated(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return entropy_mixing.mixture(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their places in sequences."""
    return best_fit.packed_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", mixing_sources),
    ("best-fit packing", best_fit_packing),
]

#: Neither the fitted model nor the components and the packing can be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's result is written, and what came before it in the shared folder goes then."""
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        with noted() as written:
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        removed(spark, before + written[:-1])
        before = written[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
