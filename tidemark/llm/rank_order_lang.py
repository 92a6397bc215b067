"""Language identification by rank-order profiles of character n-grams.

A text's letters are lower-cased and everything between them becomes one word
mark. Its n-grams of one to three characters are ranked by frequency; for each
language the out-of-place distance adds up how far the ranks of the text's most
frequent n-grams are from their ranks in the language's profile, and the
smallest distance wins.

Defined results: a text that is null or has no letter is ``und`` with score 0;
equal distances go to the language that comes first by code point; ties in
frequency are ranked by n-gram; without any learned language every text is
``und``; repeated rows get one result each; an empty table gives an empty
result. Columns of the input other than the named ones play no role.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import packed, stored

UNKNOWN = "und"
#: n-grams in a profile, and those of a text that are compared with it.
PROFILE, COMPARED = 400, 300
#: The mark of a word's start and end among code points.
MARK = 1
_CODE = 21
_DRAWS = 1 << 20


@dataclass(frozen=True)
class Sample:
    """Profiles are learned from at most ``per_language`` texts of each language, those with the least hashes of doc_id.

    More than ``languages`` different languages are an error: a column with so many values names something else, and what
    is broadcast and collected has a row per language.
    """

    per_language: int = 1000
    languages: int = 1000


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as numbers, ascending, and how often each occurs."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    codes = np.where(_letters()[codes], codes, MARK) if len(codes) else codes
    codes = np.concatenate(([MARK], codes, [MARK]))
    mark = codes == MARK
    codes = codes[~(mark & np.concatenate(([False], mark[:-1])))]
    mark = codes == MARK
    pairs = (codes[:-1] << _CODE) | codes[1:]
    triples = (pairs[:-1] << _CODE) | codes[2:]
    return np.unique(np.concatenate((codes[~mark], pairs, triples[~mark[1:-1]])), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams, in order of rank."""
    return grams[np.lexsort((grams, -counts))[:most]]


@dataclass(frozen=True)
class Profile:
    """A language's n-grams ascending, with the rank of each."""

    lang: str
    grams: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, lang: str, by_rank: np.ndarray) -> Profile:
        order = np.argsort(by_rank)
        return cls(lang, by_rank[order], order)

    def distance(self, by_rank: np.ndarray) -> int:
        """Out-of-place distance; an n-gram that the profile lacks counts the profile's length."""
        at = np.minimum(np.searchsorted(self.grams, by_rank), len(self.grams) - 1)
        apart = np.abs(self.ranks[at] - np.arange(len(by_rank)))
        return int(np.where(self.grams[at] == by_rank, np.minimum(apart, PROFILE), PROFILE).sum())


def predicted(text: str | None, profiles: list[Profile]) -> tuple[str, float]:
    """The language, and how much of the largest possible distance the text stays below."""
    grams, counts = gram_counts(text)
    by_rank = ranked(grams, counts, COMPARED)
    if len(grams) < 3 or not profiles:  # one letter alone gives itself, two pairs and a triple
        return UNKNOWN, 0.0
    distance, lang = min((p.distance(by_rank), p.lang) for p in profiles)
    return lang, 1.0 - distance / (PROFILE * len(by_rank))


def learn(docs: DataFrame, sample: Sample = Sample(), text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> list[Profile]:
    """One profile per language of ``docs``; rows without language or text are left out.

    The sample is chosen from ids alone, counted in the tasks and summed in the
    cluster; the driver gets at most ``PROFILE`` n-grams of a language.
    """
    rows = packed(docs, [], doc_id=doc_id, text=text, lang=lang).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = stored(rows.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    if counts.limit(sample.languages + 1).count() > sample.languages:
        raise ValueError(f"{lang} has more than {sample.languages} different values")
    ids = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("draw"))
    # by the least hashes alone some twice as many as wanted are left before they are shuffled, so that no task gets all
    # rows of a language; the counts are a row per language
    ids = ids.join(F.broadcast(counts), F.col("lang") == F.col("of")).filter(F.pmod("draw", F.lit(_DRAWS)) * F.col("n") < 2 * sample.per_language * _DRAWS)
    drawn = Window.partitionBy("lang").orderBy(F.pmod("draw", F.lit(_DRAWS)), "draw", "doc_id")
    drawn_ids = ids.withColumn("place", F.row_number().over(drawn)).filter(F.col("place") <= sample.per_language).select(F.col("doc_id").alias("of"), F.col("lang").alias("in")).distinct()
    # at most ``per_language`` ids of each language
    chosen = rows.join(F.broadcast(drawn_ids), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("lang") == F.col("in"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                grams, counts = gram_counts(value.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])

    sums = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = sums.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= PROFILE).collect()
    found: dict[str, list[tuple[int, int]]] = {}
    for r in best:
        found.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return [Profile.of(name, np.array([g for _, g in sorted(rows)], dtype=np.int64)) for name, rows in sorted(found.items())]


def identified(docs: DataFrame, profiles: list[Profile], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score): one row per row of ``docs``, from its whole text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predicted(value.as_py(), profiles) for value in batch.column("text")]
            langs, scores = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    needed = packed(docs, [], doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    return needed.mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(doc_id: str = "doc_id"):
    """The fold of a document, 0 to 3; a null id has none."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))
