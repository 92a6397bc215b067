"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w.x - t_k): the thresholds t_k ascend and share the
weights w, so one direction in feature space moves a text through all grades.
The output is the expected grade. Features are words and word beginnings that
the labelled sample has more often in toxic texts than chance allows; a text is
scanned once for all of them by an Aho-Corasick automaton.

Labels only tell toxic texts apart. The sample is halved by a hash of the texts,
and a toxic text's strength is the score that a model of the other half gives it;
the weakest third has grade 1, the strongest grade 3. So severity says how
strongly a text looks toxic to a model that has not seen it; nobody judged it.

Defined results: a null text has no features and gets the grade of a text
without any; without both classes among the labels nothing is learned and every
grade is 0; several labels of one document count as toxic if one is; repeated
rows get one result each; an empty table gives an empty result. Columns of the
input other than the named ones play no role.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import packed, stored

#: Highest grade.
GRADES = 3
_WORD = re.compile(r"[^\W\d_]+")
_STEM = 5


@dataclass(frozen=True)
class Fit:
    """The model is fitted on at most ``per_class`` labelled texts of each class, those with the least hashes of doc_id.

    At most ``features`` features of at least ``least_texts`` toxic texts and a z score of ``least_z`` are kept.
    """

    per_class: int = 3000
    features: int = 1000
    least_texts: int = 4
    least_z: float = 5.0
    penalty: float = 1e-4
    steps: int = 400


@dataclass(frozen=True)
class Model:
    """Features end with a blank if they are whole words; ``thresholds`` ascend."""

    features: tuple[str, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, from feature values (rows, features)."""
        return _sigmoid((x @ self.weights)[:, None] - self.thresholds[None, :])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def features_of(text: str | None) -> set[str]:
    """All features that a text could have."""
    found = set(_WORD.findall((text or "").lower()))
    return {w + " " for w in found} | {w[:_STEM] for w in found if len(w) >= _STEM}


class Scanner:
    """Counts the features of a model in a text."""

    def __init__(self, features: tuple[str, ...]) -> None:
        import ahocorasick

        self.size = len(features)
        self.automaton = ahocorasick.Automaton()
        forms: dict[str, list[tuple[int, bool]]] = {}
        for i, f in enumerate(features):
            forms.setdefault(f.rstrip(), []).append((i, f.endswith(" ")))
        for form, uses in forms.items():
            self.automaton.add_word(form, (len(form), uses))
        if forms:
            self.automaton.make_automaton()

    def counts(self, text: str | None) -> Counter[int]:
        found: Counter[int] = Counter()
        if not self.size or not text:
            return found
        low = text.lower()
        for end, (length, uses) in self.automaton.iter(low):
            start = end - length
            if start >= 0 and _WORD.match(low[start]):
                continue  # not at a word's start
            ends = end + 1 == len(low) or not _WORD.match(low[end + 1])
            for i, whole in uses:
                if ends or not whole:
                    found[i] += 1
        return found


def dense(rows: list[Counter[int]], size: int) -> np.ndarray:
    x = np.zeros((len(rows), size))
    for at, row in enumerate(rows):
        for i, n in row.items():
            x[at, i] = np.log1p(n)
    return x


def fit_ordinal(x: np.ndarray, grades: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds that minimise the penalised negative log-likelihood, by accelerated gradient steps.

    Thresholds are a first one and positive gaps, kept positive by their logarithms.
    """
    n, size = x.shape
    w, first, gaps = np.zeros(size), 0.0, np.zeros(GRADES - 1)
    params = np.concatenate((w, [first], gaps))
    mean, square = np.zeros_like(params), np.zeros_like(params)
    onehot = np.eye(GRADES + 1)[grades]
    for step in range(1, steps + 1):
        w, first, gaps = params[:size], params[size], params[size + 1 :]
        thresholds = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        above = _sigmoid((x @ w)[:, None] - thresholds)
        edges = np.hstack((np.ones((n, 1)), above, np.zeros((n, 1))))
        chance = np.maximum((onehot * (edges[:, :-1] - edges[:, 1:])).sum(1), 1e-12)
        slope = above * (1 - above)
        # d log chance / d (w.x - t_k): the edge below the grade raises it, the edge above lowers it
        pull = slope * (onehot[:, 1:] - onehot[:, :-1]) / chance[:, None]
        by_threshold = pull.sum(0) / n
        gradient = np.concatenate((
            -(x.T @ pull.sum(1)) / n + penalty * w,
            [by_threshold.sum()],
            np.exp(gaps) * np.cumsum(by_threshold[::-1])[::-1][1:],
        ))
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        params = params - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return params[:size], params[size] + np.concatenate(([0.0], np.cumsum(np.exp(params[size + 1 :]))))


def cross_grades(x: np.ndarray, toxic: np.ndarray, half: np.ndarray, fit: Fit) -> np.ndarray:
    """0 for texts that are not toxic; for the others the third of the strengths that models of the other halves give them.

    Where a half lacks a class there is nothing to tell strengths by, and all toxic texts have grade 1.
    """
    bad, strength = toxic == 1, np.zeros(len(toxic))
    for own in (0, 1):
        other = half != own
        if len(set(toxic[other].tolist())) == 2:
            weights, _ = fit_ordinal(x[other], GRADES * toxic[other], fit.penalty, fit.steps)
            strength[~other] = x[~other] @ weights
    lower, upper = np.quantile(strength[bad], [1 / 3, 2 / 3])
    return np.where(bad, 1 + (strength > lower).astype(int) + (strength > upper), 0)


NOTHING = Model((), np.zeros(0), np.full(GRADES, np.inf))


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), text: str = "text", doc_id: str = "doc_id") -> Model:
    """Fit the model on a bounded sample of the labelled documents.

    Feature counts are summed in the cluster; the driver gets at most
    ``features`` names and the sample's few hits.
    """
    rows = packed(docs, [], doc_id=doc_id, text=text)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.per_class) for c in (0, 1)]
    ids = drawn[0].union(drawn[1]).withColumnRenamed("doc_id", "of")
    # at most twice ``per_class`` ids
    sample = stored(rows.join(F.broadcast(ids), F.col("doc_id") == F.col("of")).select("text", "toxic"), "toxic-sample")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                found = sorted(features_of(value.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())], ["feature", "toxic"])

    n, n_toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_toxic < n:
        return NOTHING
    sums = sample.mapInArrow(name, "feature string, toxic int").groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad"))
    share, lift = F.col("n") / F.lit(float(n)), F.col("bad") / F.lit(float(n_toxic)) - (F.col("n") - F.col("bad")) / F.lit(float(n - n_toxic))
    spread = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / n_toxic + 1 / (n - n_toxic)))
    chosen = sums.filter(F.col("bad") >= fit.least_texts).withColumn("z", lift / spread).filter(F.col("z") >= fit.least_z)
    features = tuple(r["feature"] for r in chosen.orderBy(F.desc("z"), "feature").limit(fit.features).collect())
    if not features:
        return NOTHING
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    hits = _hits(sample.select((F.col("toxic").cast("long") + 2 * half).alias("key"), "text"), features).collect()
    counts = [Counter(dict(zip(r["at"], r["n"], strict=True))) for r in hits]
    keys = np.array([r["key"] for r in hits])
    grade = cross_grades(dense(counts, len(features)), keys % 2, keys // 2, fit)
    weights, thresholds = fit_ordinal(dense(counts, len(features)), grade, fit.penalty, fit.steps)
    return Model(features, weights, thresholds)


def _hits(rows: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """(key, at, n): which features each text has and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(features)
        for batch in batches:
            found = [sorted(scanner.counts(value.as_py()).items()) for value in batch.column("text")]
            at = pa.array([[i for i, _ in f] for f in found], pa.list_(pa.int32()))
            n = pa.array([[c for _, c in f] for f in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), at, n], ["key", "at", "n"])

    return rows.mapInArrow(run, "key long, at array<int>, n array<int>")


def graded(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` as ``row`` with ``severity`` (expected grade), ``p_toxic`` = P(grade > 0) and ``toxic``."""
    rows = packed(docs, keep, text=text)
    row_type = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model.features)
        for batch in batches:
            x = [scanner.counts(value.as_py()) for value in batch.column("text")]
            above = np.array([model.above(dense([c], scanner.size))[0] if c else blank for c in x]).reshape(len(x), GRADES)
            columns = [batch.column("row"), pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array(above[:, 0] >= 0.5)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "severity", "p_toxic", "toxic"])

    blank = model.above(np.zeros((1, len(model.features))))[0]
    return rows.mapInArrow(run, f"row {row_type}, severity double, p_toxic double, toxic boolean")
