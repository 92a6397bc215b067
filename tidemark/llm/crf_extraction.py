"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is a sequence of blocks (``page_blocks``), each main text or not. A
block's score is the sum of the weights of its features: the elements around it,
the words of their classes, the order of sectioning elements, and the form of its
text (length, share of links, punctuation, frequent words of the training
pages). Neighbouring labels have weights of their own, apart for blocks of the
same and of different parents. Weights maximise the likelihood of labelled pages
(forward-backward, all pages at once), and Viterbi finds the best labels of a page.

No table here has labels, so the pages of training are laid out at random by
``page_layouts``, where labels are known. The model does not depend on the pages
it is applied to; a page's result never depends on other rows.

Defined results: a null or empty page, and one without main text, has an empty
text; repeated rows get one result each; an empty table gives an empty result.
Pages are read whole, blocks of any length are kept whole, and columns of the
input other than the named ones play no role.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import packed
from tidemark.llm.page_blocks import Block, Element, blocks
from tidemark.llm.page_layouts import LabelledPage, labelled_pages

_SECTIONS = frozenset(("main", "article", "aside", "nav", "header", "footer", "form", "section"))
_WORD = re.compile(r"[^\W\d_]+")
#: Texts of up to so many words are looked at word by word.
_SHORT = 30
#: Upper bounds of the classes of length (words).
_LENGTHS = (1, 2, 4, 8, 15, 30, 80)


@dataclass(frozen=True)
class Fit:
    """The model is fitted on ``pages`` labelled pages; features and words that occur in fewer blocks are left out."""

    pages: int = 1500
    seed: int = 3
    least_blocks: int = 3
    least_word: int = 8
    penalty: float = 0.02
    steps: int = 150
    rate: float = 0.15


@dataclass(frozen=True)
class Model:
    """``weights`` of features for main text; ``links[same parent][from][to]`` of neighbouring labels; ``first`` of the first label."""

    weights: dict[str, float]
    links: np.ndarray
    first: np.ndarray


def place_features(around: tuple[Element, ...]) -> list[str]:
    """What the elements around a block say: each counts once, the innermost named ones also by themselves."""
    found = {f"tag {name}" for name, _ in around} | {f"name {w}" for _, words in around for w in words}
    named = [words for _, words in around if words]
    found |= {f"inner {w}" for w in (named[-1] if named else ())} | {f"next {w}" for w in (named[-2] if len(named) > 1 else ())}
    sections = [name for name, _ in around if name in _SECTIONS]
    found.add("sections " + ">".join(dict.fromkeys(sections[-3:])))
    found |= {f"leaf {around[-1][0]}", f"parent {around[-2][0]}" if len(around) > 1 else "parent"} if around else {"leaf"}
    return sorted(found)


def text_features(block: Block) -> list[str]:
    text = block.text
    n = text.count(" ") + 1
    found = ["any", f"length {sum(n > most for most in _LENGTHS)}"]
    share = block.linked / max(1, len(text) - n + 1)
    found.append(f"linked {0 if not share else 1 if share < 0.3 else 2 if share < 0.9 else 3}")
    found.append("stop" if text[-1] in ".!?:;" else "no stop")
    if "©" in text:
        found.append("copyright")
    if n <= _SHORT:
        found += sorted({f"word {w}" for w in _WORD.findall(text.lower())})
    return found


def same_parent(one: Block, other: Block) -> bool:
    return one.around[:-1] == other.around[:-1]


class _Batch:
    """All pages at once, longer ones first: features as flat indexes, labels and scores as (page, place)."""

    def __init__(self, pages: list[LabelledPage], fit: Fit) -> None:
        found = [(blocks(p.html), p.labels) for p in pages]
        found = sorted(((b, labels) for b, labels in found if b), key=lambda x: -len(x[0]))
        for b, labels in found:
            if len(b) != len(labels):
                raise ValueError("a labelled page has another number of blocks than labels")
        rows = [place_features(b.around) + text_features(b) for page, _ in found for b in page]
        counts = Counter(f for row in rows for f in row)
        self.names = sorted(f for f, n in counts.items() if n >= (fit.least_word if f.startswith("word ") else fit.least_blocks))
        index = {f: i for i, f in enumerate(self.names)}
        flat = [(r, index[f]) for r, row in enumerate(rows) for f in row if f in index]
        self.rows, self.features = (np.array(x) for x in zip(*flat, strict=True))
        lengths = np.array([len(b) for b, _ in found])
        n, longest = len(found), int(lengths.max())
        self.inside = np.arange(longest)[None, :] < lengths[:, None]
        self.labels = np.zeros((n, longest), dtype=np.int64)
        self.labels[self.inside] = [label for _, labels in found for label in labels]
        self.same = np.zeros((n, longest), dtype=np.int64)
        self.same[self.inside] = [int(i > 0 and same_parent(page[i - 1], page[i])) for page, _ in found for i in range(len(page))]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def likelihood(scores: np.ndarray, same: np.ndarray, inside: np.ndarray, labels: np.ndarray, links: np.ndarray, first: np.ndarray):
    """The log-likelihood of ``labels``, and its gradients by scores, links and first.

    ``scores`` (page, place) are those of main text, other blocks have 0; ``same``
    says which link weights lead to a place, ``inside`` which places exist. Longer
    pages come first, so the pages that have a place are the first ones.
    """
    n, longest = scores.shape
    emit = np.stack([np.zeros_like(scores), scores], axis=2)
    step = links[same]  # (page, place, from, to)
    ahead = np.zeros((n, longest, 2))
    ahead[:, 0] = first + emit[:, 0]
    having = inside.sum(axis=0)
    for t in range(1, longest):
        here = slice(having[t])
        ahead[here, t] = _log_sum(ahead[here, t - 1, :, None] + step[here, t], axis=1) + emit[here, t]
    total = _log_sum(ahead[np.arange(n), inside.sum(axis=1) - 1], axis=1)
    behind = np.zeros((n, longest, 2))
    for t in range(longest - 2, -1, -1):
        here = slice(having[t + 1])
        behind[here, t] = _log_sum(step[here, t + 1] + (emit[here, t + 1] + behind[here, t + 1])[:, None, :], axis=2)
    single, pair = np.zeros_like(emit), np.zeros_like(step[:, 1:])
    single[inside] = np.exp((ahead + behind)[inside] - np.repeat(total, inside.sum(axis=1))[:, None])
    led = inside[:, 1:]
    pair[led] = np.exp(ahead[:, :-1][led][:, :, None] + step[:, 1:][led] + (emit + behind)[:, 1:][led][:, None, :] - np.repeat(total, led.sum(axis=1))[:, None, None])
    truth = np.eye(2)[labels] * inside[:, :, None]
    true_pair = truth[:, :-1, :, None] * truth[:, 1:, None, :]
    by_links = np.stack([((true_pair - pair) * (same[:, 1:] == c)[:, :, None, None]).sum(axis=(0, 1)) for c in (0, 1)])
    value = (truth * emit).sum() + (true_pair * step[:, 1:]).sum() + (truth[:, 0] * first).sum() - total.sum()
    return value, (truth - single)[:, :, 1], by_links, (truth[:, 0] - single[:, 0]).sum(axis=0)


@lru_cache(maxsize=4)
def learn(fit: Fit = Fit()) -> Model:
    """Maximises the penalised likelihood of the labelled pages by steps of adaptive size, from zero; equal arguments give equal models."""
    batch = _Batch(labelled_pages(fit.pages, fit.seed), fit)
    n = len(batch.names)
    x = np.zeros(n + 8 + 2)
    mean, square = np.zeros_like(x), np.zeros_like(x)
    scores = np.zeros(batch.inside.shape)
    for step in range(1, fit.steps + 1):
        weights, links, first = x[:n], x[n : n + 8].reshape(2, 2, 2), x[n + 8 :]
        scores[batch.inside] = np.bincount(batch.rows, weights[batch.features], minlength=int(batch.inside.sum()))
        _, by_score, by_links, by_first = likelihood(scores, batch.same, batch.inside, batch.labels, links, first)
        by_weight = np.bincount(batch.features, by_score[batch.inside][batch.rows], minlength=n)
        slope = np.concatenate([by_weight, by_links.ravel(), by_first]) - fit.penalty * x
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        size = fit.rate * (1 - step / (fit.steps + 1))
        x = x + size * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return Model(dict(zip(batch.names, x[:n].tolist(), strict=True)), x[n : n + 8].reshape(2, 2, 2), x[n + 8 :])


def viterbi(scores: list[float], same: list[bool], links: list, first: list) -> list[bool]:
    """The most likely labels for the blocks' scores; among equals, other text rather than main text."""
    if not scores:
        return []
    other, main = first[0], first[1] + scores[0]
    back = []
    for score, alike in zip(scores[1:], same[1:], strict=True):
        (oo, om), (mo, mm) = links[alike]
        from_other, from_main = other + oo >= main + mo, other + om >= main + mm
        back.append((from_other, from_main))
        other, main = (other + oo if from_other else main + mo), (other + om if from_main else main + mm) + score
    now = main > other
    found = [now]
    for from_other, from_main in reversed(back):
        now = not (from_main if now else from_other)
        found.append(now)
    return found[::-1]


class Extractor:
    """Applies a model to pages; scores of places are kept, as pages of a site share them."""

    def __init__(self, model: Model, most_places: int = 50_000) -> None:
        self.weights, self.links, self.first = model.weights, model.links.tolist(), model.first.tolist()
        self.places: dict[tuple[Element, ...], float] = {}
        self.most_places = most_places

    def score(self, block: Block) -> float:
        place = self.places.get(block.around)
        if place is None:
            if len(self.places) >= self.most_places:
                self.places.clear()
            place = self.places[block.around] = sum(self.weights.get(f, 0.0) for f in place_features(block.around))
        return place + sum(self.weights.get(f, 0.0) for f in text_features(block))

    def labels(self, found: list[Block]) -> list[bool]:
        same = [i > 0 and same_parent(found[i - 1], b) for i, b in enumerate(found)]
        return viterbi([self.score(b) for b in found], same, self.links, self.first)

    def text(self, page: str | None) -> str:
        found = blocks(page)
        return "\n".join(b.text for b, main in zip(found, self.labels(found), strict=True) if main)


def extracted(pages: DataFrame, model: Model, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """(row, text, n_chars): one row per page, ``row`` with the columns ``keep`` (all)."""
    rows = packed(pages, keep, html=html).withColumn("html", F.col("html").cast("string"))
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Extractor(model)
        for batch in batches:
            texts = [reader.text(page.as_py()) for page in batch.column("html")]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), lengths], ["row", "text", "n_chars"])

    return rows.mapInArrow(run, f"row {kind}, text string, n_chars long")
