from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import entropy_mixing as mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def goals(size, plan):
    """Targets by the rule's own words: stop at the cap, share the excess again."""
    names = sorted((s for s in size if s is not None), key=str.encode) + [s for s in size if s is None]
    weight = {s: plan.weights[i % len(plan.weights)] for i, s in enumerate(names)}
    total, capped = plan.percent / 100 * sum(size.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(plan.cap * size[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * level > plan.cap * size[s]}
        if not above:
            return {s: plan.cap * size[s] if s in capped else weight[s] * level for s in names}
        capped |= above


def words(n):
    return " ".join(["w"] * n)


@pytest.mark.parametrize("plan", [mixing.MixPlan(), mixing.MixPlan(weights=(1, 9), percent=40), mixing.MixPlan(percent=250)])
def test_targets_rates_and_copies(documents, plan):
    sizes = {"a": [3, 4, 50, 7, 7, 7, 900], "b": [10] * 300 + [11], "é": list(range(1, 80)), "z": [5000, 1, 2, 3], "": [20, 30], None: [40, 41, 42], "none": [0, 0]}
    rows = [(1000 * i + k, words(n) if n else None, s) for i, (s, all_) in enumerate(sizes.items()) for k, n in enumerate(all_)]
    total = {s: sum(all_) for s, all_ in sizes.items()}
    target = goals(total, plan)
    docs = documents(*rows)
    found = mixing.mixed(docs, plan).collect()
    of = {r[0]: r for r in rows}
    assert sorted(r.doc_id for r in found) == sorted(of)
    taken = Counter()
    for r in found:
        source = of[r.doc_id][2]
        assert r.size == len(WORD.findall(of[r.doc_id][1] or "")) and r.source_size == total[source]
        assert r.target == pytest.approx(target[source]) and 0 <= r.copies <= plan.cap
        taken[source] += r.size * r.copies
    for s, all_ in sizes.items():
        assert abs(taken[s] - target[s]) <= max(50 if s != "z" else 5000, 0.01 * target[s])
        rates = {r.size: r.rate for r in found if of[r.doc_id][2] == s and r.size}
        if rates and target[s] < plan.cap * total[s]:  # exp(multiplier * size), cut at the cap, and the target in expectation
            assert sum(n * rates[n] for n in all_) == pytest.approx(target[s], rel=1e-5)
            order = [rates[n] for n in sorted(rates)]
            assert order in (sorted(order), sorted(order, reverse=True))
    again = mixing.mixed(docs.repartition(5), plan).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_mixture_keeps_columns_and_repeats_rows(documents):
    docs = documents(*[(i, words(5 + i % 7), "a" if i % 3 else None) for i in range(60)], (0, words(5), None), (None, words(9), "a"))
    found = mixing.mixture(docs)
    assert found.columns == docs.columns
    copies = Counter()
    for r in mixing.mixed(docs).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in found.collect()) == +copies


@pytest.mark.parametrize("doc_id", [1, None])
def test_repeated_rows_share_the_copies(documents, doc_id):
    # 600 equal rows of one source beside others: each of the others' sources has too few words, so "a" is below its cap
    docs = documents(*[(doc_id, words(10), "a")] * 600, (2, words(10), "a"), *[(100 + i, words(10), "b") for i in range(900)])
    found = mixing.mixed(docs).collect()
    assert len(found) == 1501
    for of in (lambda r: r.key == "=a", lambda r: r.key == "=b"):
        taken = sum(r.size * r.copies for r in found if of(r))
        target = next(r.target for r in found if of(r))
        assert abs(taken - target) <= 10 and taken < 2 * next(r.source_size for r in found if of(r)) or target == taken
        assert {r.copies for r in found if of(r)} <= {0, 1, 2}
    chosen = Counter(r.source for r in mixing.mixture(docs).collect())
    assert chosen == {s: sum(r.copies for r in found if r.key == f"={s}") for s in "ab"}


def test_multipliers_that_do_not_converge_are_an_error(documents, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_JOBS", 1)
    monkeypatch.setattr(mixing, "STEPS", 1)
    docs = documents(*[(i, words(1 + i % 50), "ab"[i % 2]) for i in range(100)])
    with pytest.raises(ArithmeticError, match="still off"):
        mixing.mixed(docs, mixing.MixPlan(weights=(1, 9), percent=40))


def test_odd_rows(many):
    assert mixing.mixed(many).count() == many.count()
    assert mixing.mixed(many.limit(0)).count() == 0 and mixing.mixture(many.limit(0)).count() == 0
