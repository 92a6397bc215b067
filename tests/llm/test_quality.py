from __future__ import annotations

import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base(text):
    text = text or ""
    found = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(8)}
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def kept(rows, limits):
    """Brute force over (doc_id, text, source)."""
    folded = lambda line: " ".join(WORD.findall(line)).lower()
    have, size, across = defaultdict(set), defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        size[host].add(text or "")
        for line in (text or "").split("\n"):
            have[host, folded(line)].add(text or "")
            across[folded(line)].add(text or "")
    result = []
    for _, text, host in rows:
        gone = 0
        for line in (text or "").split("\n"):
            n = len(have[host, folded(line)])
            above = n > limits.min_documents and 100 * n > limits.host_percent * len(size[host])
            above |= limits.most_documents is not None and n > limits.most_documents
            above |= limits.most_across is not None and len(WORD.findall(line)) >= limits.long_words and len(across[folded(line)]) > limits.most_across
            if folded(line) and above:
                gone += len(WORD.findall(line))
        n_words, _, _, _, repeats = base(text)
        failed = n_words < 20 or 100 * repeats > 30 * n_words
        result.append(not failed and 100 * (n_words - gone) >= limits.least_percent_left * n_words)
    return result


def test_line_frequency_against_brute_force(documents):
    common = "This very common line stands in many of the pages here, again and again and again."
    own = lambda i: " ".join(f"word{i}x{k}" for k in range(30))
    rows = [(i, f"{common}\n{own(i)}", "a") for i in range(12)]
    rows += [(20 + i, f"{common}\n{common.upper()}\n{own(20 + i)[:30]} {i}", "a") for i in range(4)]  # depleted
    rows += [(40 + i, f"{common}\n{own(1)}", "b") for i in range(9)]  # copies: one document
    rows += [(60, own(60), None), (61, None, None), (62, "", "a")]
    limits = line_rules.LineLimits()
    found = {r["doc_id"]: r for r in line_rules.judged(documents(*rows), limits, keep=["doc_id"]).select("row.doc_id", *BASE, "kept").collect()}
    assert {k: r["kept"] for k, r in found.items()} == dict(zip([r[0] for r in rows], kept(rows, limits), strict=True))
    assert sum(not found[i]["kept"] for i in range(20, 24)) == 4 and found[40]["kept"] and found[0]["kept"]
    assert all(tuple(found[i][c] for c in BASE) == base(t) for i, t, _ in rows)


@settings(max_examples=12, deadline=None, derandomize=True)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "\n", " ", "é#", "d<"]), max_size=60).map(" ".join), min_size=1, max_size=20))
def test_base_measures(spark, texts):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    found = line_rules.measured(docs).select("row.doc_id", *BASE).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == {i: base(t) for i, t in enumerate(texts)}


def test_odd_rows(many):
    found = line_rules.judged(many)
    assert found.count() == many.count() and found.select("row.*").columns == many.columns
    assert line_rules.judged(many.limit(0)).count() == 0


def test_removed_lines_leave_the_text(documents):
    rows = [(i, f"Shared line with some words in it.\nOwn {i} " + "and more " * 12) for i in range(9)]
    found = line_rules.judged(documents(*rows))
    texts = found.select(line_rules.without_lines(found["row.text"], found["removed"]).alias("t")).collect()
    assert all(r.t.startswith("Own") for r in texts)


def test_a_line_in_many_documents_of_a_large_host(documents):
    # 1,001 of 14,000 documents of the host are 7 %
    own = lambda i: f"{i} " + " ".join(f"w{k}" for k in range(25))
    rows = [(i, own(i) + ("\nA hot line" if i < 1001 else ""), "host") for i in range(14_000)]
    found = line_rules.judged(documents(*rows), keep=["doc_id"]).filter("n_lines_removed > 0").select("row.doc_id").collect()
    assert {r.doc_id for r in found} == set(range(1001))
    fewer = line_rules.judged(documents(*rows[1:]), keep=["doc_id"]).filter("n_lines_removed > 0")
    assert fewer.count() == 0


def test_count_limits_remove_by_themselves(documents):
    passage = "A passage of more than eight words that stands on several hosts at once."
    own = lambda i: " ".join(f"word{i}x{k}" for k in range(30))
    rows = [(i, "\n".join([own(i), *["Hot short line"] * (i < 9), *[passage] * (i % 20 == 0)]), "large") for i in range(160)]
    rows += [(200 + i, f"{own(200 + i)}\n{passage}", f"small{i}") for i in range(3)]
    rows += [(300, f"{own(0)}\nHot short line\n{passage}", "small0")]  # a copy on another host
    removed = lambda limits: {r[0] for r in line_rules.judged(documents(*rows), limits).filter("n_lines_removed > 0").select("row.doc_id").collect()}
    assert removed(line_rules.LineLimits()) == set()  # nine of 160 are less than 8 %
    assert removed(line_rules.LineLimits(most_documents=9)) == set() and removed(line_rules.LineLimits(most_documents=8)) == set(range(9))
    having = set(range(0, 160, 20)) | {200, 201, 202, 300}
    assert removed(line_rules.LineLimits(most_across=11)) == set() and removed(line_rules.LineLimits(most_across=10)) == having
