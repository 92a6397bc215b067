from __future__ import annotations

import re
import zlib

import numpy as np
import pytest

from tidemark.llm import license_digests, ordinal_toxicity, queries, rank_order_lang, url_vocabulary

# ---- URL filters


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0].translate({c: c + 32 for c in range(65, 91)})
    path = re.split(r"[?#]", rest[len(host) :])[0]
    fits = [(len(r), r, v) for r, v in url_vocabulary.Rules().entries for d, s in [r.split("/", 1)] if (host == d or host.endswith("." + d)) and path.startswith("/" + s)]
    rule, verdict = max(fits)[1:] if fits else (None, None)
    from urllib.parse import unquote

    known = url_vocabulary.Vocabulary()
    tokens = set(re.findall(r"[^\W_]+", unquote(url or "").lower()))
    soft = {t: w for t, w in known.soft if t in tokens}
    blocked = tokens & set(known.strict) or len(soft) >= 2 and sum(soft.values()) >= known.limit
    return host, path, rule, verdict or ("block" if blocked else "allow")


def test_urls(spark):
    urls = [
        *[None, "", "no scheme example.org/es/", "http://", "http://example.org", "https://Example.ORG/es/x?y#z", "http://a.example.org/en/1", "x://b.com"],
        *["http://b.com/fr/1", "http://b.com/de/1", "http://bcom/de/1", "http://org/", "http://x.net/xxx/1", "http://x.net/axxx/1", "http://x.net/XXX", "ftp://x.net/%78xx"],
        *["http://free.net/casino", "http://free.net/freedom", "http://free.net/free-free", "http://x.net?poker=1#bet", "http://x.org/porn", "a://b://c.org/es/"],
        *["http://example.org/en/1", "http://example.org?/en/1", "http://myexample.org/es/", "http://ÉX.net/hot_sex", "http://x.net/" + "a/" * 20000 + "porn", "http://x.net/%ff"],
        *["http://x.net/free/track", "http://x.net/win-farm-hot", "http://x.net/poker", "http://x.net/poker/poker", "http://x.net/free-bets"],
    ]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls + urls[:3])], "page_id long, url string, html string, verdict string")
    found = url_vocabulary.filtered(pages, keep=["page_id"]).select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert {r[0]: tuple(r)[1:] for r in found} == {i: plain_verdict(u) for i, u in enumerate(urls + urls[:3])}
    assert url_vocabulary.filtered(pages.limit(0)).count() == 0
    assert url_vocabulary.filtered(pages).select("row.*").columns == pages.columns


def test_vocabulary_from_a_table(spark):
    terms = spark.createDataFrame([(" Strict ", None), ("a1", 2), ("a1", 1), ("b2", 1), ("strict", 5), ("", 1), (None, 1)], "term string, weight int")
    known = url_vocabulary.vocabulary_of(terms)
    assert known.strict == ("strict",) and known.soft == (("a1", 2), ("b2", 1))
    scan = url_vocabulary.TermScanner(known)
    assert [scan(u) for u in ("x://STRICT", "x/a1-b2", "x/a12", None)] == [(1, 0, 0), (0, 2, 3), (0, 0, 0), (0, 0, 0)]
    with pytest.raises(ValueError, match="more than 2 terms"):
        url_vocabulary.vocabulary_of(terms, most_terms=2)
    assert url_vocabulary.TermScanner(url_vocabulary.Vocabulary((), ()))("x") == (0, 0, 0)


# ---- toxicity


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    x = rng.poisson(0.7, (3000, 4)).astype(float)
    true = np.array([1.5, 0.8, 0.0, -0.4])
    grade = (x @ true + rng.logistic(size=3000) > np.array([1.0, 2.5, 4.0])[:, None]).sum(0)
    weights, thresholds = ordinal_toxicity.fit_ordinal(x, grade, 1e-4, 600)
    assert np.abs(weights - true).max() < 0.25 and (np.diff(thresholds) > 0).all()
    model = ordinal_toxicity.Model(tuple("abcd"), weights, thresholds)
    expected = model.above(x).sum(1)
    means = [expected[grade == g].mean() for g in range(4)]
    assert means == sorted(means)


def test_grades_are_thirds_of_strengths_by_the_other_half():
    rng = np.random.default_rng(2)
    toxic = rng.integers(0, 2, 900)
    x = np.stack([rng.poisson(0.2 + 2 * toxic), rng.poisson(0.5, 900)], axis=1).astype(float)
    half = rng.integers(0, 2, 900)
    fit = ordinal_toxicity.Fit()
    grade = ordinal_toxicity.cross_grades(x, toxic, half, fit)
    assert (grade[toxic == 0] == 0).all() and set(grade[toxic == 1].tolist()) == {1, 2, 3}
    for own in (0, 1):
        w, _ = ordinal_toxicity.fit_ordinal(x[half != own], 3 * toxic[half != own], fit.penalty, fit.steps)
        mine = (half == own) & (toxic == 1)
        order = (x @ w)[mine]
        assert order[grade[mine] == 1].max() <= order[grade[mine] == 3].min()
    one_sided = ordinal_toxicity.cross_grades(x, toxic, np.zeros(900, dtype=int), fit)
    assert set(one_sided[toxic == 1].tolist()) == {1}


def test_toxicity_learns_and_scores(spark, documents, many):
    rng = np.random.default_rng(1)
    neutral = [f"mot{chr(97 + i)}{chr(97 + k)}" for i in range(20) for k in range(20)]
    text = lambda bad: " ".join([*rng.choice(neutral, 60), *(["Idiot!"] * bad), *(["vermin" + "ous"] * (bad > 2))])
    rows = [(i, text(i % 5 if i % 2 else 0)) for i in range(400)]
    docs = documents(*rows)
    labels = spark.createDataFrame([(i, 1, int("Idiot" in t)) for i, t in rows if i < 300] + [(0, 1, None), (None, 1, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    model = ordinal_toxicity.learn(docs, labels)
    assert "idiot " in model.features
    found = {r[0]: r for r in ordinal_toxicity.graded(docs, model, keep=["doc_id"]).select("row.doc_id", "severity", "p_toxic", "toxic").collect()}
    assert np.mean([found[i].toxic == ("Idiot" in t) for i, t in rows if i >= 300]) > 0.97
    for i, t in rows[:80]:  # the formula, from features found by other means
        low = t.lower()
        n = np.array([len(re.findall(rf"(?<![^\W\d_]){re.escape(f.rstrip())}" + (r"(?![^\W\d_])" if f.endswith(" ") else ""), low)) for f in model.features])
        p = 1 / (1 + np.exp(model.thresholds - np.log1p(n) @ model.weights))
        assert found[i].severity == pytest.approx(p.sum()) and found[i].p_toxic == pytest.approx(p[0])
    assert ordinal_toxicity.graded(many, model).count() == many.count()
    assert ordinal_toxicity.graded(many, model).select("row.*").columns == many.columns
    assert ordinal_toxicity.graded(many.limit(0), model).count() == 0
    nothing = ordinal_toxicity.learn(docs, labels.limit(0))
    assert {r.severity for r in ordinal_toxicity.graded(docs, nothing).select("severity").collect()} == {0.0}
    assert ordinal_toxicity.learn(docs.limit(0), labels) == ordinal_toxicity.NOTHING


# ---- language


def plain_grams(text):
    import itertools
    from collections import Counter

    words = ["".join(g) for letter, g in itertools.groupby((text or "").lower(), str.isalpha) if letter]
    if not words:
        return []
    marked = "\x01" + "\x01".join(words) + "\x01"
    grams = [marked[i : i + n] for n in (1, 2, 3) for i in range(len(marked) - n + 1)]
    counts = Counter(g for g in grams if g != "\x01" and not (len(g) == 3 and g[1] == "\x01"))
    number = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return sorted(counts, key=lambda g: (-counts[g], number(g)))


def plain_distance(text, profile):
    mine = plain_grams(text)[: rank_order_lang.COMPARED]
    longest = rank_order_lang.PROFILE
    return sum(min(abs(profile.index(g) - i), longest) if g in profile else longest for i, g in enumerate(mine)), len(mine)


def test_language_against_brute_force(documents, many):
    texts = {"en": "the cat and the dog went to the house with the other", "fr": "le chat et la souris sont dans la maison avec les autres où été"}
    rows = [(i, f"{texts[lang]} {i} {texts[lang][i % 20 :]}", "s", lang) for i, lang in enumerate(["en", "fr"] * 20)]
    docs = documents(*rows, (100, "no language", "s", None))
    profiles = rank_order_lang.learn(docs)
    assert [p.lang for p in profiles] == ["en", "fr"]
    with pytest.raises(ValueError, match="more than 1 different"):
        rank_order_lang.learn(docs, rank_order_lang.Sample(languages=1))
    by_rank = {lang: plain_grams("\n".join(r[1] for r in rows if r[3] == lang)) for lang in texts}
    found = {r.doc_id: r for r in rank_order_lang.identified(docs, profiles).collect()}
    assert all(found[r[0]].lang_pred == r[3] for r in rows)
    top = {lang: grams[: rank_order_lang.PROFILE] for lang, grams in by_rank.items()}
    for doc_id, text, *_ in rows[:6]:
        d, n = min(plain_distance(text, top[lang]) for lang in sorted(texts))
        assert found[doc_id].score == pytest.approx(1 - d / (rank_order_lang.PROFILE * n), abs=0.02)
    odd = {r.doc_id: r for r in rank_order_lang.identified(many, profiles).collect()}
    assert odd[1].lang_pred == odd[2].lang_pred == odd[3].lang_pred == "und" and odd[1].score == 0
    assert rank_order_lang.identified(many, profiles).count() == many.count()
    assert rank_order_lang.learn(docs.limit(0)) == [] and rank_order_lang.identified(docs, []).first().lang_pred == "und"


def test_language_query_learns_only_from_its_folds(documents, many, spark, tmp_path):
    rows = [(i, "only fold two speaks this: zzz qqq", "s", "qq") if zlib.crc32(str(i).encode()) % 4 == 2 else (i, "the usual words here", "s", "en") for i in range(40)]
    documents(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op6_language_id(spark, str(tmp_path)).collect()
    assert {r.lang_pred for r in found} == {"en"}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)


# ---- licences


def test_licences(documents, many):
    mit = dict(license_digests.KNOWN[:1])["MIT"]
    other = "Copyright (c) 2020 Some Body\n\n" + mit.replace("sublicense", "sub-license").replace("MIT License", "The MIT Licence").replace("The MIT", "MIT")
    docs = documents(
        (1, mit.upper().replace(" ", "\n")),
        (2, other),
        (3, "Text before.\n(c) Me\nReleased under the MIT Licence!\nAll rights reserved"),
        (4, mit + " And more."),
        (5, "Licensed under Creative Commons BY-NC 4.0."),
        (5, "nothing"),
        (6, None),
        (7, "The copyright holder said so."),
    )
    found = {(r.doc_id, r.document_license, r.line_licenses, r.n_license_lines) for r in license_digests.scanned(docs).collect()}
    assert found == {
        (1, "MIT", "", 0),
        (2, "MIT", "MIT", 1),
        (3, None, "MIT,all-rights-reserved", 2),
        (4, None, "", 0),
        (5, "CC-BY-NC-4.0", "CC-BY-NC-4.0", 1),
        (6, None, "", 0),
        (7, None, "", 0),
    }
    assert license_digests.scanned(docs).count() == 8
    assert license_digests.scanned(many).count() == many.count() and license_digests.scanned(many.limit(0)).count() == 0


def plain_form(text):
    """The canonical form, by Python's own expressions."""
    import regex

    text = regex.sub(r"(?m)^[^\p{L}\p{N}\n©]*(copyright\b(?=[^\n]*(\(c\)|©|\d{4}))|\(c\)|©)[^\n]*$", "", (text or "").lower())
    text = regex.sub(r"(?m)(?:^|(?<=[:;.]))\s*\(?(\d{1,2}|[a-z])[.)](?=\s)", " ", text)
    found = regex.sub(r"[^\p{L}\p{N}]+", " ", text).strip()
    for other, one in license_digests.SPELLINGS:
        found = regex.sub(rf"(?<![^ ]){other}(?![^ ])", one, found)
    return regex.sub(r"^((the )?([a-z0-9]+ ){0,3}license ([a-z0-9]+ ){0,2}?)?(all rights reserved )?(?=permission |redistribution )", "", found)


def plain_scan(rows):
    """Every document, line and rest of a copyright line against every known text, without digests of texts or first words."""
    import hashlib

    forms = {plain_form(t): name for name, t in license_digests.KNOWN}
    long = {d: name for name, _, d in license_digests.DIGESTS}

    def of(text):
        form = plain_form(text)
        return forms.get(form) or long.get(hashlib.sha256(form.encode()).hexdigest()) if form else None

    def rests(line):
        if not re.match(r"[^\w\n©]*(copyright\b(?=[^\n]*(\(c\)|©|\d{4}))|\(c\)|©)", line.lower()):
            return [line]
        return [line, *(line[m.end() :] for m in re.finditer(r"(?<=[.;,])\s+", line))]

    found = {}
    for i, text in rows:
        whole, lines = found.setdefault(i, (set(), []))
        text = text or ""
        whole |= {of(t) for t in ([text] if "\n" in text else rests(text))} - {None}
        lines += [n for line in text.split("\n") for t in rests(line) if (n := of(t))]
    return {i: (min(whole, default=None), ",".join(sorted(set(lines))), len(lines)) for i, (whole, lines) in found.items()}


def found_licenses(df):
    return {r.doc_id: (r.document_license, r.line_licenses, r.n_license_lines) for r in df.collect()}


def test_usual_spellings_of_licenses(documents):
    mit = dict(license_digests.KNOWN[:1])["MIT"].removeprefix("MIT License ")
    bsd = next(t for n, t in license_digests.KNOWN if n == "BSD-3-Clause")
    listed = re.sub(r"(\d)\. (?=Redistributions|Neither)", r"\n* ", bsd)
    texts = {
        1: (mit, "MIT"),
        2: (f"The MIT License (MIT)\n\nCopyright (c) 2019 A. B. Person, Inc. All rights reserved.\n\n{mit}", "MIT"),
        3: (f"BSD 3-Clause License\n\nCopyright (c) 2017, Some Body\nAll rights reserved.\n\n{listed}", "BSD-3-Clause"),
        4: ("Copyright 2020 X. Licensed under the MIT License.", "MIT"),
        5: ("(c) 2024 X. All rights reserved.", "all-rights-reserved"),
        6: ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"),
        7: ("Copyright 2021 A. B. Body, Inc., Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use it.", None),
        8: (next(t for n, t in license_digests.KNOWN if n == "Apache-2.0" and "governing" in t).replace("http:", "https:").replace("; you", ";\n  you"), "Apache-2.0"),
        9: ("copyright (c) 2020 " + "and, so; on. " * 200 + "All rights reserved.", "all-rights-reserved"),
        10: ("Permission is hereby granted to read this. The redistribution of it is not.", None),
    }
    docs = documents(*[(i, t) for i, (t, _) in texts.items()])
    found = found_licenses(license_digests.scanned(docs))
    assert {i: of[0] for i, of in found.items()} == {i: name for i, (_, name) in texts.items()}
    assert found == plain_scan([(i, t) for i, (t, _) in texts.items()])


def test_long_licenses_by_their_digests(documents):
    from pathlib import Path

    folder = Path("/usr/share/common-licenses")
    if not folder.is_dir():
        pytest.skip("no licence texts on this machine")
    known = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = [(folder / f).read_text() for f in known]
    docs = documents(*enumerate(t.upper().replace(" ", "  ") for t in texts), (100, texts[0][:-200]))
    found = found_licenses(license_digests.scanned(docs))
    assert [found[i][0] for i in range(len(texts))] == list(known.values()) and found[100][0] is None


def test_scan_of_the_whole_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = found_licenses(queries.op7_license_scans(spark, "/root/testdata/sf0.001"))
    assert found == plain_scan(rows) and any(of[1] for of in found.values())
