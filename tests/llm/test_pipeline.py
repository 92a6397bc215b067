from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from test_near import plain_components, plain_fingerprint
from test_quality import base, kept
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tidemark.llm import entropy_mixing, line_rules, ordinal_toxicity
from tidemark.llm.frames import noted, stored, table

SF = "/root/testdata/sf0.001"


def as_rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_every_stage_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    before = as_rows(docs)
    after = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "stage")
        assert out.columns == docs.columns, name
        after.append((name, docs, out))
        docs = out
    # quality rules
    _, source, out = after[0]
    rows = [(r.doc_id, r.text, r.source) for r in before.values()]
    good = kept(rows, line_rules.LineLimits())
    found = as_rows(out)
    assert set(found) == {r[0] for r, ok in zip(rows, good, strict=True) if ok}
    assert all(r.n_chars == len(r.text) and set(r.text.split("\n")) <= set(before[d].text.split("\n")) for d, r in found.items())
    assert sum(r.text == before[d].text for d, r in found.items()) > 0.5 * len(found) and all(base(r.text)[0] for r in found.values())
    # toxicity: the model's own formula, features counted by expression
    _, source, out = after[1]
    import numpy as np

    model = ordinal_toxicity.learn(source, table(spark, SF, "labels"))
    for d, r in as_rows(source).items():
        n = [len(re.findall(rf"(?<![^\W\d_]){re.escape(f.rstrip())}" + (r"(?![^\W\d_])" if f.endswith(" ") else ""), r.text.lower())) for f in model.features]
        p = 1 / (1 + np.exp(model.thresholds[0] - np.log1p(n) @ model.weights))
        assert (p < 0.5) == (d in set(as_rows(out))), d
    # near-duplicates: one of each component
    _, source, out = after[2]
    texts = {d: r.text for d, r in as_rows(source).items()}
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    near = lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3
    group = plain_components(sorted(texts), near)
    assert set(as_rows(out)) == set(group.values()) and all(as_rows(out)[d].text == texts[d] for d in set(group.values()))
    # mixing: as often as decided
    _, source, out = after[3]
    copies = {r.doc_id: r.copies for r in entropy_mixing.mixed(source).collect() if r.copies}
    assert Counter(r.doc_id for r in out.collect()) == copies
    # packing: all tokens of all copies, no sequence too long
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    length = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts.items() if d in copies}
    total = Counter()
    filled = Counter()
    for r in pieces:
        total[r.doc_id] += r.length
        filled[r.sequence_id] += r.length
    assert total == {d: n * copies[d] for d, n in length.items()} and max(filled.values()) <= 1024
    assert len(filled) <= 1.05 * sum(total.values()) / 1024 + 1
    with noted() as written:
        assert corpus_pipeline.run(spark, SF).count() == len(pieces)
    # only the last stage's input and own tables are left in the shared folder
    left = [re.sub(r"-[0-9a-f]{32}$", "", p.rpartition("/")[2]) for p in written if Path(p).exists()]
    assert left[0] == "mixing-sources-to-target-weights" and len(left) < 8 < len(written)


def test_stages_take_odd_rows(spark, many):
    docs = many
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns or name == "best-fit packing"
        docs = stored(out, "stage") if name != "quality rules" else docs
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, many.limit(0), SF).count() == 0


def test_registered_queries_match_sql(spark):
    import duckdb

    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert {f"op{n}_" for n in range(1, 14)} <= {m.group() for q in queries if (m := re.match(r"op\d+_", q))} and "pipeline" in queries
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "conversations", "embeddings"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    plain = lambda row, names: repr([round(v, 9) if isinstance(v, float) else v for _, v in sorted(zip(names, row, strict=True))])
    for name in sorted(n for n in oracles if re.match(r"op\d+_|pipeline", n)):
        df = queries[name](spark, SF)
        cursor = con.execute(oracles[name])
        names = [d[0] for d in cursor.description]
        assert sorted(df.columns) == sorted(names), name
        assert sorted(plain(r, df.columns) for r in df.collect()) == sorted(plain(r, names) for r in cursor.fetchall()), name


def test_queries_read_whole_tables(spark, tmp_path):
    for name, query in __spark_entry__.queries().items():
        if m := re.match(r"op(\d+)_", name):
            n = query(spark, SF).count()
            least = {4: 50, 8: 20, 10: 200, 11: 50}.get(int(m[1]), 200)
            assert n >= least, name


@pytest.mark.parametrize("gone", ["tidemark.llm", "corpus_pipeline"])
def test_entry_without_this_subpackage(gone):
    import subprocess
    import sys

    code = f"import sys; sys.modules['{gone}'] = None; import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op1_') for q in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) > 200 and said[1] == "False"
