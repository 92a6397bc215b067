from __future__ import annotations

import itertools
import random

import numpy as np
import xxhash

from tidemark.llm import covering_simhash as simhash
from tidemark.llm.components import connected_components


def plain_fingerprint(text, k=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if near(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    texts = [None, "", " \n", "A b", "One two THREE four", "É ß É ß É", "x " * 70_000, "a\x0bb\x1cc d e f"]
    assert [simhash.fingerprint_of(t, 3) & (2**64 - 1) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_masks_cover_every_difference():
    for radius in (1, 2, 3):
        kept = [m & (2**64 - 1) for m in simhash.masks(radius)]
        rng = random.Random(radius)
        for _ in range(3000):
            apart = sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius)))
            assert any(not apart & m for m in kept)
    assert min(m.bit_count() for m in kept) >= 30


def clustered(n_groups, size, seed):
    rng = random.Random(seed)
    found = set()
    for _ in range(n_groups):
        at = rng.getrandbits(64)
        for _ in range(size):
            found.add(at)
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4, 5])):
                at ^= 1 << b
    return sorted(int(np.uint64(x).astype(np.int64)) for x in found)


def test_links_and_components(spark, rows):
    fps = clustered(12, 12, 1)
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    expected = plain_components(fps, near)
    prints = spark.createDataFrame([(f,) for f in fps + fps[:9]], "fp long")
    for direct in (simhash.DIRECT, 2):  # 2: almost all through midpoints
        links = simhash.links(prints, 3, direct)
        assert all(near(r.a, r.b) for r in links.collect())
        found = {f: f for f in fps} | {r.node: r.root for r in connected_components(links).collect()}
        assert found == expected


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000 + i, 1000) for i in range(50)] + [(7, 7)]
    links = spark.createDataFrame(random.Random(3).sample(chain, len(chain)), "a long, b long")
    found = {r.node: r.root for r in connected_components(links).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1050), 1000)}
    assert connected_components(links.limit(0)).count() == 0


def test_documents(documents, many):
    text = " ".join(f"word{i}" for i in range(400))
    docs = documents((5, text), (3, text.upper()), (9, text), (4, "other words here"), (1, None), (2, " "), (None, text))
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == {(5, 3), (3, 3), (9, 3), (None, 3), (4, 4), (1, 1), (2, 1)}
    assert simhash.near_duplicates(many).count() == many.count()
    assert simhash.near_duplicates(many.limit(0)).count() == 0


def test_removal_keeps_one_of_each_component(documents, many):
    rng = random.Random(6)
    rows = []
    for _ in range(12):
        words = [f"word{rng.randrange(10**6)}" for _ in range(rng.choice([2, 120, 400, 900]))]
        for _ in range(rng.choice([1, 2, 5])):
            copy = list(words)
            for i in rng.sample(range(len(words)), rng.choice([0, 1, len(words) // 100])):
                copy[i] = f"edit{rng.randrange(100)}"
            rows.append((len(rows) * 7 % 101, " ".join(copy)))
    fps = {d: plain_fingerprint(t) for d, t in rows}
    expected = set(plain_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3).values())
    rows += [(500, None), (501, " "), (None, rows[0][1]), rows[0], (502, rows[0][1].upper())]
    for direct in (simhash.DIRECT, 2):
        kept = simhash.deduplicated(documents(*rows), direct=direct).collect()
        assert sorted(r.doc_id for r in kept) == sorted(expected | {500})
        assert all(r.text == dict(rows)[r.doc_id] for r in kept)
    assert simhash.deduplicated(many).count() == 5  # null, empty and blank; 5 and 6; three others
    assert simhash.deduplicated(many).columns == many.columns and simhash.deduplicated(many.limit(0)).count() == 0


def test_rows_of_one_null_id(documents):
    texts = [" ".join(f"w{g}x{i}" for i in range(200)) for g in range(6)]
    kept = simhash.deduplicated(documents(*[(None, t) for t in texts * 3])).collect()
    assert sorted(r.text for r in kept) == sorted(texts)
