from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bisector_clusters as clusters
from tidemark.llm import chebyshev_whitening as whitening
from tidemark.llm import queries, vectors

SF = "/root/testdata/sf0.001"
EMBEDDING = "vec_id long, embedding array<float>, label int, row string, x long, cluster string"


@pytest.fixture
def embeddings(spark):
    """A table of (vec_id, vector), with columns whose names the operators use inside."""

    def make(*rows):
        return spark.createDataFrame([(i, v, 1, "r", 2, "c") for i, v in rows], EMBEDDING).repartition(3)

    return make


def odd(size):
    """Vectors that are dropped: null, with a null, not a number, infinite."""
    return [(900, None), (901, [None] + [1.0] * (size - 1)), (902, [float("nan")] * size), (903, [1.0] * (size - 1) + [float("-inf")])]


# ---- clustering


def plain_clusters(rows, ways):
    """Brute force: all distances in Python's whole numbers."""
    whole = lambda v: [int(np.floor(ways.scale * float(np.float32(c)))) for c in v]
    rows = [(i, whole(v)) for i, v in rows]
    digest = lambda r: (hashlib.sha256(f"{ways.salt}:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted((r for r in rows if r[0] is not None), key=digest)[: ways.k]]
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for turn in range(ways.rounds + 1):
        near = [min(range(len(centroids)), key=lambda c: (apart(v, centroids[c]), c)) for _, v in rows]
        if turn < ways.rounds:
            for c in range(len(centroids)):
                own = [v for (_, v), n in zip(rows, near, strict=True) if n == c]
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)] if own else centroids[c]
    distances = [apart(v, centroids[n]) for (_, v), n in zip(rows, near, strict=True)]
    inertia = [sum(d for d, n in zip(distances, near, strict=True) if n == c) for c in range(len(centroids))]
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), n, d, inertia[n], sum(distances), marks[n]) for (i, _), n, d in zip(rows, near, distances, strict=True))


def found_clusters(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_clusters_equal_brute_force(embeddings):
    rng = random.Random(1)
    ways = clusters.Clustering(k=5, size=3)
    grid = [(i, [rng.randint(-3, 3) / 64 for _ in range(3)]) for i in range(60)]  # many equal distances
    spread = [(100 + i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(60)]
    repeated = [grid[0]] * 40 + [(None, spread[3][1]), (None, spread[3][1])]
    for rows in (grid, spread, grid + spread + repeated, grid[:1], grid[:3] + grid[:3]):
        found = clusters.clustered(embeddings(*rows, *odd(3), (904, [1.0]), (905, [])), ways)
        assert found_clusters(found) == plain_clusters(rows, ways)
    assert found.select("row.*").columns == EMBEDDING.replace(",", "").replace(" array<float>", " x").split()[::2]


def test_bisectors_keep_the_nearest_of_the_smallest_numbers():
    rng = np.random.default_rng(2)
    for _ in range(200):
        centroids = rng.integers(-2, 3, (rng.integers(1, 9), 2))
        x = rng.integers(-4, 5, (50, 2))
        game = clusters.Tournament(centroids)
        apart = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (game.winners(x) == apart.argmin(axis=1)).all()  # the first of equals
        assert (game.distances(x, game.winners(x)) == apart.min(axis=1)).all()


def test_largest_components_are_exact_and_larger_ones_an_error(embeddings):
    ways = clusters.Clustering(k=3, rounds=2, size=2, scale=1)
    top = float(vectors.LARGEST)
    rows = [(1, [top, -top]), (2, [-top, top]), (3, [top - 64, 0.0]), (4, [0.0, 0.0])]
    assert found_clusters(clusters.clustered(embeddings(*rows), ways)) == plain_clusters(rows, ways)
    with pytest.raises(Exception, match="component beyond"):
        clusters.clustered(embeddings(*rows, (5, [2 * top, 0.0])), ways).collect()


def test_no_vectors(embeddings):
    for rows in ([], odd(64), [(None, [1.0] * 64)]):
        assert clusters.clustered(embeddings(*rows)).collect() == []
        assert len(whitening.whitened(embeddings(*rows)).collect()) == (1 if rows and len(rows) == 1 else 0)


# ---- whitening


def plain_whitening(rows, scale=256, k=4):
    """(vec_id, deviation, projections), shares of variance: by a dense eigendecomposition."""
    x = np.array([np.floor(scale * np.float32(v).astype(float)) for _, v in rows])
    once = np.unique(x, axis=0)
    n, sums = len(once), once.sum(axis=0)
    centred = once - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    deviation = [sum((int(n) * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, (x - sums / n) @ basis / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_equals_dense_eigenvectors(embeddings):
    rng = np.random.default_rng(3)
    steep = rng.standard_normal((300, 40)) * np.linspace(3, 0.1, 40)
    flat = rng.standard_normal((400, 40))
    for data in (steep, flat, steep[:6], flat[:, :3], flat[:, :1]):
        rows = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
        rows += [(1000 + i, rows[0][1]) for i in range(50)]  # copies count once in the fit
        ways = whitening.Whitening(block=8)
        found = whitening.component_rows(whitening.whitened(embeddings(*rows, *odd(data.shape[1])), ways))
        n, deviation, expected, shares = plain_whitening(rows)
        k = min(4, data.shape[1])
        got = np.full((len(rows), k), np.nan)
        at = {i: p for p, (i, _) in enumerate(rows)}
        for r in found.collect():
            got[at[r.vec_id], r.component - 1] = r.whitened
            assert r.n == n and r.deviation == deviation[at[r.vec_id]] and r.identity_error < 1e-9
            assert abs(r.explained - shares[r.component - 1]) < 1e-12 and r.residual < 1e-11
        signs = np.sign((got * expected[:, :k]).sum(axis=0))
        assert np.abs(got * signs - expected[:, :k]).max() < 1e-8


def test_polynomial_damps_the_unwanted_part():
    values = np.array([5.0, 3.0, 2.0, 1.0, 0.5, 0.0])
    times = lambda block: values[:, None] * block
    found = whitening.filtered(times, np.eye(6), times(np.eye(6)), 2.0, 5.0, 9).diagonal()
    chebyshev = np.cos(9 * np.arccos((values[2:] - 1).clip(-1, 1))) / np.cosh(9 * np.arccosh(5.0 - 1))
    assert np.allclose(found[2:], chebyshev) and np.isclose(found[0], 1) and found[1] > 100 * np.abs(found[2:]).max()


def test_little_variance_and_uneven_lengths(embeddings):
    line = [(i, [float(i), float(i), 1.0]) for i in range(6)]
    found = whitening.component_rows(whitening.whitened(embeddings(*line))).collect()
    assert {r.component for r in found} == {1} and np.isclose([r.explained for r in found], 1).all()  # one direction has all variance
    assert whitening.component_rows(whitening.whitened(embeddings((1, [2.0, 3.0]), (2, [2.0, 3.0])))).count() == 0
    short = [(1, []), (2, [1.0]), (3, [1.0, 2.0]), (4, [0.0, 3.0])]
    padded = [(i, v + [0.0] * (2 - len(v))) for i, v in short]
    of = lambda rows: sorted((r.vec_id, r.component, round(r.whitened, 9)) for r in whitening.component_rows(whitening.whitened(embeddings(*rows))).collect())
    assert of(short) == of(padded) and len(of(short)) == 8


def test_deviations_beyond_a_long(embeddings):
    rows = [(i, [float(3 * 10**12 * i), 1.0]) for i in range(3)]
    done = whitening.whitened(embeddings(*rows), whitening.Whitening(scale=1))
    exact = {r.vec_id: int(r.deviation) for r in done.collect()}
    x = {i: int(np.float32(v[0])) for i, v in rows}
    assert exact == {i: (3 * x[i] - sum(x.values())) ** 2 for i in x} and max(exact.values()) > 1 << 63
    assert {r.deviation for r in whitening.component_rows(done).filter("vec_id = 2").collect()} == {None}


def test_queries_on_whole_tables(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert found_clusters(queries.op12_centroid_clustering(spark, SF)) == plain_clusters(rows, clusters.Clustering())
    done = queries.op13_embedding_whitening(spark, SF)
    n, deviation, expected, _ = plain_whitening(rows)
    for k in range(4):
        got = {r.vec_id: r for r in done.filter(F.col("component") == k + 1).collect()}
        mine = np.array([got[i].whitened for i, _ in rows])
        assert np.abs(mine * np.sign(mine @ expected[:, k]) - expected[:, k]).max() < 1e-8
        assert [got[i].deviation for i, _ in rows] == deviation and got[rows[0][0]].n == n
