"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance of the distinct vectors is never formed. A pass over the data
multiplies a block Q of ``block`` columns by it: every task centres its vectors
(exactly, from whole numbers), computes X'(X Q) and sends one small matrix, and
Spark adds these. A Chebyshev polynomial of the covariance, evaluated by its
three-term recurrence with one pass per degree, damps all eigenvalues between 0
and the block's smallest Ritz value and lets those above grow. Then the block is
made orthonormal by QR, a Rayleigh-Ritz step turns it to the eigenvectors, and
the same product gives their residuals. It ends when each wanted component is
certified: its residual, relative to the largest eigenvalue, is below
``certified``, or has stopped falling below ``stalled`` (rounding). Otherwise it
raises.

Defined results: rows whose vector is null or has null or non-finite entries are
dropped; shorter vectors end in zeros; repeated rows get results each but count
once in the fit; only components with variance exist, so a single distinct
vector, or a table without rows, gives an empty result; equal eigenvalues share a
basis that depends on rounding. The entry of a component that is largest in
magnitude is positive. An entry of more than 2^45 after scaling is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import packed, stored
from tidemark.llm.vectors import blocks_of, checked, column_sums, matrices, matrix, usable, whole

#: Entries beyond this would not be whole numbers of a double after centring.
LARGEST = 1 << 45
#: An eigenvalue below this share of the trace is no variance but rounding.
NOTHING = 1e-12


@dataclass(frozen=True)
class Whitening:
    """``components`` wanted ones from a block of ``block`` columns, a filter of ``degree``, at most ``turns`` filters."""

    components: int = 4
    scale: int = 256
    block: int = 32
    degree: int = 10
    turns: int = 200
    certified: float = 2e-14
    stalled: float = 1e-11
    seed: int = 1


@dataclass(frozen=True)
class Fitted:
    """``basis`` has a column per component; ``values`` are their eigenvalues, ``residuals`` relative to the largest one."""

    n: int
    sums: tuple[int, ...]
    basis: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    trace: float


def _exactly(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S without rounding: 64-bit integers where they fit, else Python's."""
    most = max(map(abs, sums), default=0) + n * int(max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0)
    kind = np.int64 if most < 1 << 62 else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S / n, rounded once."""
    return (_exactly(x, n, sums) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Sums over components of (n * x - S)^2, exact."""
    apart = _exactly(x, n, sums)
    if apart.dtype != object and apart.size and max(-int(apart.min()), int(apart.max())) ** 2 * apart.shape[1] >= 1 << 63:
        apart = apart.astype(object)
    return (apart * apart).sum(axis=1).tolist()


def _added(blocks: DataFrame, size: int, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``part(x)``, a matrix: one per task, added by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, met = np.zeros(shape), False
        for batch in batches:
            for x in matrices(batch, size):
                total += part(x)
                met = True
        flat = total.ravel() if met else np.zeros(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["at", "value"])

    rows = blocks.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    found = np.zeros(shape[0] * shape[1])
    for r in rows:
        found[r["at"]] = r["value"]
    return found.reshape(shape)


def filtered(times, block: np.ndarray, product: np.ndarray, cut: float, largest: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of the covariance that is small on [0, cut], applied to ``block``.

    ``times`` multiplies by the covariance, ``product`` is its product with
    ``block``; the polynomial is scaled to about 1 at ``largest``.
    """
    half = cut / 2
    ratio = half / max(largest - half, half)
    first, scale = ratio, ratio
    last, now = block, (product - half * block) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        last, now = now, (times(now) - half * now) * (2 * following / half) - last * (scale * following)
        scale = following
    return now


def fit(blocks: DataFrame, size: int, ways: Whitening = Whitening()) -> Fitted:
    """The leading eigenvectors of the covariance over ``blocks``, which have each vector once."""
    n, sums = column_sums(blocks, size)
    shift = tuple(sums)
    nothing = Fitted(n, shift, np.zeros((size, 0)), np.zeros(0), np.zeros(0), 0.0)
    if not n or not size:
        return nothing
    trace = float(_added(blocks, size, (1, 1), lambda x: np.array([[(centred(x, n, shift) ** 2).sum()]]))[0, 0]) / n
    if not trace:
        return nothing

    def times(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            apart = centred(x, n, shift)
            return apart.T @ (apart @ block)

        return _added(blocks, size, block.shape, part) / n

    wanted, width = min(ways.components, size), min(ways.block, size)
    block = np.linalg.qr(np.random.default_rng(ways.seed).standard_normal((size, width)))[0]
    before = np.inf
    for _ in range(ways.turns):
        product = times(block)
        values, turn = np.linalg.eigh((block.T @ product + product.T @ block) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        real = max(1, int((values[:wanted] > NOTHING * trace).sum()))
        residuals = np.linalg.norm(product - block * values, axis=0)[:real] / values[0]
        worst = float(residuals.max())
        if worst <= ways.certified or (worst <= ways.stalled and worst > before / 2):
            return Fitted(n, shift, _signed(block[:, :real]), values[:real], residuals, trace)
        before = worst
        cut = max(float(values[-1]), 1e-3 * float(values[0]))
        block = np.linalg.qr(filtered(times, block, product, cut, float(values[0]), ways.degree))[0]
    raise ArithmeticError(f"components not certified after {ways.turns} filters: residual {before:.3g}")


def _signed(basis: np.ndarray) -> np.ndarray:
    return basis * np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])


def identity_error(blocks: DataFrame, size: int, found: Fitted) -> float:
    """How far the whitened vectors' covariance, measured on the data, is from the identity."""
    k = found.basis.shape[1]
    if not k:
        return 0.0
    weights = found.basis / np.sqrt(found.values)

    def part(x: np.ndarray) -> np.ndarray:
        y = centred(x, found.n, found.sums) @ weights
        return np.vstack([y.T @ y, y.sum(axis=0, keepdims=True)])

    total = _added(blocks, size, (k + 1, k), part) / found.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whitened(
    embeddings: DataFrame, ways: Whitening = Whitening(), vec_id: str = "vec_id", vector: str = "embedding", keep: list[str] | None = None
) -> DataFrame:
    """(row, vec_id, n, deviation, whitened, explained, residuals, identity_error): one row per usable vector.

    ``whitened``, ``explained`` and ``residuals`` are arrays with an entry per
    component; ``deviation`` is a text of digits, as it may exceed a long.
    """
    rows = packed(embeddings, keep, vec_id=vec_id, vector=vector)
    rows = rows.withColumns({"vec_id": F.col("vec_id").cast("long"), "vector": F.col("vector").cast("array<double>")})
    good = rows.filter(usable(F.col("vector"))).withColumn("x", whole(F.col("vector"), ways.scale)).drop("vector")
    # each distinct vector once; equal ones are dropped before the shuffle, so a frequent one costs a row per task
    size = good.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    blocks = stored(blocks_of(good.select("x").distinct(), size, LARGEST), "whitening-blocks")
    found = fit(blocks, size, ways)
    error = identity_error(blocks, size, found)
    weights, n, sums = found.basis / np.sqrt(found.values), found.n, found.sums
    carried = [c for c in good.columns if c != "x"]
    types = ", ".join(f"{c} {good.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = checked(matrix(batch.column("x"), size), LARGEST)
            values = pa.array((centred(x, n, sums) @ weights).tolist(), pa.list_(pa.float64()))
            digits = pa.array(map(str, deviations(x, n, sums)), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), digits, values], [*carried, "deviation", "whitened"])

    done = good.mapInArrow(run, f"{types}, deviation string, whitened array<double>")
    doubles = lambda values: F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")
    return done.withColumns(
        {
            "n": F.lit(n).cast("long"),
            "explained": doubles(found.values / found.trace if found.trace else found.values),
            "residuals": doubles(found.residuals),
            "identity_error": F.lit(error),
        }
    )


def component_rows(done: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1; ``deviation`` as a long, null where none holds it."""
    numbered = done.select("*", F.posexplode("whitened").alias("at", "value"))
    return numbered.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("value").alias("whitened"),
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
        F.get("residuals", F.col("at")).alias("residual"),
    )
