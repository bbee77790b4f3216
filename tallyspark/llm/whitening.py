"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers x = floor(scale * c) + offset. With X the centred rows,
the bidiagonalisation X V = U B alternates u ~ X v and v ~ X'u; V and B are as
wide as a vector and stay on the driver, U (as long as the table) is never
stored: each u is X w for a driver-side w that follows the same recurrence, so
one pass over the rows gives both the product X y and X'(X y). New left and
right vectors are orthogonalised against all earlier ones; the pass is made
again when the left one had lost its orthogonality. A chain that ends early
(a null direction, an eigenvalue that occurs twice) starts anew from a vector
orthogonal to all before, so that after as many steps as there are dimensions
every component is found, equal eigenvalues included. The singular values and
vectors of the small bidiagonal B give the deviations and components.

Rows are centred before any product, with the mean split into its whole part,
subtracted in integers, and the rest, so that a large offset costs no digits.
Every pass is a Spark job over a written table; a task returns one sum per
dimension, and sums are added up by Spark.

Defined results: rows whose vector is null or holds a null or non-finite entry
are left out (so are entries too large for an exact x, 2^46 and more in
absolute value); shorter vectors count as padded with zeros; null or repeated
ids are rows like others; extra columns are ignored. Components without
variance (deviation under 1e-9 of the largest) have no whitened value and are
not returned, so one row, equal rows or an empty table give no rows. A
deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
SEED = 13
#: Rows that a task centres at a time.
BLOCK = 2048
#: Deviations under this share of the largest count as none.
NO_VARIANCE = 1e-9
#: A left vector with more than this share along earlier ones is taken again.
LOST = 1e-8

_SUMS = "pos int, part double"
_ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Rows:
    """Integer rows (vec_id, x) in ``table``, their number, width and the sums of every dimension."""
    table: DataFrame
    n: int
    width: int
    sums: list[int]

    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole part and rest of each dimension's mean."""
        return (np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n / self.n for s in self.sums]))


def integer_rows(embeddings: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> Rows:
    # An unordered comparison with null or NaN is not true, so these fail the test too.
    good = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float(2**46)))
    kept = embeddings.where(F.col("embedding").isNotNull() & good).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    width = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale) + offset)
    full = F.concat(x, F.array_repeat(F.lit(offset).cast("long"), F.lit(width) - F.size("embedding")))
    table = stash(kept.select("vec_id", full.alias("x")), "whitening-rows")
    # The row count travels as one more dimension, -1.
    sums = {p: s for p, s in table.select(F.posexplode(F.concat(F.array(F.lit(1).cast("long")), "x"))).groupBy("pos").agg(F.sum("col")).collect()}
    return Rows(table, sums.get(0, 0), width, [sums[p + 1] for p in range(width) if p + 1 in sums])


def _centred(batch: pa.RecordBatch, width: int, whole: np.ndarray, rest: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, x minus the mean's whole part, x minus the mean) of blocks of a batch."""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    for at in range(0, len(x), BLOCK):
        part = x[at:at + BLOCK] - whole
        yield at, at + len(part), part, part - rest


def _summed(rows: Rows, per_block) -> np.ndarray:
    """Sum over all blocks of centred rows of the vector ``per_block`` makes of one."""
    whole, rest = rows.mean()
    width = rows.width

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, _, _, block in _centred(batch, width, whole, rest):
                part = per_block(block)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["pos", "part"])
    sums = rows.table.select("x").mapInArrow(work, _SUMS).groupBy("pos").agg(F.sum("part").alias("part")).collect()
    return np.array([r["part"] for r in sorted(sums, key=lambda r: r["pos"])])


def _there_and_back(rows: Rows, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Length of X y, and X'(X y)."""
    def per_block(block: np.ndarray) -> np.ndarray:
        p = block @ y
        return np.append(block.T @ p, p @ p)
    out = _summed(rows, per_block)
    return float(np.sqrt(out[-1])), out[:-1]


def _orthogonal(z: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    if basis:
        b = np.array(basis)
        for _ in range(2):
            z = z - b.T @ (b @ z)
    return z


def bidiagonalise(rows: Rows, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(V, B) with X V = U B: V orthogonal, columns are right vectors; B upper
    bidiagonal."""
    d = rows.width
    rng = np.random.default_rng(seed)
    right, lift = [], []  # v; w with u = X w
    B = np.zeros((d, d))

    def fresh() -> np.ndarray:
        z = _orthogonal(rng.standard_normal(d), right)
        return z / np.linalg.norm(z)

    v, beta, largest = fresh(), 0.0, 0.0
    for j in range(d):
        right.append(v)
        y = v - beta * lift[-1] if beta else v
        alpha, r = _there_and_back(rows, y)
        for _ in range(2):
            along = np.array(lift) @ r if lift else np.empty(0)  # u'(X y) = w'X'X y
            if not len(along) or np.abs(along).max() <= LOST * max(alpha, largest * 1e-12):
                break
            y = y - np.array(lift).T @ along
            alpha, r = _there_and_back(rows, y)
        largest = max(largest, alpha)
        nothing = 10 * d * np.finfo(float).eps * largest
        if alpha <= nothing:
            lift.append(np.zeros(d))
            z, beta = np.zeros(d), 0.0
        else:
            lift.append(y / alpha)
            B[j, j] = alpha
            z = _orthogonal(r / alpha - alpha * v, right)
            beta = float(np.linalg.norm(z))
        if j + 1 < d:
            if beta <= nothing:
                v, beta = fresh(), 0.0
            else:
                v = z / beta
                v = _orthogonal(v, right)
                v /= np.linalg.norm(v)
                B[j, j + 1] = beta
    return np.array(right).T, B


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per vector and component, see the module's head: n (rows the
    fit takes), deviation (the vector's squared distance from the mean, times
    n squared, exact), whitened, explained (the component's share of the
    variance), identity_error (largest entry of the whitened rows' covariance
    minus the identity)."""
    spark = embeddings.sparkSession
    rows = integer_rows(embeddings, scale, offset)
    if not rows.n or not rows.width:
        return spark.createDataFrame([], _ROWS)
    V, B = bidiagonalise(rows)
    _, sigma, Q = np.linalg.svd(B)
    k = int((sigma[:components] > max(NO_VARIANCE * sigma[0], 1e-200)).sum())
    if not k:
        return spark.createDataFrame([], _ROWS)
    vectors = V @ Q.T[:, :k]
    project = vectors / (sigma[:k] / np.sqrt(rows.n))

    def spread(block: np.ndarray) -> np.ndarray:
        z = block @ project
        return np.concatenate([(z.T @ z).ravel(), z.sum(axis=0), [(block * block).sum()]])
    sums = _summed(rows, spread)
    mean = sums[k * k:k * k + k] / rows.n
    covariance = sums[:k * k].reshape(k, k) / rows.n - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = sigma[:k] ** 2 / sums[-1]

    n, width = rows.n, rows.width
    whole, rest = rows.mean()
    over = [s - n * (s // n) for s in rows.sums]

    def deviations(part: np.ndarray) -> list:
        top = max(int(np.abs(part).max(initial=0)), 1) * n + n
        if width * top * top < 2**63:
            gap = part * n - np.array(over, np.int64)
            return (gap * gap).sum(axis=1).tolist()
        exact = [sum((n * x - o) ** 2 for x, o in zip(row, over)) for row in part.tolist()]
        return [v if v < 2**63 else None for v in exact]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for low, high, part, block in _centred(batch, width, whole, rest):
                m = high - low
                which = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(low, m).take(pa.array(which)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)), pa.array(deviations(part), pa.int64()).take(pa.array(which)),
                    pa.array((block @ project).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    [c.split()[0] for c in _ROWS.split(", ")])
    return rows.table.mapInArrow(work, _ROWS)


def op13_whitening(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings)
