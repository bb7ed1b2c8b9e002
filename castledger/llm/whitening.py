r"""Embedding whitening with eigenvalue intervals found by contour integration.

Spark reduces the vectors to their exact sums and their covariance matrix. The
components come from that matrix by FEAST: the axis above the wanted eigenvalues
is cut into intervals by inertia counts, and each interval is solved on its own,
as one row of a Spark job. A quadrature of complex shifted solves around the
interval projects a few vectors onto its eigenvectors, Rayleigh-Ritz extracts the
components, and the interval is done when every one that its inertia counts
promise is there with a residual of rounding size.

Entries become whole numbers, ``floor(scale * entry) + shift``, so sums and
deviations are exact. Everything is fitted on each distinct vector once, however
often it occurs, and the distinct vectors are found by an aggregation that
combines map-side. Only sums over dimensions and the dimension x dimension
matrix reach the driver.

Rows whose vector is null, empty, or holds a null or non-finite entry are
dropped; so are vectors that are not as long as most distinct ones (the shorter
length if two are equally common). Repeated rows, equal and null ids each give rows of their
own. Extra columns are ignored. Equal eigenvalues have some orthonormal basis of
their space. A component without variance can't be whitened and is left out: a
table with fewer than two distinct vectors gives no rows, nor does an empty one.
``deviation`` is null where it exceeds 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from castledger.llm.common import Tables

SCALE, SHIFT, COMPONENTS = 64.0, 1_000_000, 16
#: Points of the quadrature on the upper half of a contour; the lower half mirrors them.
NODES = 8
#: Most eigenvalues that an interval is given, unless they are too close to part.
PER_INTERVAL = 6
#: Share of the largest eigenvalue below which a component has no variance.
NO_VARIANCE = 1e-9
ROUNDS = 40

OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double")


# -- whole vectors ---------------------------------------------------------------------------

def _usable(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """Row numbers and entries of the vectors that are not dropped."""
    rows, vectors = [], []
    values = column.values.to_numpy(zero_copy_only=False)  # null entries become nan
    edges = column.offsets.to_numpy()
    present = column.is_valid().to_numpy(zero_copy_only=False)
    for row in np.flatnonzero(present & (edges[1:] > edges[:-1])).tolist():
        own = values[edges[row]:edges[row + 1]]
        if np.isfinite(own).all():
            rows.append(row)
            vectors.append(own)
    return rows, vectors


def whole(vectors: DataFrame, scale: float, shift: int) -> DataFrame:
    """(vec_id, dim, x): vectors of whole numbers, as bytes of 64-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = _usable(batch.column(1))
            x = [np.floor(scale * v).astype(np.int64) + shift for v in found]
            yield pa.record_batch([batch.column(0).take(pa.array(rows, pa.int64())),
                                   pa.array([len(v) for v in x], pa.int32()),
                                   pa.array([v.tobytes() for v in x], pa.binary())],
                                  names=["vec_id", "dim", "x"])

    return vectors.mapInArrow(run, "vec_id long, dim int, x binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The batch's vectors as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


# -- sums over the fit list ------------------------------------------------------------------

def _summed(frame: DataFrame, partial: Callable[[pa.RecordBatch], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all batches of a flat array: added up in each task, then by place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = partial(batch)
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                                  names=["place", "value"])

    rows = (frame.mapInArrow(run, f"place int, value {kind}")
            .groupBy("place").agg(F.sum("value").alias("value")).toPandas())
    return rows.sort_values("place")["value"].to_numpy()


def _centred_products(frame: DataFrame, values: Callable[[pa.RecordBatch], np.ndarray], n: int,
                      mean: np.ndarray | None, size: int) -> np.ndarray:
    """Covariance matrix (divisor n) of the rows that ``values`` gives, less ``mean``."""
    upper = np.triu_indices(size)

    def partial(batch: pa.RecordBatch) -> np.ndarray:
        rows = values(batch)
        rows = rows if mean is None else rows - mean
        return (rows.T @ rows)[upper]

    matrix = np.zeros((size, size))
    matrix[upper] = _summed(frame, partial, "double") / n
    return matrix + np.triu(matrix, 1).T


# -- eigenvalue intervals --------------------------------------------------------------------

def eigenvalues_above(matrix: np.ndarray, at: float) -> int:
    """Inertia of ``matrix - at``: how many eigenvalues lie above. The matrix is
    reduced by pivots of one or two rows, the largest there are; their signs are
    those of the eigenvalues."""
    rest = matrix - at * np.eye(len(matrix))
    above = 0
    while len(rest):
        diagonal = np.abs(np.diagonal(rest))
        one = int(diagonal.argmax())
        off = np.abs(np.triu(rest, 1))
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[one] >= 0.64 * off[i, j]:
            if diagonal[one] == 0:
                return above  # all that is left is zero: not above
            above += int(rest[one, one] > 0)
            chosen = [one]
        else:
            above += 1  # a block with a positive and a negative eigenvalue
            chosen = [int(i), int(j)]
        kept = np.setdiff1d(np.arange(len(rest)), chosen)
        cross = rest[np.ix_(kept, chosen)]
        rest = rest[np.ix_(kept, kept)] - cross @ np.linalg.solve(rest[np.ix_(chosen, chosen)], cross.T)
        rest = (rest + rest.T) / 2
    return above


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues within) that together hold the ``wanted`` largest."""
    top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)  # no eigenvalue is larger
    if top <= 0:
        return []
    low, high, least = NO_VARIANCE * top, top, 1e-10 * top
    have = eigenvalues_above(matrix, low)
    wanted = min(wanted, have)
    if not wanted:
        return []
    while have > wanted and high - low > least:
        middle = (low + high) / 2
        if (count := eigenvalues_above(matrix, middle)) >= wanted:
            low, have = middle, count
        else:
            high = middle
    found, open_ = [], [(low, top, have, 0)]  # with the eigenvalues above low and above high
    while open_:
        low, high, above_low, above_high = open_.pop()
        count = above_low - above_high
        if count <= PER_INTERVAL or high - low <= least:
            found += [(low, high, count)] * (count > 0)
            continue
        middle = (low + high) / 2
        above = eigenvalues_above(matrix, middle)
        open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return sorted(found)


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high] and their unit vectors (rows)."""
    d = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max())
    centre, radius = (low + high) / 2, max((high - low) / 2, 1e-12 * scale)
    roots, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (roots + 1)
    points = centre + radius * np.exp(1j * angles)
    shifted = [point * np.eye(d) - matrix for point in points]
    size = min(d, 2 * count + 4)
    basis = np.linalg.qr(np.random.default_rng(13).standard_normal((d, size)))[0]
    slack = 1e-11 * scale
    for step in range(ROUNDS):
        projected = sum(w / 2 * (radius * np.exp(1j * a) * np.linalg.solve(s, basis)).real
                        for w, a, s in zip(weights, angles, shifted))
        basis = np.linalg.qr(projected)[0]
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        basis = basis @ turned
        residual = np.abs(matrix @ basis - basis * values).max(axis=0)
        inside = (values > low - slack) & (values <= high + slack)
        done = inside & (residual <= 4e-15 * d * scale)
        if done.sum() >= count:
            # at the interval's edges, the nearest to its middle
            best = np.flatnonzero(done)[np.argsort(np.abs(values[done] - centre), kind="stable")[:count]]
            best = np.sort(best)
            return values[best], basis[:, best].T
        if (inside.sum() >= size or step % 6 == 5) and size < d:  # crowded, or edges that many share: more vectors
            size = min(d, 2 * size)
            extra = np.random.default_rng(size).standard_normal((d, size - basis.shape[1]))
            basis = np.linalg.qr(np.hstack([basis, extra]))[0]
    raise ArithmeticError(f"{count} eigenvalues lie in ({low}, {high}], {int(done.sum())} were found")


def components(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above zero, falling, and their vectors as
    rows. Each interval is solved by a task of its own."""
    cut = intervals(matrix, wanted)
    if not cut:
        return np.empty(0), np.empty((0, len(matrix)))
    shared = spark.sparkContext.broadcast(matrix)  # of the dimension's size, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = feast(shared.value, row["low"], row["high"], row["count"])
                yield pa.record_batch([pa.array(values), pa.array([v.tobytes() for v in vectors], pa.binary())],
                                      names=["value", "vector"])

    solved = (spark.createDataFrame(cut, "low double, high double, count int").repartition(len(cut))
              .mapInArrow(run, "value double, vector binary").collect())
    if len(solved) != sum(c[2] for c in cut):
        raise ArithmeticError("eigenvalues are missing")
    solved.sort(key=lambda r: -r["value"])
    values = np.array([r["value"] for r in solved[:wanted]])
    return values, np.array([np.frombuffer(r["vector"]) for r in solved[:wanted]])


# -- the operator ----------------------------------------------------------------------------

def whiten(embeddings: DataFrame, count: int = COMPONENTS, scale: float = SCALE,
           shift: int = SHIFT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of
    every vector and each of the ``count`` largest components: the distance from
    the mean in units of 1/n, squared; the vector in whitened coordinates; the
    component's share of all variance; and how far the whitened fit list is from
    having the identity as covariance."""
    spark = embeddings.sparkSession
    tables = Tables(spark, "whitening")
    rows = whole(embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"),
                                   embeddings["embedding"].cast("array<double>").alias("embedding")),
                 scale, shift)
    fit = tables.keep(rows.select("dim", "x").distinct())
    commonest = fit.groupBy("dim").count().orderBy(F.desc("count"), "dim").head()
    nothing = spark.createDataFrame([], OUT)
    if commonest is None:
        return nothing
    dim, n = commonest
    fit, rows = (frame.where(F.col("dim") == dim).drop("dim") for frame in (fit, rows))
    sums = _summed(fit, lambda batch: _matrix(batch.column(0), dim).sum(axis=0), "long")

    def centred(batch: pa.RecordBatch, at: int = 0) -> np.ndarray:
        return (n * _matrix(batch.column(at), dim) - sums) / n

    matrix = _centred_products(fit, centred, n, None, dim)
    values, vectors = components(spark, matrix, count)
    if not len(values):
        return nothing
    turn = (vectors / np.sqrt(values)[:, None]).T
    found = len(values)
    mean = _summed(fit, lambda batch: (centred(batch) @ turn).sum(axis=0), "double") / n
    identity = _centred_products(fit, lambda batch: centred(batch) @ turn, n, mean, found)
    error = float(np.abs(identity - np.eye(found)).max())
    explained = values / np.trace(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                deviations = [_deviation(d) for d in n * _matrix(part.column(1), dim) - sums]
                rows, own = part.num_rows, centred(part, 1) @ turn
                again = pa.array(np.repeat(np.arange(rows), found))
                yield pa.record_batch([
                    part.column(0).take(again),
                    pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * found, n, np.int64)),
                    pa.array(deviations, pa.int64()).take(again),
                    pa.array(own.ravel()), pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * found, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, OUT)


def _deviation(difference: np.ndarray) -> int | None:
    """Exact sum of squares, None beyond 64 bits."""
    largest = int(np.abs(difference).max())
    if largest * largest * len(difference) < 2**63:
        return int((difference * difference).sum())
    total = sum(int(x) ** 2 for x in difference)
    return total if total < 2**63 else None


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
