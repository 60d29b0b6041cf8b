"""Embedding whitening by QDWH spectral divide-and-conquer.

Vectors become integers (``floor(64 c) + 1000000``), so their sums are exact and a centred entry is one rounded
division. The tasks add up the covariance; only its matrix, whose size is set by the dimension, reaches the
driver. There the polar factor of the shifted covariance (QDWH: dynamically weighted Halley steps) gives the
projector on the eigenvectors above the shift. It splits the space in two, each part is split again, until the
parts are single components. The components are broadcast, and every row is projected where it lies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the integer form: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries with a scaled value from here on fit no long; their rows are dropped as if they weren't finite.
TOO_LARGE = 2.0 ** 62
#: Entries that a task turns into numbers at a time.
CELLS = 1 << 20
#: Shifts tried for a split, as shares of the spread of the diagonal, from its mean.
SHIFTS = (0.0, 0.15, -0.15, 0.3, -0.3, 0.05, -0.05)
EPS = np.finfo(float).eps


# -- the spectral decomposition ---------------------------------------------------------------------------------

def polar_sign(h: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix: its matrix sign. At most eight QDWH steps."""
    one = np.eye(len(h))
    x, low = h / np.linalg.norm(h), EPS / 4
    for _ in range(12):
        d = np.cbrt(4 * (1 - low ** 2) / low ** 4)
        root = np.sqrt(1 + d)
        a = root + np.sqrt(8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * root)) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        if c > 100:  # by orthogonal factors, safe however small the least singular value is
            q, _ = np.linalg.qr(np.concatenate([np.sqrt(c) * x, one]))
            y = b / c * x + (a - b / c) / np.sqrt(c) * q[:len(h)] @ q[len(h):].T
        else:
            y = b / c * x + (a - b / c) * np.linalg.solve(one + c * x.T @ x, x.T).T
        y = (y + y.T) / 2
        moved, x = np.linalg.norm(y - x), y
        low = min(low * (a + b * low ** 2) / (1 + c * low ** 2), 1 - EPS)
        if moved < 1e-9 and low > 1 - 1e-9:  # steps are cubic, so the last one is exact to rounding
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first k columns span the eigenvectors above a shift; None for a multiple of one."""
    m = len(a)
    diagonal = np.sort(np.diag(a))
    size = np.linalg.norm(a - np.mean(diagonal) * np.eye(m))
    best = None
    for share in SHIFTS:
        u = polar_sign(a - (np.mean(diagonal) + share * size / np.sqrt(m)) * np.eye(m))
        k = round((np.trace(u) + m) / 2)
        if not 0 < k < m:
            continue
        project = (u + np.eye(m)) / 2
        basis = np.random.default_rng(m).standard_normal((m, k))
        for _ in range(3):
            basis = np.linalg.qr(project @ basis)[0]
        q = np.linalg.qr(np.concatenate([basis, (np.eye(m) - project)], axis=1), mode="complete")[0]
        q[:, :k] = basis
        left = np.abs(q[:, :k].T @ a @ q[:, k:]).max()
        if best is None or left < best[0]:
            best = left, q, k
        if left <= 100 * m * EPS * size:
            break
    return None if best is None else (best[1], best[2])


def components_of(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns."""
    d = len(v)
    floor = 4 * d * EPS * max(np.linalg.norm(v), np.finfo(float).tiny)
    parts, found = [(np.eye(d), v)] if d else [], []
    while parts and len(found) < wanted:  # the part with the larger eigenvalues comes first
        basis, a = parts.pop()
        m = len(a)
        cut = split(a) if m > 1 and np.linalg.norm(a - np.trace(a) / m * np.eye(m)) > floor else None
        if cut is None:  # one component, or equal eigenvalues, of which any basis will do
            found.extend(basis.T)
            continue
        q, k = cut
        for own in (q[:, k:], q[:, :k]):
            part = np.linalg.qr(basis @ own)[0]
            parts.append((part, part.T @ v @ part))
    p = np.array(found[:wanted]).reshape(-1, d).T
    e = np.einsum("ik,ij,jk->k", p, v, p)
    order = np.argsort(-e, kind="stable")
    return e[order], p[:, order]


# -- rows --------------------------------------------------------------------------------------------------------

def read_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the rows that stay, and for each row its entries as longs."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(float)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * SCALE)
        bad = np.concatenate([[0], np.cumsum(~(np.abs(scaled) < TOO_LARGE))])
    whole = (bad[offsets[1:]] == bad[offsets[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    stay = np.flatnonzero(whole)
    longs = np.where(np.abs(scaled) < TOO_LARGE, scaled, 0).astype(np.int64) + OFFSET
    return stay, [longs[offsets[i]:offsets[i + 1]] for i in stay]


def padded(rows: list[np.ndarray], d: int) -> np.ndarray:
    """A matrix of rows; where a vector is too short its entries count as zero."""
    if all(len(r) == d for r in rows):
        return np.concatenate(rows).reshape(len(rows), d) if rows else np.zeros((0, d), np.int64)
    out = np.full((len(rows), d), OFFSET, np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def chunks(column: pa.Array, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrices of the rows that stay, a bounded number of entries at a time."""
    stay, rows = read_vectors(column)
    step = max(1, CELLS // max(d, 1))
    for at in range(0, len(rows), step):
        yield stay[at:at + step], padded(rows[at:at + step], d)


@dataclass(frozen=True)
class Sums:
    """Number of vectors, sums by dimension, and the largest absolute entry: exact integers."""

    n: int
    sums: tuple[int, ...]
    largest: int

    @property
    def d(self) -> int:
        return len(self.sums)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: longs, or Python integers where they don't fit."""
        if 2 * self.n * max(self.largest, 1) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(float)

    def squares(self, x: np.ndarray) -> list[int | None]:
        """Sums of the squared deviations, exact; None over a long."""
        y = self.deviations(x)
        if y.dtype != object and self.d * int(np.abs(y).max(initial=0)) ** 2 >= 1 << 62:
            y = y.astype(object)
        return [s if s < 1 << 63 else None for s in (int(s) for s in (y * y).sum(axis=1))]


def exact_sums(rows: DataFrame) -> Sums:
    """The sums of all vectors; each task sends a row for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, count, largest = 0, [], [], 0
        for batch in batches:
            _, vectors = read_vectors(batch.column(0))
            n += len(vectors)
            by_length: dict[int, list[np.ndarray]] = {}
            for v in vectors:
                by_length.setdefault(len(v), []).append(v)
            for d, own in by_length.items():
                x = np.stack(own)
                top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
                largest = max(largest, top)
                s = x.sum(axis=0) if top * len(own) < 1 << 62 else x.astype(object).sum(axis=0)
                total += [0] * (d - len(total))
                count += [0] * (d - len(count))
                for i in range(d):
                    total[i] += int(s[i])
                    count[i] += len(own)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(total)), pa.int32()),
                 pa.array([Decimal(x) for x in (0, *total)], pa.decimal128(38, 0)),
                 pa.array([n, *count], pa.int64()), pa.array([Decimal(largest)] * (len(total) + 1), pa.decimal128(38, 0))],
                names=["dim", "total", "n", "largest"])

    got = (rows.mapInArrow(run, "dim int, total decimal(38,0), n long, largest decimal(38,0)")
           .groupBy("dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("largest").alias("largest"))
           .orderBy("dim").collect())
    if not got:
        return Sums(0, (), 0)
    n = int(got[0].n)
    return Sums(n, tuple(int(r.total) + (n - int(r.n)) * OFFSET for r in got[1:]),
                max(OFFSET, *(int(r.largest) for r in got)))


def moments(rows: DataFrame, sums: Sums, d: int, transform: Callable[[np.ndarray], np.ndarray]) \
        -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance (divisor n) of the transformed centred vectors, from a partial matrix of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, line = np.zeros((d, d)), np.zeros(d)
        for batch in batches:
            for _, x in chunks(batch.column(0), sums.d):
                y = transform(sums.centred(x))
                square += y.T @ y
                line += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, d), pa.int32()), pa.array([line, *(square[i, i:] for i in range(d))])], names=["i", "part"])

    got = (rows.mapInArrow(run, "i int, part array<double>").select("i", F.posexplode("part").alias("j", "v"))
           .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    mean, cov = np.zeros(d), np.zeros((d, d))
    for r in got:
        if r.i < 0:
            mean[r.j] = r.v / sums.n
        else:
            cov[r.i, r.i + r.j] = cov[r.i + r.j, r.i] = r.v / sums.n
    return mean, cov - np.outer(mean, mean)


def whiten(rows: DataFrame, row_id: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """A row for each vector that stays and each of the largest ``components`` components.

    Vectors that are null, or hold a null, a value that isn't finite or one whose integer form fits no long, are
    dropped. A vector shorter than the longest counts as ending in zeros; if all are empty there are no rows.
    Repeated rows and null ids each give their own rows. ``deviation`` is null where the exact sum fits no long.
    A component without variance (its eigenvalue is rounding error) has null ``whitened`` and is left out of
    ``identity_error``; without any variance that is null, and so is ``explained``. Equal eigenvalues have no
    order of their own; any orthogonal basis of theirs is a right answer.
    """
    column = F.col(f"`{vector}`").cast("array<double>").alias("v")
    only = rows.select(column)
    sums = exact_sums(only)
    schema = (f"vec_id {rows.schema[row_id].dataType.simpleString()}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    if not sums.d:
        return rows.sparkSession.createDataFrame([], schema)
    _, v = moments(only, sums, sums.d, lambda y: y)
    e, p = components_of(v, min(components, sums.d))
    alive = e > sums.d * EPS * max(e.max(), 0)
    to_white = np.where(alive, p / np.sqrt(np.where(alive, e, 1)), 0)
    _, white = moments(only, sums, len(e), lambda y: y @ to_white)
    error = float(np.abs(white - np.eye(len(e)))[np.ix_(alive, alive)].max()) if alive.any() else None
    explained = [float(x) for x in e / np.trace(v)] if alive.any() else [None] * len(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(e)
        for batch in batches:
            for stay, x in chunks(batch.column(1), sums.d):
                m = len(stay)
                dead = np.tile(~alive, m)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(stay, k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, sums.n)),
                     pa.array(sums.squares(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array((sums.centred(x) @ to_white).ravel(), mask=dead), pa.array(explained * m, pa.float64()),
                     pa.array([error] * (m * k), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col(f"`{row_id}`").alias("vec_id"), column).mapInArrow(run, schema)
