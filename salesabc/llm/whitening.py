"""Embedding whitening: principal components by QDWH spectral divide and conquer, broadcast to all rows.

Entries become whole numbers, x = floor(64 c) + 1000000.  The fit list holds
every distinct x vector once; its size, sums and covariance are summed over
tasks, entries centred before they are multiplied.  The covariance (dimension
squared, whatever the number of rows) is split on the driver: the polar factor
of the covariance less a shift, found by QR-based dynamically weighted Halley
steps, gives the projector on the eigenvectors above the shift; orthonormal
bases of both sides give two smaller problems, down to single vectors.  The
covariance is then summed again in these components, where those of little
variance keep all their digits beside very large ones, and plane rotations take
out what is left off its diagonal.  Mean and scaled components (dimension x 16
at most) then go to every task.

Defined cases: rows with a null vector, or with null or non-finite entries, go.
If vectors have different lengths, those of the most frequent length (the
longer one of equally frequent ones) are whitened and the others have no rows.
Components without variance (under 1e-24 of the trace) can't be scaled and are
left out, so equal rows only, one row, or an empty table give no rows.  Repeated
rows and null ids each keep their rows; extra columns are ignored.  Entries so
large that x leaves 64 bits are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .sums import SCHEMA, packed, summed

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Share of the trace below which a component has no variance.
FLAT = 1e-24
_EPS = np.finfo(float).eps


def polar(a: np.ndarray, most: int = 60) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH."""
    n = len(a)
    norm = np.linalg.norm(a)
    if norm == 0:
        return np.eye(n)
    x = a / norm
    r = np.linalg.qr(x, mode="r")
    d = np.abs(np.diag(r))
    low = _EPS
    if d.min() > _EPS * d.max():
        low = max(low, 0.9 / np.linalg.norm(np.linalg.inv(r)))
    low = min(low, 1.0)
    for _ in range(most):
        g = np.cbrt(4 * (1 - low * low) / low ** 4)
        h = np.sqrt(1 + g)
        wa = h + 0.5 * np.sqrt(max(0.0, 8 - 4 * g + 8 * (2 - low * low) / (low * low * h)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, np.eye(n))))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        step = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        if abs(low - 1) < 10 * _EPS and step < np.cbrt(_EPS) * 1e-3:
            break
    return x


def _split(a: np.ndarray, shift: float, scale: float) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below the shift; None if the shift lies too near an eigenvalue."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    k = int(round(np.trace(projector)))
    if k in (0, n):
        return k, None, None
    basis = projector @ np.random.default_rng(n).standard_normal((n, k))
    for _ in range(3):
        q, _ = np.linalg.qr(basis, mode="complete")
        if np.abs(q[:, k:].T @ a @ q[:, :k]).max() <= 50 * n * _EPS * scale:
            return k, q[:, :k], q[:, k:]
        basis = projector @ q[:, :k]
    return None


def spectral(a: np.ndarray, scale: float | None = None) -> np.ndarray:
    """Orthonormal eigenvectors of a symmetric matrix as columns, in no order."""
    n = len(a)
    scale = np.linalg.norm(a) if scale is None else scale
    off = a - np.diag(np.diag(a))
    if n == 1 or np.abs(off).max() <= _EPS * scale / n:
        return np.eye(n)
    reach = np.abs(off).sum(axis=1)
    low, high = (np.diag(a) - reach).min(), (np.diag(a) + reach).max()  # Gershgorin
    shift, tries = float(np.median(np.diag(a))), 0
    while high - low > 4 * _EPS * scale:
        found = _split(a, shift, scale)
        if found is None:  # beside an eigenvalue: elsewhere in the interval
            tries += 1
            if tries > 40:
                raise ArithmeticError("no shift splits the spectrum")
            shift = low + (high - low) * ((tries * 0.6180339887498949) % 1)
            continue
        k, above, below = found
        if above is None:
            low, high = (shift, high) if k == n else (low, shift)
            shift = (low + high) / 2
            continue
        parts = []
        for v in (above, below):
            own = v.T @ a @ v
            parts.append(v @ spectral((own + own.T) / 2, scale))
        return np.hstack(parts)
    return np.eye(n)  # equal eigenvalues: any basis


def rotated(b: np.ndarray, sweeps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(values, columns) of a nearly diagonal covariance: plane rotations until each entry is
    within rounding of the two variances that it lies between."""
    b, n = b.copy(), len(b)
    turn = np.eye(n)
    for _ in range(sweeps):
        spread = np.sqrt(np.maximum(np.diag(b), 0))
        left = np.argwhere(np.triu(np.abs(b) > 4 * _EPS * np.outer(spread, spread), 1) & (np.abs(b) > FLAT * _EPS * np.trace(b)))
        if not len(left):
            break
        for i, j in left:
            if b[i, j] == 0:
                continue
            t = (b[j, j] - b[i, i]) / (2 * b[i, j])
            t = 1 / (t + np.copysign(np.hypot(1, t), t))
            c = 1 / np.hypot(1, t)
            g = np.array([[c, t * c], [-t * c, c]])
            b[:, [i, j]] = b[:, [i, j]] @ g
            b[[i, j]] = g.T @ b[[i, j]]
            b[i, j] = b[j, i] = 0
            turn[:, [i, j]] = turn[:, [i, j]] @ g
    return np.diag(b), turn


def components(values: np.ndarray, vectors: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Those with variance by falling eigenvalue, at most ``most``."""
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > FLAT * values.sum()]
    return values[order], vectors[:, order]


def whole_numbers(rows: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector has finite entries only, with ``x`` as an array of longs."""
    entry = lambda e: e.cast("double")
    bad = F.exists(vector_col, lambda e: e.isNull() | F.isnan(entry(e)) | (F.abs(entry(e)) == float("inf")))
    return (rows.where(F.col(vector_col).isNotNull() & ~bad)
            .withColumn("x", F.transform(vector_col, lambda e: F.floor(F.lit(float(SCALE)) * entry(e)) + F.lit(SHIFT).cast("long"))))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


def _moments(fit: DataFrame, d: int, centre: np.ndarray, rest: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
    """Sum over the fit list of z z', z being x - centre - rest, or that times w; a matrix row is a key."""
    k = d if w is None else w.shape[1]

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            x = _matrix(batch.column(0), d)
            for lo in range(0, len(x), 8192):
                z = (x[lo:lo + 8192] - centre).astype(float) - rest
                z = z if w is None else z @ w
                total += z.T @ z
        for i in range(k):
            yield packed(i, total[i])

    got = summed(fit.select("x").mapInArrow(run, SCHEMA), "<f8")
    return np.stack([got[i] for i in range(k)]) if got else np.zeros((k, k))


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """id, component (from 1), n, deviation decimal(38,0), whitened, explained, identity_error.

    deviation is the sum over the dimensions of (n x - S)^2, exact.
    """
    spark = rows.sparkSession
    own = whole_numbers(rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), "v").select("id", "x")
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    lengths = own.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None or not lengths["d"]:
        return spark.createDataFrame([], schema)
    d = lengths["d"]
    own = own.where(F.size("x") == d)
    fit = written(own.groupBy("x").agg(F.lit(1)).select("x"), "fit-list")

    def sums(batches):
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            for lo in range(0, len(x), 4096):  # 32-bit halves, so that no partial sum leaves 64 bits
                part = x[lo:lo + 4096]
                total = total + (part >> 32).sum(axis=0).astype(object) * (1 << 32) + (part & 0xFFFFFFFF).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([int(v) for v in total], pa.decimal128(38, 0))], ["at", "n", "s"])

    found = (fit.mapInArrow(sums, "at int, n long, s decimal(38,0)").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
             .orderBy("at").collect())
    n, s = found[0]["n"], [int(r["s"]) for r in found]
    centre = np.array([v // n for v in s], np.int64)
    left = [v % n for v in s]  # S = n * centre + left
    rest = np.array([v / n for v in left])
    v = _moments(fit, d, centre, rest) / n
    vectors, _ = np.linalg.qr(spectral((v + v.T) / 2))
    inner = _moments(fit, d, centre, rest, vectors) / n
    values, turn = rotated((inner + inner.T) / 2)
    total = values.sum()
    values, vectors = components(values, vectors @ turn, most)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    w = vectors / np.sqrt(values)
    error = float(np.abs(_moments(fit, d, centre, rest, w) / n - np.eye(k)).max())
    explained = values / total
    narrow = np.array(left, np.int64) if n < 1 << 62 else None

    def project(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                y = _matrix(part.column(1), d) - centre
                m = len(y)
                z = (y.astype(float) - rest) @ w
                top = int(np.abs(y).max()) + 1
                if narrow is not None and n * top < 1 << 31 and d < 1 << 20 and (n * top) ** 2 * d < 1 << 62:
                    deviation = ((n * y - narrow) ** 2).sum(axis=1).tolist()
                else:
                    deviation = [sum((n * a - b) ** 2 for a, b in zip(row, left)) for row in y.tolist()]
                take = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                    pa.array(deviation, pa.decimal128(38, 0)).take(take), pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return own.mapInArrow(project, schema)
