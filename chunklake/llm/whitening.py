"""Whitening of embeddings by a bidiagonal qd solver.

The centred rows are never multiplied with themselves: their blocks are reduced by QR factorisations to one small triangle R
with the same singular values. Householder reflections bring R to a bidiagonal B; differential quotient-difference steps with
shifts (dqds) find the singular values of B to high relative accuracy; and each direction comes from twisted factorisations of
B^T B - s^2, one forward and one backward, glued where their residual is least. Vectors of close singular values, which twisted
factorisations cannot hold apart by themselves, are made orthogonal to each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import in_small_batches, kept, private

#: Components at most, and the grid that vectors are put on: floor(GRID * entry) + SHIFT.
COMPONENTS, GRID, SHIFT = 16, 64, 1_000_000
#: Triangles that one task joins.
JOINED = 64
#: Singular values closer than this share of the first have their vectors made orthogonal.
CLOSE = 1e-3
#: What a direction may miss its equation by, as a share of the first square.
SETTLED = 1e-13
EPS = float(np.finfo(float).eps)


def gridded(vector: Column, dimensions: int) -> Column:
    """The vector on the integer grid; null where it is null, of another length, or has entries that are null or not finite."""
    infinite = F.lit(float("inf"))
    sound = F.size(vector) == dimensions
    for bad in (lambda x: x.isNull(), F.isnan, lambda x: F.abs(x) == infinite):
        sound = sound & ~F.coalesce(F.exists(vector, bad), F.lit(True))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * GRID) + SHIFT))


# --- the solver: dense matrices of a vector's dimensions, on the driver -----------------------------------------------


def triangle(*blocks: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of stacked blocks, square."""
    rows = np.vstack(blocks)
    r = np.linalg.qr(rows, mode="r") if len(rows) else rows
    return np.vstack([r, np.zeros((max(0, rows.shape[1] - len(r)), rows.shape[1]))])


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U^T R V, and V, by Householder reflections from both sides in turn."""
    a, n = r.astype(float).copy(), r.shape[1]
    v = np.eye(n)

    def reflection(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            return None
        u = x.copy()
        u[0] += math.copysign(norm, x[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        u = reflection(a[k:, k])
        if u is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < n - 2:
            u = reflection(a[k, k + 1 :])
            if u is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One dqds sweep: the factors of L R - shift as new L and R, and the least d met."""
    d, least = q[0] - shift, math.inf
    new_q, new_e = [0.0] * len(q), [0.0] * len(e)
    for k in range(len(e)):
        least = min(least, d)
        new_q[k] = d + e[k]
        if new_q[k] <= 0:
            return new_q, new_e, -math.inf
        ratio = q[k + 1] / new_q[k]
        new_e[k] = e[k] * ratio
        d = d * ratio - shift
    new_q[-1] = d
    return new_q, new_e, min(least, d)


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The singular values of a bidiagonal matrix, falling, by dqds on the squares of its entries."""
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if not scale:
        return np.zeros(len(diagonal))
    found: list[float] = []
    rounds, most = 0, 60 * len(diagonal) + 200
    # a zero on the diagonal is carried to the end by a sweep without shift, and parted from the rest there
    pending = [(((diagonal / scale) ** 2).tolist(), ((above / scale) ** 2).tolist(), 0.0)]
    while pending:
        q, links, shifted = pending.pop()
        while q:
            rounds += 1
            if rounds > most:
                raise RuntimeError("dqds does not settle")
            if len(q) == 1:
                found.append(math.sqrt(max(q[0] + shifted, 0.0)))
                break
            cut = next((k for k in range(len(links) - 1, -1, -1) if links[k] <= EPS * EPS * (shifted + q[k + 1])), None)
            if cut is not None:
                pending.append((q[: cut + 1], links[:cut], shifted))
                q, links = q[cut + 1 :], links[cut + 1 :]
                continue
            # the lesser eigenvalue of the last two rows; where that goes too far, less of it, at last none
            a, b, c = q[-2] + (links[-2] if len(links) > 1 else 0.0), math.sqrt(q[-2] * links[-1]), q[-1] + links[-1]
            half = (a - c) / 2
            guess = c - b * b / (half + math.copysign(math.hypot(half, b), half)) if b else min(a, c)
            shift = max(0.0, min(guess, q[-1])) * (1 - 4 * EPS)
            for tried in (shift, shift * (1 - math.sqrt(EPS)), shift * 0.75, shift * 0.25, 0.0):
                new_q, new_links, least = _step(q, links, tried)
                if least >= 0:
                    break
            q, links, shifted = new_q, new_links, shifted + tried
    return np.sort(np.array(found))[::-1] * scale


def _twisted(diagonal: np.ndarray, above: np.ndarray, square: float) -> np.ndarray:
    """A unit vector z with (B^T B - square) z = least: stationary steps from the top, progressive ones from the bottom, joined at the twist."""
    n, tiny = len(diagonal), float(np.finfo(float).tiny) * 1e20
    # B^T B = L D L^T with D = squares of the diagonal and L holding above / diagonal
    d = [x * x or tiny for x in diagonal.tolist()]
    low = [b / (a or math.sqrt(tiny)) for a, b in zip(diagonal.tolist(), above.tolist(), strict=False)]
    s, plus = [-square] + [0.0] * (n - 1), [0.0] * max(n - 1, 0)
    for k in range(n - 1):
        pivot = d[k] + s[k] or tiny
        plus[k] = d[k] * low[k] / pivot
        s[k + 1] = plus[k] * low[k] * s[k] - square
    p, minus = [0.0] * (n - 1) + [d[-1] - square], [0.0] * max(n - 1, 0)
    for k in range(n - 2, -1, -1):
        pivot = d[k] * low[k] * low[k] + p[k + 1] or tiny
        minus[k] = d[k] * low[k] / pivot
        p[k] = d[k] / pivot * p[k + 1] - square
    residual = [abs(s[k] + p[k] + square) for k in range(n)]
    twist = min(range(n), key=lambda k: residual[k] if math.isfinite(residual[k]) else math.inf)
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -plus[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -minus[k] * z[k]
    norm = np.linalg.norm(z)
    return z / norm if math.isfinite(norm) and norm else np.eye(n)[twist]


def _directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors of the bidiagonal matrix for its leading singular values, as columns, orthogonal to each other."""
    b = np.diag(diagonal) + np.diag(above, 1)
    columns: list[np.ndarray] = []

    def apart(z: np.ndarray, near: list[np.ndarray]) -> tuple[np.ndarray, float]:
        """What is left of the vector beside its neighbours, as a unit vector, and how much; twice is enough."""
        size = float(np.linalg.norm(z))
        for _ in range(2):
            for other in near:
                z = z - (other @ z) * other
        left = float(np.linalg.norm(z))
        return z / (left or 1.0), left / (size or 1.0)

    def settled(z: np.ndarray, value: float) -> bool:
        return bool(np.linalg.norm(b.T @ (b @ z) - value * value * z) <= SETTLED * values[0] ** 2)

    for k, value in enumerate(values.tolist()):
        near = [columns[m] for m in range(k) if values[m] - value <= CLOSE * values[0]]
        z, left = apart(_twisted(diagonal, above, value * value), near)
        starts = iter(np.eye(len(diagonal)))
        # a vector that lies among its neighbours, whose value it shares, is sought by inverse iteration from elsewhere
        while not (left > 1e-3 and settled(z, value)) and (start := next(starts, None)) is not None:
            z, left = apart(start, near)
            for _ in range(3):
                if not (left > 1e-3 and settled(z, value)):
                    z, left = apart(_solved(b, value, z), near)
        columns.append(z)
    return np.stack(columns, 1)


def _solved(b: np.ndarray, value: float, z: np.ndarray) -> np.ndarray:
    """One step of inverse iteration."""
    matrix = b.T @ b - value * value * (1 + 8 * EPS) * np.eye(len(b))
    try:
        return np.linalg.solve(matrix, z)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(matrix, z, rcond=None)[0]


def components_of(r: np.ndarray, most: int, rows: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """Right singular vectors of the triangle as columns, their singular values, and the sum of all squares.

    Directions whose singular value is rounding only (under eps of the first, times the rows reduced or the dimensions) are left out.
    """
    if not r.size or not np.any(r):
        return np.zeros((r.shape[1], 0)), np.zeros(0), 0.0
    diagonal, above, v = bidiagonalised(r)
    values = singular_values(diagonal, above)
    sound = values > max(rows, len(values)) * EPS * values[0]
    wanted = int(min(most, sound.sum()))
    return v @ _directions(diagonal, above, values[:wanted]), values[:wanted], float((values**2).sum())


# --- the passes over the table -----------------------------------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S / n, rounded once: whole numbers are subtracted before the fraction is."""
    whole = np.array([s // n for s in sums])
    return (x - whole) - np.array([s % n / n for s in sums])


def _reduced(sums: list[int], n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The triangle of a task's centred rows, block by block."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            if batch.num_rows:
                block = _centred(_matrix(batch["x"], len(sums)), sums, n)
                r = triangle(block) if r is None else triangle(r, block)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.astype("<f8").tobytes()], pa.binary())], ["r"])

    return reduce


def _read(rows: list[bytes], width: int) -> list[np.ndarray]:
    return [np.frombuffer(r, "<f8").reshape(-1, width) for r in rows]


def reduced_triangle(fit: DataFrame, sums: list[int], n: int, joined: int = JOINED) -> np.ndarray:
    """R of all centred rows: one triangle a task, joined ``joined`` at a time until one is left."""
    width = len(sums)
    triangles = kept(fit.mapInArrow(_reduced(sums, n), "r binary"), "whitening-triangles")
    count = triangles.count()

    def join(group: pa.Table) -> pa.Table:
        r = triangle(*_read(sorted(group["r"].to_pylist()), width))
        return pa.table({"r": pa.array([r.astype("<f8").tobytes()], pa.binary())})

    while count > joined:
        lots = -(-count // joined)
        triangles = kept(triangles.groupBy(F.pmod(F.xxhash64("r"), F.lit(lots)).alias("lot")).applyInArrow(join, "r binary"), "whitening-triangles")
        count = triangles.count()
    rows = [bytes(row["r"]) for row in triangles.collect()]  # at most ``joined`` triangles of a vector's dimensions
    return triangle(*_read(sorted(rows), width)) if rows else np.zeros((width, width))


def _moments(sums: list[int], n: int, to: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums and sums of products of a task's whitened rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = to.shape[1]
        total, products = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            white = _centred(_matrix(batch["x"], len(sums)), sums, n) @ to
            total += white.sum(0)
            products += white.T @ white
        places = np.arange(width * (width + 1))
        values = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(values)], ["place", "value"])

    return add


def identity_error(fit: DataFrame, sums: list[int], n: int, to: np.ndarray) -> float:
    """The largest absolute entry of the whitened fit list's covariance less the identity, measured on the rows."""
    width = to.shape[1]
    cells = fit.mapInArrow(_moments(sums, n, to), "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(width * (width + 1))
    for row in cells:  # one for each cell of the covariance
        flat[row["place"]] = row["value"]
    mean = flat[:width] / n
    covariance = flat[width:].reshape(width, width) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(width)).max(initial=0))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over dimensions of (n x - S)^2, exact; None beyond 63 bits."""
    if max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums))) < 2**62:
        apart = n * x - np.array(sums, np.int64)
        if int(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return (apart * apart).sum(1).tolist()
    exact = [sum((n * value - s) ** 2 for value, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [d if d < 2**63 else None for d in exact]


def _whitened(sums: list[int], n: int, to: np.ndarray, explained: list[float], error: float, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    width, count = len(sums), to.shape[1]

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(batch.num_columns - 1), width)
            white = _centred(x, sums, n) @ to
            deviation = _deviations(x, n, sums)
            at = np.repeat(np.arange(len(x)), count)
            rows = batch.select(batch.schema.names[:-1])
            columns = [
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(at), n, np.int64)),
                pa.array(deviation, pa.int64()).take(pa.array(at)),
                pa.array(white.ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(at), error)),
            ]
            rows = rows.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*rows.columns, *columns], [*rows.schema.names, *names])

    return whiten


ADDED = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}


def whiten(vectors: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row per sound vector and component: its other columns, ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Vectors are put on an integer grid, fitted once for each distinct one, and centred exactly: sums are whole numbers. Two
    passes fit (sums, then triangles), one measures the covariance, one whitens; distinct vectors are the only shuffle of rows.
    The driver holds triangles of a vector's dimensions. ``deviation`` is exact, and null where it exceeds 63 bits.

    Dropped are rows whose vector is null or of another length than most are (of equally many the longest counts), or holds
    null, NaN or infinite entries. Repeated rows are whitened each. Components without variance are left out: a table whose
    vectors are all alike, and an empty table, give no rows. Columns named like the new ones are replaced.
    """
    spark = vectors.sparkSession
    in_small_batches(spark)
    vectors = vectors.select(*(c for c in vectors.columns if c.lower() not in ADDED or c == column))
    others = [c for c in vectors.columns if c != column]
    inner = private(vectors.drop(column), "x", *ADDED)
    schema = vectors.drop(column).withColumns({i: F.lit(None).cast(t) for i, t in zip(inner[1:], ADDED.values(), strict=True)}).schema
    lengths = vectors.filter(F.col(column).isNotNull()).groupBy(F.size(column).alias("size")).agg(F.count("*").alias("rows"))
    commonest = lengths.orderBy(F.col("rows").desc(), F.col("size").desc()).first()
    if not commonest or not commonest["size"]:
        return spark.createDataFrame([], schema).withColumnsRenamed(dict(zip(inner[1:], ADDED, strict=True)))
    width = commonest["size"]
    x = inner[0]
    sound = vectors.select(*(F.col(f"`{c}`") for c in others), gridded(F.col(f"`{column}`"), width).alias(x)).filter(F.col(x).isNotNull())
    fit = kept(sound.select(F.col(x).alias("x")).distinct(), "whitening-fit")
    total = fit.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.sum("v").alias("s"), F.count("*").alias("n")).collect()
    sums, n = [row["s"] for row in sorted(total, key=lambda row: row["d"])], total[0]["n"] if total else 0
    if not n:
        return spark.createDataFrame([], schema).withColumnsRenamed(dict(zip(inner[1:], ADDED, strict=True)))
    directions, values, squares = components_of(reduced_triangle(fit, sums, n), most, n)
    to = directions * (math.sqrt(n) / values)
    error = identity_error(fit, sums, n, to)
    explained = (values**2 / squares).tolist() if squares else []
    rows = sound.mapInArrow(_whitened(sums, n, to, explained, error, inner[1:]), schema)
    return rows.withColumnsRenamed(dict(zip(inner[1:], ADDED, strict=True)))
