"""Linear machine on random Fourier features, learned without ever keeping these features.

Objective, scaling and steps are those of ``pyspark.ml``'s ``LinearSVC``: features are centred and divided by their
deviations, the loss is the mean hinge loss plus the squared coefficients, steps come from ten remembered ones and a
backtracking search (OWL-QN without an L1 part). ``LinearSVC`` keeps ``width`` numbers of each row and reads them in every
pass; here each pass works the features out from the row's own numbers, a few rows at a time in a core's cache.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Features that are worked out at a time, and a variance of cosines below which they count as constant.
_AT_ONCE = 32_768
_CONSTANT = 1e-24
# Settings of the search for a step, as in breeze.
_REMEMBERED, _LAST_VALUES, _SEARCHES = 10, 20, 20
_ARMIJO, _WOLFE, _GROW, _LEAST_STEP, _LARGEST_STEP = 1e-4, 0.9, 2.1, 1e-10, 1e10


def squared_half_cosines(x: np.ndarray, halves: np.ndarray, shifts: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """``(1 + cos(2 (x @ halves + shifts))) / 2``, by the tangent of half the angle: it is far quicker than the cosine."""
    half = np.matmul(x, halves, out=out)
    half += shifts
    np.tan(half, out=half)
    np.multiply(half, half, out=half)
    half += 1.0
    return np.reciprocal(half, out=half)


def _packed(df: DataFrame, features: str, label: str) -> DataFrame:
    """One row for each batch: its vectors and labels as bytes."""
    def pack(batches):
        for batch in batches:
            if batch.column("x").null_count or batch.column("y").null_count:
                raise ValueError("vectors and labels must not be missing")
            x, y = np.asarray(batch.column("x").flatten(), np.float64), np.asarray(batch.column("y"), np.float64)
            if not np.isfinite(x).all():
                raise ValueError("vectors must be finite")
            if not ((y == 0) | (y == 1)).all():
                raise ValueError("labels must be 0 or 1")
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]), pa.array([y.tobytes()])], names=["x", "y"])

    return df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")).mapInArrow(pack, "x binary, y binary")


def _chunks(rows, directions: np.ndarray, shifts: np.ndarray):
    """Halved features and labels of a few rows at a time; the features stand in a buffer that the next ones overwrite."""
    size, width = directions.shape
    step = max(1, _AT_ONCE // width)
    directions, shifts = directions / 2, shifts / 2
    buffer = np.empty((step, width))
    for row in rows:
        x, y = np.frombuffer(row[0]).reshape(-1, size), np.frombuffer(row[1])
        for at in range(0, len(y), step):
            part = x[at:at + step]
            yield squared_half_cosines(part, directions, shifts, buffer[:len(part)]), y[at:at + step]


def _moments(rows, directions: np.ndarray, shifts: np.ndarray):
    """Rows, rows of class 1, and means and squared deviations of the cosines."""
    n, ones, mean, off = 0, 0, np.zeros(len(shifts)), np.zeros(len(shifts))
    for v, y in _chunks(rows, directions, shifts):
        c = 2 * v - 1
        own = c.mean(axis=0)
        n, mean, off = _merged(n, mean, off, len(y), own, ((c - own) ** 2).sum(axis=0))
        ones += int(y.sum())
    yield n, ones, mean, off


def _merged(n: int, mean: np.ndarray, off: np.ndarray, m: int, more: np.ndarray, more_off: np.ndarray):
    gap = more - mean
    return n + m, mean + gap * (m / max(1, n + m)), off + more_off + gap * gap * (n * m / max(1, n + m))


def _losses(rows, directions: np.ndarray, shifts: np.ndarray, weights: np.ndarray, offsets: np.ndarray):
    """Sums of hinge losses of ``cosines @ weights + offsets``, and their derivatives by weights and offsets; a column for each guess."""
    loss, slopes, pull = np.zeros(len(offsets)), np.zeros(weights.shape), np.zeros(len(offsets))
    twice, base = 2 * weights, offsets - weights.sum(axis=0)
    for v, y in _chunks(rows, directions, shifts):
        side = (2 * y - 1)[:, None]
        short = 1 - side * (v @ twice + base)
        missed = short > 0
        loss += np.where(missed, short, 0.0).sum(axis=0)
        pulls = np.where(missed, -side, 0.0)
        slopes += v.T @ pulls
        pull += pulls.sum(axis=0)
    yield loss, 2 * slopes - pull, pull


class _StepFailed(Exception):
    pass


def fit_hinge(
    df: DataFrame, features: str, label: str, directions: np.ndarray, shifts: np.ndarray, *, reg: float, max_iter: int, tol: float,
) -> tuple[np.ndarray, float, list[float]]:
    """Coefficients of the features ``sqrt(2 / width) cos(x @ directions + shifts)``, intercept, and the objective after each step.

    What is kept for the passes are the rows' own vectors; the driver gets one row of ``width`` sums from each task.
    """
    kept = _packed(df, features, label).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, ones, mean, off = 0, 0, np.zeros(len(shifts)), np.zeros(len(shifts))
        for own, more, own_mean, own_off in kept.mapPartitions(lambda rows: _moments(rows, directions, shifts)).collect():
            n, mean, off = _merged(n, mean, off, own, own_mean, own_off)
            ones += more
        if not ones:
            raise ValueError("the kernel machine needs rows of both classes")
        variance = off / max(1, n - 1)
        spread = np.sqrt(np.where(variance > _CONSTANT, variance, 0.0))
        scale = np.sqrt(2.0 / len(shifts))
        inverse = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
        centre = mean * inverse
        penalty = reg * (inverse / scale) ** 2  # of the coefficients before they were scaled

        def objective(guesses: Sequence[np.ndarray]) -> list[tuple[float, np.ndarray]]:
            w = np.array(guesses).T
            weights, offsets = w[:-1] * inverse[:, None], w[-1] - centre @ w[:-1]
            loss, slopes, pull = np.zeros(len(guesses)), np.zeros(weights.shape), np.zeros(len(guesses))
            for a, b, c in kept.mapPartitions(lambda rows: _losses(rows, directions, shifts, weights, offsets)).collect():
                loss, slopes, pull = loss + a, slopes + b, pull + c
            slope = np.vstack([(slopes * inverse[:, None] - np.outer(centre, pull)) / n + penalty[:, None] * w[:-1], pull / n])
            value = loss / n + 0.5 * (penalty[:, None] * w[:-1] ** 2).sum(axis=0)
            return list(zip(value.tolist(), np.ascontiguousarray(slope.T)))

        w, values = minimise(objective, np.zeros(len(shifts) + 1), max_iter, tol)
    finally:
        kept.unpersist()
    return w[:-1] * inverse / scale, float(w[-1] - w[:-1] @ centre), values


def minimise(
    objective: Callable[[Sequence[np.ndarray]], list[tuple[float, np.ndarray]]], start: np.ndarray, max_iter: int, tol: float,
) -> tuple[np.ndarray, list[float]]:
    """The point reached and the values on the way, by the steps that breeze's ``OWLQN`` takes without an L1 part.

    ``objective`` gives values and slopes at some points; a search asks for the points it may need next along with the one it needs.
    """
    x, steps, failed, k = start, [], False, 0
    (value, grad), = objective([x])
    first, values, recent = value, [value], [np.inf]
    while k < max_iter and not (len(recent) >= 2 and abs(value - max(recent)) <= tol * first) and np.linalg.norm(grad) > max(tol * value, 1e-8):
        try:
            way = _direction(grad, steps)
            orthant = np.where(x != 0, np.sign(x), np.sign(-grad))

            def at(*lengths: float) -> list[tuple[np.ndarray, float, np.ndarray]]:
                ends = [x + way * s for s in lengths]
                ends = [to * (np.sign(to) == orthant) for to in ends]
                return [(to, *found) for to, found in zip(ends, objective(ends))]

            new_x, new_value, new_grad = _search(at, value, grad @ way, way, 0.5 / np.linalg.norm(grad) if k < 1 else 1.0, 0.1 if k < 1 else 0.5)
        except _StepFailed:
            if failed:
                break
            failed, steps = True, []
            values.append(value)
            continue
        steps = [(new_x - x, new_grad - grad), *steps][:_REMEMBERED]
        x, value, grad, failed, k = new_x, new_value, new_grad, False, k + 1
        values.append(value)
        recent = [*recent, value][-_LAST_VALUES:]
    return x, values


def _direction(grad: np.ndarray, steps: list) -> np.ndarray:
    """Downhill by the remembered steps; sides on which that leads uphill are left out."""
    scale = 1.0
    if steps:
        along = steps[0][0] @ steps[0][1]
        if not along >= 0:
            raise _StepFailed
        scale = along / (steps[0][1] @ steps[0][1])
    way, shares = grad.copy(), []
    for moved, turned in steps:
        product = moved @ turned
        shares.append((moved @ way / product, product))
        if np.isnan(shares[-1][0]):
            raise _StepFailed
        way = way - shares[-1][0] * turned
    way = way * scale
    for (moved, turned), (share, product) in zip(reversed(steps), reversed(shares)):
        way = way + (share - turned @ way / product) * moved
    return np.where(-way * grad < 0, -way, 0.0)


def _search(at: Callable, begin: float, slope: float, way: np.ndarray, step: float, shrink: float) -> tuple[np.ndarray, float, np.ndarray]:
    """Point, value and slope after a step that lowers the value enough and flattens the slope.

    As in breeze, the first length counts with the value at the start. So it is shortened at once, without a look at it, unless
    the slope is too small to show in the value.
    """
    known: dict[float, tuple] = {}

    def found(s: float):
        if s not in known:
            lengths = [s, *(t for t in (s * _GROW, s * shrink) if t not in known)]
            known.update(zip(lengths, at(*lengths)))
        return known[s]

    value = begin
    for search in range(_SEARCHES):
        if value > begin + step * slope * _ARMIJO:
            times = shrink
        elif (steep := found(step)[2] @ way) < _WOLFE * slope:
            times = _GROW
        elif steep > -_WOLFE * slope:
            times = shrink
        else:
            break
        longer = step * times
        if not _LEAST_STEP <= longer <= _LARGEST_STEP:
            raise _StepFailed
        if search + 1 < _SEARCHES:
            step, value = longer, found(longer)[1]
    return found(step)
