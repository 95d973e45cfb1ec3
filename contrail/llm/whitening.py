"""Whitening of embeddings by polarisation covariance.

Exact squares of the centred values are summed for every dimension and for the
sum of every two dimensions. Half the difference of these sums is the product
sum of two dimensions; the covariances so recovered are assembled for the
symmetric eigenvalue problem, and rows are projected on its vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .vectors import usable

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
LONG = 1 << 63
MOST = 2.0 ** 63 - 2.0 ** 21
LIMB = 10 ** 18
AT_ONCE = 4096      # vectors whose squares are summed together
SMALL = 1 << 24     # up to here that many squares of sums fit a long


def whole(vector: Column) -> Column:
    """floor(64 * c) + 1000000 of each component c, as longs; what a long does
    not hold is cut to +-MOST."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(
        c * SCALE, F.lit(MOST)), F.lit(-MOST))) + F.lit(SHIFT))


@dataclass(frozen=True)
class Model:
    """What is fitted to the distinct vectors of one length."""

    n: int
    floor: list[int]        # the whole part of each dimension's mean
    rest: list[int]         # n * mean - n * floor, from 0 to n - 1
    axes: np.ndarray        # (dimensions, components): unit vectors over roots of eigenvalues
    explained: np.ndarray
    usable: np.ndarray      # components whose eigenvalue is not zero


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of each length in a batch, ``AT_ONCE`` rows at a time."""
    column = batch.column("x")
    size = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(), column.offsets.to_numpy()[:-1]
    for d in np.unique(size[size > 0]):
        of = np.flatnonzero(size == d)
        for lo in range(0, len(of), AT_ONCE):
            rows = of[lo:lo + AT_ONCE]
            yield rows, flat[starts[rows][:, None] + np.arange(d)]


def _exact(x: np.ndarray, least: int) -> np.ndarray:
    """``x`` as longs where these hold what is computed, else as unbounded integers."""
    return x if x.size == 0 or np.abs(x).max() < least else x.astype(object)


def _less(x: np.ndarray, base: list[int]) -> np.ndarray:
    """x - base, exact."""
    if np.abs(x).max() < 1 << 61 and max(map(abs, base)) < 1 << 61:
        return x - np.array(base, np.int64)
    return x.astype(object) - np.array(base, object)


def _limbs(sums) -> dict[str, pa.Array]:
    """Whole numbers of any size as two decimal columns that Spark adds up."""
    high, low = zip(*(divmod(int(x), LIMB) for x in sums), strict=True)
    return {c: pa.array(list(map(Decimal, x)), pa.decimal128(38, 0))
            for c, x in (("high", high), ("low", low))}


_LIMBS = "high decimal(38,0), low decimal(38,0)"


def _added(frame: DataFrame, *keys: str, **more) -> list[tuple]:
    """(keys, sum) of each key, at the driver: a row per entry of a model."""
    found = frame.groupBy(*keys).agg(F.sum("high").alias("high"), F.sum("low").alias("low"),
                                     *[v.alias(k) for k, v in more.items()]).collect()
    return [(r, int(r["high"]) * LIMB + int(r["low"])) for r in found]


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number and sums of the vectors, by length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for rows, x in _matrices(batch):
                own = held.setdefault(x.shape[1], [0, 0])
                own[0] += len(rows)
                own[1] = own[1] + _exact(x, 1 << 50).sum(axis=0).astype(object)
        for d, (n, total) in held.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([d] * d, pa.int32()), "at": pa.array(range(d), pa.int32()),
                "n": pa.array([n] * d, pa.int64()), **_limbs(total)})

    found = _added(fit.mapInArrow(run, f"dim int, at int, n long, {_LIMBS}"), "dim", "at", n=F.sum("n"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r, total in sorted(found, key=lambda x: (x[0]["dim"], x[0]["at"])):
        out.setdefault(r["dim"], (r["n"], []))[1].append(total)
    return out


def _squares(fit: DataFrame, floors: dict[int, list[int]]) -> dict[int, np.ndarray]:
    """By length, the symmetric matrix of summed squares: of each centred
    dimension on its diagonal, of the sum of two dimensions beside it. The
    centre is the whole part of the mean, so that squares are whole numbers."""
    sent = fit.sparkSession.sparkContext.broadcast(floors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                c = _exact(_less(x, sent.value[x.shape[1]]), SMALL)
                d = x.shape[1]
                own = held.setdefault(d, [0] * d)
                for i in range(d):  # of dimension i alone, then with each later one
                    both = c[:, i:] + c[:, i:i + 1]
                    both[:, 0] = c[:, i]
                    own[i] = own[i] + (both * both).sum(axis=0).astype(object)
        for d, rows in held.items():
            for i, row in enumerate(rows):
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([d] * len(row), pa.int32()), "i": pa.array([i] * len(row), pa.int32()),
                    "j": pa.array(range(i, d), pa.int32()), **_limbs(row)})

    out = {d: np.zeros((d, d), object) for d in floors}
    for r, total in _added(fit.mapInArrow(run, f"dim int, i int, j int, {_LIMBS}"), "dim", "i", "j"):
        out[r["dim"]][r["i"], r["j"]] = out[r["dim"]][r["j"], r["i"]] = total
    return out


def covariance(squares: np.ndarray, rest: list[int], n: int) -> np.ndarray:
    """Covariances from squares by polarisation: exact products, one division."""
    own = squares.diagonal()
    products = (squares - own[:, None] - own[None, :]) // 2
    np.fill_diagonal(products, own)
    r = np.array(rest, object)
    top = products * n - r[:, None] * r[None, :]
    return np.array([[x / (n * n) for x in row] for row in top.tolist()], np.float64)


def _fit(fit: DataFrame, components: int) -> dict[int, Model]:
    sums = _sums(fit)
    squares = _squares(fit, {d: [s // n for s in total] for d, (n, total) in sums.items()})
    models = {}
    for d, (n, total) in sums.items():
        rest = [s % n for s in total]
        cov = covariance(squares[d], rest, n)
        values, axes = np.linalg.eigh(cov)
        values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
        trace = float(np.trace(cov))
        real = values > max(trace, 0) * d * np.finfo(float).eps
        models[d] = Model(n, [s // n for s in total], rest,
                          axes / np.sqrt(np.where(real, values, 1)),
                          np.where(real, values, 0) / (trace if trace > 0 else 1), real)
    return models


def _project(x: np.ndarray, model: Model) -> np.ndarray:
    return (_less(x, model.floor).astype(np.float64) - np.array(model.rest, float) / model.n) @ model.axes


def _deviation(x: np.ndarray, model: Model) -> list[int | None]:
    """sum over dimensions of (n * x - S) ** 2; null beyond a long."""
    off = _less(x, model.floor)
    most = (int(np.abs(off).max()) + 1) * model.n
    if most * most * x.shape[1] >= LONG:
        off = off.astype(object)
    far = off * model.n - np.array(model.rest, off.dtype)
    return [int(v) if v < LONG else None for v in (far * far).sum(axis=1)]


def _identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length, the largest absolute entry of the whitened fit vectors'
    covariance minus the identity, measured on the vectors."""
    sent = fit.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                model = sent.value[x.shape[1]]
                y = _project(x, model)[:, model.usable]
                own = held.setdefault(x.shape[1], [0.0, 0.0])
                own[0] = own[0] + y.sum(axis=0)
                own[1] = own[1] + y.T @ y
        for d, (first, second) in held.items():
            k = len(first)
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([d] * (k + k * k), pa.int32()),
                "i": pa.array([-1] * k + [i for i in range(k) for _ in range(k)], pa.int32()),
                "j": pa.array([*range(k), *(j for _ in range(k) for j in range(k))], pa.int32()),
                "s": pa.array([*first, *second.ravel()], pa.float64())})

    found = (fit.mapInArrow(run, "dim int, i int, j int, s double").groupBy("dim", "i", "j")
             .agg(F.sum("s").alias("s")).collect())
    errors = {d: 0.0 for d in models}
    mean = {(r["dim"], r["j"]): r["s"] / models[r["dim"]].n for r in found if r["i"] < 0}
    for r in found:
        d, i, j = r["dim"], r["i"], r["j"]
        if i >= 0:
            entry = r["s"] / models[d].n - mean[d, i] * mean[d, j] - (i == j)
            errors[d] = max(errors[d], abs(entry))
    return errors


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``vectors`` and component: the id,
    ``component`` (from 1), ``n`` (distinct vectors), ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    Rows whose vector is null, empty or holds null or non-finite entries are
    left out; a null id stays null. Repeated vectors count once in the fit and
    have rows each. Vectors of each length are fitted on their own; a model of d
    dimensions holds d * d numbers. A component without variance (one distinct
    vector, constant or dependent dimensions) has ``whitened`` null and
    ``explained`` 0 and is not part of the identity error. Entries that a long
    does not hold are cut to its range, and a deviation beyond a long is null.
    No rows give no rows; other columns are not read."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.where(usable(v) & (F.size(v) > 0)).select(F.col(id_col).alias("id"), whole(v).alias("x"))
    fit = cut_lineage(rows.select("x").distinct(), "distinct")
    models = _fit(fit, components)
    sent = fit.sparkSession.sparkContext.broadcast((models, _identity_errors(fit, models)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, errors = sent.value
        for batch in batches:
            for of, x in _matrices(batch):
                model = models[x.shape[1]]
                k, m = len(model.explained), len(of)
                blank = np.tile(~model.usable, m)
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("id").take(pa.array(np.repeat(of, k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    "n": pa.array(np.full(m * k, model.n)),
                    "deviation": pa.array(_deviation(x, model), pa.int64()).take(
                        pa.array(np.repeat(np.arange(m), k))),
                    "whitened": pa.array(_project(x, model).ravel(), mask=blank),
                    "explained": pa.array(np.tile(model.explained, m)),
                    "identity_error": pa.array(np.full(m * k, errors[x.shape[1]]))})

    kind = vectors.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double").withColumnRenamed("id", id_col)
