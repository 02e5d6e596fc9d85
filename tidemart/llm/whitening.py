"""Whitening of embeddings by an incremental eigendecomposition, refined over the whole table."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .spectrum import EPS, Spectrum

COMPONENTS = 4
# Steps of an entry's grid.
STEPS = 256
# Vectors that one task updates its spectrum with before there are ``MOST_TASKS`` of them.
TASK_ROWS = 2048
MOST_TASKS = 4096
# Partial results that one task merges.
FAN = 16
# Entries beyond this have no place on a grid of longs.
LARGEST = 2.0**55

_PARTIAL = "part long, n long, sums array<decimal(38,0)>, mean binary, value binary, vectors binary"
_RESULT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
    "identity_error double"
)


def gridded(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: vectors (vec_id, embedding) as whole numbers of 1/256, rounded down.

    Left out are vectors that are null, empty or hold a null or non-finite entry, or one beyond 2^55; and
    those of another length than most have (of equally many, the longer).
    """
    entry = F.col("embedding").cast("array<double>")
    fits = F.forall("_c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), entry.alias("_c"))
        .where(F.coalesce(fits, F.lit(False)) & (F.size("_c") > 0))
        .select("vec_id", F.transform("_c", lambda c: F.floor(c * STEPS)).alias("x"))
    )
    lengths = rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.agg(F.max(F.struct("rows", "dim")).alias("most")).select("most.dim")
    # One row.
    return rows.join(F.broadcast(most), F.size("x") == F.col("dim")).drop("dim")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their x as one matrix of whole numbers."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            yield batch, x.reshape(batch.num_rows, -1)


def _sums(x: np.ndarray) -> list[int]:
    """Column sums as Python numbers: high and low halves are added apart, so none overflows."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(v) for h, v in zip(high, low)]


def _row(part: int, n: int, sums: list[int], mean=b"", value=b"", vectors=b"") -> pd.DataFrame:
    cells = {"part": part, "n": n, "sums": [Decimal(s) for s in sums], "mean": mean, "value": value, "vectors": vectors}
    return pd.DataFrame([cells])


def _spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spectrum of a partition: a centred rank-one update for every vector."""
    found, sums = None, None
    for _, x in _matrices(batches):
        if found is None:
            found, sums = Spectrum.empty(x.shape[1]), [0] * x.shape[1]
        sums = [a + b for a, b in zip(sums, _sums(x))]
        for row in x.astype(np.float64):
            found.add(row)
    if found:
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([found.n]), pa.array([[Decimal(s) for s in sums]], pa.list_(pa.decimal128(38, 0))),
             *[pa.array([v.tobytes()], pa.binary()) for v in (found.mean, found.values, found.vectors)]],
            names=["part", "n", "sums", "mean", "value", "vectors"],
        )


def _spectrum(row) -> Spectrum:
    dim = len(row.sums)
    vectors = np.frombuffer(row.vectors).reshape(dim, dim)
    return Spectrum(int(row.n), np.frombuffer(row.mean), np.frombuffer(row.value), vectors)


def _merged_spectra(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    found, sums = None, None
    for row in rows.itertuples():
        if found is None:
            found, sums = _spectrum(row), [int(s) for s in row.sums]
        else:
            found.merge(_spectrum(row))
            sums = [a + int(b) for a, b in zip(sums, row.sums)]
    return _row(int(key[0]), found.n, sums, found.mean.tobytes(), found.values.tobytes(), found.vectors.tobytes())


def _added_products(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    total = sum(np.frombuffer(v) for v in rows["value"])
    return _row(int(key[0]), int(rows["n"].sum()), [], value=total.tobytes())


def _tree(parts: DataFrame, merge, count: int, name: str):
    """The one row that partial results, numbered below ``count``, merge into; a few of them a task."""
    while True:
        grouped = parts.groupBy(F.floor(F.col("part") / FAN).alias("_group"))
        parts = staged(grouped.applyInPandas(merge, _PARTIAL), name)
        count = -(-count // FAN)
        if count <= 1:
            return parts.first()


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x less the mean, given as a whole number and what is left of it: the large parts cancel exactly."""
    return (x - whole).astype(np.float64) - rest


def _products(batches: Iterator[pa.RecordBatch], whole, rest, basis) -> Iterator[pa.RecordBatch]:
    """The sum of outer products of a partition's centred vectors, in the basis."""
    total, n = np.zeros_like(basis), 0
    for _, x in _matrices(batches):
        y = _centred(x, whole, rest) @ basis
        total += y.T @ y
        n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()]), pa.array([n]),
             pa.array([[]], pa.list_(pa.decimal128(38, 0))),
             *[pa.array([v], pa.binary()) for v in (b"", total.tobytes(), b"")]],
            names=["part", "n", "sums", "mean", "value", "vectors"],
        )


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal]:
    largest = n * int(np.abs(x).max()) + max(map(abs, sums))
    if largest < 2**62 and largest * largest * x.shape[1] < 2**63:
        away = n * x - np.array(sums, np.int64)
        return [Decimal(int(d)) for d in (away * away).sum(axis=1)]
    away = x.astype(object) * n - np.array(sums, object)
    return [Decimal(d) for d in (away * away).sum(axis=1)]


def _projected(batches: Iterator[pa.RecordBatch], whole, rest, axes) -> Iterator[pa.RecordBatch]:
    for batch, x in _matrices(batches):
        w = _centred(x, whole, rest) @ axes
        kept = [batch.column(name) for name in batch.schema.names if name != "x"]
        yield pa.RecordBatch.from_arrays(
            [*kept, *[pa.array(np.ascontiguousarray(w[:, i])) for i in range(w.shape[1])]],
            names=[*[n for n in batch.schema.names if n != "x"], *[f"w{i}" for i in range(w.shape[1])]],
        )


def _whitened(batches: Iterator[pa.RecordBatch], n, sums, whole, rest, axes, explained, error) -> Iterator[pa.RecordBatch]:
    k = axes.shape[1]
    for batch, x in _matrices(batches):
        rows = len(x)
        w = _centred(x, whole, rest) @ axes
        each = np.repeat(np.arange(rows), k)
        deviations = pa.array(_deviations(x, n, sums), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
             pa.array(np.full(rows * k, n)), deviations.take(pa.array(each)), pa.array(w.ravel()),
             pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
            names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        )


def _identity_error(fit: DataFrame, whole, rest, axes) -> float:
    """The largest entry of the covariance of the whitened fit list less the identity."""
    k = axes.shape[1]
    schema = ", ".join(f"w{i} double" for i in range(k))
    w = fit.mapInArrow(partial(_projected, whole=whole, rest=rest, axes=axes), schema)
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    found = w.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of vectors (vec_id, embedding).

    Vectors are taken on a grid, see :func:`gridded`. The model is fitted to each distinct one once: every
    partition keeps the eigensystem of what it has seen and takes a vector up by a centred rank-one update
    (the roots of a secular equation, with negligible and equal parts deflated), partitions are merged in a tree by
    further rank-one updates, and a last pass over the distinct vectors solves the eigenproblem of their
    covariance within the basis found (Rayleigh-Ritz), which takes away the errors that updates gather.
    The driver and a task of the tree hold eigensystems only: numbers by the square of the dimension.

    Components fall by eigenvalue; their sign makes the largest entry positive. ``n`` counts the distinct
    vectors; ``deviation`` is exact. Directions without variance have no component, so a table whose
    usable vectors are all equal has no rows, like an empty one. Repeated rows each have a result, a null
    vec_id stays null, other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = staged(gridded(vectors.select("vec_id", "embedding")), "whitening-rows")
    fit = staged(rows.select("x").distinct(), "whitening-fit")
    n = fit.count()
    if n < 2:
        return spark.createDataFrame([], _RESULT)
    tasks = min(-(-n // TASK_ROWS), MOST_TASKS)
    # Dealt evenly by rows: an update costs the same for every vector, whatever its bytes.
    spectra = staged(fit.repartition(tasks).mapInArrow(_spectra, _PARTIAL), "whitening-spectra")
    found = _tree(spectra, _merged_spectra, tasks, "whitening-spectra")
    sums = [int(s) for s in found.sums]
    dim = len(sums)
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    basis = np.frombuffer(bytes(found.vectors)).reshape(dim, dim)
    parts = fit.mapInArrow(partial(_products, whole=whole, rest=rest, basis=basis), _PARTIAL)
    parts = staged(parts, "whitening-products")
    ends = parts.agg(F.max("part")).first()[0] + 1
    product = np.frombuffer(bytes(_tree(parts, _added_products, ends, "whitening-products").value)).reshape(dim, dim)
    values, turned = np.linalg.eigh((product + product.T) / 2)
    values, axes = values[::-1] / n, (basis @ turned)[:, ::-1]
    k = min(components, int((values > dim * EPS * max(values[0], 0.0)).sum()))
    axes, lead = axes[:, :k], values[:k]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])
    scaled = axes / np.sqrt(lead)
    error = _identity_error(fit, whole, rest, scaled)
    done = partial(_whitened, n=n, sums=sums, whole=whole, rest=rest, axes=scaled, explained=lead / values.sum(), error=error)
    return rows.mapInArrow(done, _RESULT)
