"""Embedding whitening by shifted CholeskyQR.

A QR factorisation of the centred rows needs only their small Gram matrix: its Cholesky factor R turns the rows into
``rows R^-1`` by a triangular solve. One such step fails or loses digits for rows of very unequal directions, so the first
step adds a shift that makes the factor safe, and further passes orthogonalise what the steps before left, until the Gram
matrix is the identity. Rows are never stored between passes: each pass solves through all factors so far. The product
of the factors is the R of the rows; its singular vectors are the principal components and its singular values their
spreads, without the loss of half the digits that the eigenvectors of a covariance matrix suffer.

A pass sends one Gram matrix for each task through a grouped sum; the driver gets width x width numbers, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.session import materialise

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Passes after which the factors stand as they are; a full-rank input needs three.
PASSES = 6
SETTLED = 1e-10
UNIT = 2.0**-53
OUT = "id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def integer_rows(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``id, v`` of rows of ``vectors`` (vec_id, embedding): each entry c as the long floor(scale * c) + offset.

    Rows whose vector is null or holds a null or non-finite entry are left out. Entries beyond a long are held at its range.
    """
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    most = F.lit(float(1 << 62))
    whole = lambda x: F.floor(F.greatest(-most, F.least(most, F.floor(x.cast("double") * scale).cast("double")))) + offset
    return vectors.filter(F.coalesce(fit, F.lit(False))).select(F.col("vec_id").cast("long").alias("id"), F.transform("embedding", whole).alias("v"))


def _matrix(column: pa.Array, width: int, fill: int) -> np.ndarray:
    """Rows of whole numbers; a shorter vector counts as ``fill`` in what it lacks."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(column), width), fill, np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


@dataclass(frozen=True)
class Centre:
    """``n`` rows with sums ``total`` in each place; ``wide`` if products of the numbers need more than a long."""

    n: int
    total: tuple[int, ...]
    fill: int
    wide: bool

    def scaled(self, column: pa.Array) -> np.ndarray:
        """n x - S, exactly: longs, or Python integers where those could overflow."""
        x = _matrix(column, len(self.total), self.fill)
        kind = object if self.wide else np.int64
        return x.astype(kind) * self.n - np.array(self.total, kind)

    def rows(self, column: pa.Array) -> np.ndarray:
        """x - S/n."""
        return self.scaled(column).astype(np.float64) / self.n


def _sums(batches: Iterator[pa.RecordBatch], width: int, fill: int) -> Iterator[pa.RecordBatch]:
    """Exact sum and largest magnitude of each place over a task's rows."""
    total, most = [0] * width, np.zeros(width)
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("v"), width, fill)
            high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            total = [t + (int(h) << 32) + int(lo) for t, h, lo in zip(total, high, low, strict=True)]
            most = np.maximum(most, np.abs(x.astype(np.float64)).max(0))
    sums = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
    yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), sums, pa.array(most)], names=["place", "total", "most"])


def centre_of(data: DataFrame, fill: int = OFFSET) -> Centre | None:
    """Count and exact sums of ``data`` (id, v); None if there is nothing to centre."""
    n, width = data.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n or not width:
        return None
    found = data.select("v").mapInArrow(lambda it: _sums(it, width, fill), "place int, total decimal(38,0), most double")
    # A row for each place of a vector.
    found = found.groupBy("place").agg(F.sum("total").alias("total"), F.max("most").alias("most")).orderBy("place").collect()
    total = tuple(int(r["total"]) for r in found)
    reach = [n * (int(r["most"]) + 1) + abs(int(r["total"])) for r in found]
    return Centre(n, total, fill, wide=sum(x * x for x in reach) >= 1 << 63)


def through(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows factor^-1`` for an upper triangular factor, by substitution from the first column on."""
    out = np.array(rows, order="F")
    for j in range(out.shape[1]):
        out[:, j] = (out[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _grams(batches: Iterator[pa.RecordBatch], made: Callable[[pa.Array], np.ndarray]) -> Iterator[pa.RecordBatch]:
    gram = None
    for batch in batches:
        if batch.num_rows:
            q = made(batch.column("v"))
            q = np.concatenate((q, np.ones((len(q), 1))), 1)
            gram = q.T @ q if gram is None else gram + q.T @ q
    if gram is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(gram)), pa.int32()), pa.array(gram.tolist(), pa.list_(pa.float64()))], names=["place", "values"]
        )


def gram_of(data: DataFrame, made: Callable[[pa.Array], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and column sums of the rows that ``made`` makes of each batch of ``v``."""
    parts = data.select("v").mapInArrow(lambda it: _grams(it, made), "place int, values array<double>")
    cells = parts.select("place", F.posexplode("values").alias("other", "value")).groupBy("place", "other").agg(F.sum("value").alias("value"))
    gram = np.zeros((width + 1, width + 1))
    # (width + 1)^2 numbers.
    for place, other, value in cells.collect():
        gram[place, other] = value
    return gram[:width, :width], gram[:width, width]


def triangular_factors(data: DataFrame, centre: Centre) -> tuple[list[np.ndarray], np.ndarray]:
    """The factors, first pass first, and the Gram matrix of the rows solved through all of them."""
    width, factors = len(centre.total), []
    while True:
        known = list(factors)

        def solved(column: pa.Array, known=known) -> np.ndarray:
            rows = centre.rows(column)
            for factor in known:
                rows = through(rows, factor)
            return rows

        gram, _ = gram_of(data, solved, width)
        spread = np.linalg.eigvalsh(gram)
        if len(factors) == PASSES or not spread[-1] > 0 or (factors and np.abs(spread - 1).max() < SETTLED):
            return factors, gram
        # Without a shift only where nothing is left that rounding could turn negative.
        safe = factors and spread[0] > 0.1
        shift = 0.0 if safe else 11 * (centre.n * width + width * (width + 1)) * UNIT * np.trace(gram)
        factors.append(np.linalg.cholesky(gram + shift * np.eye(width)).T)


def principal(centre: Centre, factors: list[np.ndarray], gram: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit components as columns, their eigenvalues and their shares of the variance, largest first.

    Directions in which the rows don't vary at all, as far as doubles can tell, are left out. Of either sign, that is
    taken which makes the largest entry positive.
    """
    r = np.eye(len(centre.total))
    for factor in factors:
        r = factor @ r
    level, turn = np.linalg.eigh(gram)
    _, size, axes = np.linalg.svd(np.sqrt(np.maximum(level, 0))[:, None] * turn.T @ r)
    values = size**2 / centre.n
    kept = min(components, int((size > size[0] * max(centre.n, len(size)) * UNIT).sum())) if size[0] > 0 else 0
    axes = axes[:kept].T
    if kept:
        axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(kept)])
    return axes, values[:kept], values[:kept] / values.sum() if kept else values[:kept]


def _deviations(scaled: np.ndarray) -> pa.Array:
    total = (scaled**2).sum(1)
    return pa.array([Decimal(int(t)) if int(t) < 10**38 else None for t in total], pa.decimal128(38, 0))


def _whitened(batches: Iterator[pa.RecordBatch], centre: Centre, project: np.ndarray, explained: np.ndarray, error: float) -> Iterator[pa.RecordBatch]:
    k = project.shape[1]
    for batch in batches:
        if batch.num_rows:
            scaled, rows = centre.scaled(batch.column("v")), batch.num_rows
            at = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, centre.n)), _deviations(scaled).take(at),
                    pa.array((scaled.astype(np.float64) / centre.n @ project).ravel()), pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def whiten(rows: DataFrame, components: int = COMPONENTS, fill: int = OFFSET) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` for each row and component of ``rows`` (id, v).

    ``v`` holds whole numbers; all rows form the fit list, repeated rows and null ids too. A vector shorter than the longest
    counts as ``fill`` in what it lacks. ``deviation`` is the exact sum of (n x - S)^2, null from 10^38 on. Components
    are numbered from 1 by falling eigenvalue; equal eigenvalues share a plane, in which any axes may come. There are as
    many as directions in which the rows vary, at most ``components``: one row alone, equal rows, empty vectors or an
    empty table give no rows.
    """
    spark = rows.sparkSession
    data = materialise(rows.select("id", "v"), "whole-vectors")
    centre = centre_of(data, fill)
    if centre is None:
        return spark.createDataFrame([], OUT)
    factors, gram = triangular_factors(data, centre)
    axes, values, explained = principal(centre, factors, gram, components)
    if not len(values):
        return spark.createDataFrame([], OUT)
    project = axes / np.sqrt(values)
    square, sums = gram_of(data, lambda column: centre.rows(column) @ project, len(values))
    covariance = square / centre.n - np.outer(sums, sums) / centre.n**2
    error = float(np.abs(covariance - np.eye(len(values))).max())
    return data.mapInArrow(lambda it: _whitened(it, centre, project, explained, error), OUT)


def long_deviation() -> Column:
    """The deviation as a long; null where a long is too small for it."""
    return F.col("deviation").try_cast("long")
