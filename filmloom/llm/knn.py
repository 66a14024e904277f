"""Exact top-k inner products by a Voronoi join.

Largest inner products are nearest neighbours once every vector gets one more component: the square root of what its
squared length lacks to the largest squared length M for a candidate, and 0 for a query. Then the squared distance is
|q|^2 + M - 2 q.x. Queries and candidates are grouped by their nearest pivots, which are drawn from the candidates.
Each query is first solved in its own group: the k-th best score there, of rows with another id than the query's, is a
score that the answer reaches, and so bounds the distance of what can still matter. A candidate at distance s of its pivot
p is no nearer to q than | |q p| - s |, so for each group of queries and each pivot there is a ring of distances that
matter, and only candidates inside are copied to the group. Small groups of near pivots are packed together. The queries
and copies of a pack are dealt over tasks by their number, each task solves its part with whole-block products, and the
parts' best are merged.

Rings are widened by ``SLACK`` of the longest vector for rounding. Scores are exact: products that doubles can't hold are
taken in whole numbers; a score beyond a long is held at its range.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.operators.skew import fits_broadcast
from filmloom.session import materialise

#: Pivots: the root of the number of candidates within these bounds, which also bound the sample they are drawn from.
PIVOTS = (64, 2_048)
#: Queries that one task holds at most, and candidates that it holds about.
QUERIES, CANDIDATES = 2_048, 50_000
SLACK = 1e-6
SCORES = "query_id bigint, vec_id bigint, score bigint"


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; a shorter one is zero in the components it lacks."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return np.asarray(flat, np.float64).reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _augmented(vectors: np.ndarray, most: float) -> np.ndarray:
    return np.concatenate((vectors, np.sqrt(np.maximum(most - (vectors**2).sum(1, keepdims=True), 0))), 1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squared, 0))


def _nearest(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, most: float | None) -> Iterator[pa.RecordBatch]:
    """Nearest pivot of each vector and its distance; ``most`` is None for queries, whose last component is 0."""
    for batch in batches:
        if batch.num_rows:
            vectors = _matrix(batch.column("v"), pivots.shape[1] - 1)
            full = np.pad(vectors, ((0, 0), (0, 1))) if most is None else _augmented(vectors, most)
            found = _distances(full, pivots)
            cell = found.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(found[np.arange(len(cell)), cell])],
                names=[*batch.schema.names, "cell", "far"],
            )


def _packs(queries: pd.DataFrame, pivots: np.ndarray) -> dict[int, int]:
    """Number of the group of each cell that holds queries: cells in order of their pivots along the direction in which
    pivots vary most, a new group after each ``QUERIES`` queries. ``queries``: cell, n."""
    centred = pivots - pivots.mean(0)
    along = centred @ np.linalg.svd(centred, full_matrices=False)[2][0]
    packs, held, pack = {}, 0, 0
    for cell, n in sorted(zip(queries["cell"], queries["n"], strict=True), key=lambda x: (along[x[0]], x[0])):
        if held and held + n > QUERIES:
            pack, held = pack + 1, 0
        packs[cell], held = pack, held + n
    return packs


def _products(queries: np.ndarray, data: np.ndarray, exact: int) -> np.ndarray:
    """Scores of all pairs: in doubles below 2^53, which hold them exactly, else in longs or in Python integers."""
    if exact < 1 << 53:
        return queries @ data.T
    if exact < 1 << 63:
        return queries.astype(np.int64) @ data.astype(np.int64).T
    whole = lambda x: np.array([[int(c) for c in row] for row in x], object)
    most = np.iinfo(np.int64).max
    return np.clip(whole(queries) @ whole(data).T, -most, most).astype(np.int64)


def _best(queries: pa.Table, candidates: pa.Table, k: int, width: int, exact: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``place of the query, ids, scores``: its best ``k`` candidates of another id, ties to the smaller id, in no order."""
    order = np.argsort(candidates.column("id").to_numpy(), kind="stable")
    ids = candidates.column("id").to_numpy()[order]
    data = _matrix(candidates.column("v"), width)[order]
    asked, vectors = queries.column("id").to_numpy(), _matrix(queries.column("v"), width)
    for start in range(0, len(asked), 256):
        scores = _products(vectors[start : start + 256], data, exact)
        barred = -np.inf if scores.dtype == np.float64 else np.iinfo(np.int64).min
        own = asked[start : start + 256]
        first, last = np.searchsorted(ids, own), np.searchsorted(ids, own, "right")
        for i in np.flatnonzero(first < last):
            scores[i, first[i] : last[i]] = barred
        n = min(k, len(ids))
        least = np.partition(scores, len(ids) - n, axis=1)[:, len(ids) - n]
        for i, row in enumerate(scores):
            above = np.flatnonzero(row > least[i])
            level = np.flatnonzero(row == least[i])[: n - len(above)]
            best = np.concatenate((above, level))
            best = best[row[best] > barred]
            yield start + i, ids[best], row[best].astype(np.int64)


def _solve(queries: pa.Table, candidates: pa.Table, k: int, width: int, exact: int) -> pa.Table:
    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    if not queries.num_rows or not candidates.num_rows:
        return kind.empty_table()
    asked = queries.column("id").to_numpy()
    found = [(np.full(len(ids), asked[i]), ids, scores) for i, ids, scores in _best(queries, candidates, k, width, exact)]
    return pa.table([np.concatenate(x) for x in zip(*found, strict=True)], schema=kind)


def _floors(queries: pa.Table, candidates: pa.Table, k: int, width: int, exact: int) -> pa.Table:
    """Queries with the k-th best score among the candidates; null if there are fewer."""
    floors: list[int | None] = [None] * queries.num_rows
    if queries.num_rows and candidates.num_rows:
        for i, ids, scores in _best(queries, candidates, k, width, exact):
            if len(ids) == k:
                floors[i] = int(scores.min())
    return queries.select(["id", "v", "cell"]).append_column("floor", pa.array(floors, pa.int64()))


def _rings(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, packs: dict[int, int], most: float) -> Iterator[pa.RecordBatch]:
    """For each pack of queries and pivot, between which distances to the pivot a candidate can matter."""
    for batch in batches:
        if batch.num_rows:
            vectors = _matrix(batch.column("v"), pivots.shape[1] - 1)
            floor = batch.column("floor").cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy()
            squared = (vectors**2).sum(1)
            gaps = _distances(np.pad(vectors, ((0, 0), (0, 1))), pivots)
            with np.errstate(invalid="ignore"):
                reach = np.sqrt(np.maximum(squared + most - 2 * floor, 0)) + SLACK * (1 + np.sqrt(most) + np.sqrt(squared))
            pack = np.array([packs[c] for c in batch.column("cell").to_pylist()])
            order = np.argsort(pack, kind="stable")
            at = np.flatnonzero(np.diff(pack[order], prepend=-1))
            inner = np.minimum.reduceat((gaps - reach[:, None])[order], at)
            outer = np.maximum.reduceat((gaps + reach[:, None])[order], at)
            n, m = inner.shape
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(pack[order][at], m)), pa.array(np.tile(np.arange(m, dtype=np.int32), n)), pa.array(inner.ravel()), pa.array(outer.ravel())],
                names=["pack", "cell", "from", "upto"],
            )


def integer_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """``id, v`` of rows of ``vectors`` (vec_id, embedding): each component as floor(scale * x). Vectors that are null,
    empty, or hold a null or non-finite component take no part, nor do rows without an id."""
    whole: Column = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.coalesce(fit & (F.size("embedding") > 0), F.lit(False)) & F.col("vec_id").isNotNull()
    return vectors.filter(ok).select(F.col("vec_id").cast("long").alias("id"), whole.alias("v"))


def _measured(df: DataFrame) -> DataFrame:
    """Sent to every task if measured as small, else joined by shuffle."""
    return F.broadcast(df) if fits_broadcast(df) else df


def needed_copies(near: DataFrame, sought: DataFrame, places: np.ndarray, most: float, k: int, width: int, exact: int) -> tuple[DataFrame, pd.DataFrame]:
    """``pack, r, id, v``: the candidates that can matter to each pack of queries, and the queries of each cell with its pack."""
    spark = near.sparkSession
    # The summaries: a row for each pivot at most.
    asked = sought.groupBy("cell").agg(F.count("*").alias("n")).toPandas()
    asked["pack"] = asked["cell"].map(_packs(asked, places))
    blocks = spark.createDataFrame(pd.DataFrame({"cell": asked["cell"].astype("int32"), "blocks": -(-asked["n"] // QUERIES)}))
    # Of a large cell a slice by row number: any candidates give a score that the answer reaches.
    cells = near.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(CANDIDATES)).alias("slices"), F.min("far").alias("least"), F.max("far").alias("most"))
    cells = F.broadcast(materialise(cells.join(F.broadcast(blocks), "cell", "left"), "cells"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    own = near.join(cells.filter("blocks is not null"), "cell").filter(F.pmod(F.xxhash64("r"), F.col("slices")) == 0).select("cell", every.alias("block"), "id", "v")
    first = sought.join(F.broadcast(blocks), "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "v")
    floors = first.groupBy("cell", "block").cogroup(own.groupBy("cell", "block")).applyInArrow(
        lambda key, q, c: _floors(q, c, k, width, exact), "id bigint, v array<double>, cell int, floor bigint"
    )
    pack_of = {int(c): int(p) for c, p in zip(asked["cell"], asked["pack"], strict=True)}
    rings = floors.mapInArrow(lambda it: _rings(it, places, pack_of, most), "pack bigint, cell int, from double, upto double")
    rings = rings.groupBy("pack", "cell").agg(F.min("from").alias("from"), F.max("upto").alias("upto"))
    rings = rings.join(cells.select("cell", "least", "most"), "cell").filter((F.col("from") <= F.col("most")) & (F.col("upto") >= F.col("least")))
    rings = _measured(materialise(rings.select("pack", "cell", "from", "upto"), "rings"))
    copied = near.join(rings, "cell").filter((F.col("far") >= F.col("from")) & (F.col("far") <= F.col("upto")))
    return materialise(copied.select("pack", "r", "id", "v"), "copied"), asked


def top_products(candidates: DataFrame, queries: DataFrame, k: int = 20, pivots: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query with candidates of another id.

    Both tables are ``id, v`` with whole numbers as doubles; a vector shorter than others is zero in the components it
    lacks. Ranks start at 1; equal scores go to the smaller id. A query with fewer candidates gets them all. Repeated
    candidate rows each take a rank, and none of a query's own id does; a repeated query is answered once, by its
    largest vector. Empty tables give no rows. ``pivots`` grow with the root of the candidates unless given.
    """
    spark = candidates.sparkSession
    data = materialise(candidates.select("id", "v").withColumn("r", F.monotonically_increasing_id()), "candidates")
    asked = materialise(queries.groupBy("id").agg(F.max("v").alias("v")), "queries")
    squared = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows, longest, most = data.agg(F.count("*"), F.max(F.size("v")), F.max(squared)).first()
    wanted, other, far = asked.agg(F.count("*"), F.max(F.size("v")), F.max(squared)).first()
    if not rows or not wanted:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width, exact = max(longest, other), int((most * far) ** 0.5 * (1 + 1e-9)) + 1
    pivots = pivots or min(max(PIVOTS[0], isqrt(rows)), PIVOTS[1])
    drawn = data.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").toArrow()
    places = np.unique(_augmented(_matrix(drawn.column("v"), width), most), axis=0)

    near = materialise(data.mapInArrow(lambda it: _nearest(it, places, most), "id bigint, v array<double>, r bigint, cell int, far double"), "cells")
    sought = materialise(asked.mapInArrow(lambda it: _nearest(it, places, None), "id bigint, v array<double>, cell int, far double"), "query-cells")
    copied, per_cell = needed_copies(near, sought, places, most, k, width, exact)

    packs = per_cell.groupby("pack", as_index=False)["n"].sum()
    packs["blocks"] = -(-packs["n"] // QUERIES)
    packs = spark.createDataFrame(packs[["pack", "blocks"]].astype("int64"))
    deals = copied.groupBy("pack").agg(F.ceil(F.count("*") / F.lit(CANDIDATES)).alias("deals")).join(packs, "pack")
    deals = _measured(materialise(deals, "deals"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    dealt = copied.join(deals, "pack").select("pack", F.pmod(F.xxhash64("r"), F.col("deals")).alias("deal"), every("blocks").alias("block"), "id", "v")
    # A row for each pivot at most.
    of_cell = F.broadcast(spark.createDataFrame(per_cell[["cell", "pack"]].astype({"cell": "int32", "pack": "int64"})))
    copies = sought.join(of_cell, "cell").join(deals, "pack")
    copies = copies.select("pack", every("deals").alias("deal"), F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "v")
    solved = copies.groupBy("pack", "deal", "block").cogroup(dealt.groupBy("pack", "deal", "block")).applyInArrow(
        lambda key, q, c: _solve(q, c, k, width, exact), SCORES
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return solved.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
