"""SimHash near-duplicates, with bit-sliced comparison of fingerprints.

Fingerprints that differ in at most ``radius`` of 64 bits agree wholly in all but ``radius`` of any blocks the bits are
divided into, so only fingerprints that share such a choice of blocks are compared. In a task the fingerprints lie
sorted by that key and are compared in tiles: the bits of a tile's ``LANES`` fingerprints are stored as 64 planes, one
word for 64 fingerprints; for a tile of other fingerprints all differences of a plane are added to bitwise counters by
carry-save, and a fingerprint whose distance to the whole tile exceeds the radius is abandoned. Links are reduced to a
spanning set in each tile, and components found by contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.llm.common import by_size, steps
from filmloom.llm.components import components
from filmloom.session import materialise

SEED = 42
RADIUS = 3
SHINGLE = 3
LANES = 512
#: Fingerprints expected to share a key, at most; more blocks are used from there on.
CROWD = 64
#: Members of one key that a task compares; a larger group is divided, and its parts compared pair by pair.
GROUP = 16_384
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text: bit i is 1 if it is set in over half of the hashes of its shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle)), strict=False)) if len(words) >= shingle else iter([b" ".join(words)])
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    sums = np.zeros(64, np.int64)
    for start in range(0, n, BLOCK):
        part = np.fromiter(hashes, np.uint64, min(BLOCK, n - start))
        sums += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * sums > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in steps(batches, lambda b: b.column("text")):
        found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found.view(np.int64))], names=["row", "fingerprint"])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """Every document as ``row`` (a struct of its columns ``keep``) with the ``fingerprint`` of its text as a long."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "text")
    schema = T.StructType([rows.schema["row"], T.StructField("fingerprint", T.LongType())])
    return rows.mapInArrow(lambda it: _fingerprints(it, shingle), schema)


def block_count(n: int, radius: int = RADIUS) -> int:
    """The fewest blocks for which ``n`` fingerprints, if evenly spread, share a key with at most ``CROWD`` others."""
    blocks = radius + 1
    while blocks < 2 * radius + 2 and n >> (64 * (blocks - radius) // blocks) > CROWD:
        blocks += 1
    return blocks


def keys_of(blocks: int, radius: int = RADIUS) -> list[Column]:
    """A key for each choice of ``blocks - radius`` blocks: the fingerprint with all other bits cleared."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [F.col("fp").bitwiseAND(F.lit(signed(sum(chosen))).cast("long")) for chosen in combinations(masks, blocks - radius)]


def planes_of(fps: np.ndarray) -> np.ndarray:
    """64 rows of words: bit j of row i's words is bit i of the j-th fingerprint. Spare lanes are zero."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = np.pad(bits, ((0, -len(fps) % 64), (0, 0)))
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(queries: np.ndarray, lanes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in queries, place in lanes) at most ``radius`` bits apart.

    Each counter starts so far below its overflow that the radius just fits, and saturates by the overflow word. Queries
    without a lane left are abandoned after each 8 planes.
    """
    planes, alive = planes_of(lanes), np.arange(len(queries))
    flips = np.where(np.unpackbits(queries.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool), ~np.uint64(0), np.uint64(0))
    width = radius.bit_length()
    ahead = (1 << width) - 1 - radius
    shape = (len(queries), planes.shape[1])
    count = [np.full(shape, ~np.uint64(0) if ahead >> b & 1 else np.uint64(0)) for b in range(width)]
    over = np.zeros(shape, np.uint64)
    if len(lanes) % 64:
        over[:, -1] = ~np.uint64(0) << np.uint64(len(lanes) % 64)
    for i in range(64):
        carry = planes[i][None, :] ^ flips[:, i][:, None]
        for c in count:
            held = c & carry
            c ^= carry
            carry = held
        over |= carry
        if i % 8 == 7 and i < 63:
            left = (over != ~np.uint64(0)).any(1)
            if not left.all():
                alive, flips, over, count = alive[left], flips[left], over[left], [c[left] for c in count]
                if not len(alive):
                    return alive, alive
    found = np.unpackbits((~over).view(np.uint8).reshape(len(alive), -1), axis=1, bitorder="little")
    q, lane = np.nonzero(found)
    return alive[q], lane


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``n`` edges that join the same places (below ``n``) as the edges ``a, b``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        fresh = root.copy()
        np.minimum.at(fresh, root[a], low)
        np.minimum.at(fresh, root[b], low)
        fresh = fresh[fresh[root]]
        if (fresh == root).all():
            break
        root = fresh
    nodes = np.unique(np.concatenate((a, b)))
    nodes = nodes[root[nodes] != nodes]
    return nodes, root[nodes]


def links(key: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among fingerprints that share a key, tile by tile; ``key`` is sorted."""
    last = np.searchsorted(key, key, "right")
    for start in range(0, len(fps), LANES):
        stop = min(start + LANES, len(fps))
        for lane in range(start, int(last[stop - 1]), LANES):
            # Places in this pair of tiles; those of the second tile follow those of the first.
            q, p = within(fps[start:stop], fps[lane : lane + LANES], radius)
            p = p + LANES * (lane > start)
            q, p = q[q < p], p[q < p]
            if len(q) > 2 * LANES:
                q, p = spanning(q, p, 2 * LANES)
            if len(q):
                place = lambda x, start=start, lane=lane: fps[np.where(x < LANES, x + start, x - LANES + lane)]
                yield place(q), place(p)


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    parts = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.concat_tables(parts)
    groups = rows.select(["table", "key", "part"]).to_pandas()
    key = np.concatenate(([0], np.cumsum((groups != groups.shift()).any(axis=1).to_numpy()[1:])))
    fps = rows.column("fp").to_numpy().view(np.uint64)
    for a, b in links(key, fps, radius):
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a, b`` between the distinct fingerprints ``fp`` that join the same ones as all pairs within the radius."""
    spark, n = distinct.sparkSession, distinct.count()
    choices = keys_of(block_count(n, radius), radius)
    keyed = distinct.select("fp", F.posexplode(F.array(*choices)).alias("table", "key"))
    crowded = materialise(keyed.groupBy("table", "key").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP), "crowds")
    # A crowded key is divided into parts of at most half a group; each pair of parts is a group of its own.
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(GROUP // 2)), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.least(p, F.col("own")) * F.col("parts") + F.greatest(p, F.col("own")),
    )
    if not crowded.isEmpty():
        keyed = keyed.join(crowded, ["table", "key"], "left").withColumn("parts", parts).withColumn("own", own)
        keyed = keyed.select("fp", "table", "key", F.explode(pairs).alias("part"))
    else:
        keyed = keyed.withColumn("part", F.lit(0))
    tasks = by_size(spark, n * len(choices), 1_000_000)
    dealt = keyed.repartition(tasks, "table", "key", "part").sortWithinPartitions("table", "key", "part", "fp")
    return dealt.mapInArrow(lambda it: _links(it, radius), "a bigint, b bigint")


def group_fingerprints(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fingerprint, component_id, first_row`` for every distinct fingerprint of ``marked`` (doc_id, fingerprint, rid).

    ``component_id`` is the smallest doc_id of all fingerprints that links reach, null ids aside; ``first_row`` is the
    ``rid`` of one row of the component: the first with the smallest doc_id, rows without an id last.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    nodes = materialise(marked.groupBy("fingerprint").agg(F.min(rank).alias("first")).withColumnRenamed("fingerprint", "fp"), "fingerprints")
    roots = components(near_links(nodes.select("fp"), radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    linked = rooted.select("fp", "root").join(best, "root")
    return linked.select(F.col("fp").alias("fingerprint"), F.col("best.doc_id").alias("component_id"), F.col("best.rid").alias("first_row"))


def mark_documents(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """Documents as ``row, fingerprint`` and a row number ``rid`` of their own, as a written table."""
    return materialise(fingerprints(docs, keep, shingle).withColumn("rid", F.monotonically_increasing_id()), "marked")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (doc_id, text).

    Null, empty and wordless texts have the fingerprint zero and are linked like any other. Repeated rows each come
    back. A row without an id belongs to the component its text reaches, whose id is null only if no row there has one.
    Other columns are not read.
    """
    marked = mark_documents(docs, ["doc_id"], shingle).select("row.doc_id", "fingerprint", "rid")
    return marked.select("doc_id", "fingerprint").join(group_fingerprints(marked, radius).drop("first_row"), "fingerprint", "left")


def without_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the first of those with the smallest doc_id."""
    marked = mark_documents(docs, docs.columns, shingle)
    firsts = group_fingerprints(marked.select("row.doc_id", "fingerprint", "rid"), radius).select(F.col("first_row").alias("rid")).distinct()
    return marked.join(firsts, "rid", "left_semi").select("row.*")
