"""Ranked lexical search by presence masks.

One pass over the texts keeps, for each document, its length and the occurrences of terms that some item asks for. The
ranking then goes task by task: a block of documents becomes one bitmap for each term; the bitmaps of an item's terms,
transposed, give each document the mask of terms that it holds, and documents of one mask form a group. No document of a
group scores more than the largest gains of its terms in the block, so groups are evaluated by falling bound, and once
the item's k-th best score is above the next bound the rest of the block is passed over. That score is carried on
to the task's next blocks. A task hands on ``k`` documents for each item at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmloom.llm.common import steps, words_of
from filmloom.session import materialise

K = 10
#: Documents of one block, and the occurrences of terms after which a block ends earlier.
DOCUMENTS, OCCURRENCES = 32_768, 4_000_000
#: Bytes of terms of the items that are asked at once; more items are asked block after block.
TERM_BYTES = 32 << 20
#: Groups evaluated between two looks at the k-th best score, at first; doubled each time.
GROUPS = 16

FOUND = "item bigint, doc_id bigint, score bigint"


@dataclass(frozen=True)
class Items:
    """Items as rows of places in a vocabulary of terms."""

    number: np.ndarray
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def item_blocks(rows: Iterator, limit: int = TERM_BYTES) -> Iterator[Items]:
    """Items with their distinct terms, in blocks of bounded size. ``rows``: (item, text); items without terms are left out."""
    number, terms, vocabulary, held = [], [], {}, 0
    for item, text in rows:
        found = dict.fromkeys(words_of(text or ""))
        if not found:
            continue
        if held and held + sum(map(len, found)) > limit:
            yield Items(np.array(number, np.int64), terms, vocabulary)
            number, terms, vocabulary, held = [], [], {}, 0
        number.append(item)
        terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in found], np.int64))
        held += sum(map(len, found))
    if number:
        yield Items(np.array(number, np.int64), terms, vocabulary)


def _occurrences(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Length of each document and its occurrences of known terms; documents without a term are left out."""
    for batch, texts in steps(batches, lambda b: b.column("text")):
        rows, lengths, ids, counts = [], [], [], []
        for i, text in enumerate(texts):
            words = words_of(text or "")
            if words:
                known = np.fromiter((vocabulary.get(w, -1) for w in words), np.int64, len(words))
                term, n = np.unique(known[known >= 0], return_counts=True)
                rows.append(i)
                lengths.append(len(words))
                ids.append(term)
                counts.append(n)
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()), pa.array(ids, kind), pa.array(counts, kind)],
            names=["doc_id", "n", "terms", "tfs"],
        )


def occurrences(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of each document with a term, as a written table."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "doc_id bigint, n bigint, terms array<bigint>, tfs array<bigint>"
    return materialise(kept.mapInArrow(lambda it: _occurrences(it, sent.value), kind), "occurrences")


def term_weights(kept: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """Weight of each term, number of documents and number of their words."""
    documents, words = kept.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n = F.lit(documents)
    rare = (2 * n + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    # One row for each term asked for, of which a block holds a bounded number.
    found = kept.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    found = found.select("term", F.floor(F.lit(1000.0) * F.log(rare)).alias("w")).toPandas().astype(np.int64)
    weights = np.zeros(size, np.int64)
    weights[found["term"].to_numpy()] = found["w"].to_numpy()
    return weights, documents, words


class Best:
    """The best ``k`` documents of each item so far: higher score first, then smaller id, a null id last."""

    def __init__(self, items: int, k: int):
        self.k = k
        none = np.zeros(0, np.int64)
        #: Scores, ids, and whether the id is null, of each item.
        self.found = [(none, none, none.astype(bool))] * items

    def floor(self, item: int) -> int:
        """The score that a document must reach."""
        scores = self.found[item][0]
        return int(scores[-1]) if len(scores) == self.k else 1

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        good = scores >= self.floor(item)
        scores, ids, none = (np.concatenate(x) for x in zip(self.found[item], (scores[good], ids[good], none[good]), strict=True))
        order = np.lexsort((ids, none, -scores))[: self.k]
        self.found[item] = scores[order], ids[order], none[order]


def masks_of(bitmaps: np.ndarray) -> np.ndarray:
    """Words of 64 bits for each document: bit j, from the left, tells if it is set in bitmap j. ``bitmaps``: terms x documents."""
    packed = np.packbits(bitmaps, axis=0)
    return np.ascontiguousarray(np.pad(packed, ((0, -len(packed) % 8), (0, 0))).T).view(np.uint64)


def _rank_block(best: Best, items: Items, weights: np.ndarray, ids: tuple[np.ndarray, np.ndarray], sizes: np.ndarray, terms: np.ndarray, gains: np.ndarray) -> None:
    """Rank one block. ``ids``: of each document, and whether it is null; ``sizes``: terms of each; ``terms, gains``:
    those terms, document after document."""
    ends = np.cumsum(sizes)
    starts, doc = ends - sizes, np.repeat(np.arange(len(sizes)), sizes)
    by_term = np.argsort(terms, kind="stable")
    edges = np.searchsorted(terms[by_term], np.arange(len(weights) + 1))
    holders, most = doc[by_term], np.zeros(len(weights), np.int64)
    there = np.flatnonzero(np.diff(edges))
    if len(there):
        most[there] = np.maximum.reduceat(gains[by_term], edges[there])
    reach, asked = weights * most, np.zeros(len(weights), np.int64)
    for item, wanted in enumerate(items.terms):
        wanted = wanted[reach[wanted] > 0]
        if not len(wanted) or int(reach[wanted].sum()) < best.floor(item):
            continue
        bitmaps = np.zeros((len(wanted), len(sizes)), bool)
        for j, t in enumerate(wanted):
            bitmaps[j, holders[edges[t] : edges[t + 1]]] = True
        matched = np.flatnonzero(bitmaps.any(0))
        masks = masks_of(bitmaps[:, matched])
        one = masks.ravel() if masks.shape[1] == 1 else masks.view(np.dtype((np.void, masks.itemsize * masks.shape[1]))).ravel()
        groups, member = np.unique(one, return_inverse=True)
        held = np.unpackbits(groups.view(np.uint8).reshape(len(groups), -1), axis=1, count=len(wanted))
        bounds = held.astype(np.int64) @ reach[wanted]
        order = np.argsort(-bounds, kind="stable")
        inside = matched[np.argsort(member, kind="stable")]
        first = np.searchsorted(np.sort(member), np.arange(len(groups) + 1))
        asked[wanted] = weights[wanted]
        at, step = 0, GROUPS
        while at < len(order) and bounds[order[at]] >= best.floor(item):
            chosen = np.concatenate([inside[first[g] : first[g + 1]] for g in order[at : at + step]])
            n = sizes[chosen]
            place = np.repeat(starts[chosen] - np.cumsum(n) + n, n) + np.arange(n.sum())
            scores = np.add.reduceat(asked[terms[place]] * gains[place], np.cumsum(n) - n)
            best.add(item, scores, ids[0][chosen], ids[1][chosen])
            at, step = at + step, step * 2
        asked[wanted] = 0


def _rank(batches: Iterator[pa.RecordBatch], items: Items, weights: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    best, held, documents, occurring = Best(len(items.number), k), [], 0, 0

    def flush() -> None:
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            terms = rows.column("terms").combine_chunks()
            flat = terms.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(terms.offsets.to_numpy())
            tf = rows.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            gains = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(rows.column("m").to_numpy(), sizes))
            some, ids = sizes > 0, rows.column("doc_id")
            ids = pc.fill_null(ids, 0).to_numpy()[some], ids.is_null().to_numpy()[some]
            _rank_block(best, items, weights, ids, sizes[some], flat, gains)

    for batch in batches:
        for start in range(0, batch.num_rows, DOCUMENTS):
            part = batch.slice(start, DOCUMENTS)
            size = len(part.column("terms").flatten())
            if held and (documents + part.num_rows > DOCUMENTS or occurring + size > OCCURRENCES):
                flush()
                held, documents, occurring = [], 0, 0
            held.append(part)
            documents, occurring = documents + part.num_rows, occurring + size
    flush()
    scores, ids, none = (np.concatenate(x) for x in zip(*best.found, strict=True))
    numbers = np.repeat(items.number, [len(f[0]) for f in best.found])
    yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(ids, mask=none), pa.array(scores)], names=["item", "doc_id", "score"])


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each row of ``items`` (item_id, text).

    Documents are rows of ``docs`` (doc_id, text). A null, empty or wordless text has no terms: as an item it finds nothing,
    as a document it isn't counted. Each row of either table stands for itself, so repeated documents each take a rank and
    repeated items are each answered; equal scores go to the smaller id, a null id last. Other columns are not read.
    Items beyond ``TERM_BYTES`` of terms are asked in blocks, each a pass over the documents.
    """
    spark = docs.sparkSession
    numbered = materialise(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    answers = [spark.createDataFrame([], f"{FOUND}, rank int")]
    for block in item_blocks(numbered.select("item", "text").toLocalIterator()):
        kept = occurrences(docs, block.vocabulary)
        weights, documents, words = term_weights(kept, len(block.vocabulary))
        if not documents:
            break
        length = f"10 + cast(n as decimal(18,0)) * cast({90 * documents} as decimal(20,0)) div cast({words} as decimal(20,0))"
        sent = spark.sparkContext.broadcast((block, weights))
        local = kept.withColumn("m", F.expr(length)).mapInArrow(lambda it, sent=sent: _rank(it, *sent.value, k), FOUND)
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        answers.append(materialise(local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "ranked"))
    found = reduce(DataFrame.unionByName, answers)
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
