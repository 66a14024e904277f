"""Quality of documents by hierarchical empirical Bayes over sites.

A logistic classifier over the text alone gives each document's own evidence: over its shape, and over the mean log-odds of
its words, word pairs and runs of four bytes, which are hashed to buckets and counted by class in the labelled documents.
For the fits a labelled document is read by the counts of the half that it isn't in. A host's posterior is the mean
evidence of its documents shrunk toward the global mean, and a path's posterior is that of its documents shrunk toward
its host; how strongly is estimated from the data: the spread of the host means beyond chance, and that of the path
means within their hosts, by the method of moments over grouped sums. A document's own evidence is left out of its
site's. Finally the document's log-odds and the shift of its path's log-odds are weighed by a second logistic fit.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import STEP_BYTES, added, steps, words_of
from filmloom.session import materialise

#: Bound on the labelled documents that the classifier is fitted on: those with the smallest hashed ids.
MAX_LABELLED = 50_000
#: Bounds on the number of documents that the prior of a site is worth.
LEAST_PRIOR, MOST_PRIOR = 1.0, 1e6
#: Buckets of words and word pairs, and as many again of runs of four bytes.
BUCKETS = 1 << 16
#: Labelled texts whose buckets one task counts.
TASK_TEXTS = 4096
#: Numbers of a shape.
SHAPES = 13

_symbols = re.compile(rb"[#$%&*+/<=>@\\^_`{|}~\[\]]")
_digits = re.compile(rb"[0-9]")
_capitals = re.compile(rb"[A-Z]")


def _bucket(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def grams(text: str | None) -> np.ndarray:
    """Distinct buckets of a whole text, in order: below ``BUCKETS`` of words and word pairs, above of runs of four bytes."""
    found = np.zeros(2 * BUCKETS, bool)
    words = words_of(text or "")
    codes = np.fromiter(map(crc32, words), np.uint64, len(words))
    found[_bucket(codes)] = True
    found[_bucket(codes[:-1] * np.uint64(1_000_003) + codes[1:] + np.uint64(1 << 60))] = True
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    for at in range(0, max(0, len(data) - 3), STEP_BYTES):
        part = data[at : at + STEP_BYTES + 3].astype(np.uint64)
        runs = part[:-3] | part[1:-2] << np.uint64(8) | part[2:-1] << np.uint64(16) | part[3:] << np.uint64(24)
        found[BUCKETS + _bucket(runs)] = True
    return np.flatnonzero(found)


def class_odds(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Log-odds of each bucket for good over bad, from ``counts`` (bad, good) of documents that hold it, out of so many
    ``documents`` of either kind; 0 for a bucket in none, and throughout where a kind is missing."""
    if not documents.all():
        return np.zeros(counts.shape[1], np.float32)
    share = np.log((counts + 1) / (documents[:, None] + 2))
    return np.where(counts.sum(0) > 0, share[1] - share[0], 0).astype(np.float32)


def _mean(values: np.ndarray) -> float:
    return float(values.mean(dtype=np.float64)) if len(values) else 0.0


def shape(text: str | None, odds: np.ndarray | None = None) -> list[float]:
    """Numbers that tell prose from junk; all 0 for a text without words, but for the last, which is 1 then. The two before
    the last are the mean ``odds`` of the text's buckets of words and pairs, and of its buckets of runs of bytes."""
    words = (text or "").split()
    if not words:
        return [0.0] * (SHAPES - 1) + [1.0]
    data, n, counts = text.encode("utf-8", "surrogatepass"), len(words), Counter(words)
    lines = text.split("\n")
    share = lambda found: len(found.findall(data)) / len(data)
    held = grams(text) if odds is not None else np.empty(0, np.int64)
    border = np.searchsorted(held, BUCKETS)
    told = [_mean(odds[part]) if odds is not None else 0.0 for part in (held[:border], held[border:])]
    return [
        float(np.log1p(n)), float(np.log1p(len(counts)) / np.log1p(n)), max(counts.values()) / n,
        share(_symbols), share(_digits), share(_capitals), sum(map(len, words)) / n / 10,
        sum(map(str.__eq__, words, words[1:])) / n, 1 - len(set(lines)) / len(lines), len(lines) / n, *told, 0.0,
    ]


def _shapes(odds: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The text is replaced by its ``shape`` under the last row of ``odds``; where there is a ``half`` (0 or 1), ``crossed``
    is its shape under the row of the other half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, lambda b: b.column("text")):
            rest = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            made = {"shape": pa.array([shape(t, odds[-1]) for t in texts], pa.list_(pa.float64()))}
            if "half" in batch.schema.names:
                halves = batch.column("half").to_pylist()
                made["crossed"] = pa.array([shape(t, odds[1 - h]) for t, h in zip(texts, halves, strict=True)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in rest], *made.values()], names=[*[batch.schema.names[i] for i in rest], *made])

    return run


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task by cell (half and class) and bucket, as ``cell, bucket, n``."""
    counts = np.zeros((4, 2 * BUCKETS), np.int64)
    for batch, texts in steps(batches, lambda b: b.column("text")):
        for cell, text in zip(batch.column("cell").to_pylist(), texts, strict=True):
            counts[cell, grams(text)] += 1
    for cell, held in enumerate(counts):
        bucket = np.flatnonzero(held)
        columns = [np.full(len(bucket), cell, np.int32), bucket.astype(np.int32), held[bucket]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "bucket", "n"])


def gram_odds(sample: DataFrame) -> np.ndarray:
    """Log-odds of every bucket by the documents of half 0, of half 1, and of both, from ``half, good, text``.

    What reaches the driver is a number for each cell and bucket, at most 8 x ``BUCKETS``. A task adds up ``TASK_TEXTS``
    texts before it hands on as many numbers at most.
    """
    cell = (2 * F.col("half") + (F.col("good") > 0).cast("int")).alias("cell")
    counts, documents = np.zeros((4, 2 * BUCKETS), np.int64), np.zeros(4, np.int64)
    tasks = -(-sample.count() // TASK_TEXTS) or 1
    found = sample.select(cell, "text").coalesce(tasks).mapInArrow(_gram_counts, "cell int, bucket int, n long")
    found = found.groupBy("cell", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts[found["cell"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    for row in sample.groupBy(cell).count().collect():
        documents[row[0]] = row[1]
    halves = [(counts[:2], documents[:2]), (counts[2:], documents[2:]), (counts[:2] + counts[2:], documents[:2] + documents[2:])]
    return np.stack([class_odds(*half) for half in halves])


@dataclass
class QualityModel:
    """Mean and spread of the shape's terms, and the weights of the classifier, intercept first."""

    mean: list[float]
    spread: list[float]
    weights: list[float]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, intercept first, by Newton's steps with a ridge on all but the intercept."""
    design, penalty = np.concatenate((np.ones((len(x), 1)), x), 1), np.diag([1e-6] + [ridge] * x.shape[1])
    beta = np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, design.T @ (y - p) - penalty @ beta)
        beta += step * min(1.0, 4 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit_shapes(shapes: np.ndarray, good: np.ndarray) -> QualityModel:
    """The classifier over the shape's numbers and their squares."""
    mean = shapes.mean(0) if len(shapes) else np.zeros(SHAPES)
    spread = np.maximum(shapes.std(0), 1e-6) if len(shapes) else np.ones(SHAPES)
    scaled = np.clip((shapes - mean) / spread, -8, 8)
    terms = np.concatenate((scaled, scaled**2), 1)
    weights = logistic(terms, good) if len(shapes) else np.zeros(2 * SHAPES + 1)
    return QualityModel(mean.tolist(), spread.tolist(), weights.tolist())


def log_odds(shape_column: Column, model: QualityModel) -> Column:
    """Log-odds of the classifier, clipped to 12 on either side."""
    constant = lambda values: F.array(*map(F.lit, values))
    scaled = F.zip_with(shape_column, F.zip_with(constant(model.mean), constant(model.spread), lambda m, s: F.struct(m.alias("m"), s.alias("s"))),
                        lambda x, z: F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (x - z["m"]) / z["s"])))
    linear, square = model.weights[1 : SHAPES + 1], model.weights[SHAPES + 1 :]
    parts = F.zip_with(scaled, F.zip_with(constant(linear), constant(square), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                       lambda x, z: x * z["a"] + x * x * z["b"])
    total = F.aggregate(parts, F.lit(model.weights[0]), lambda s, x: s + x)
    return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), total))


def prior_size(sites: DataFrame, above: Column, within: float) -> float:
    """What the prior of a site is worth in documents, from rows ``n, s`` (documents, summed evidence) and the mean
    ``above`` that sites vary about: the chance variance of one document over the variance of the sites' true means."""
    moments = sites.select(F.col("n"), (F.col("n") * F.pow(F.col("s") / F.col("n") - above, 2)).alias("d")).agg(F.sum("n"), F.sum("d"), F.count("*")).first()
    n, spread, groups = moments
    if not n:
        return MOST_PRIOR
    between = (spread - groups * within) / n
    return float(np.clip(within / between if between > 0 else MOST_PRIOR, LEAST_PRIOR, MOST_PRIOR))


def _logit(p: Column) -> Column:
    safe = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(safe / (1 - safe))


def score_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, score, evidence, host_posterior, path_posterior`` of every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, quality) holds only rows that may be learned from; null ids and labels are left out, labels of
    one id that disagree count as bad. ``host`` and ``path`` are columns of ``docs``; nulls are sites of their own.
    Null, empty and wordless texts are scored by their (empty) shape. Without labels, or of one kind only, scores are
    those of the fit's prior. Repeated rows each count for their sites and come back; the fits learn from one row of an id,
    that with the smallest text (null first). Other columns are not read.
    """
    fields = docs.select(F.col("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col("text"))
    chosen = (
        labels.select("doc_id", F.col("quality").cast("int").alias("good")).dropna()
        .groupBy("doc_id").agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    chosen = F.broadcast(materialise(chosen, "labelled"))
    one = fields.join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "host", "path")).alias("row"), F.min("good").alias("good"))
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id")), F.lit(2)).cast("int").alias("half")
    sample = materialise(one.select(half, "good", "row.*"), "sample")
    told = gram_odds(sample)
    shaped = materialise(fields.mapInArrow(_shapes(told), added(fields.drop("text"), "shape array<double>")), "shapes")
    sample = materialise(sample.mapInArrow(_shapes(told), added(sample.drop("text"), "shape array<double>, crossed array<double>")), "sample-shapes")
    learned = sample.select("crossed", "good").toPandas()
    shapes = np.stack([np.asarray(s) for s in learned["crossed"]]) if len(learned) else np.empty((0, SHAPES))
    model = fit_shapes(shapes, (learned["good"] > 0).to_numpy(np.float64))

    odds = log_odds(F.col("shape"), model)
    chance = (1 / (1 + F.exp(-odds))).alias("p")
    judged = shaped.select("doc_id", "host", "path", odds.alias("odds"), chance)
    paths = judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q"))
    paths = materialise(paths, "paths")
    hosts = materialise(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "hosts")
    n, s, spread = paths.agg(F.sum("n"), F.sum("s"), F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n"))).first()
    mean, within = (s / n, max(spread / n, 1e-9)) if n else (0.5, 1.0)
    host_prior = prior_size(hosts, F.lit(mean), within)
    shrunk = hosts.select(F.col("host").alias("of"), ((F.col("s") + host_prior * mean) / (F.col("n") + host_prior)).alias("host_posterior"))
    sites = paths.join(shrunk, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    path_prior = prior_size(sites, F.col("host_posterior"), within)
    sites = materialise(sites.select(F.col("host").alias("site_host"), F.col("path").alias("site_path"), "n", "s", "host_posterior"), "sites")

    same = F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path"))
    posterior = (F.col("s") - F.col("p") + path_prior * F.col("host_posterior")) / (F.col("n") - 1 + path_prior)

    def placed(rows: DataFrame) -> DataFrame:
        """Rows ``host, path, p`` with the posteriors of their sites, their own ``p`` left out of the path's."""
        found = rows.join(sites, same, "left").withColumn("path_posterior", posterior)
        return found.withColumn("shift", _logit(F.col("path_posterior")) - _logit(F.lit(mean)))

    crossed = log_odds(F.col("crossed"), model).alias("odds")
    fit = placed(sample.select("host", "path", "good", crossed, chance)).select("odds", "shift", "good").toPandas()
    weights = [0.0, 1.0, 0.0]
    if 0 < (fit["good"] > 0).sum() < len(fit):
        weights = logistic(fit[["odds", "shift"]].to_numpy(np.float64), (fit["good"] > 0).to_numpy(np.float64)).tolist()
    total = F.lit(weights[0]) + weights[1] * F.col("odds") + weights[2] * F.col("shift")
    return placed(judged).select("doc_id", (1 / (1 + F.exp(-total))).alias("score"), F.col("p").alias("evidence"), "host_posterior", "path_posterior")
