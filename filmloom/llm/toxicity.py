"""Toxic passages: maximum-scoring segments of token log-odds, judged by extreme-value statistics.

Fitting. Every token has a log-odds of toxic against clean with an informative Dirichlet prior: the prior of a token is
its share of all documents of the corpus, and the class counts come from labelled documents. Counts are exact, and of
documents that hold the token, so a word repeated in one document counts once; they stay in a Spark table. A token's score
is the near end of the confidence interval of its log-odds; a token that isn't surely at least ``MIN_ODDS`` times likelier
on one side says nothing, and only the others are sent to the tasks, or joined to the documents if they are too many. Every
token pays a small drift, which makes the expected score negative, as the statistics of maximal segments need.

Scoring. One linear scan finds all maximal-scoring segments of a text (the list of disjoint candidates with links to
the last smaller left sum). The score S of a segment in n tokens is chance with expected count K n exp(-lambda S);
lambda is the root of sum p exp(lambda s) = 1 over clean tokens, K the maximum-likelihood fit to the best segments of
clean documents. Segments with an expected count of at most ``MAX_EXPECTED`` are the toxic passages; their evidence
(lambda S - ln K n) adds up, and a logistic curve fitted on labelled documents makes it a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import WORD_BYTES, added, packed, steps, struct_text, with_columns, words_of
from filmloom.session import materialise

#: A task hands on its counts when it holds so many words, or has read so many bytes of text.
HELD_WORDS, HELD_BYTES = 1 << 18, 1 << 26
#: Scored words that are sent to every task; more are joined to the documents.
SENT_WORDS, SENT_BYTES = 500_000, 1 << 24
#: Bound on the labelled documents that the classes are fitted on: those with the smallest hashed ids.
MAX_LABELLED = 100_000
PRIOR_SHARE = 0.1
Z = 2.0
MIN_ODDS = 5.0
DRIFT = 0.05
MAX_EXPECTED = 0.01

PASSAGES = "array<struct<start:int,length:int,score:double,expected:double>>"


@dataclass
class ToxicityModel:
    """Scores of the words that say something, before the drift: in ``scores``, or in the table ``scored`` (word, score) if
    they are too many; the extreme-value parameters, and the logistic curve over log(1 + evidence)."""

    scores: dict[bytes, float] = field(default_factory=dict)
    scored: DataFrame | None = None
    drift: float = DRIFT
    lam: float = 1.0
    k: float = 1.0
    intercept: float = -20.0
    slope: float = 0.0


def scores_of(words: list[bytes], scores: dict[bytes, float], drift: float) -> np.ndarray:
    """Score of each word."""
    return np.array([scores.get(w, 0.0) for w in words], np.float64) - drift


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments as (start, end, score), left to right, in linear time.

    Runs of positive scores are taken as one; only they can start or end a segment.
    """
    positive = scores > 0
    if not positive.any():
        return []
    sums = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], positive, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    found: list[list] = []  # start, end, left sum, right sum, place of the last candidate with a smaller left sum
    for start, end, left, right in zip(starts.tolist(), ends.tolist(), sums[starts].tolist(), sums[ends].tolist(), strict=True):
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append([start, end, left, right, j])
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
    return [(s, e, r - l) for s, e, l, r, _ in found]


def passages_of(scores: np.ndarray, model: ToxicityModel) -> list[tuple[int, int, float, float]]:
    """Significant segments as (first word, words, score, expected count by chance)."""
    chance = model.k * len(scores)
    out = []
    for start, end, score in maximal_segments(scores):
        expected = chance * float(np.exp(-model.lam * score))
        if expected <= MAX_EXPECTED:
            out.append((start, end - start, float(score), expected))
    return out


def evidence_of(passages: list[tuple[int, int, float, float]]) -> float:
    return float(sum(-np.log(max(p[3], 1e-300)) for p in passages))


def probability(evidence: float, model: ToxicityModel) -> float:
    return float(1 / (1 + np.exp(-np.clip(model.intercept + model.slope * np.log1p(evidence), -500, 500))))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each word: those without a label (the corpus), the clean and the toxic ones."""
    held: tuple[Counter, Counter, Counter] = (Counter(), Counter(), Counter())
    size = 0

    def handed() -> pa.RecordBatch:
        words = list(set().union(*held))
        counts = [pa.array([h[w] for w in words], pa.int64()) for h in held]
        for h in held:
            h.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *counts], names=["word", "n", "clean", "toxic"])

    for batch, texts in steps(batches, lambda b: b.column("text")):
        for text, label in zip(texts, batch.column("label").to_pylist(), strict=True):
            if text:
                held[0 if label is None else 1 + (label > 0)].update(set(words_of(text)))
                size += len(text)
                if sum(map(len, held)) >= HELD_WORDS or size >= HELD_BYTES:
                    yield handed()
                    size = 0
    yield handed()


def word_scores(counts: DataFrame) -> DataFrame:
    """``word, score, share`` of the words that say something, from exact counts ``word, n, clean, toxic``: scores before the
    drift, and the shares of a clean document's tokens."""
    everything, clean, toxic, vocabulary = counts.agg(F.sum("n"), F.sum("clean"), F.sum("toxic"), F.count("*")).first()
    if not clean or not toxic:
        return counts.select("word", F.lit(0.0).alias("score"), F.lit(0.0).alias("share")).limit(0)
    weight = PRIOR_SHARE * (clean + toxic)
    prior = F.lit(weight / (everything + vocabulary)) * (F.col("n") + 1)
    placed = counts.select("word", (F.col("clean") + prior).alias("clean"), (F.col("toxic") + prior).alias("toxic"))
    odds = F.log(F.col("toxic") / F.col("clean")) - float(np.log((toxic + weight) / (clean + weight)))
    sure = F.abs(odds) - Z * F.sqrt(1 / F.col("toxic") + 1 / F.col("clean"))
    said = placed.filter(sure >= float(np.log(MIN_ODDS)))
    return said.select("word", (F.signum(odds) * sure).alias("score"), (F.col("clean") / (clean + weight)).alias("share"))


def spectrum(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Scores before the drift and their shares, of all words, in steps of 1/1024; words that say nothing share the first."""
    steps_of = scored.groupBy(F.round(F.col("score") * 1024)).agg(F.sum(F.col("score") * F.col("share")), F.sum("share")).collect()
    shares = np.array([r[2] for r in steps_of], np.float64)
    scores = np.array([r[1] for r in steps_of], np.float64) / shares
    return np.append(0.0, scores), np.append(max(0.0, 1 - shares.sum()), shares)


def decay(weights: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1."""
    if weights.max() <= 0:
        return 1.0
    scores = weights.astype(np.float64)
    excess = lambda lam: float((shares * np.exp(np.minimum(lam * scores, 700.0))).sum()) - 1
    high = 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    low = 0.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return max(high, 1e-6)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope by Newton's steps; the slope isn't negative."""
    design, beta = np.stack([np.ones(len(x)), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), design.T @ (y - p) - ridge * beta)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return (float(beta[0]), float(beta[1])) if beta[1] > 0 else (float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), 0.0)


def _known(batch: pa.RecordBatch, sent: dict[bytes, float], rows: int) -> Iterator[dict[bytes, float]]:
    """Scores of the words of each text: the sent ones, or those that were joined to its row."""
    if "known" not in batch.schema.names:
        return iter([sent] * rows)
    return ({k["word"]: k["score"] for k in known or ()} for known in batch.column("known").to_pylist())


def _best(model: ToxicityModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words and score of the best segment of each labelled document, and its evidence."""
    for batch, texts in steps(batches, struct_text):
        lengths, best, evidence = [], [], []
        for text, known in zip(texts, _known(batch, model.scores, len(texts)), strict=True):
            scores = scores_of(words_of(text or ""), known, model.drift)
            lengths.append(len(scores))
            best.append(max((s for _, _, s in maximal_segments(scores) if s >= 1.0), default=0.0))
            evidence.append(evidence_of(passages_of(scores, model)))
        yield pa.RecordBatch.from_arrays(
            [pc.struct_field(batch.column("row"), "label"), pa.array(lengths, pa.int64()), pa.array(best, pa.float64()), pa.array(evidence, pa.float64())],
            names=["label", "n", "best", "evidence"],
        )


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each text."""
    for batch, texts in steps(batches, lambda b: b.column("text")):
        words = [list(set(words_of(text or ""))) for text in texts]
        keys = pc.take(batch.column("key"), pa.array(np.repeat(np.arange(len(texts)), list(map(len, words)))))
        yield pa.RecordBatch.from_arrays([keys, pa.array([w for own in words for w in own], pa.binary())], names=["key", "word"])


def _in_tasks(rows: DataFrame, model: ToxicityModel, task: Callable, schema) -> DataFrame:
    """``task`` over packed rows, with the scores of their words.

    Words that are too many to be sent are joined to the distinct texts, and their scores to the rows by text.
    """
    sent = rows.sparkSession.sparkContext.broadcast(replace(model, scored=None))
    if model.scored is not None:
        keyed = rows.withColumn("key", F.sha2(F.col("row.text").cast("binary"), 256))
        texts = keyed.select("key", "row.text").dropna().dropDuplicates(["key"])
        words = texts.mapInArrow(_words, "key string, word binary").join(model.scored.select("word", "score"), "word")
        known = words.groupBy("key").agg(F.collect_list(F.struct("word", "score")).alias("known"))
        rows = keyed.join(known, "key", "left").select("row", "known")
    return rows.mapInArrow(lambda it: task(sent.value, it), schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), which holds only rows that may be learned from.

    Corpus counts come from every document and are exact. The classes come from at most ``max_labelled`` labelled ids, those with
    the smallest hashes, so their list can be sent to every task. Labels of one id that disagree count as toxic, and of
    its rows only that with the smallest text is learned from; null labels and ids are left out. Without both classes every document has the same score.
    """
    chosen = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("label")).dropna()
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    sample = F.broadcast(chosen)
    labelled = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    labelled = materialise(labelled.select("text", "label"), "labelled")
    texts = docs.select("text", F.lit(None).cast("int").alias("label")).union(labelled)
    counts = texts.mapInArrow(_counts, "word binary, n bigint, clean bigint, toxic bigint")
    counts = counts.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "clean", "toxic")])
    scored = materialise(word_scores(materialise(counts, "words")), "scored-words")
    model = ToxicityModel()
    scores, shares = spectrum(scored)
    model.drift = DRIFT + max(0.0, float((shares * scores).sum()))
    model.lam = decay(scores - model.drift, shares)
    words, size = scored.agg(F.count("*"), F.sum(F.length("word"))).first()
    if words > SENT_WORDS or (size or 0) > SENT_BYTES:
        model.scored = scored
    else:
        found = scored.select("word", "score").toArrow()
        model.scores = dict(zip(found["word"].to_pylist(), found["score"].to_pylist(), strict=True))

    # Once for K, then for the evidence that depends on it; numbers of the labelled ids are all that comes to the driver.
    fields = "label int, n bigint, best double, evidence double"
    found = _in_tasks(packed(labelled), model, _best, fields).select("label", "n", "best").toArrow()
    if found.num_rows:
        n, best, toxic = found["n"].to_numpy().astype(np.float64), found["best"].to_numpy(), found["label"].to_numpy() > 0
        clean = ~toxic & (n > 0)
        if clean.any():
            model.k = float(clean.sum() / (n[clean] * np.exp(-model.lam * best[clean])).sum())
        found = _in_tasks(packed(labelled), model, _best, fields).select("label", "evidence").toArrow()
        model.intercept, model.slope = logistic(np.log1p(found["evidence"].to_numpy()), (found["label"].to_numpy() > 0).astype(np.float64))
    return model


def _score(model: ToxicityModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in steps(batches, struct_text):
        scores, passages = [], []
        for text, known in zip(texts, _known(batch, model.scores, len(texts)), strict=True):
            found = passages_of(scores_of(words_of(text or ""), known, model.drift), model)
            scores.append(probability(evidence_of(found), model))
            passages.append([{"start": s, "length": n, "score": v, "expected": e} for s, n, v, e in found])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        yield with_columns(batch.select(["row"]), {"score": pa.array(scores, pa.float64()), "passages": pa.array(passages, kind)})


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Every document as ``row`` (a struct of its own columns), its ``score`` from 0 to 1 and its toxic ``passages``.

    A passage is (first word, number of words, score, expected count by chance). A null, empty or wordless text has no
    passage and the score of a document without evidence. Every row is scored by its own text alone, so repeated rows
    and ties score alike, and other columns are neither read nor renamed.
    """
    rows = packed(docs)
    return _in_tasks(rows, model, _score, added(rows, f"score double, passages {PASSAGES}"))


def passage_texts(text: str, passages: list) -> list[str]:
    """The text of each passage, from its first to its last word."""
    data = text.encode("utf-8", "surrogatepass")
    marks = np.concatenate(([32], np.frombuffer(data.translate(WORD_BYTES), np.uint8), [32])) != 32
    edge = np.flatnonzero(np.diff(marks.astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    return [data[starts[p["start"]] : ends[p["start"] + p["length"] - 1]].decode("utf-8", "surrogatepass") for p in passages]


__all__ = ["ToxicityModel", "fit_toxicity", "maximal_segments", "passage_texts", "score_toxicity"]
