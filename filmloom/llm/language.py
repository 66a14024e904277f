"""Language identification: each document as a mixture of languages, fitted by expectation-maximisation.

A text is cut to words (as in ``words_of``, without digits), joined by blanks, and read as byte 3-grams hashed to
``BUCKETS`` numbers. A language is a distribution over the buckets, smoothed toward that of all languages. Every
``SEGMENT`` 3-grams are a segment, written in one language; the shares of the languages in a document are the weights
that expectation-maximisation finds for its segments. Neighbouring 3-grams share letters, so log-likelihoods count
``TEMPER`` only. The set of languages is the one with the least BIC among the best single language and the 2, 3, ...
most weighted ones, each fitted anew; sets grow until a bound of the document's own rules out any gain.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import WORD_BYTES, added, packed, steps, struct_text, with_columns

BUCKETS = 1 << 16
SEGMENT = 64
TEMPER = 1 / 3
SMOOTH = 1000.0
ROUNDS = 20
#: Languages whose counts a task holds before it hands them on.
HELD_LANGS = 64
#: Numbers of a matrix, of 3-grams or segments by languages, that is held at once.
CELLS = 1 << 22
UNKNOWN = "und"

#: As WORD_BYTES, with blanks for digits.
LETTER_BYTES = bytes(32 if 48 <= c <= 57 else w for c, w in enumerate(WORD_BYTES))


@dataclass
class LanguageModel:
    """Names of the languages, and the log-probability of each bucket in each of them."""

    langs: list[str]
    logs: np.ndarray


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all 3-grams of the texts, and how many there are of each text."""
    lines = [b" %b " % b" ".join(t.encode("utf-8", "surrogatepass").translate(LETTER_BYTES).split()) for t in texts]
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
    codes = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    ends = np.cumsum(lengths)
    inside = np.ones(len(data), bool)
    inside[ends - 1] = inside[np.maximum(ends - 2, 0)] = False
    return (codes[inside[:-2]] * np.uint32(2654435761)) >> np.uint32(16), np.maximum(lengths - 2, 0)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            buckets = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(buckets), pa.string()), pa.array(buckets.astype(np.int32)), pa.array(counts[buckets])],
                names=["lang", "bucket", "n"],
            )
        held.clear()

    for batch, texts in steps(batches, lambda b: b.column("text")):
        of: dict[str, list[str]] = {}
        for text, lang in zip(texts, batch.column("lang").to_pylist(), strict=True):
            if text and has_letter(text):
                of.setdefault(lang, []).append(text)
        for lang, own in of.items():
            if lang not in held and len(held) >= HELD_LANGS:
                yield from handed()
            held[lang] = held.get(lang, 0) + np.bincount(grams_of(own)[0], minlength=BUCKETS)
    yield from handed()


def fit_languages(docs: DataFrame) -> LanguageModel:
    """Fit on all of ``docs`` (text, lang), which holds only rows that may be learned from; null languages are left out.

    Counts are summed in each task before they are shuffled, so a language that holds most documents is no burden.
    Every language with a letter in any text is learned; each takes a quarter of a MB of the model.
    """
    known = docs.select("text", "lang").filter(F.col("lang").isNotNull())
    counted = known.mapInArrow(_counts, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    named = pc.dictionary_encode(counted["lang"].combine_chunks())
    order = sorted(range(len(named.dictionary)), key=named.dictionary.to_pylist().__getitem__)
    langs, place = [named.dictionary[i].as_py() for i in order], np.argsort(order).astype(np.int64)
    where, buckets, n = place[named.indices.to_numpy()], counted["bucket"].to_numpy(), counted["n"].to_numpy()
    totals, sums = np.bincount(buckets, n, BUCKETS), np.bincount(where, n, len(langs))
    shares = (totals + 0.01) / (totals.sum() + 0.01 * BUCKETS)
    logs = np.log(SMOOTH * shares).astype(np.float32)[:, None] - np.log(sums + SMOOTH).astype(np.float32)
    logs[buckets, where] = np.log((n + SMOOTH * shares[buckets]) / (sums[where] + SMOOTH))
    return LanguageModel(langs, logs)


class _Segments:
    """Log-likelihoods of the segments of some texts: held if they are few, else found anew for each pass over them."""

    def __init__(self, buckets: np.ndarray, sizes: np.ndarray, model: LanguageModel) -> None:
        self.buckets, self.logs, n, k = buckets, model.logs, len(sizes), len(model.langs)
        self.counts = -(-sizes // SEGMENT)
        self.doc = np.repeat(np.arange(n), self.counts)
        self.starts = np.cumsum(self.counts) - self.counts
        self.cuts = (np.cumsum(sizes) - sizes)[self.doc] + SEGMENT * (np.arange(len(self.doc)) - self.starts[self.doc])
        self.totals, self.top, self.held = np.zeros((n, k)), np.empty(len(self.doc)), []
        held = len(self.doc) * k <= CELLS or n > 1
        for a, b, logs in self._parts(None, k):
            self.top[a:b] = logs.max(1)
            if held:
                self.held.append(logs)
            else:
                self.totals[0] += logs.sum(0)
        if held:
            logs = np.concatenate(self.held)
            self.totals = np.add.reduceat(logs, self.starts, axis=0)
            self.held = [np.exp(logs - self.top[:, None])]
        self.highest = np.add.reduceat(self.top, self.starts)

    def _parts(self, columns: np.ndarray | None, k: int) -> Iterator[tuple[int, int, np.ndarray]]:
        step = max(1, CELLS // (SEGMENT * k))
        for a in range(0, len(self.cuts), step):
            b = min(a + step, len(self.cuts))
            begin, end = self.cuts[a], self.cuts[b] if b < len(self.cuts) else len(self.buckets)
            rows = self.buckets[begin:end]
            logs = self.logs[rows] if columns is None else self.logs[rows[:, None], columns]
            yield a, b, np.add.reduceat(logs.astype(np.float64), self.cuts[a:b] - begin, axis=0) * TEMPER

    def parts(self, chosen: np.ndarray, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text of each segment, first segment of each text and relative likelihoods of the languages ``order`` of the
        ``chosen`` texts; several parts only of a single text."""
        if self.held:
            counts, picked = self.counts[chosen], np.isin(self.doc, chosen)
            doc = np.repeat(np.arange(len(chosen)), counts)
            yield doc, np.cumsum(counts) - counts, np.take_along_axis(self.held[0][picked], order[doc], 1)
        else:
            for a, b, logs in self._parts(order[0], order.shape[1]):
                yield np.zeros(b - a, np.int64), np.zeros(1, np.int64), np.exp(logs - self.top[a:b, None])


def _mixture(segments: _Segments, chosen: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and log-likelihood of every chosen text, of the languages ``order`` in it; each text ends by itself."""
    weights, moving = np.full(order.shape, 1 / order.shape[1]), np.arange(len(chosen))
    for _ in range(ROUNDS):
        fresh = np.zeros((len(moving), order.shape[1]))
        for doc, starts, likelihood in segments.parts(chosen[moving], order[moving]):
            share = weights[moving][doc] * likelihood
            share /= np.maximum(share.sum(1, keepdims=True), 1e-300)
            fresh += np.add.reduceat(share, starts, axis=0)
        fresh /= segments.counts[chosen[moving]][:, None]
        moved = np.abs(fresh - weights[moving]).max(1)
        weights[moving] = fresh
        moving = moving[moved >= 1e-4]
        if not len(moving):
            break
    found = segments.highest[chosen]
    for doc, starts, likelihood in segments.parts(chosen, order):
        found = found + np.add.reduceat(np.log(np.maximum((weights[doc] * likelihood).sum(1), 1e-300)), starts)
    return weights, found


def _shares(segments: _Segments) -> tuple[np.ndarray, np.ndarray]:
    totals, (n, k) = segments.totals, segments.totals.shape
    single = totals.argmax(1)
    posterior = 1 / np.exp(totals - totals.max(1, keepdims=True)).sum(1)
    best = np.zeros((n, k))
    best[np.arange(n), single] = 1.0
    penalty = np.log(segments.counts + 1.0)
    bic = -2 * totals.max(1) + penalty
    # No mixture is likelier than the best language of each segment, so a text is done when that bound can't gain.
    able = lambda size: np.flatnonzero(-2 * segments.highest + size * penalty < bic - 1e-9)
    order, chosen = np.zeros((n, k), np.int64), able(2)
    if len(chosen) and k > 1:
        weights, _ = _mixture(segments, chosen, np.tile(np.arange(k), (len(chosen), 1)))
        order[chosen] = np.argsort(-weights, axis=1, kind="stable")
    for size in range(2, k + 1):
        chosen = able(size)
        if not len(chosen):
            break
        fitted, ll = _mixture(segments, chosen, order[chosen, :size])
        now = -2 * ll + size * penalty[chosen]
        ok = now < bic[chosen] - 1e-9
        gains = chosen[ok]
        best[gains], bic[gains] = 0.0, now[ok]
        best[gains[:, None], order[gains, :size]] = fitted[ok]
    return best, posterior


def proportions(texts: list[str], model: LanguageModel) -> Iterator[tuple[np.ndarray, float]]:
    """For each text (each with a letter): shares of the languages of the chosen set, and the posterior of the best single
    language. Texts are taken so many at a time that memory doesn't grow with languages; one that is too long goes alone."""
    buckets, sizes = grams_of(texts)
    cells = -(-sizes // SEGMENT) * len(model.langs)
    long, step = cells > CELLS, np.cumsum(np.where(cells > CELLS, 0, cells)) // CELLS
    cuts = [0, *(np.flatnonzero((np.diff(step) > 0) | long[1:] | long[:-1]) + 1).tolist(), len(texts)]
    ends = np.append(0, np.cumsum(sizes))
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield from zip(*_shares(_Segments(buckets[ends[a] : ends[b]], sizes[a:b], model)), strict=True)


def _predict(model: LanguageModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in steps(batches, struct_text):
        with_letter = [i for i, t in enumerate(texts) if has_letter(t)] if model.langs else []
        preds, scores, shares = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
        if with_letter:
            found = proportions([texts[i] for i in with_letter], model)
            for i, (row, sure) in zip(with_letter, found, strict=True):
                best = int(row.argmax())
                preds[i], scores[i] = model.langs[best], float(row[best] * (sure if row[best] == 1.0 else 1.0))
                shares[i] = [{"lang": model.langs[j], "share": float(row[j])} for j in np.flatnonzero(row > 0)]
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        yield with_columns(batch, {"lang_pred": pa.array(preds, pa.string()), "score": pa.array(scores, pa.float64()), "shares": pa.array(shares, kind)})


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Every document as ``row`` (a struct of its own columns), ``lang_pred``, its ``score`` and the ``shares`` of the chosen languages.

    The score is the share of the predicted language; where one language is chosen alone, it is that language's
    posterior among all. A null text, one without a letter, and every text if nothing was learned, are ``und`` with
    score 0 and no shares. Each row is judged by its own text alone, so repeated rows are judged alike; equal shares
    go to the smaller name. Other columns are neither read nor renamed.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = "lang_pred string, score double, shares array<struct<lang:string,share:double>>"
    rows = packed(docs)
    return rows.mapInArrow(lambda it: _predict(sent.value, it), added(rows, fields))
