"""BPE with word ends: frequent words from a memory-mapped transducer, all others by exact merging.

The frequent words are counted over the whole corpus, merged once on the driver (their number is bounded), compiled by
``transducer`` and broadcast (some 25 bytes a word), and each Python worker maps it from a file of its own. A word that isn't in the lexicon is
merged pair by pair, lowest rank first and leftmost of equals. Each worker remembers the ids of a bounded number of
words. The vocabulary file is a parameter; it must be readable at the same path on every machine.

Words are what the vocabulary file's own rules make of a text. For texts of common characters (``SAFE``) two regular
expressions do the same; every other text goes through the normaliser and the splitter that the file describes.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import added, packed, steps, struct_text, with_columns
from filmloom.llm.transducer import Lexicon, compile_words
from filmloom.session import materialise

#: Bound on the words of a lexicon: the most frequent ones of the corpus.
LEXICON_WORDS = 50_000
#: Words a worker remembers at a time, and the longest of them.
REMEMBERED, LONGEST = 400_000, 64
#: Steps in which counts are told apart, for each doubling.
LEVELS = 64
#: Distinct words that a counting task holds before it hands on its counts.
COUNTED = 1_000_000
END = "</w>"
NEVER = 1 << 62

#: Characters for which the plain rules below and those of the vocabulary file agree: they are in composed form, each
#: has one lower-case character, and letters, digits and blanks are the same to both.
SAFE = "\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ňŊ-ž–—‘’“”"
_unsafe = re.compile(f"[^{SAFE}]").search
#: Its lower-case letters. Explicit ranges are matched nearly twice as fast as classes.
_small = "a-zß-öø-ž"
_plain = re.compile(rf"[{_small}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\s0-9{_small}]+").findall


def _byte_chars() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Remembered(dict):
    """Ids of words as little-endian unsigned 32-bit numbers, found when first asked for.

    Once full, the words at hand become the older half; one that is asked for again comes back, the rest go next time.
    """

    def __init__(self, find) -> None:
        super().__init__()
        self._find, self._older = find, {}

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = pack(self._find(word.encode()))
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED // 2:
                self._older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordBpe:
    """Encoder and decoder of a vocabulary file, with a lexicon of words if one is given."""

    def __init__(self, vocabulary: str, lexicon: str | None = None) -> None:
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in (ids | specials).items()}
        self._names = [names.get(i, "") for i in range(max(names) + 1)]
        # The rank of a merge and, below it, the id that it makes.
        self._ranks = {(ids[a], ids[b]): rank << 32 | ids[a + b] for rank, (a, b) in enumerate(spec["model"]["merges"])}
        letters = _byte_chars()
        self._bytes = str.maketrans({c: chr(b) for c, b in letters.items()})
        self._single = [ids.get(c) for c in sorted(letters, key=letters.get)]
        self._final = [ids.get(c + END) for c in sorted(letters, key=letters.get)]
        self._specials = {name: np.array([i], "<u4").tobytes() for name, i in specials.items()}
        self._special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        rules = Tokenizer.from_file(vocabulary)
        self._normalise, self._split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        self._lexicon = Lexicon(lexicon) if lexicon else None
        self._known = _Remembered(self.word_ids)

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word by merging, without the lexicon."""
        ids = [i for i in [*map(self._single.__getitem__, word[:-1]), self._final[word[-1]]] if i is not None]
        if len(ids) > 48:
            return self._merge_long(ids)
        rank = self._ranks.get
        ranks = [rank(pair, NEVER) for pair in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            ids[at : at + 2] = [new] = [best & 0xFFFFFFFF]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((ids[at - 1], new), NEVER)
            if at < len(ranks):
                ranks[at] = rank((new, ids[at + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for words of any length."""
        n, ranks = len(ids), self._ranks
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if pair in ranks]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = best & 0xFFFFFFFF, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (pair := (ids[left], ids[right])) in ranks:
                    heapq.heappush(heap, (ranks[pair], left, *pair))
        return [x for x in ids if x >= 0]

    def word_ids(self, word: bytes) -> list[int]:
        if not word:
            return []
        found = self._lexicon.get(word) if self._lexicon else None
        return self.merge(word) if found is None else found

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if not _unsafe(text):
            return _plain(text.lower())
        pieces = self._split(self._normalise(text))
        return [p.translate(self._bytes).encode("latin-1").decode() for p, _ in pieces]

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at special tokens, and whether a part is one."""
        if self._special is None or not self._special.search(text):
            yield text, False
            return
        at = 0
        for m in self._special.finditer(text):
            if m.start() > at:
                yield text[at : m.start()], False
            yield m[0], True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        known = self._known.__getitem__
        return b"".join(self._specials[part] if special else b"".join(map(known, self.words(part))) for part, special in self.parts(text))

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, parted by blanks: the vocabulary file names no decoder."""
        return " ".join(map(self._names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def encoder(vocabulary: str) -> WordBpe:
    """An encoder without lexicon, one for each Python process."""
    return WordBpe(vocabulary)


def _count_words(vocabulary: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rules, counts = encoder(vocabulary), Counter()
    made = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
    for _, texts in steps(batches, lambda b: b.column("text")):
        for text in texts:
            for part, special in rules.parts(text or ""):
                if not special:
                    counts.update(rules.words(part))
        if len(counts) > COUNTED:
            yield made()
            counts.clear()
    yield made()


def frequent_words(docs: DataFrame, vocabulary: str, words: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all texts, at most ``words`` of them.

    The least count is found from a histogram of the counts on a logarithmic scale, so only words that are wanted reach
    the driver; words of about the same count are taken together or not at all. Words that occur once and very long
    words stay out.
    """
    counted = docs.select("text").mapInArrow(lambda it: _count_words(vocabulary, it), "word string, n bigint")
    totals = counted.filter(F.length("word") <= LONGEST).groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1")
    level = F.floor(F.log2("n") * LEVELS).cast("int")
    totals = materialise(totals.select("word", level.alias("level")), "word-counts")
    sizes = sorted(totals.groupBy("level").count().collect(), reverse=True)
    within = [sum(n for _, n in sizes[: i + 1]) <= words for i in range(len(sizes))]
    least = [lev for (lev, _), ok in zip(sizes, within, strict=True) if ok][-1:]
    return [r["word"] for r in totals.filter(F.col("level") >= least[0]).collect()] if least else []


def build_lexicon(docs: DataFrame, vocabulary: str, words: int = LEXICON_WORDS) -> bytes:
    """The compiled transducer of the frequent words of ``docs``."""
    rules = WordBpe(vocabulary)
    return compile_words(sorted((w.encode(), tuple(rules.merge(w.encode()))) for w in frequent_words(docs, vocabulary, words) if w))


_mapped: dict[str, WordBpe] = {}


def _mapped_encoder(vocabulary: str, name: str, lexicon) -> WordBpe:
    """The encoder of this Python process; a lexicon seen for the first time is written to a file and mapped. The file
    loses its name at once, so it goes with the process."""
    if name not in _mapped:
        with tempfile.NamedTemporaryFile() as f:
            f.write(lexicon.value)
            f.flush()
            _mapped.clear()
            _mapped[name] = WordBpe(vocabulary, f.name)
    return _mapped[name]


def _encode(vocabulary: str, name: str, lexicon, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bpe = _mapped_encoder(vocabulary, name, lexicon)
    for batch, texts in steps(batches, struct_text):
        ids = [bpe.encode(t or "") for t in texts]
        yield with_columns(batch, {
            "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids": pa.array(ids, pa.binary()),
            "decoded": pa.array(map(bpe.decode, ids), pa.string()),
        })


def encode_documents(docs: DataFrame, vocabulary: str, words: int = LEXICON_WORDS) -> DataFrame:
    """Every document as ``row`` (a struct of its own columns), ``n_tokens``, ``ids`` (little-endian unsigned 32-bit
    numbers) and ``decoded``, the text that the ids stand for.

    A null or empty text has no ids and decodes to the empty text. Each row is encoded by its own text alone: repeated
    rows come out alike. Special tokens written in a text are encoded as such. An empty table gives an empty lexicon
    and no rows. Other columns are neither read nor renamed.
    """
    lexicon, name = docs.sparkSession.sparkContext.broadcast(build_lexicon(docs, vocabulary, words)), uuid.uuid4().hex
    rows = packed(docs)
    return rows.mapInArrow(lambda it: _encode(vocabulary, name, lexicon, it), added(rows, "n_tokens bigint, ids binary, decoded string"))
