"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window of an item is a set of word shingles with their places. Containment must be whole, so of a window's shingles
ordered by rarity in the corpus a prefix of one is necessary: wherever the window occurs, its rarest shingle occurs.
The join is on that shingle alone; the place of the shingle gives the one start that is possible, the length bound drops
starts at which the window would leave the document, and what is left is compared word by word.

Corpus rows are read three times and never shuffled by text: for the rarity of the shingles, for the join, and for the
word counts. Windows are broadcast in blocks of ``BLOCK_BYTES``. Where that would take more than ``BLOCKS`` blocks, each a pass
over the corpus, hashes and places are shuffled by shingle instead, once for any benchmark, and only documents with a candidate
are read again for its words.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.operators.skew import skew_join
from filmloom.session import materialise

WINDOW = 13
SHINGLE = 3
BLOCK_BYTES = 32 << 20
#: Blocks that are broadcast one after the other; with more, the joins are by shuffle.
BLOCKS = 4
#: A document is contaminated if at least one in so many of its words is hit.
SHARE = 20

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_column(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _token(words: Column, start: Column, size: int) -> Column:
    """Hash of the shingle of ``size`` words from ``start`` (from 0)."""
    return F.xxhash64(F.lit(size), *[F.get(words, start + i) for i in range(size)])


def windows_of(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows of ``items`` (item_id, text) as ``wid, words, size``, and the items of each as rows ``wid, item``.
    A shorter item is one window. A window that very many items share is so many rows, never one array."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_column(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    cut = words.filter(F.size("words") > 0).select("item", "words", F.explode(starts).alias("start"))
    held = materialise(cut.select("item", F.slice("words", F.col("start"), F.lit(window)).alias("words")).distinct(), "held")
    windows = held.select("words").distinct().select(F.monotonically_increasing_id().alias("wid"), "words", F.size("words").alias("size"))
    windows = materialise(windows, "windows")
    return windows, materialise(skew_join(held, windows.drop("size"), ["words"], "inner", salt_by=["item"]).select("wid", "item"), "window-items")


def _shingle_sizes(windows: DataFrame, shingle: int) -> list[int]:
    """Sizes of the shingles in use: at most ``shingle`` values, as a window shorter than that is one shingle."""
    return sorted(r[0] for r in windows.select(F.least("size", F.lit(shingle))).distinct().collect())


def _positions(tokenised: DataFrame, sizes: list[int]) -> DataFrame:
    """Every place of every document with the hashes of the shingles that start there. The words stay beside it by
    reference: joins that follow must be broadcast joins, which drop the row before it is copied."""
    at = tokenised.select("*", F.posexplode("words").alias("at", "_word")).drop("_word")
    fits = [(F.col("at") + n <= F.size("words"), _token(F.col("words"), F.col("at"), n)) for n in sizes]
    if len(sizes) == 1:
        return at.filter(fits[0][0]).withColumn("token", fits[0][1])
    tokens = F.array(*[F.when(ok, token) for ok, token in fits])
    return at.withColumn("token", F.explode(tokens)).filter(F.col("token").isNotNull())


def prefixes(windows: DataFrame, tokenised: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Windows with the hash ``token`` of their rarest shingle in the corpus and its ``offset``; ties to the smaller hash."""
    sizes = _shingle_sizes(windows, shingle)
    own = reduce(
        DataFrame.union,
        [
            windows.filter(F.least("size", F.lit(shingle)) == n)
            .select("wid", "words", F.explode(F.sequence(F.lit(0), F.col("size") - n)).alias("offset"))
            .select("wid", "offset", _token(F.col("words"), F.col("offset"), n).alias("token"))
            for n in sizes
        ],
    )
    own = materialise(own, "shingles")
    tokens = own.select("token").distinct()
    blocks = 1 + own.count() * 16 // BLOCK_BYTES
    places = lambda: _positions(tokenised.select("words"), sizes).select("token")
    if blocks > BLOCKS:
        counts = places().groupBy("token").agg(F.count("*").alias("n")).join(tokens, "token")
    else:
        parts = [tokens.filter(F.pmod(F.xxhash64("token"), F.lit(blocks)) == block) for block in range(blocks)]
        counts = reduce(DataFrame.union, [places().join(F.broadcast(part), "token").groupBy("token").agg(F.count("*").alias("n")) for part in parts])
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")
    rarest = own.join(counts, "token", "left").groupBy("wid").agg(F.min(rarity).alias("rarest"))
    return materialise(windows.join(rarest.select("wid", "rarest.token", "rarest.offset"), "wid"), "prefixes")


def occurrences(tokenised: DataFrame, prefixed: DataFrame, sizes: list[int]) -> DataFrame:
    """Every occurrence of a window as ``key, wid, start, size``, from ``tokenised`` (key, words)."""
    total = prefixed.agg(F.sum(F.octet_length(F.array_join("words", " ")) + 64)).first()[0] or 0
    blocks = 1 + total // BLOCK_BYTES
    if blocks > BLOCKS:
        return _shuffled_occurrences(tokenised, prefixed, sizes)
    found = None
    for block in range(blocks):
        part = prefixed.filter(F.pmod(F.xxhash64("wid"), F.lit(blocks)) == block).withColumnRenamed("words", "sought")
        start = F.col("at") - F.col("offset")
        hits = (
            _positions(tokenised, sizes).join(F.broadcast(part), "token")
            .filter((start >= 0) & (start + F.col("size") <= F.size("words")))
            .filter(F.slice("words", start + 1, F.col("size")) == F.col("sought"))
            .select("key", "wid", start.alias("start"), "size")
        )
        found = hits if found is None else found.union(hits)
    return found


def _shuffled_occurrences(tokenised: DataFrame, prefixed: DataFrame, sizes: list[int]) -> DataFrame:
    """The same for windows of any number: candidates from hashes, places and lengths alone, then the words of each.

    A shingle or window that very many documents hold is a hot key of a plain inner join, which the runtime divides.
    """
    places = _positions(tokenised, sizes).select("key", "token", "at", F.size("words").alias("length"))
    start = F.col("at") - F.col("offset")
    near = places.join(prefixed.drop("words"), "token").filter((start >= 0) & (start + F.col("size") <= F.col("length")))
    near = near.groupBy("key").agg(F.collect_set(F.struct("wid", start.alias("start"), "size")).alias("near"))
    read = tokenised.join(materialise(near, "candidates"), "key").select("key", "words", F.explode("near").alias("c"))
    read = read.select("key", "c.*", F.slice("words", F.col("c.start") + 1, F.col("c.size")).alias("words"))
    sought = prefixed.select("wid", F.col("words").alias("sought"))
    return read.join(sought, "wid").filter(F.col("words") == F.col("sought")).select("key", "wid", "start", "size")


def covered(spans: Column) -> Column:
    """Number of places inside any of the spans (start, size)."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def add(acc: Column, span: Column) -> Column:
        end = span["start"] + span["size"]
        new = F.greatest(F.lit(0), end - F.greatest(acc["end"], span["start"]))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["n"])


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``keep`` of ``docs``, by default all), ``n_words``, ``n_hit``, ``items`` and ``contaminated`` for every document.

    ``items`` are the ids, as text and sorted, of the items of which a window occurs in the document. Null, empty and
    wordless texts have no words, no hits and aren't contaminated; such items have no window. A null item id is the
    empty text; rows of one item id are one item with the windows of all. Repeated documents each come back, with the
    same result. Without items nothing is hit. Other columns pass through inside ``row``.
    """
    key = F.struct(F.col("doc_id").cast("string").alias("id"), F.xxhash64("text").alias("hash"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), key.alias("key"), words_column(F.col("text")).alias("words"))
    windows, members = windows_of(items, window)
    if windows.isEmpty():
        none = F.array().cast("array<string>")
        return rows.select("row", F.size("words").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), none.alias("items"), F.lit(False).alias("contaminated"))
    tokenised = rows.select("key", "words")
    hits = occurrences(tokenised, prefixes(windows, tokenised, shingle), _shingle_sizes(windows, shingle))
    by_doc = hits.groupBy("key").agg(F.collect_set(F.struct("start", "size")).alias("spans"), F.collect_set("wid").alias("wids"))
    by_doc = materialise(by_doc.select("key", covered(F.col("spans")).alias("n_hit"), F.array_sort("wids").alias("wids")), "hits")
    # Copies, and documents with one passage, hit the same windows: their items are put together once for all of them.
    alike = by_doc.select("wids").distinct().select("wids", F.explode("wids").alias("wid"))
    named = alike.join(members, "wid").groupBy("wids").agg(F.sort_array(F.collect_set("item")).alias("items"))
    marks = by_doc.join(named, "wids").select(F.col("key").alias("mark"), "n_hit", "items")
    counted = rows.select("row", "key", F.size("words").cast("long").alias("n_words"))
    out = counted.join(marks, F.col("key").eqNullSafe(F.col("mark")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select(
        "row", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated."""
    return benchmark_hits(docs, items).filter("NOT contaminated").select("row.*")
