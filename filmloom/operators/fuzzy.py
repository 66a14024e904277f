"""Terms within a few edits of each other, found by equi-joins.

Two terms within ``d`` edits (insert, delete, replace, swap of neighbours) share
a string left over when at most ``d`` characters are deleted from the first
``PREFIX`` characters of each. So the candidates come from a join on those left-over
strings, never from comparing every pair, and the exact distance decides.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.operators.index import Index, hash_bucket
from filmloom.operators.search import query_terms, term_hits
from filmloom.operators.skew import each_once, fits_broadcast, skew_join
from filmloom.session import materialise

# A longer prefix gives fewer candidates and more join rows.
PREFIX = 7


def edit_budget(term: Column) -> Column:
    """Edits allowed for a query term: 0 up to two characters, 1 up to five, else 2."""
    size = F.length(term)
    return F.when(size <= 2, 0).when(size <= 5, 1).otherwise(2)


def beginning(term: Column) -> Column:
    """The first ``PREFIX`` characters."""
    return F.substring(term, 1, PREFIX)


def leftovers(term: Column) -> Column:
    """Array of ``(deleted, rest)`` for up to two deletions in the prefix: each rest once, with the fewest deletions."""
    prefix = beginning(term)
    size, places = F.length(prefix), range(1, PREFIX + 1)
    before = lambda i: F.substring(prefix, 1, i - 1)
    after = lambda i: F.substring(prefix, i + 1, PREFIX)
    between = lambda i, j: F.substring(prefix, i + 1, j - i - 1)
    one = [F.when(size >= i, F.concat(before(i), after(i))) for i in places]
    two = [F.when(size >= j, F.concat(before(i), between(i, j), after(j))) for i, j in combinations(places, 2)]
    # The length of a rest tells how many characters were deleted.
    rests = F.array_distinct(F.array_compact(F.array(prefix, *one, *two)))
    return F.transform(rests, lambda rest: F.struct((size - F.length(rest)).alias("deleted"), rest.alias("rest")))


def _swaps(text: Column) -> Column:
    size = F.length(text)
    swap = lambda i: F.concat(
        text.substr(F.lit(1), i - 1), text.substr(i + 1, F.lit(1)), text.substr(i, F.lit(1)), text.substr(i + 2, size)
    )
    return F.when(size > 1, F.transform(F.sequence(F.lit(1), size - 1), swap)).otherwise(
        F.array().cast("array<string>")
    )


def within(a: Column, b: Column, budget: Column) -> Column:
    """True if ``a`` becomes ``b`` in at most ``budget`` (0 to 2) edits, a swap being one."""
    plain = F.levenshtein(a, b, 2)
    a_swaps, b_swaps = _swaps(a), _swaps(b)
    one_more = (
        F.exists(a_swaps, lambda s: F.levenshtein(s, b, 1) >= 0)
        | F.exists(b_swaps, lambda s: F.levenshtein(a, s, 1) >= 0)
        | F.arrays_overlap(a_swaps, b_swaps)
    )
    return (
        ((plain >= 0) & (plain <= budget))
        | ((budget >= 1) & F.array_contains(a_swaps, b))
        | ((budget >= 2) & one_more)
    )


def vocabulary_rests(vocabulary: DataFrame) -> DataFrame:
    """``term, rest, b``: each distinct term with what is left of it after ``b`` deletions.

    An asked term that may lose one character keeps two at least, one that may lose two keeps four, so shorter
    left-overs cannot meet any.
    """
    rests = each_once(vocabulary, "term").select("term", F.explode(leftovers(F.col("term"))).alias("l"))
    return rests.select("term", "l.rest", F.col("l.deleted").alias("b")).filter((F.col("b") == 0) | (F.length("rest") >= 2 * F.col("b")))


def dictionary(index: Index) -> tuple[DataFrame, DataFrame]:
    """``term, prefix, bucket``: the terms of the index, in folders by hash of the prefix; and ``prefix, rest, b, bucket``:
    the left-overs of each prefix, in folders by hash of the left-over. What an earlier generation held may come again.

    What is left of a term is what is left of its prefix. Terms share prefixes, the more the more terms there are, so a
    prefix is expanded once for all its terms. Both are written once for each generation of the index, by the first who asks.
    """
    place = f"{index.path}/close"
    for gen in index.gens:
        try:
            index.spark.read.schema("gen int").parquet(f"{place}/written/{gen}")
        except AnalysisException:
            # What the generation adds; its terms may be known to an earlier one.
            added = index.rows("blocks", "term string, level int").filter((F.col("gen") == gen) & F.col("level").isNotNull())
            words = added.select("term").distinct().withColumn("prefix", beginning(F.col("term")))
            _write_folders(words, f"{place}/words/gen={gen}", "prefix", index.buckets)
            words = index.spark.read.schema("prefix string").parquet(f"{place}/words/gen={gen}")
            rests = vocabulary_rests(words.withColumnRenamed("prefix", "term")).withColumnRenamed("term", "prefix")
            _write_folders(rests, f"{place}/rests/gen={gen}", "rest", index.buckets)
            index.spark.createDataFrame([(gen,)], "gen int").coalesce(1).write.mode("overwrite").parquet(f"{place}/written/{gen}")
    words = index.rows("close/words", "term string, prefix string, bucket int")
    return words.drop("gen"), index.rows("close/rests", "prefix string, rest string, b int, bucket int").drop("gen")


def _write_folders(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    rows = rows.withColumn("bucket", hash_bucket(key, buckets)).hint("rebalance", "bucket")
    rows.sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(path)


def _in_folders(rows: DataFrame, wanted: DataFrame, key: str, buckets: int) -> DataFrame:
    """``rows`` in the folders that may hold a ``key`` of ``wanted``, a scan."""
    # At most ``buckets`` numbers.
    places = [r[0] for r in wanted.select(hash_bucket(key, buckets)).distinct().collect()]
    return rows.filter(F.col("bucket").isin(places)).drop("bucket")


def _asked_rests(asked: DataFrame) -> DataFrame:
    """``asked, budget, rest``: the left-overs of the asked terms within their budgets, as a scan."""
    left = asked.select("asked").distinct().withColumn("budget", edit_budget(F.col("asked")))
    left = left.select("asked", "budget", F.explode(leftovers(F.col("asked"))).alias("l"))
    return materialise(left.filter("l.deleted <= budget").select("asked", "budget", "l.rest"), "asked-terms")


def _meeting(left: DataFrame, rests: DataFrame, key: str, stored: bool) -> DataFrame:
    """Rows of ``left`` joined with ``rests`` (``key``, rest, b; a scan if ``stored``) on the left-over."""
    if fits_broadcast(left):
        pairs = rests.join(F.broadcast(left), "rest")
    else:
        pairs = skew_join(rests if stored else materialise(rests, "vocabulary-rests"), left, ["rest"], "inner", salt_by=[key])
    return pairs.filter("b <= budget")


def _within_budget(pairs: DataFrame) -> DataFrame:
    """The pairs ``(asked, term)`` of ``asked, term, budget`` whose distance is within the budget."""
    near = F.abs(F.length("term") - F.length("asked")) <= F.col("budget")
    pairs = pairs.filter(near).select("asked", "term", "budget").distinct()
    return pairs.filter(within(F.col("asked"), F.col("term"), F.col("budget"))).select("asked", "term")


def close_terms(asked: DataFrame, rests: DataFrame) -> DataFrame:
    """Pairs ``(asked, term)`` within the budget of the asked term. ``rests``: ``vocabulary_rests``."""
    return _within_budget(_meeting(_asked_rests(asked), rests, "term", stored=False))


def close_index_terms(asked: DataFrame, index: Index) -> DataFrame:
    """``close_terms`` among the terms of an index: prefixes that share a left-over first, then the terms that begin with
    them. Only the folders of the asked terms' left-overs and of those prefixes are read."""
    words, rests = dictionary(index)
    left = _asked_rests(asked)
    met = _meeting(left, _in_folders(rests, left, "rest", index.buckets), "prefix", stored=True)
    # Cut to the prefix, lengths differ no more than before.
    near = F.abs(F.length("prefix") - F.least(F.lit(PREFIX), F.length("asked"))) <= F.col("budget")
    met = materialise(met.filter(near).select("asked", "budget", "prefix").distinct(), "close-prefixes")
    return _within_budget(skew_join(_in_folders(words, met, "prefix", index.buckets), met, ["prefix"], "inner", salt_by=["term"]))


def fuzzy_matches(queries: DataFrame, index: Index) -> DataFrame:
    """Distinct ``(query_key, doc)`` with a term close to a query term, in any field."""
    asked = materialise(query_terms(queries, index.fields).select("query_key", "field", F.col("term").alias("asked")), "query-terms")
    close = close_index_terms(asked, index)
    expanded = materialise(asked.join(close, "asked").select("query_key", "field", "term").distinct(), "close-terms")
    return term_hits(index, expanded).select("query_key", "doc").distinct()
