"""Set operations on key frames and whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.session import materialise


def union_ids(*frames: DataFrame) -> DataFrame:
    """Every id once, whichever frame it comes from."""
    return reduce(DataFrame.unionByName, frames).distinct()


def add_ids(known: DataFrame, new: DataFrame) -> DataFrame:
    """The set after inserting ``new``; inserting twice changes nothing."""
    return union_ids(known, new.select(*known.columns))


def _bucketed(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with the ``_bucket`` of its key."""
    return df.withColumn("_bucket", F.pmod(_row_hash(key, 0), F.lit(buckets)).cast("int"))


def _row_hash(columns: Sequence[str], salt: int) -> Column:
    """Hash of a row's values; a null counts by its place."""
    return F.xxhash64(F.lit(salt), *[x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def changed_buckets(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_bucket``: those whose rows differ, by digests that depend on neither order nor partitioning.

    A digest is the number of rows and two sums of 64-bit row hashes, so unequal buckets go unseen with a probability
    of about 2^-128. Sums are taken in each task before they move.
    """
    sums = [F.sum(_row_hash(columns, salt).cast("decimal(20,0)")).alias(f"h{salt}") for salt in (1, 2)]
    side = lambda df: df.groupBy("_bucket").agg(F.count("*").alias("n"), *sums)
    a, b = side(source).alias("a"), side(target).alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("n", "h1", "h2")]
    joined = a.join(b, F.col("a._bucket") == F.col("b._bucket"), "full").filter(~reduce(Column.__and__, same))
    return joined.select(F.coalesce("a._bucket", "b._bucket").alias("_bucket"))


def table_diff(source: DataFrame, target: DataFrame, key: Sequence[str] = (), buckets: int = 4_096) -> DataFrame:
    """Rows, with multiplicity and all columns, found on one side only.

    Both sides are compared by digests of buckets of the ``key`` (default: the whole row); only rows of buckets that
    differ are shuffled, and one signed count of each tells on which side it is, and how often.
    """
    columns = source.columns
    source, target = (_bucketed(df.select(*columns), key or columns, buckets) for df in (source, target))
    # At most ``buckets`` numbers.
    differ = F.broadcast(materialise(changed_buckets(source, target, columns), "changed-buckets"))
    signed = lambda df, sign: df.join(differ, "_bucket", "left_semi").select(*columns, F.lit(sign).alias("_n"))
    counted = signed(source, 1).unionAll(signed(target, -1)).groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    side = F.when(F.col("_n") > 0, "source").otherwise("target").alias("side")
    return counted.select(*columns, side, F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_n"))).alias("_copy")).drop("_copy")


def common_names(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)
