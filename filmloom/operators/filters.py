"""Predicates, composed from parts and pushed down where the source allows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.operators.skew import heavy_keys, salted_join


def all_of(clauses: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, clauses, F.lit(True))


def any_of(clauses: Iterable[Column]) -> Column:
    """True if one clause holds; without clauses there is no restriction."""
    found = list(clauses)
    return reduce(lambda a, b: a | b, found) if found else F.lit(True)


def boolean(must: Iterable[Column] = (), should: Iterable[Column] = ()) -> Column:
    """All of ``must``; ``should`` restricts only while ``must`` is empty."""
    required = list(must)
    return all_of(required) if required else any_of(should)


def changed_since(df: DataFrame, mark: Column, column: str = "modified") -> DataFrame:
    return df.filter(F.col(column) > mark)


def changed_from(df: DataFrame, mark: Column, column: str = "modified") -> DataFrame:
    """As ``changed_since``, rows at the mark itself included: one that is stored late, with the time of the mark, isn't lost."""
    return df.filter(F.col(column) >= mark)


def by_id(df: DataFrame, value: object, key: str = "id") -> DataFrame:
    """The row with this id; an empty frame means not found."""
    return df.filter(F.col(key) == F.lit(value))


def lookup(requests: DataFrame, df: DataFrame, key: str = "id") -> DataFrame:
    """One row for each request ``(request_id, <key>)``, with ``found`` telling a miss."""
    target = df.withColumn("found", F.lit(True))
    joined = salted_join(requests, target, [key], heavy_keys(requests, [key]), "left", salt_by=["request_id"])
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))
