"""Joins and groupings that stay even when one key holds much of the data."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.session import materialise

# A key with fewer rows than this is no burden for one task, whatever the table's size.
HOT_ROWS = 1_000_000


def heavy_keys(df: DataFrame, keys: Sequence[str], floor: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``floor`` rows, as ``keys + [n]``; ``None`` if there are none.

    There are at most rows / ``floor`` such keys, so the list is a millionth of the
    table; who joins with it measures it first. A table of at most ``floor`` rows is
    answered by its row count alone.
    """
    if df.count() <= floor:
        return None
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    hot = materialise(counts.filter(F.col("n") > floor), "hot-keys")
    return None if hot.isEmpty() else hot


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over as many tasks as the session shuffles into, for costly row work on an input of few row groups."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def each_once(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``key``, kept over all cores for costly work on each.

    The runtime would pack a short list into few tasks, going by its bytes.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.select(key).repartition(tasks, key).distinct()


def fits_broadcast(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> bool:
    """Measured, not estimated: at most so many rows, and so many bytes as text."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    rows, text = df.limit(max_rows + 1).agg(F.count("*"), F.sum(size)).first()
    return rows <= max_rows and (text or 0) <= max_bytes


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    hot: DataFrame | None,
    how: str = "left",
    salt_by: Sequence[str] = (),
    floor: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join of many fact rows to few rows of each key, given the hot keys ``on + [n]``.

    Each hot group is divided into salts of about ``floor`` rows, and only the
    hot rows of ``dim`` are repeated, once for each salt. ``salt_by`` names
    columns that vary inside a group. Without hot keys this is a plain join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"facts must be the preserved side, not {how!r}")
    on = list(on)
    if hot is None:
        return facts.join(dim, on, how)
    salts_of = hot.select(*on, F.ceil(F.col("n") / F.lit(floor)).cast("int").alias("_salts"))
    if fits_broadcast(salts_of):
        salts_of = F.broadcast(salts_of)
    vary = list(salt_by) or [c for c in facts.columns if c not in on]
    keyless = reduce(operator.or_, [F.col(c).isNull() for c in on])
    # Rows without a key match nothing, so they may go anywhere.
    salts = F.when(keyless, F.lit(1024)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = facts.join(salts_of, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*vary), salts))
    copies = dim.join(salts_of, on, "left").withColumn(
        "_salt",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)).cast("bigint") - 1)),
    )
    return salted.drop("_salts").join(copies.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def skew_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salt_by: Sequence[str] = (),
    measure: DataFrame | None = None,
    floor: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join that looks before it shuffles.

    Few facts need no care. Else a ``dim`` measured as small is broadcast, and a
    large one is joined with the hot keys of ``facts`` salted. ``measure`` is a
    cheaper frame with the same keys to count on; without it ``facts`` should be
    a scan, as counting would compute it twice.
    """
    counted = facts if measure is None else measure
    if counted.count() <= floor:
        return facts.join(dim, list(on), how)
    if fits_broadcast(dim, max_rows=1_000_000):
        return facts.join(F.broadcast(dim), list(on), how)
    return salted_join(facts, dim, on, heavy_keys(counted, list(on), floor), how, salt_by, floor)


def matching(facts: DataFrame, keys: DataFrame, on: Sequence[str], **kw) -> DataFrame:
    """Fact rows whose key is in ``keys``, each once; an empty list gives no rows."""
    return skew_join(facts, materialise(keys.select(*on).distinct(), "keys"), on, "left_semi", **kw)


def lacking(facts: DataFrame, keys: DataFrame, on: Sequence[str], **kw) -> DataFrame:
    """Fact rows whose key is not in ``keys``."""
    return skew_join(facts, materialise(keys.select(*on).distinct(), "keys"), on, "left_anti", **kw)
