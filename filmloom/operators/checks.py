"""Constraints as jobs: each check returns the offending keys or rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.operators.skew import lacking


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def key_faults(df: DataFrame, key: str = "id") -> DataFrame:
    """Primary-key faults: null or repeated values."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .filter(F.col(key).isNull() | (F.col("n") > 1))
    )


def orphans(links: DataFrame, fk: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """Foreign-key values without a parent, with the links that hold them.

    Links are counted by value before the join, so a value shared by very many
    links reaches it as one row.
    """
    used = links.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("n"))
    return used.join(parent.select(F.col(key).alias(fk)), fk, "left_anti")


def out_of_range(df: DataFrame, c: str, low: float, high: float) -> DataFrame:
    return df.filter(~F.col(c).between(low, high))


def out_of_domain(df: DataFrame, c: str, domain: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(c).isin(*domain))


def too_long(df: DataFrame, c: str, limit: int) -> DataFrame:
    return df.filter(F.length(c) > limit)


def schema_faults(actual: T.StructType, declared: T.StructType, path: str = "") -> list[str]:
    """Fields, at any depth, that the declared schema lacks or types otherwise."""
    known = {f.name: f.dataType for f in declared}
    faults = []
    for f in actual:
        name = f"{path}{f.name}"
        if f.name not in known:
            faults.append(f"unknown field {name}")
            continue
        have, want = f.dataType, known[f.name]
        if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
            have, want = have.elementType, want.elementType
        if isinstance(have, T.StructType) and isinstance(want, T.StructType):
            faults += schema_faults(have, want, f"{name}.")
        elif have != want:
            faults.append(f"field {name} is {have.simpleString()}, not {want.simpleString()}")
    return faults


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` in the declared shape: unknown fields fail, missing ones become null."""
    declared = T.StructType.fromDDL(ddl)
    faults = schema_faults(df.schema, declared)
    if faults:
        raise ValueError("; ".join(faults))
    return df.to(declared)


def cascade(links: DataFrame, fk: str, deleted: DataFrame, key: str = "id") -> DataFrame:
    """Links left after their parents in ``deleted`` are gone."""
    return lacking(links, deleted.select(F.col(key).alias(fk)), [fk])


def with_faults(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``faults``: names of the rules a row breaks. A rule that is null is broken."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("faults", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and quarantined rows with a ``reason``."""
    checked = with_faults(df, rules)
    valid = checked.filter(F.size("faults") == 0).drop("faults")
    bad = checked.filter(F.size("faults") > 0).withColumn("reason", F.array_join("faults", ",")).drop("faults")
    return valid, bad


def document_rules() -> dict[str, Column]:
    """Required fields of a film document; rating and description are optional."""
    arrays = ("genres", "genres_names", "directors", "directors_names", "writers", "writers_names",
              "actors", "actors_names")
    rules = {c: F.col(c).isNotNull() for c in ("id", "title", *arrays)}
    for c in arrays:
        rules[f"{c}_items"] = ~F.exists(c, lambda x: x.isNull())
    return rules


def require_none(faults: dict[str, DataFrame]) -> None:
    """Fail the batch, naming each check that found something."""
    found = [name for name, df in faults.items() if not df.isEmpty()]
    if found:
        raise ValueError(f"data checks failed: {', '.join(found)}")


def reconcile(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Row counts of each table on both sides."""

    def counts(tables: dict[str, DataFrame], into: str) -> DataFrame:
        parts = [df.agg(F.count("*").alias(into)).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
        return reduce(DataFrame.unionByName, parts)

    return counts(source, "source_rows").join(counts(target, "target_rows"), "table_name", "full").select(
        "table_name", "source_rows", "target_rows",
        (F.col("source_rows").eqNullSafe(F.col("target_rows"))).alias("equal"),
    )
