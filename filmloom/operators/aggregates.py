"""Distinct aggregates of link tables, counts, and role lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_sorted(value: Column) -> Column:
    """Distinct non-null values in a fixed order; none gives an empty array."""
    return F.sort_array(F.collect_set(value))


def names_in_role(role: str, name: str = "name") -> Column:
    return distinct_sorted(F.when(F.col("role") == role, F.col(name)))


def row_count(df: DataFrame, into: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(into))


def roles_of_persons(person: DataFrame, person_film: DataFrame) -> DataFrame:
    """Person documents: id, name and the roles held anywhere."""
    held = person_film.groupBy(F.col("person_id").alias("id")).agg(distinct_sorted(F.col("role")).alias("roles"))
    return (
        person.select("id", F.col("full_name").alias("name"))
        .join(held, "id", "left")
        .withColumn("roles", F.coalesce("roles", F.array().cast("array<string>")))
    )


def genre_documents(genre: DataFrame) -> DataFrame:
    return genre.select("id", "name")
