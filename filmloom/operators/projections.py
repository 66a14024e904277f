"""Column subsets, renames and response shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.catalog import FILM_DOCUMENT
from filmloom.functions.scalar import text_or_default

# Source column names that change on load.
RENAMES = {"created_at": "created", "updated_at": "modified"}
LISTING_FIELDS = ("id", "title", "description", "creation_date", "rating", "type")
GRID_FIELDS = ("title", "type", "creation_date", "rating")
DOCUMENT_FIELDS = tuple(part.split(" ", 1)[0] for part in FILM_DOCUMENT.split(", "))


def rename_loaded(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})


def default_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: text_or_default(c) for c in cols})


def listing(film: DataFrame) -> DataFrame:
    return film.select(*LISTING_FIELDS)


def grid(film: DataFrame) -> DataFrame:
    return film.select(*GRID_FIELDS)


def document_shape(df: DataFrame) -> DataFrame:
    return df.select(*DOCUMENT_FIELDS)


def partial_film(documents: DataFrame, *extra: str) -> DataFrame:
    return documents.select(*extra, F.col("id").alias("uuid"), "title", "imdb_rating")


def _renamed(objects: str, name: str) -> Column:
    return F.transform(objects, lambda x: F.struct(x["id"].alias("uuid"), x["name"].alias(name))).alias(objects)


def full_film(documents: DataFrame, *extra: str) -> DataFrame:
    return documents.select(
        *extra,
        F.col("id").alias("uuid"),
        "title",
        "imdb_rating",
        "description",
        _renamed("genres", "name"),
        _renamed("actors", "full_name"),
        _renamed("writers", "full_name"),
        _renamed("directors", "full_name"),
    )


def partial_genre(genres: DataFrame, *extra: str) -> DataFrame:
    return genres.select(*extra, F.col("id").alias("uuid"), "name")


def partial_person(persons: DataFrame, *extra: str) -> DataFrame:
    return persons.select(*extra, F.col("id").alias("uuid"), F.col("name").alias("full_name"))


def names_of(objects: str) -> Column:
    return F.transform(objects, lambda x: x["name"])
