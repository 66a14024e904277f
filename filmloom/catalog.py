"""Declared schemas and the catalogue of normalised tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILM_WORK = (
    "id string, title string, description string, type string, creation_date timestamp, "
    "certificate string, file_path string, rating double, created timestamp, modified timestamp"
)
PERSON = "id string, full_name string, birth_date date, created timestamp, modified timestamp"
GENRE = "id string, name string, description string, created timestamp, modified timestamp"
PERSON_FILM_WORK = "id string, film_work_id string, person_id string, role string, created timestamp"
GENRE_FILM_WORK = "id string, film_work_id string, genre_id string, created timestamp"

# Parents come before the links that refer to them.
TABLES = {
    "genre": GENRE,
    "person": PERSON,
    "film_work": FILM_WORK,
    "genre_film_work": GENRE_FILM_WORK,
    "person_film_work": PERSON_FILM_WORK,
}

FILM_DOCUMENT = (
    "id string, imdb_rating double, title string, description string, "
    "genres_names array<string>, directors_names array<string>, "
    "actors_names array<string>, writers_names array<string>, "
    "genres array<struct<id:string,name:string>>, actors array<struct<id:string,name:string>>, "
    "directors array<struct<id:string,name:string>>, writers array<struct<id:string,name:string>>"
)
GENRE_DOCUMENT = "id string, name string"
PERSON_DOCUMENT = "id string, name string, roles array<string>"

# Domains, array field of each role, field limits.
FILM_TYPES = ("movie", "tv_show")
ROLES = ("actor", "director", "writer")
ROLE_FIELDS = {"actor": "actors", "director": "directors", "writer": "writers"}
MAX_NAME_LENGTH = 255
RATING_RANGE = (0.0, 100.0)

# Fixed values: (domain, code, language, label).
DISPLAY_LABELS = (
    ("type", "movie", "en", "Movie type"),
    ("type", "movie", "ru", "Фильм"),
    ("type", "tv_show", "en", "TV show"),
    ("type", "tv_show", "ru", "ТВ-Шоу"),
    ("role", "writer", "en", "Writer"),
    ("role", "writer", "ru", "Сценарист"),
    ("role", "actor", "en", "Actor"),
    ("role", "actor", "ru", "Актёр"),
    ("role", "director", "en", "Director"),
    ("role", "director", "ru", "Режисёр"),
)


@dataclass(frozen=True)
class Catalog:
    """Five normalised frames. Key columns may have any one type.

    ``film``: id, title, description, type, creation_date, rating, modified;
    ``person``: id, full_name; ``genre``: id, name;
    ``person_film``: film_work_id, person_id, role;
    ``genre_film``: film_work_id, genre_id.
    """

    film: DataFrame
    person: DataFrame
    genre: DataFrame
    person_film: DataFrame
    genre_film: DataFrame


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role_of_flag(flag: str = "l_returnflag") -> F.Column:
    """Role that a line item's return flag stands for."""
    return (
        F.when(F.col(flag) == "A", "actor")
        .when(F.col(flag) == "N", "writer")
        .when(F.col(flag) == "R", "director")
    )


def _links(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    line = read_table(spark, sf_dir, "lineitem")
    return {
        "person_film": line.select(
            F.col("l_orderkey").alias("film_work_id"),
            F.col("l_suppkey").alias("person_id"),
            role_of_flag().alias("role"),
        ),
        "genre_film": line.select(
            F.col("l_orderkey").alias("film_work_id"), F.col("l_partkey").alias("genre_id")
        ),
        "person": read_table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("full_name")
        ),
        "genre": read_table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
        ),
    }


def orders_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The sales tables read as a film catalogue: an order is a film."""
    film = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("description"),
        F.col("o_orderstatus").alias("type"),
        F.col("o_orderdate").alias("creation_date"),
        F.col("o_totalprice").alias("rating"),
        F.col("o_orderdate").alias("modified"),
    )
    return Catalog(film=film, **_links(spark, sf_dir))


def documents_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The text corpus read as a film catalogue: a document is a film."""
    film = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("title"),
        F.col("text").alias("description"),
        F.col("lang").alias("type"),
        F.lit(None).cast("timestamp").alias("creation_date"),
        F.col("n_chars").cast("double").alias("rating"),
        F.lit(None).cast("timestamp").alias("modified"),
    )
    return Catalog(film=film, **_links(spark, sf_dir))


def document_ddl(key: str = "string") -> str:
    """The film document's schema for another key type."""
    return FILM_DOCUMENT.replace("id string", f"id {key}", 1).replace("id:string", f"id:{key}")
