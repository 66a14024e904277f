"""Named queries over the driver tables, each beside the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def snapshot(spark, sf_dir, tables):
    """What the files of the tables are now: their names, lengths and times as one number."""
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in tables])
    return files.agg(F.hex(F.bit_xor(F.xxhash64("path", "modificationTime", "length")))).first()[0]


def names_text(c: str) -> Column:
    return F.array_join(c, "|").alias(c)


def objects_text(c: str) -> Column:
    item = lambda x: F.concat(x["id"].cast("string"), F.lit(":"), x["name"])
    return F.array_join(F.transform(c, item), "|").alias(c)


def documents_text(docs: DataFrame) -> DataFrame:
    """Film documents with each array as one text, so that engines can be compared."""
    relations = ("genres", "actors", "directors", "writers")
    plain = [c for c in docs.columns if c not in relations and not c.endswith("_names")]
    return docs.select(*plain, *[names_text(f"{c}_names") for c in relations], *[objects_text(c) for c in relations])


# The driver tables as a catalogue, in SQL.
LINKS_SQL = """
person AS (SELECT s_suppkey AS id, s_name AS full_name FROM supplier),
genre AS (SELECT p_partkey AS id, p_name AS name FROM part),
person_film AS (
  SELECT l_orderkey AS film_work_id, l_suppkey AS person_id,
         CASE l_returnflag WHEN 'A' THEN 'actor' WHEN 'N' THEN 'writer' WHEN 'R' THEN 'director' END AS role
  FROM lineitem),
genre_film AS (SELECT l_orderkey AS film_work_id, l_partkey AS genre_id FROM lineitem)
"""
ORDERS_SQL = (
    """
film AS (
  SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS description, o_orderstatus AS type,
         o_orderdate AS creation_date, o_totalprice AS rating, o_orderdate AS modified
  FROM orders),"""
    + LINKS_SQL
)
DOCUMENTS_SQL = (
    """
film AS (
  SELECT doc_id AS id, source AS title, text AS description, lang AS type,
         CAST(NULL AS TIMESTAMP) AS creation_date, CAST(n_chars AS DOUBLE) AS rating,
         CAST(NULL AS TIMESTAMP) AS modified
  FROM documents),"""
    + LINKS_SQL
)


def members_sql(film: str = "") -> str:
    """Distinct people and genres of films as lists, by two separate aggregations."""

    def people(role: str, field: str) -> str:
        return (
            f"list_sort(list(DISTINCT {{'id': p.id, 'name': p.full_name}}) FILTER (WHERE role = '{role}')) AS {field}, "
            f"list_sort(list(DISTINCT p.full_name) FILTER (WHERE role = '{role}')) AS {field}_names"
        )

    return f"""
cast_of AS (
  SELECT film_work_id, {people("actor", "actors")}, {people("director", "directors")}, {people("writer", "writers")}
  FROM person_film JOIN person p ON p.id = person_id {film} GROUP BY film_work_id),
kinds_of AS (
  SELECT film_work_id, list_sort(list(DISTINCT {{'id': g.id, 'name': g.name}})) AS genres,
         list_sort(list(DISTINCT g.name)) AS genres_names
  FROM genre_film JOIN genre g ON g.id = genre_id {film} GROUP BY film_work_id)
"""


def names_sql(c: str, into: str | None = None) -> str:
    return f"coalesce(array_to_string({c}, '|'), '') AS {into or c}"


def objects_sql(c: str) -> str:
    return f"coalesce(array_to_string([x.id || ':' || x.name for x in {c}], '|'), '') AS {c}"


RELATIONS = ("genres", "actors", "directors", "writers")
DOCUMENT_COLUMNS_SQL = ", ".join(
    [names_sql(f"{c}_names") for c in RELATIONS] + [objects_sql(c) for c in RELATIONS]
)
DOCUMENT_FROM_SQL = (
    "FROM film f LEFT JOIN cast_of c ON c.film_work_id = f.id LEFT JOIN kinds_of k ON k.film_work_id = f.id"
)


def documents_sql(catalog: str = ORDERS_SQL) -> str:
    return (
        f"WITH {catalog}, {members_sql()} SELECT f.id, f.rating AS imdb_rating, f.title, f.description, "
        f"{DOCUMENT_COLUMNS_SQL} {DOCUMENT_FROM_SQL}"
    )
