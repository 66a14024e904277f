"""Nested film documents from the normalised tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.catalog import ROLE_FIELDS, Catalog
from filmloom.functions.scalar import id_name, or_empty
from filmloom.operators.aggregates import distinct_sorted
from filmloom.operators.projections import names_of
from filmloom.operators.skew import HOT_ROWS, heavy_keys, skew_join
from filmloom.session import materialise

RELATIONS = ("genres", *ROLE_FIELDS.values())


def person_links(cat: Catalog) -> DataFrame:
    """``(film_work_id, role, id)`` of people in a document role."""
    links = cat.person_film.filter(F.col("role").isin(*ROLE_FIELDS) & F.col("person_id").isNotNull())
    return links.select("film_work_id", "role", F.col("person_id").alias("id"))


def genre_links(cat: Catalog) -> DataFrame:
    links = cat.genre_film.filter(F.col("genre_id").isNotNull())
    return links.select("film_work_id", F.col("genre_id").alias("id"))


def _named(links: DataFrame, names: DataFrame, measure: DataFrame) -> DataFrame:
    """Members with their names; links to nobody fall away."""
    vary = [c for c in links.columns if c != "id"]
    return skew_join(links, names, ["id"], "inner", salt_by=vary, measure=measure.select("id"))


def _merged(links: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct links where some film has very many rows, so that copies merge before they move; otherwise the links as
    they are, as films with few links each have few copies to move."""
    return links if heavy_keys(stored.select("film_work_id"), ["film_work_id"], HOT_ROWS) is None else links.distinct()


def person_members(cat: Catalog) -> DataFrame:
    """Distinct ``(film_work_id, role, id, name)``. Copies of a link merge before they move."""
    return _named(person_links(cat).distinct(), cat.person.select("id", F.col("full_name").alias("name")), cat.person_film.select(F.col("person_id").alias("id")))


def genre_members(cat: Catalog) -> DataFrame:
    """Distinct ``(film_work_id, id, name)``."""
    return _named(genre_links(cat).distinct(), cat.genre.select("id", "name"), cat.genre_film.select(F.col("genre_id").alias("id")))


def film_documents(cat: Catalog, extra: Sequence[str] = ()) -> DataFrame:
    """One document for each film: its fields and its distinct people and genres.

    Both link tables are aggregated by film before they meet the film, so the
    person x genre product never exists. A relation without members is an empty
    array; names are distinct and sorted.

    A document is one row, whatever its size, so a film's distinct members meet in
    one task; their copies do not. What needs members but not documents (filters,
    nested searches) reads ``person_members`` and ``genre_members`` instead.
    """
    people, genres = person_links(cat), genre_links(cat)
    film_key = ["film_work_id"]
    cast = _named(_merged(people, cat.person_film), cat.person.select("id", F.col("full_name").alias("name")), cat.person_film.select(F.col("person_id").alias("id")))
    kinds = _named(_merged(genres, cat.genre_film), cat.genre.select("id", "name"), cat.genre_film.select(F.col("genre_id").alias("id")))
    member = id_name("id", "name")
    # Films have few links each, so merging before the shuffle would gain nothing.
    cast = cast.repartition(*film_key).groupBy(*film_key).agg(
        *[distinct_sorted(F.when(F.col("role") == role, member)).alias(f) for role, f in ROLE_FIELDS.items()]
    )
    kinds = kinds.repartition(*film_key).groupBy(*film_key).agg(distinct_sorted(member).alias("genres"))
    film = cat.film.select(
        F.col("id").alias("film_work_id"), F.col("rating").alias("imdb_rating"), "title", "description", *extra
    )
    docs = film.join(cast, film_key, "left").join(kinds, film_key, "left")
    docs = docs.withColumns({c: or_empty(F.col(c)) for c in RELATIONS})
    names = [
        F.sort_array(F.array_distinct(F.array_compact(names_of(c)))).alias(f"{c}_names") for c in RELATIONS
    ]
    return docs.select(F.col("film_work_id").alias("id"), "imdb_rating", "title", "description", *names, *RELATIONS, *extra)


def films_with_genre(cat: Catalog, genre: object) -> DataFrame:
    """Films with a genre as ``id``, each once, from the link table alone; no value means no restriction."""
    if genre is None:
        return cat.film.select("id")
    known = cat.genre.filter(F.col("id") == F.lit(genre)).select(F.col("id").alias("genre_id"))
    links = genre_pairs(cat).filter(F.col("genre_id") == F.lit(genre)).join(F.broadcast(known.limit(1)), "genre_id", "left_semi")
    return links.select("id").distinct().join(cat.film.select("id"), "id", "left_semi")


def films_with_person(cat: Catalog, person: object) -> DataFrame:
    """Films with a person in any document role, as ``films_with_genre``."""
    if person is None:
        return cat.film.select("id")
    known = cat.person.filter(F.col("id") == F.lit(person)).select(F.col("id").alias("person_id"))
    links = person_pairs(cat).filter(F.col("person_id") == F.lit(person)).join(F.broadcast(known.limit(1)), "person_id", "left_semi")
    return links.select("id").distinct().join(cat.film.select("id"), "id", "left_semi")


def restrict(cat: Catalog, ids: DataFrame) -> Catalog:
    """The catalogue cut down to the films in ``ids`` (one column, ``id``).

    The cut tables are written to the shared folder: whatever is built from
    them reads a few films' rows, not the whole link tables again.
    """
    wanted = materialise(ids.distinct(), "film-ids")
    of_films = wanted.select(F.col("id").alias("film_work_id"))
    people = skew_join(cat.person_film, of_films, ["film_work_id"], "left_semi", salt_by=["person_id"])
    genres = skew_join(cat.genre_film, of_films, ["film_work_id"], "left_semi", salt_by=["genre_id"])
    return Catalog(
        # Ids are unique on both sides here, so nothing can be hot.
        film=cat.film.join(wanted, "id", "left_semi"),
        person=cat.person,
        genre=cat.genre,
        person_film=materialise(people, "person-links"),
        genre_film=materialise(genres, "genre-links"),
    )


def admin_rows(cat: Catalog) -> DataFrame:
    """Admin listing: film fields with the distinct names of genres and people."""
    docs = film_documents(cat, extra=["creation_date", "type"])
    names = [F.col(f"{c}_names").alias(c) for c in ("genres", "actors", "writers", "directors")]
    return docs.select(
        "id", "title", "description", "creation_date", F.col("imdb_rating").alias("rating"), "type", *names
    )


def genre_pairs(cat: Catalog) -> DataFrame:
    """``(id, genre_id)``: the searchable form of a document's genres; repeats as stored."""
    return cat.genre_film.select(F.col("film_work_id").alias("id"), "genre_id")


def person_pairs(cat: Catalog) -> DataFrame:
    """``(id, person_id)`` over every document role; repeats as stored."""
    links = cat.person_film.filter(F.col("role").isin(*ROLE_FIELDS))
    return links.select(F.col("film_work_id").alias("id"), "person_id")
