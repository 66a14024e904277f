"""Listing, lookup, page and search queries over film, genre and person documents.

Each takes a request table and answers all requests in one job. ``request_id``
is carried through; page requests add ``page_number`` and ``page_size``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.catalog import Catalog
from filmloom.operators.filters import lookup
from filmloom.operators.paging import envelope, page, pages_for, result_order
from filmloom.operators.projections import full_film, partial_film, partial_genre, partial_person
from filmloom.operators.index import Index
from filmloom.operators.search import query_key, scores_of, top_scores
from filmloom.operators.skew import skew_join
from filmloom.plans.documents import admin_rows, genre_pairs, person_pairs, restrict
from filmloom.session import materialise

DEFAULT_SORT = "imdb_rating"
# Fields a listing can be sorted by, and the columns that hold them.
SORT_FIELDS = {"id": "id", "imdb_rating": "imdb_rating", "title.raw": "title", "genres_names": "genres_names"}


def sort_column(sort: str) -> str:
    """A sort request by field as one by column, its sign kept."""
    field = sort.removeprefix("-")
    if field not in SORT_FIELDS:
        raise ValueError(f"a listing can't be sorted by {field!r}; fields: {', '.join(SORT_FIELDS)}")
    return sort[: len(sort) - len(field)] + SORT_FIELDS[field]


def listing_fields(film: DataFrame) -> DataFrame:
    """The listing part of a film document, straight from the film table."""
    return film.select("id", "title", F.col("rating").alias("imdb_rating"))


def with_links(films: DataFrame, links: DataFrame) -> DataFrame:
    """Films repeated for each link key; ``links`` is a scan of ``(id, key)``, repeats allowed."""
    vary = [c for c in links.columns if c != "id"]
    return skew_join(links.distinct(), films, ["id"], "inner", salt_by=vary, measure=links.select("id"))


def _with_genre_name(films: DataFrame, links: DataFrame, genres: DataFrame, falling: bool) -> DataFrame:
    """Films with the genre name they sort by: the last of them in a falling order, the first in a rising one."""
    named = skew_join(links.distinct(), genres.select(F.col("id").alias("genre_id"), "name"), ["genre_id"], "inner", salt_by=["id"], measure=links.select("genre_id"))
    name = (F.max if falling else F.min)("name").alias("genres_names")
    return films.join(named.groupBy("id").agg(name), "id", "left")


def film_list(requests: DataFrame, film: DataFrame, links: DataFrame, sort: str = DEFAULT_SORT, genres: DataFrame | None = None) -> DataFrame:
    """Pages of films, of one genre where ``genre_id`` is given, of all where it is null.

    ``genres`` (id, name) is needed to sort by ``genres_names``.
    """
    films, column = listing_fields(film), sort_column(sort)
    if column.removeprefix("-") == "genres_names":
        films = _with_genre_name(films, links, genres, falling=not column.startswith("-"))
    order = result_order(column)
    some = requests.filter(F.col("genre_id").isNotNull())
    pages = pages_for(some, with_links(films, links), order, ["genre_id"]).drop("genre_id")
    every = pages_for(requests.filter(F.col("genre_id").isNull()).drop("genre_id"), films, order)
    return partial_film(pages.unionByName(every.select(*pages.columns)), "request_id", "place")


def films_of_key(requests: DataFrame, film: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Pages of the films of a genre or person, lowest rating first."""
    films = with_links(listing_fields(film), links)
    return partial_film(pages_for(requests, films, result_order("-imdb_rating"), [key]), "request_id", "place")


def films_of_genre(requests: DataFrame, cat: Catalog) -> DataFrame:
    return films_of_key(requests, cat.film, genre_pairs(cat), "genre_id")


def films_of_person(requests: DataFrame, cat: Catalog) -> DataFrame:
    return films_of_key(requests, cat.film, person_pairs(cat), "person_id")


def film_details(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """Full films by id; an unknown id has ``found`` false and no film."""
    return full_film(lookup(requests, documents), "request_id", "found")


def genre_details(requests: DataFrame, genres: DataFrame) -> DataFrame:
    return partial_genre(lookup(requests, genres), "request_id", "found")


def person_details(requests: DataFrame, persons: DataFrame) -> DataFrame:
    return partial_person(lookup(requests, persons), "request_id", "found")


def genre_list(requests: DataFrame, genres: DataFrame) -> DataFrame:
    return partial_genre(pages_for(requests, genres, result_order()), "request_id", "place")


def person_list(requests: DataFrame, persons: DataFrame) -> DataFrame:
    return partial_person(pages_for(requests, persons, result_order()), "request_id", "place")


def film_search(requests: DataFrame, films: DataFrame, index: Index | None, links: DataFrame) -> DataFrame:
    """Pages of films by relevance: ``query`` and ``genre_id`` restrict where given.

    Distinct (query, genre) pairs are answered once. Without a query every film
    matches alike, so the order is by id; ``index`` may be None if no request has
    a query. Scores are never written: the best of each search are kept by every
    task before they are shuffled.
    """
    requests = requests.withColumn("query_key", query_key())
    untexted = requests.filter(F.col("query").isNull()).drop("query", "query_key")
    listed = pages_for(untexted.filter(F.col("genre_id").isNotNull()), links.distinct(), result_order(), ["genre_id"])
    every = pages_for(untexted.filter(F.col("genre_id").isNull()).drop("genre_id"), films.select("id"), result_order())
    columns = ["request_id", "place", "id"]
    hits = listed.select(*columns).unionByName(every.select(*columns))
    if index is not None:
        hits = hits.unionByName(_searched(requests.filter(F.col("query").isNotNull()), index, links).select(*columns))
    return partial_film(_filled(hits, films), "request_id", "place")


def _wanted(requests: DataFrame) -> DataFrame:
    """``query, k``: how many documents of each query the pages reach."""
    return requests.select("query", (F.col("page_number") * F.col("page_size")).alias("k"))


def _searched(requests: DataFrame, index: Index, links: DataFrame) -> DataFrame:
    within, plain = requests.filter(F.col("genre_id").isNotNull()), requests.filter(F.col("genre_id").isNull())
    pairs = materialise(within.select("query_key", "genre_id").distinct(), "query-genres")
    matched = top_scores(_wanted(plain), index).select("query_key", "doc", F.lit(None).cast(links.schema["genre_id"].dataType).alias("genre_id"), "score")
    if not pairs.isEmpty():
        # The films of the genres asked for, with the queries that ask: a genre that many queries ask for is salted by its films.
        asked = skew_join(links.distinct(), pairs, ["genre_id"], "inner", salt_by=["id"], measure=links.select("genre_id"))
        asked = materialise(asked.withColumnRenamed("id", "doc"), "genre-films")
        # Only these films are scored. One row for each query and film on either side, so nothing is hot here.
        by_genre = scores_of(asked, within, index).join(asked, ["query_key", "doc"])
        matched = matched.unionByName(by_genre)
    # A search without a genre is a group of its own.
    group = F.concat("query_key", F.lit("/"), F.coalesce(F.col("genre_id").cast("string"), F.lit("*")))
    wanted = requests.select("request_id", group.alias("search"), "page_number", "page_size")
    return pages_for(wanted, matched.select(group.alias("search"), F.col("doc").alias("id"), "score"), result_order(score="score"), ["search"])


def _filled(hits: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the hits; one row may be a hit of very many requests."""
    return skew_join(materialise(hits, "hits"), rows, ["id"], "inner", salt_by=["request_id"])


def person_search(requests: DataFrame, persons: DataFrame, index: Index) -> DataFrame:
    """Pages of people whose name shares a term with ``query``."""
    asked = requests.withColumn("query_key", query_key()).drop("query")
    scored = top_scores(_wanted(requests), index).withColumnRenamed("doc", "id")
    hits = pages_for(asked, scored, result_order(score="score"), ["query_key"]).select("request_id", "place", "id")
    return partial_person(_filled(hits, persons), "request_id", "place")


def admin_list(cat: Catalog, number: int = 1, size: int = 50) -> DataFrame:
    """One admin page: the page is cut first, relations are built for its films only."""
    ids = page(cat.film.select("id"), result_order(), number, size)
    return admin_rows(restrict(cat, ids))


def admin_envelope(cat: Catalog, page_name: str | int = 1, size: int = 50) -> DataFrame:
    return envelope(cat.film, page_name, size)


def admin_details(requests: DataFrame, cat: Catalog) -> DataFrame:
    """Admin rows by id, built for the requested films only."""
    rows = admin_rows(restrict(cat, requests.select("id").distinct()))
    return lookup(requests, rows)
