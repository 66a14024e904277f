"""Listing, lookup and search over the small catalogue."""

from itertools import chain

import pytest
from golden import FILM_GENRES, FILM_PEOPLE, FILMS, GENRE, GENRES, PEOPLE, PERSON, empty_catalog, films_of_genre, films_of_person, golden_catalog

from filmloom.catalog import FILM_DOCUMENT, ROLE_FIELDS
from filmloom.operators.aggregates import genre_documents, roles_of_persons
from filmloom.operators.checks import conform
from filmloom.operators.index import FILM_FIELDS, PERSON_FIELDS, build_index
from filmloom.plans import requests as req
from filmloom.plans.documents import film_documents, genre_pairs

NAMES, KINDS = dict(PEOPLE), dict(GENRES)


@pytest.fixture(scope="module")
def cat(spark):
    return golden_catalog(spark)


@pytest.fixture(scope="module")
def docs(cat):
    return film_documents(cat)


@pytest.fixture(scope="module")
def index(docs):
    return build_index(docs, FILM_FIELDS)


@pytest.fixture(scope="module")
def persons(cat):
    return roles_of_persons(cat.person, cat.person_film)


@pytest.fixture(scope="module")
def names(persons):
    return build_index(persons, PERSON_FIELDS)


def ask(spark, number=1, size=50, **params):
    ddl = ", ".join(["request_id int", *[f"{k} string" for k in params], "page_number int", "page_size int"])
    return spark.createDataFrame([(1, *params.values(), number, size)], ddl)


def uuids(df):
    return [r["uuid"] for r in df.orderBy("place").collect()]


def by_rating(films, falling=True):
    """Films by rating, those without one last, then by id."""
    rating = lambda f: FILMS[f][5] or 0
    return sorted(films, key=lambda f: (FILMS[f][5] is None, -rating(f) if falling else rating(f), f))


def pages(rows, size):
    """Numbered pages of the rows, and an empty one behind them."""
    return [(n + 1, rows[n * size : (n + 1) * size]) for n in range(len(rows) // size + 2)]


def test_the_catalogue_holds_the_cases(cat):
    assert len({f for f, _ in FILM_GENRES}) == len({f for f, _, _ in FILM_PEOPLE}) == len(FILMS) - 1
    assert any(len({r for f, p, r in FILM_PEOPLE if (f, p) == pair}) > 1 for pair in {(f, p) for f, p, _ in FILM_PEOPLE})
    ratings = [row[5] for row in FILMS.values()]
    assert None in ratings and len(set(ratings)) < len(ratings)


def test_documents_hold_the_members_of_each_film(docs):
    rows = conform(docs, FILM_DOCUMENT).collect()
    assert sorted(r["id"] for r in rows) == sorted(FILMS)
    for r in rows:
        kinds = {g for f, g in FILM_GENRES if f == r["id"]}
        assert {(g["id"], g["name"]) for g in r["genres"]} == {(g, KINDS[g]) for g in kinds} and r["genres_names"] == sorted(KINDS[g] for g in kinds)
        for role, field in ROLE_FIELDS.items():
            cast = {p for f, p, held in FILM_PEOPLE if (f, held) == (r["id"], role)}
            assert {(p["id"], p["name"]) for p in r[field]} == {(p, NAMES[p]) for p in cast}
        assert (r["title"], r["description"], r["imdb_rating"]) == (FILMS[r["id"]][1], FILMS[r["id"]][2], FILMS[r["id"]][5])


@pytest.mark.parametrize(("number", "expected"), pages(by_rating(FILMS), 4))
def test_film_pages(spark, cat, number, expected):
    assert uuids(req.film_list(ask(spark, number, 4, genre_id=None), cat.film, genre_pairs(cat))) == expected


@pytest.mark.parametrize(("number", "expected"), pages(by_rating(films_of_genre(GENRE), falling=False), 2))
def test_genre_films_rise_by_rating(spark, cat, number, expected):
    assert uuids(req.films_of_genre(ask(spark, number, 2, genre_id=GENRE), cat)) == expected


@pytest.mark.parametrize(("number", "expected"), pages(by_rating(films_of_person(PERSON), falling=False), 3))
def test_person_films_come_once(spark, cat, number, expected):
    assert uuids(req.films_of_person(ask(spark, number, 3, person_id=PERSON), cat)) == expected


@pytest.mark.parametrize(("number", "expected"), pages(sorted(KINDS), 3))
def test_genre_pages(spark, cat, number, expected):
    assert uuids(req.genre_list(ask(spark, number, 3), genre_documents(cat.genre))) == expected


@pytest.mark.parametrize(("number", "expected"), pages(sorted(NAMES), 9))
def test_person_pages(spark, persons, number, expected):
    assert uuids(req.person_list(ask(spark, number, 9), persons)) == expected


@pytest.mark.parametrize("word", ["Harbour", "night"])
def test_search_in_genre_by_pages(spark, cat, docs, index, word):
    expected = {f for f in films_of_genre(GENRE) if word in FILMS[f][1].split()}
    search = lambda n, size: uuids(req.film_search(ask(spark, n, size, query=word, genre_id=GENRE), docs, index, genre_pairs(cat)))
    whole = search(1, 50)
    assert set(whole) == expected and len(whole) == len(expected)
    assert list(chain.from_iterable(search(n, 2) for n in (1, 2))) == whole[:4]


def _matching():
    """Texts, and the films that hold them in some field."""
    person = FILM_PEOPLE[0][1]
    word = NAMES[person].split()[1]
    rating = next(row[5] for row in FILMS.values() if row[5])
    kind = KINDS[GENRE]
    return [
        ("harbour", {f for f in FILMS if "Harbour" in FILMS[f][1]}),
        (next(iter(FILMS)), {next(iter(FILMS))}),
        (str(rating), {f for f in FILMS if FILMS[f][5] == rating}),
        (kind, films_of_genre(GENRE)),
        (word, films_of_person(person)),
        ("location", {f for f in FILMS if FILMS[f][2]}),
        ("nothing like it in there", set()),
    ]


@pytest.mark.parametrize(("text", "expected"), _matching())
def test_search_reads_every_field(spark, cat, docs, index, text, expected):
    found = uuids(req.film_search(ask(spark, query=text, genre_id=None), docs, index, genre_pairs(cat)))
    assert set(found) == expected and len(found) == len(expected)


def test_the_whole_title_comes_first(spark, cat, docs, index):
    title = FILMS["f05"][1]
    found = uuids(req.film_search(ask(spark, query=title, genre_id=None), docs, index, genre_pairs(cat)))
    same = sorted(f for f in FILMS if FILMS[f][1] == title)
    assert found[: len(same)] == same


def test_search_without_text_lists_by_id(spark, cat, docs, index):
    request = ask(spark, query=None, genre_id=None)
    assert uuids(req.film_search(request, docs, index, genre_pairs(cat))) == sorted(FILMS)


@pytest.mark.parametrize("word", ["Ada", "bo"])
def test_person_search(spark, persons, names, word):
    expected = sorted(p for p, name in PEOPLE if name.split()[0].lower() == word.lower())
    assert uuids(req.person_search(ask(spark, query=word), persons, names)) == expected
    assert uuids(req.person_search(ask(spark, 2, 2, query=word), persons, names)) == expected[2:4]


def test_person_search_keeps_underscores_in_terms(spark, persons, names):
    assert uuids(req.person_search(ask(spark, query="quill_99"), persons, names)) == []
    assert uuids(req.person_search(ask(spark, query=PEOPLE[3][1].split()[1]), persons, names)) == [PEOPLE[3][0]]


def test_lookups(spark, cat, docs, persons):
    requests = spark.createDataFrame([(1, "f01"), (2, "no such film")], "request_id int, id string")
    films = {r["request_id"]: r for r in req.film_details(requests, docs).collect()}
    assert films[1]["title"] == FILMS["f01"][1] and films[1]["found"] and len(films[1]["genres"]) == len([1 for f, _ in FILM_GENRES if f == "f01"])
    assert not films[2]["found"] and films[2]["title"] is None
    genres = req.genre_details(spark.createDataFrame([(1, GENRE)], "request_id int, id string"), genre_documents(cat.genre))
    assert [tuple(r) for r in genres.collect()] == [(1, True, GENRE, KINDS[GENRE])]
    people = req.person_details(spark.createDataFrame([(1, PERSON)], "request_id int, id string"), persons)
    assert people.first()["full_name"] == NAMES[PERSON]


def test_roles_of_persons(persons):
    roles = {r["id"]: r["roles"] for r in persons.collect()}
    assert {p: set(held or []) for p, held in roles.items()} == {p: {r for _, q, r in FILM_PEOPLE if q == p} for p in NAMES}


def test_empty_store(spark, cat):
    none = empty_catalog(cat)
    docs = film_documents(none)
    assert docs.count() == 0
    assert uuids(req.film_list(ask(spark, 1, 1000, genre_id=None), none.film, genre_pairs(none))) == []
    assert uuids(req.film_list(ask(spark, 2, 1000, genre_id=None), none.film, genre_pairs(none))) == []
    assert uuids(req.genre_list(ask(spark), genre_documents(none.genre))) == []
    assert uuids(req.person_list(ask(spark), roles_of_persons(none.person, none.person_film))) == []
    assert uuids(req.film_search(ask(spark, query="harbour", genre_id=None), docs, build_index(docs, FILM_FIELDS), genre_pairs(none))) == []
    assert req.admin_envelope(none).first().asDict() == {"count": 0, "total_pages": 1, "prev": None, "next": None, "page": 1}
