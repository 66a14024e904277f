"""A small catalogue drawn from a seed. What tests expect of it is computed from these rows."""

import random

from filmloom.catalog import Catalog

_rng = random.Random(71)
_ROLES = ("actor", "director", "writer")

GENRES = [(f"g{i}", name) for i, name in enumerate(("western", "heist", "essay film", "opera", "noir"), 1)]
PEOPLE = [(f"p{i:02}", f"{_rng.choice(('Ada', 'Bo', 'Cleo', 'Dag'))} {last}_{i}") for i, last in enumerate(("Quill", "Rask", "Stroud", "Tamm") * 3 + ("Ulm",))]

# id, title, description, type, creation date, rating, modified. Some share a rating, one has none.
FILM_ROWS = [
    (f"f{i:02}", f"{_rng.choice(('Harbour', 'Quarry', 'Orchard'))} {_rng.choice(('night', 'ledger', 'bell'))}", _rng.choice((None, "shot on location")),
     _rng.choice(("movie", "tv_show")), None, None if i == 4 else _rng.randint(8, 20) / 2, None)
    for i in range(11)
]
FILMS = {row[0]: row for row in FILM_ROWS}

# One film has no genre, one nobody; a person may hold several roles in a film.
FILM_GENRES = [(film, g) for film in list(FILMS)[1:] for g, _ in _rng.sample(GENRES, _rng.randint(1, 3))]
FILM_PEOPLE = sorted({(film, _rng.choice(PEOPLE)[0], _rng.choice(_ROLES)) for film in list(FILMS)[:-1] for _ in range(_rng.randint(3, 9))})


def films_of_genre(genre: str) -> set[str]:
    return {f for f, g in FILM_GENRES if g == genre}


def films_of_person(person: str) -> set[str]:
    return {f for f, p, _ in FILM_PEOPLE if p == person}


#: The genre and the person of most films.
GENRE = max((g for g, _ in GENRES), key=lambda g: (len(films_of_genre(g)), g))
PERSON = max((p for p, _ in PEOPLE), key=lambda p: (len(films_of_person(p)), p))


def golden_catalog(spark) -> Catalog:
    film = "id string, title string, description string, type string, creation_date timestamp, rating double, modified timestamp"
    return Catalog(
        film=spark.createDataFrame(FILM_ROWS, film),
        person=spark.createDataFrame(PEOPLE, "id string, full_name string"),
        genre=spark.createDataFrame(GENRES, "id string, name string"),
        person_film=spark.createDataFrame(FILM_PEOPLE, "film_work_id string, person_id string, role string"),
        genre_film=spark.createDataFrame(FILM_GENRES, "film_work_id string, genre_id string"),
    )


def empty_catalog(cat: Catalog) -> Catalog:
    return Catalog(*[getattr(cat, f).limit(0) for f in ("film", "person", "genre", "person_film", "genre_film")])
