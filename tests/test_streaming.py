"""Streams: first-seen ids over batches, replay after failure, batch size."""

from dataclasses import replace

import pytest
from golden import FILM_PEOPLE, FILMS, GENRE, PEOPLE, PERSON, films_of_genre, films_of_person, golden_catalog
from pyspark.sql import functions as F

from filmloom.catalog import FILM_DOCUMENT, Catalog
from filmloom.plans.documents import film_documents
from filmloom.plans.refresh import Marks, StoredCatalog, affected_films, films_of, next_mark, refresh_from_state, refresh_links
from filmloom.sources.documents import DocumentTable
from filmloom.sources.state import read_state
from filmloom.streaming import changes

DDL = "entity string, id string, seq int"


def log_file(spark, folder, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(f"{folder}/log")


def test_ids_are_seen_once_over_runs(spark, folder):
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    for batch in ([("film", "a", i) for i in range(40)], [("film", "a", 99), ("film", "b", 100)]):
        log_file(spark, folder, batch)
        stream = changes.read_changes(spark, f"{folder}/log", DDL, files_per_batch=1)
        changes.run_to_files(changes.first_seen(stream, "id", "seq", salts=4).select("id"), out, checkpoint)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_refresh_survives_a_lost_batch(spark, folder):
    cat = golden_catalog(spark)
    table = DocumentTable(spark, f"{folder}/docs", FILM_DOCUMENT, buckets=4)
    table.append(film_documents(cat).withColumn("title", F.lit("stale")))
    log_file(spark, folder, [("genre", GENRE, 1), ("film", "f00", 2), ("film", "no such film", 3)])
    stream = changes.read_changes(spark, f"{folder}/log", DDL)
    sink, calls = changes.refresh_sink(StoredCatalog.write(cat, f"{folder}/links", 4), table), []

    def failing(batch, number):
        calls.append(number)
        sink(batch, number)
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        changes.run_batches(stream, failing, f"{folder}/checkpoint")
    changes.run_batches(stream, sink, f"{folder}/checkpoint")
    changes.run_batches(stream, sink, f"{folder}/checkpoint")
    titles = {r["id"]: r["title"] for r in table.read().collect()}
    assert set(titles) == set(FILMS) and {i for i, t in titles.items() if t != "stale"} == films_of_genre(GENRE) | {"f00"}
    assert calls == [0]


def test_an_append_that_comes_again_keeps_each_row_once(spark, folder):
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    sink = changes.append_sink(out)

    def failing(batch, number):
        sink(batch, number)
        raise RuntimeError("lost")

    for part in range(3):
        log_file(spark, folder, [("film", f"x{part}-{i}", i) for i in range(10)])
        stream = changes.read_changes(spark, f"{folder}/log", DDL)
        with pytest.raises(Exception, match="lost"):
            changes.run_batches(stream, failing, checkpoint)
        changes.run_batches(stream, sink, checkpoint)
    rows = [r["id"] for r in spark.read.parquet(out).collect()]
    assert len(rows) == len(set(rows)) == 30


LINK = "op string, seq int, film_work_id string, person_id string, role string"


def _documents_of(cat):
    return sorted(map(repr, film_documents(cat).collect()))


def _link_log():
    """Links that come, go, move and come back, one of them twice; and the links that should be left."""
    held = set(FILM_PEOPLE)
    first, second, third = FILM_PEOPLE[0], FILM_PEOPLE[7], FILM_PEOPLE[12]
    unused = next(f for f in FILMS if f not in {x for x, _, _ in FILM_PEOPLE})
    moved, fresh = (unused, *second[1:]), (unused, PEOPLE[0][0], "writer")
    log = [("delete", 1, *first), ("delete", 1, *second), ("insert", 2, *moved), ("insert", 1, *fresh), ("insert", 1, *fresh),
           ("delete", 1, *third), ("insert", 2, *third), ("delete", 3, "f02", "nobody", "actor")]
    return log, (held - {first, second}) | {moved, fresh}


@pytest.mark.parametrize("fails", [False, True])
def test_changes_of_links_reach_the_documents(spark, folder, fails):
    cat, (log, left) = golden_catalog(spark), _link_log()
    stored, table = StoredCatalog.write(cat, f"{folder}/links", 4), DocumentTable(spark, f"{folder}/docs", FILM_DOCUMENT, buckets=4)
    table.append(film_documents(cat))
    changed = spark.createDataFrame(log, LINK)
    if fails:
        # Only the links by film are written; the log then comes again as a whole.
        stored.person.by_film.replace(changed.drop("op", "seq"), changed.filter("op = 'insert'").drop("op", "seq").distinct(), ["film_work_id", "person_id", "role"])
    films = {r["id"] for r in refresh_links(stored, table, person=changed).collect()}
    assert films == {row[2] for row in log}
    after = replace(cat, person_film=spark.createDataFrame(sorted(left), "film_work_id string, person_id string, role string"))
    for kept in (stored.person.by_film, stored.person.by_member):
        assert sorted(map(tuple, kept.read().collect())) == sorted(left)
    assert sorted(map(repr, table.read().select(*film_documents(cat).columns).collect())) == _documents_of(after)
    # A person that is renamed now reaches the films of the new links.
    _, near = stored.around({"person": spark.createDataFrame([(PEOPLE[0][0],)], "id string")})
    assert {r["id"] for r in near.collect()} == {f for f, p, _ in left if p == PEOPLE[0][0]}


def test_changes_of_genres_as_links(spark, folder):
    cat = golden_catalog(spark)
    stored, table = StoredCatalog.write(cat, f"{folder}/links", 4), DocumentTable(spark, f"{folder}/docs", FILM_DOCUMENT, buckets=4)
    table.append(film_documents(cat))
    gone = cat.genre_film.filter(F.col("genre_id") == GENRE).select(F.lit("delete").alias("op"), F.lit(1).alias("seq"), "*")
    refresh_links(stored, table, genre=gone)
    after = replace(cat, genre_film=cat.genre_film.filter(F.col("genre_id") != GENRE))
    assert sorted(map(repr, table.read().select(*film_documents(cat).columns).collect())) == _documents_of(after)


def test_affected_films(spark):
    cat = golden_catalog(spark)
    people = spark.createDataFrame([(PERSON,), ("nobody",)], "id string")
    assert {r["id"] for r in films_of(cat.person_film, "person_id", people).collect()} == films_of_person(PERSON)
    assert films_of(cat.person_film, "person_id", people.limit(0)).count() == 0
    old, new = "timestamp'2020-01-01'", "timestamp'2020-01-03'"
    stamped = lambda df, ids: df.withColumn("modified", F.expr(f"CASE WHEN id IN ({ids}) THEN {new} ELSE {old} END"))
    moved = type(cat)(
        film=stamped(cat.film, "'f00'"), person=stamped(cat.person, "''"),
        genre=stamped(cat.genre, f"'{GENRE}'"), person_film=cat.person_film, genre_film=cat.genre_film,
    )
    mark = F.lit("2020-01-02").cast("timestamp")
    got = {r["id"] for r in affected_films(moved, Marks(mark, mark, mark)).collect()}
    assert got == films_of_genre(GENRE) | {"f00"}
    assert [r["last_id"] for r in next_mark(moved.genre, mark, "genre").collect()] == [GENRE]
    assert next_mark(moved.person, mark, "person").count() == 0


@pytest.mark.parametrize("stored", [False, True])
def test_a_late_row_at_the_mark_is_refreshed(spark, folder, stored):
    cat = golden_catalog(spark)
    day = "timestamp'2020-01-03'"
    stamped = lambda df: df.withColumn("modified", F.expr(day))
    full = Catalog(film=stamped(cat.film), person=stamped(cat.person), genre=stamped(cat.genre), person_film=cat.person_film, genre_film=cat.genre_film)
    early = replace(full, film=full.film.filter("id <> 'f01'"))
    wrapped = (lambda c, n: StoredCatalog.write(c, f"{folder}/links-{n}", 4)) if stored else (lambda c, n: c)
    table, state = DocumentTable(spark, f"{folder}/docs", FILM_DOCUMENT, buckets=4), f"{folder}/marks"
    refresh_from_state(wrapped(early, 1), state, table)
    assert sorted(r["id"] for r in table.read().collect()) == sorted(set(FILMS) - {"f01"})
    marks = {r["name"]: str(r["mark"]) for r in read_state(spark, state).collect()}
    assert marks == dict.fromkeys(("film", "person", "genre"), "2020-01-03 00:00:00")

    class Lost(DocumentTable):
        def upsert(self, *args, **kwargs):
            raise RuntimeError("lost")

    late = replace(full, film=full.film.withColumn("modified", F.expr("CASE WHEN id = 'f02' THEN timestamp'2020-01-05' ELSE modified END")))
    with pytest.raises(RuntimeError, match="lost"):
        refresh_from_state(wrapped(late, 2), state, Lost(spark, table.path, FILM_DOCUMENT, buckets=4))
    assert {r["name"]: str(r["mark"]) for r in read_state(spark, state).collect()} == marks  # a failed run moves no mark
    refresh_from_state(wrapped(late, 3), state, table)
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, film_documents(late).select(*table.read().columns).collect()))
    assert str(read_state(spark, state).filter("name = 'film'").first()["mark"]) == "2020-01-05 00:00:00"


def test_the_part_around_changes_holds_its_films_alone(spark, folder):
    stored = StoredCatalog.write(golden_catalog(spark), f"{folder}/links", 4)
    near, films = stored.around({"person": spark.createDataFrame([(PERSON,)], "id string")})
    ids = {r["id"] for r in films.collect()}
    assert ids and {r["id"] for r in near.film.collect()} == ids == {r["id"] for r in film_documents(near).collect()}
