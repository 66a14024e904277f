"""Hot keys: same results with and without salting, one document for each film."""

import pytest
from pyspark.sql import functions as F

from filmloom.catalog import Catalog, document_ddl
from filmloom.operators.skew import fits_broadcast, heavy_keys, matching, salted_join, skew_join
from filmloom.plans import documents
from filmloom.plans.documents import film_documents, films_with_genre, films_with_person
from filmloom.plans.joins import presence
from filmloom.plans.requests import film_details
from filmloom.sources.documents import DocumentTable

FIELDS = ("genres", "actors", "directors", "writers")


@pytest.fixture(scope="module")
def facts(spark):
    rows = [(1 if i % 3 == 0 else i % 50, i) for i in range(900)] + [(None, 900 + i) for i in range(300)]
    return spark.createDataFrame(rows, "k int, v int")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(i, f"n{i}") for i in range(0, 60, 2)] + [(1, "a"), (1, "b")], "k int, name string")


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salting_changes_nothing(facts, dim, how):
    hot = heavy_keys(facts, ["k"], floor=50)
    assert {r["k"] for r in hot.collect()} == {1, None}
    assert rows(salted_join(facts, dim, ["k"], hot, how, ["v"], floor=50)) == rows(facts.join(dim, "k", how))
    assert rows(skew_join(facts, dim, ["k"], how, ["v"], floor=50)) == rows(facts.join(dim, "k", how))


def test_a_hot_group_is_divided(facts, dim):
    hot = heavy_keys(facts, ["k"], floor=50)
    joined = salted_join(facts, dim, ["k"], hot, "inner", ["v"], floor=50)
    plan = joined._jdf.queryExecution().toString()
    assert "_salt" in plan and "CartesianProduct" not in plan


def test_the_preserved_side_must_be_the_facts(facts, dim):
    with pytest.raises(ValueError):
        salted_join(facts, dim, ["k"], None, "full")


def test_broadcast_needs_few_rows_and_bytes(spark):
    assert fits_broadcast(spark.range(10), max_rows=10)
    assert not fits_broadcast(spark.range(11), max_rows=10)
    wide = spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1_000))
    assert not fits_broadcast(wide, max_bytes=5_000)


def test_empty_key_list_matches_nothing(facts, dim):
    assert matching(facts, dim.limit(0), ["k"]).count() == 0


@pytest.fixture(scope="module")
def hot_film(spark):
    """Film 1 has most links, many of them copies; film 3 has none; link 99 has no film."""
    people = [(1, p % 120, ("actor", "writer", "director")[p % 3]) for p in range(600)]
    people += [(2, 5, "actor"), (2, 5, "actor"), (2, 7, None), (99, 1, "actor"), (2, 999, "actor")]
    genres = [(1, g % 40) for g in range(200)] + [(2, 3), (99, 3)]
    return Catalog(
        film=spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "id int, title string, rating double")
        .withColumn("description", F.lit(None).cast("string")),
        person=spark.createDataFrame([(i, f"p{i % 60}") for i in range(120)], "id int, full_name string"),
        genre=spark.createDataFrame([(i, f"g{i}") for i in range(40)], "id int, name string"),
        person_film=spark.createDataFrame(people, "film_work_id int, person_id int, role string"),
        genre_film=spark.createDataFrame(genres, "film_work_id int, genre_id int"),
    )


def test_a_document_is_one_row_at_every_size(spark, folder, hot_film, monkeypatch):
    whole = sorted(map(tuple, film_documents(hot_film).collect()))
    assert [r[0] for r in whole] == [1, 2, 3]
    details = sorted(map(tuple, film_details(spark.createDataFrame([(1, 1), (2, 1), (3, 9)], "request_id int, id int"), film_documents(hot_film)).collect()))
    for limit in (4, 150):  # far below the links of film 1
        monkeypatch.setattr(documents, "HOT_ROWS", limit)
        docs = film_documents(hot_film)
        assert sorted(map(tuple, docs.collect())) == whole
        requests = spark.createDataFrame([(1, 1), (2, 1), (3, 9)], "request_id int, id int")
        assert sorted(map(tuple, film_details(requests, docs).collect())) == details
        assert [r["id"] for r in films_with_person(hot_film, 3).collect()] == [1] and films_with_person(hot_film, 999).count() == 0
        assert sorted(r["id"] for r in films_with_genre(hot_film, 3).collect()) == [1, 2]
        table = DocumentTable(spark, f"{folder}/docs-{limit}", document_ddl("int"), buckets=2)
        table.insert(docs)
        table.upsert(docs)
        assert sorted(map(tuple, table.read().select(*docs.columns).collect())) == whole


def test_many_hot_keys_are_all_found(spark):
    rows = spark.range(3000).select((F.col("id") % 300).alias("k"))
    hot = heavy_keys(rows, ["k"], floor=5)
    assert hot.count() == 300  # the threshold doesn't rise with the table
    dim = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = salted_join(rows.withColumn("u", F.rand(1)), dim, ["k"], hot, "inner", floor=5)
    assert joined.count() == 3000 and joined.filter("v <> 2 * k").count() == 0


@pytest.mark.parametrize("n", [0, 1, 3])
def test_presence_is_a_full_join(spark, n):
    source = spark.createDataFrame([(1,), (1,), (2,), (None,)] * n, "k int")
    target = spark.createDataFrame([(1,), (3,), (None,), (None,)], "k int")
    want = source.select("k", F.lit(1).alias("s")).join(target.select("k", F.lit(1).alias("t")), "k", "full")
    side = F.when(F.col("t").isNull(), "source only").when(F.col("s").isNull(), "target only").otherwise("both")
    assert sorted(map(repr, presence(source, target, "k").collect())) == sorted(map(repr, want.select("k", side.alias("side")).collect()))


def test_documents_of_films_with_gaps(hot_film):
    docs = {r["id"]: r for r in film_documents(hot_film).collect()}
    assert set(docs) == {1, 2, 3}
    assert docs[2]["actors_names"] == ["p5"] and docs[2]["writers"] == [] and docs[2]["imdb_rating"] is None
    assert all(docs[3][f] == [] and docs[3][f"{f}_names"] == [] for f in FIELDS)
    # 40 ids in the role, but people 60 apart share a name: names are distinct, objects are not.
    assert len(docs[1]["actors"]) == 40 and len(docs[1]["actors_names"]) == 20
