"""Document table, bootstrap, work-sets, marks, and the file and database connectors."""

import datetime as dt
import os
import time
from unittest import mock

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom import session
from filmloom.catalog import FILM_DOCUMENT, PERSON_DOCUMENT, TABLES
from filmloom.functions import scalar
from filmloom.operators import checks
from filmloom.sources import documents
from filmloom.sources.documents import DocumentTable
from filmloom.sources.jdbc import JdbcSource
from filmloom.sources.load import bootstrap, published
from filmloom.sources.state import add_to_ids, mark_of, read_ids, read_state, write_state


def held(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def table(spark, folder):
    return DocumentTable(spark, f"{folder}/t", "id bigint, name string", buckets=4)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, name string")


def test_table_life(spark, table):
    assert table.read().count() == 0
    table.append(frame(spark, (1, "a"), (2, "b"), (3, "c")))
    change = frame(spark, (2, "B"), (4, "d"))
    table.upsert(change)
    once = held(table.read())
    table.upsert(change)
    assert held(table.read()) == once == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    table.delete(F.col("name") == "a")
    assert held(table.read()) == [(2, "B"), (3, "c"), (4, "d")]
    table.delete(F.col("id") > 0)
    assert table.read().count() == 0
    table.upsert(frame(spark, (5, "e")))
    table.truncate()
    assert table.read().count() == 0
    table.append(frame(spark, (9, None)))
    table.delete(F.col("name") == "a")
    assert held(table.read()) == [(9, None)]


def test_files_hold_a_bounded_number_of_rows(spark, folder):
    table = DocumentTable(spark, f"{folder}/t", "id bigint", buckets=2, rows_per_file=7)
    table.append(spark.range(100))
    sizes = spark.read.parquet(f"{folder}/t").groupBy(F.input_file_name()).count().select("count").collect()
    assert sum(r[0] for r in sizes) == 100 and max(r[0] for r in sizes) <= 7


def files_of(spark, table):
    """Names and times of the files of each folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table.path).select("path", "modificationTime").collect()
    folders = {}
    for r in found:
        folders.setdefault(r["path"].rsplit("/", 2)[1], set()).add(tuple(r))
    return folders


def test_an_empty_upsert_writes_nothing(spark, table):
    table.append(frame(spark, (1, "a")))
    before = files_of(spark, table)
    table.upsert(frame(spark).limit(0))
    assert files_of(spark, table) == before


def test_the_highest_row_of_an_id_wins(spark, table):
    rows = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)], "id bigint, name string, at int")
    table.upsert(rows, order="at")
    assert held(table.read()) == [(1, "new"), (2, "x")]


def test_insert_refuses_known_and_repeated_ids(spark, table):
    table.insert(frame(spark, (1, "a")))
    with pytest.raises(ValueError, match="existing id"):
        table.insert(frame(spark, (1, "b")))
    with pytest.raises(ValueError, match="repeated id"):
        table.insert(frame(spark, (2, "b"), (2, "c")))
    assert held(table.read()) == [(1, "a")]


def test_a_change_writes_only_its_folders(spark, table):
    table.append(frame(spark, *[(i, f"n{i}") for i in range(40)]))
    changed = lambda before, after: sum(before[f] != after[f] for f in before)
    first = files_of(spark, table)
    table.delete(F.col("name") == "n7")
    second = files_of(spark, table)
    assert len(first) == 4 and changed(first, second) == 1 and table.read().count() == 39
    table.delete(F.col("name") == "none")
    assert files_of(spark, table) == second
    table.append(frame(spark, (100, "more")))
    third = files_of(spark, table)
    assert all(second[f] <= third[f] for f in second) and changed(second, third) == 1


def test_rows_of_a_key_come_from_its_folder(spark, table):
    table.append(frame(spark, *[(i, f"n{i}") for i in range(40)], (None, "none")))
    found = table.rows_of(spark.createDataFrame([(7,), (99,)], "member bigint"), "member")
    assert held(found) == [(7, "n7")]
    assert "PartitionFilters: [" in found._jdf.queryExecution().toString()


def test_replace_by_several_columns_takes_null_for_equal(spark, table):
    table.append(frame(spark, (1, "a"), (1, None), (1, "a"), (2, None)))
    table.replace(frame(spark, (1, None), (1, "a"), (3, "x")), frame(spark, (1, "a"), (4, "d")), ["id", "name"])
    assert sorted(map(tuple, table.read().collect()), key=str) == [(1, "a"), (2, None), (4, "d")]


def test_a_mark_can_be_moved_back(spark, folder):
    at = lambda day: spark.sql(f"SELECT 'film' name, timestamp'2020-01-0{day} 10:00:00' mark, {day} last_id")
    write_state(at(5), f"{folder}/m")
    write_state(at(2), f"{folder}/m", move_back=True)
    assert read_state(spark, f"{folder}/m").first()["last_id"] == "2"
    write_state(at(3), f"{folder}/m")
    assert read_state(spark, f"{folder}/m").first()["last_id"] == "3"


def test_unknown_fields_are_refused_and_missing_ones_are_null(spark):
    with pytest.raises(ValueError, match="unknown field extra"):
        checks.conform(spark.range(1).selectExpr("'a' id", "1 extra"), PERSON_DOCUMENT)
    nested = spark.range(1).selectExpr("'a' id", "array(struct('g' as id, 'n' as name, 1 as more)) genres")
    with pytest.raises(ValueError, match="unknown field genres.more"):
        checks.conform(nested, FILM_DOCUMENT)
    with pytest.raises(ValueError, match="field id"):
        checks.conform(spark.range(1), PERSON_DOCUMENT)
    assert checks.conform(spark.range(1).selectExpr("'a' id"), PERSON_DOCUMENT).first()["roles"] is None


def sources(spark, **override):
    stamp = "timestamp'2020-01-01' as created_at, timestamp'2020-01-02' as updated_at"
    rows = {
        "genre": f"'g' id, 'drama' name, {stamp}",
        "person": f"'p' id, 'Ann' full_name, {stamp}",
        "film_work": f"'f' id, cast(null as string) title, cast(null as string) type, 50.0D rating, {stamp}",
        "genre_film_work": "'1' id, 'f' film_work_id, 'g' genre_id, timestamp'2020-01-01' as created_at",
        "person_film_work": "'1' id, 'f' film_work_id, 'p' person_id, 'actor' role, timestamp'2020-01-01' as created_at",
    }
    made = {n: spark.sql(f"SELECT {sql}") for n, sql in rows.items()}
    return made | {n: made[n].unionByName(spark.sql(f"SELECT {sql}"), allowMissingColumns=True) for n, sql in override.items()}


def test_bootstrap_publishes_all_tables_at_once(spark, folder):
    assert all(df.count() == 0 for df in published(spark, folder).values())
    bootstrap(spark, sources(spark), folder)
    tables = published(spark, folder)
    assert {n: df.count() for n, df in tables.items()} == dict.fromkeys(TABLES, 1)
    film = tables["film_work"].first()
    assert (film["title"], film["type"], film["created"]) == ("EMPTY_STR", "EMPTY_STR", dt.datetime(2020, 1, 1))
    assert film["modified"].year > 2024
    assert all(df.schema == T.StructType.fromDDL(TABLES[n]) for n, df in tables.items())


@pytest.mark.parametrize(
    ("name", "extra", "fault"),
    [
        ("genre", "'h' id, 'drama' name", "genre_name"),
        ("genre", "'g' id, 'other' name", "genre_key"),
        ("genre", "'h' id, repeat('x', 256) name", "genre_name_length"),
        ("film_work", "'e' id, 100.5D rating", "film_rating"),
        ("genre_film_work", "'2' id, 'none' film_work_id, 'g' genre_id", "genre_film_work_film"),
        ("person_film_work", "'2' id, 'f' film_work_id, 'p' person_id, 'actor' role", "person_role"),
    ],
)
def test_bootstrap_publishes_nothing_after_a_fault(spark, folder, name, extra, fault):
    with pytest.raises(ValueError, match=fault):
        bootstrap(spark, sources(spark, **{name: extra}), folder)
    assert published(spark, folder)["genre"].count() == 0


def test_marks_and_work_sets(spark, folder):
    assert mark_of_text(spark, f"{folder}/s") == "17000208014027"
    for day in (1, 3, 2):
        row = spark.sql(f"SELECT 'film' name, timestamp'2020-01-0{day} 10:00:00.123456' mark, {day} last_id")
        write_state(row, f"{folder}/s")
    assert read_state(spark, f"{folder}/s").first()["last_id"] == "3"
    assert mark_of_text(spark, f"{folder}/s") == "20200103100000"
    for _ in range(2):
        add_to_ids(spark.sql("SELECT * FROM VALUES ('a'), ('b'), ('a') t(id)"), f"{folder}/q")
    assert held(read_ids(spark, f"{folder}/q")) == [("a",), ("b",)]
    assert spark.read.parquet(f"{folder}/q").count() == 2


def mark_of_text(spark, path):
    return spark.range(1).withColumn("m", mark_of(spark, path, "film")).select(scalar.time_to_text("m")).first()[0]


def test_jdbc_options(spark):
    source = JdbcSource("jdbc:x:y", "d.Driver", "u", "secret")
    assert "secret" not in repr(source)
    seen = {}
    reader = mock.MagicMock()
    for m in ("format", "options", "option"):
        getattr(reader, m).side_effect = lambda *a, **k: (seen.update(k), seen.update([a] if len(a) == 2 else []), reader)[-1]
    session = mock.MagicMock(read=reader)
    source.table(session, "film_work", "id", (1, 900), 8)
    assert {k: seen[k] for k in ("dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "dbtable": "film_work", "partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "8"
    }
    seen.clear()
    source.query(session, "SELECT 1")
    assert seen["query"] == "SELECT 1" and "dbtable" not in seen


def test_an_empty_batch_is_not_sent(spark):
    JdbcSource("jdbc:none:", "no.Driver").append(spark.range(0).toDF("id"), "t")


def test_values(spark):
    df = spark.sql("SELECT CAST('NaN' AS DOUBLE) a, 'x' b, '[{\"id\":\"1\",\"name\":\"n\"}]' o, 'not json' bad, '[\"p\"]' n")
    row = df.select(
        scalar.missing_to_null("a", T.DoubleType()).alias("a"), scalar.missing_to_null("b", T.StringType()).alias("b"),
        scalar.parse_objects("o").alias("o"), scalar.parse_objects("bad").alias("bad"), scalar.parse_names("n").alias("n"),
    ).first()
    assert (row["a"], row["b"], row["o"][0]["name"], row["bad"], row["n"]) == (None, "x", "n", None, ["p"])


def test_quarantine(spark):
    df = spark.sql("SELECT 1 id, 'a' t UNION ALL SELECT 2, null UNION ALL SELECT null, null")
    valid, bad = checks.split_valid(df, {"id": F.col("id").isNotNull(), "t": F.length("t") > 0})
    assert held(valid) == [(1, "a")]
    assert sorted(r["reason"] for r in bad.collect()) == ["id,t", "t"]


def test_an_upsert_writes_only_kept_rows_aside(spark, table, monkeypatch):
    from filmloom.sources import documents

    aside, write = {}, documents.materialise

    def counted(df, label, *a):
        made = write(df, label, *a)
        aside[label] = made.count()
        return made

    monkeypatch.setattr(documents, "materialise", counted)
    table.upsert(frame(spark, *[(i, "a") for i in range(20)]))
    assert aside == {"upsert": 20, "kept-rows": 0}
    table.upsert(frame(spark, (3, "b")))
    assert aside["upsert"] == 1 and aside["kept-rows"] < 20
    assert held(table.read()) == sorted([(i, "a") for i in range(20) if i != 3] + [(3, "b")])


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return {name for name in files.split() if "/shuffle_" in name}


def test_a_write_leaves_no_shuffle_files(spark):
    before, kept = shuffle_files(spark), spark.conf.get(session.CLEANUP)
    rows = session.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("id")).count(), "grouped")
    deadline = time.time() + 20
    while shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and spark.conf.get(session.CLEANUP) == kept
    assert rows.count() == 7


def test_changes_leave_no_scratch_tables(spark, table):
    session.materialise(spark.range(1), "first")
    root = session.scratch_root(spark)
    before = set(os.listdir(root))
    table.insert(frame(spark, (1, "a"), (2, "b")))
    table.upsert(frame(spark, (2, "B"), (3, "c")))
    table.delete(F.col("id") == 1)
    assert held(table.read()) == [(2, "B"), (3, "c")] and set(os.listdir(root)) == before


def test_a_table_may_outlive_its_block(spark):
    with session.short_lived(spark):
        with session.short_lived(spark):
            short, longer = session.materialise(spark.range(2), "short"), session.materialise(spark.range(3), "longer", outlives=True)
            paths = [os.path.dirname(df.inputFiles()[0].removeprefix("file://")) for df in (short, longer)]
        assert longer.count() == 3 and [os.path.exists(p) for p in paths] == [False, True]
    assert not os.path.exists(paths[1])


@pytest.mark.parametrize("buckets, moved", [(session.FEW_FOLDERS, False), (session.FEW_FOLDERS + 1, True)])
def test_rows_of_few_folders_are_not_moved(spark, folder, monkeypatch, buckets, moved):
    plans, save = [], documents.save

    def seen(spark, writer, path):
        plans.append(writer._df._jdf.queryExecution().optimizedPlan().toString())
        save(spark, writer, path)

    monkeypatch.setattr(documents, "save", seen)
    table = DocumentTable(spark, f"{folder}/t", "id bigint, name string", buckets=buckets)
    table.append(frame(spark, *[(i, "a") for i in range(60)]))
    table.upsert(frame(spark, *[(i, "b") for i in range(30, 90)]))
    assert ["RebalancePartitions" in p for p in plans] == [moved, moved]
    assert held(table.read()) == [(i, "a" if i < 30 else "b") for i in range(90)]
