"""Order, pages, numbering: every way to a page gives the same page."""

import pytest
from pyspark.sql import functions as F

from filmloom.operators import paging as pg

KEYS = [pg.SortKey("rating", ascending=False), pg.SortKey("id")]


@pytest.fixture(scope="module")
def films(spark):
    rows = [(i, None if i % 7 == 0 else float(i % 5), 0 if i % 3 == 0 else i % 9) for i in range(200)]
    return spark.createDataFrame(rows, "id int, rating double, genre int").repartition(6)


def expected(rows, up=False):
    value = lambda r: (r["rating"] is None, r["rating"] or 0.0) if up else (r["rating"] is None, -(r["rating"] or 0.0))
    return [r["id"] for r in sorted(rows, key=lambda r: (*value(r), r["id"]))]


def test_the_sign_is_inverted_and_nulls_come_last(films):
    rows = films.collect()
    down = [r["id"] for r in films.orderBy(*pg.result_order("rating")).collect()]
    up = [r["id"] for r in films.orderBy(*pg.result_order("-rating")).collect()]
    assert down == expected(rows) and up == expected(rows, up=True)


def test_sorting_by_id_has_no_second_id(films):
    assert len(pg.result_order("id")) == 1 and len(pg.result_order("-id")) == 1 and len(pg.result_order("r", "s")) == 3


@pytest.mark.parametrize(("number", "size", "hop"), [(1, 10, 7), (4, 10, 7), (20, 10, 30), (3, 64, 10_000), (30, 10, 7)])
def test_cursor_pages_equal_offset_pages(films, number, size, hop):
    by_offset = [r["id"] for r in pg.page(films, pg.result_order("rating"), number, size).collect()]
    by_cursor = [r["id"] for r in pg.deep_page(films, KEYS, number, size, hop).collect()]
    assert by_cursor == by_offset


def test_walking_all_pages_gives_the_whole(films):
    seen, last = [], None
    while rows := pg.next_page(films, KEYS, last, 33).collect():
        seen += [r["id"] for r in rows]
        last = (rows[-1]["rating"], rows[-1]["id"])
    assert seen == expected(films.collect())


def test_numbering_is_the_global_rank(films):
    numbered = pg.number_rows(films, pg.result_order("rating")).orderBy("position").collect()
    assert [r["position"] for r in numbered] == list(range(1, 201))
    assert [r["id"] for r in numbered] == expected(films.collect())


def test_pages_of_a_hot_group_are_the_same_from_both_plans(spark, films):
    requests = spark.createDataFrame(
        [(g * 10 + n, g, n, 6) for g in range(9) for n in (1, 2, 9)], "request_id int, genre int, page_number int, page_size int"
    )
    shallow = pg.pages_for(requests, films, pg.result_order("rating"), ["genre"])
    deep = pg.pages_for(requests, films, pg.result_order("rating"), ["genre"], shallow=0)
    rows = lambda df: sorted((r["request_id"], r["place"], r["id"]) for r in df.collect())
    assert rows(shallow) == rows(deep)
    all_rows = films.collect()
    order = expected([r for r in all_rows if r["genre"] == 0])
    got = [i for q, _, i in rows(deep) if q == 9]
    assert got == order[48:54]


def test_repeated_requests_each_get_their_page(spark, films):
    requests = spark.createDataFrame([(i, 2, 5) for i in range(20)], "request_id int, page_number int, page_size int")
    pages = pg.pages_for(requests, films, pg.result_order("rating")).collect()
    want = expected(films.collect())[5:10]
    for i in range(20):
        assert [r["id"] for r in sorted((r for r in pages if r["request_id"] == i), key=lambda r: r["place"])] == want


def test_shallow_pages_limit_each_group_before_the_shuffle(spark, films):
    requests = spark.createDataFrame([(1, 1, 1, 5)], "request_id int, genre int, page_number int, page_size int")
    plan = pg.pages_for(requests, films, pg.result_order("rating"), ["genre"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_single_page_is_a_top_k(films):
    assert "TakeOrderedAndProject" in pg.page(films, pg.result_order("rating"), 2)._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    ("name", "expected_row"),
    [(1, (4, None, 2, 1)), ("first", (4, None, 2, 1)), ("last", (4, 3, None, 4)), (3, (4, 2, 4, 3)), ("99", (4, 3, None, 4))],
)
def test_admin_envelope(films, name, expected_row):
    assert tuple(pg.envelope(films, name).first())[1:] == expected_row
    assert pg.envelope(films, name).first()["count"] == 200


def test_keyset_predicate_reaches_the_scan(spark, films, folder):
    films.write.parquet(f"{folder}/f")
    plan = pg.after(spark.read.parquet(f"{folder}/f"), [pg.SortKey("id")], [100])._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(GreaterThan(id,100),IsNull(id))]" in plan or "GreaterThan(id,100)" in plan.split("PushedFilters")[1]
    assert F is not None
