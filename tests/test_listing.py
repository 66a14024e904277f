"""The kept listing against a sorted list, through changes drawn from a seed."""

import random

from filmloom.operators.listing import Listing
from filmloom.operators.paging import SortKey

DDL = "id long, rating double, title string"
KEYS = (SortKey("rating", ascending=False), SortKey("id"))


def _place(row):
    return (row[1] is None, -(row[1] or 0.0), row[0] is None, row[0] or 0)


def _listed(spark, folder, rows, range_rows=7):
    listing = Listing(spark, f"{folder}/listing", DDL, KEYS, range_rows)
    listing.write(spark.createDataFrame(rows, DDL).repartition(5))
    return listing


def _frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def _all(listing):
    found = sorted(listing.numbered().collect(), key=lambda r: r["position"])
    assert [r["position"] for r in found] == list(range(1, len(found) + 1))
    return [(r["id"], r["rating"], r["title"]) for r in found]


def _draw(rng, ids):
    return [(i, rng.choice([None, *range(6)]), rng.choice([None, "", "film"])) for i in ids]


def _changed(rows, gone, new):
    ended = {(r[1], r[0]) for r in [*gone, *new]}
    return sorted([r for r in rows if (r[1], r[0]) not in ended] + new, key=_place)


def test_changes_equal_a_sorted_list(spark, folder):
    rng = random.Random(1)
    rows = sorted([(i, r if r is None else float(r), t) for i, r, t in _draw(rng, range(60))], key=_place)
    listing = _listed(spark, folder, rows)
    assert _all(listing) == rows
    for step in range(3):
        gone = rng.sample(rows, 15) + [(9_999, 1.0, None), (None, None, None)]
        moved = [(i, float(rng.randrange(6)), t) for i, _, t in gone[:5]]
        fresh = [(i, r if r is None else float(r), t) for i, r, t in _draw(rng, range(1000 * (step + 1), 1000 * (step + 1) + 12))]
        rows = _changed(rows, gone, moved + fresh)
        listing.change(_frame(spark, gone), _frame(spark, moved + fresh))
        assert _all(listing) == rows
    for number, size in [(1, 4), (5, 6), (2, 25), (40, 9)]:
        page = sorted(listing.page(number, size).collect(), key=lambda r: r["position"])
        assert [r["id"] for r in page] == [r[0] for r in rows[(number - 1) * size : number * size]]
        assert [r["position"] for r in page] == list(range((number - 1) * size + 1, (number - 1) * size + 1 + len(page)))
    for at in (0, 11, len(rows) - 1):
        found = sorted(listing.after((rows[at][1], rows[at][0]), 10).collect(), key=lambda r: _place((r["id"], r["rating"])))
        assert [r["id"] for r in found] == [r[0] for r in rows[at + 1 : at + 11]]
    assert [r["id"] for r in listing.after((99.0, 0), 3).orderBy(*[k.order() for k in KEYS]).collect()] == [r[0] for r in rows[:3]]


def test_a_change_again_changes_nothing(spark, folder):
    rows = [(i, float(i % 4), "a") for i in range(30)]
    listing = _listed(spark, folder, rows)
    gone, new = _frame(spark, rows[:3]), _frame(spark, [(0, 9.0, "b"), (77, None, "c")])
    listing.change(gone, new)
    once = _all(listing)
    listing.change(gone, new)
    assert _all(listing) == once and len(once) == 29


def test_rows_of_equal_keys_over_many_ranges_go_together(spark, folder):
    rows = [(5, 1.0, str(i)) for i in range(40)] + [(6, 1.0, "x"), (4, 1.0, "y")]
    listing = _listed(spark, folder, rows)
    assert listing.directory().count() == 6
    listing.change(_frame(spark, [(5, 1.0, None)]), _frame(spark, [(7, 1.0, "z"), (7, 1.0, "z")]))
    assert _all(listing) == [(4, 1.0, "y"), (6, 1.0, "x"), (7, 1.0, "z"), (7, 1.0, "z")]


def test_only_the_ranges_of_the_keys_are_written(spark, folder):
    listing = _listed(spark, folder, [(i, float(-i), "a") for i in range(70)])
    before = {tuple(r["first"]): r["_range"] for r in listing.directory().collect()}
    listing.change(_frame(spark, [(33, -33.0, None)]), _frame(spark, [(500, -33.5, "n")]))
    after = {tuple(r["first"]): r["_range"] for r in listing.directory().collect()}
    assert len(before) == 10 and sum(after.get(k) != f for k, f in before.items()) == 1
    # The folder that the change freed is taken by the next one.
    freed = set(before.values()) - set(after.values())
    listing.change(_frame(spark, [(0, 0.0, None)]), _frame(spark, []))
    assert freed <= {r["_range"] for r in listing.directory().collect()}


def test_a_deep_page_opens_two_ranges_at_most(spark, folder):
    listing = _listed(spark, folder, [(i, float(-i), "a") for i in range(300)], range_rows=20)
    assert all(len(listing.ranges_between(offset, 10)) <= 2 for offset in range(0, 300, 7))
    page = listing.page(25, 10)
    assert [r["id"] for r in page.orderBy("position").collect()] == list(range(240, 250))
    assert len({r[0] for r in page.selectExpr("input_file_name()").collect()}) <= 2
    assert "PartitionFilters: [_range" in page._jdf.queryExecution().toString().replace("isnotnull(", "").replace("(_range", "_range")


def test_an_overfull_range_is_divided_and_an_empty_one_is_freed(spark, folder):
    listing = _listed(spark, folder, [(i, float(-i), "a") for i in range(28)])
    inner = [(1_000 + i, -10.5, "b") for i in range(60)]
    listing.change(_frame(spark, []), _frame(spark, inner))
    assert max(r["rows"] for r in listing.directory().collect()) <= 14 and len(_all(listing)) == 88
    listing.change(_frame(spark, inner), _frame(spark, []))
    assert [r[0] for r in _all(listing)] == list(range(28))


def test_empty(spark, folder):
    listing = _listed(spark, folder, [])
    assert _all(listing) == [] and listing.page(1, 5).collect() == [] and listing.after((1.0, 1), 5).collect() == []
    listing.change(_frame(spark, [(1, 1.0, None)]), _frame(spark, [(2, None, "a"), (3, 2.0, None)]))
    assert [r[0] for r in _all(listing)] == [3, 2]
    listing.change(_frame(spark, [(2, None, None), (3, 2.0, None)]), _frame(spark, []))
    assert _all(listing) == []
