"""Differences of whole tables, with repeats and nulls."""

import random
from collections import Counter

import pytest

from filmloom.operators.sets import _bucketed, changed_buckets, table_diff

DDL = "id int, a string, b string"


def _rows(seed, n=300):
    rng = random.Random(seed)
    some = lambda: rng.choice((None, "x", "y", ""))
    return [(rng.choice((None, *range(60))), some(), some()) for _ in range(n)]


@pytest.mark.parametrize("key", [(), ("id",), ("id", "a")])
@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_equals_counting_rows(spark, key, buckets):
    left, right = _rows(1), [*_rows(1)[:280], *_rows(2, 30), (None, None, "x"), (None, "x", None)]
    got = table_diff(spark.createDataFrame(left, DDL), spark.createDataFrame(right, DDL).repartition(5), key, buckets).collect()
    want = [(*r, "source") for r in (Counter(left) - Counter(right)).elements()] + [(*r, "target") for r in (Counter(right) - Counter(left)).elements()]
    assert Counter(map(tuple, got)) == Counter(want)


def test_one_changed_row_is_one_bucket(spark):
    rows = [(i, "x", str(i)) for i in range(500)]
    left = _bucketed(spark.createDataFrame(rows, DDL), ["id"], 64)
    right = _bucketed(spark.createDataFrame([*rows[:77], (77, "y", "77"), *rows[78:]], DDL).repartition(7), ["id"], 64)
    assert changed_buckets(left, right, ["id", "a", "b"]).count() == 1
    assert changed_buckets(left, left.repartition(3), ["id", "a", "b"]).count() == 0


def test_columns_by_name_and_empty_sides(spark):
    some = spark.createDataFrame([(1, "a", None), (1, "a", None)], DDL)
    assert table_diff(some, some.select("b", "id", "a")).count() == 0
    assert [r["side"] for r in table_diff(some.limit(0), some).collect()] == ["target", "target"]
    assert table_diff(some.limit(0), some.limit(0)).count() == 0
