import zlib

import pytest
from edges import CLASHING, documents, empty, prose
from pyspark.sql import functions as F

from filmloom.llm import sharding
from filmloom.llm.queries import QUERIES
from filmloom.llm.sharding import assign_shards, range_of, write_shards


def _check(rows, shards, sizes):
    """Slots without gaps, and no shard off by more than its largest record."""
    by = {}
    for shard, slot, size in rows:
        by.setdefault(shard, []).append((slot, size))
    assert all(sorted(s for s, _ in own) == list(range(len(own))) for own in by.values())
    mean, largest = sum(sizes) / shards, max(sizes)
    assert all(0 <= shard < shards for shard in by)
    assert all(abs(sum(z for _, z in by.get(s, [])) - mean) <= largest for s in range(shards))


@pytest.mark.parametrize("splitters", [[], [5], [-3, 0, 7, 7 << 40]])
def test_binary_search(spark, splitters):
    keys = [-(1 << 63), -4, -3, -1, 0, 5, 6, 7, 7 << 40, (1 << 63) - 1]
    got = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", range_of(F.col("k"), splitters).alias("r")).collect()
    assert all(r["r"] == sum(s <= r["k"] for s in splitters) for r in got)


def test_edges_keep_every_row_and_column(spark):
    docs = documents(spark, [(100 + i, prose(i), "en") for i in range(200)])
    placed = assign_shards(docs, F.crc32(F.col("text").cast("binary")), F.octet_length("text"), 7)
    rows = placed.collect()
    assert len(rows) == docs.count() and set(CLASHING) <= set(rows[0]["row"].asDict())
    sizes = [len((r["row"]["text"] or "").encode()) for r in rows]
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sum(sizes) and sorted(repr(r["row"]) for r in rows) == sorted(map(repr, docs.collect()))


@pytest.mark.parametrize("hot", [0, 3000])
def test_near_equal_bytes_with_a_hot_key(spark, hot):
    rows = [(i, i * 7919 % 10007, 10 + i % 50) for i in range(5000)] + [(9000 + i, 4242, 40) for i in range(hot)] + [(1, 1, 10)] * 50
    frame = spark.createDataFrame(rows, "id bigint, k bigint, size bigint").repartition(4)
    got = assign_shards(frame, F.col("k"), F.col("size"), 13).collect()
    _check([(r["shard"], r["slot"], r["row"]["size"]) for r in got], 13, [r[2] for r in rows])
    ordered = sorted((r["shard"], r["slot"], r["row"]["k"]) for r in got)
    if not hot:
        assert [k for *_, k in ordered] == sorted(k for *_, k in ordered)


def test_sizes_of_nothing_and_empty_tables(spark):
    got = assign_shards(spark.createDataFrame([(1, None), (None, 0)], "k bigint, s bigint"), F.col("k"), F.col("s"), 3).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (0, 1)]
    assert assign_shards(empty(spark), F.col("doc_id"), F.col("n_chars"), 4).collect() == []


def test_written_shards(spark, folder):
    frame = spark.createDataFrame([(i, i % 10) for i in range(100)], "id bigint, s bigint")
    write_shards(assign_shards(frame, F.col("id"), F.col("s"), 4), f"{folder}/shards", 4)
    back = spark.read.parquet(f"{folder}/shards")
    assert back.count() == 100 and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op5_sharding"](spark, sf).collect()
    assert len(rows) == len(texts)
    assert all(r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) and r["grown_shard"] is None for r in rows)
    _check([(r["shard"], r["slot"], r["size"]) for r in rows], 40, [r["size"] for r in rows])


def test_plan_is_native(spark):
    frame = spark.createDataFrame([(i, i) for i in range(10)], "k bigint, s bigint")
    plan = assign_shards(frame, F.col("k"), F.col("s"), 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert sharding.MAX_RANGES
