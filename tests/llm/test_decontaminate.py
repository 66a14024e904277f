import pytest
from edges import as_set, documents, empty, prose
from oracle_llm import compare, connect

from filmloom.llm import decontaminate
from filmloom.llm.decontaminate import benchmark_hits, without_contaminated
from filmloom.llm.queries import QUERIES

UNIQUE = " ".join(f"rare{i} word{i % 7}" for i in range(20))
ITEMS = [
    (1, UNIQUE), (2, prose(1, n=14)), (3, "Two words"), (4, None), (5, ""), (6, "?!"), (7, UNIQUE), (7, prose(77)),
    (None, "vague nameless item text"), (8, "a " * 13), (9, UNIQUE.upper()), (10, "brücke Straße ÉTÉ une"),
]


def _fixture(spark, folder):
    words = UNIQUE.split()
    extra = [
        (100, f"{prose(60)} {' '.join(words[3:16])} {prose(61)}", "en"),  # one window of 13
        (101, f"{prose(60)} {' '.join(words[3:15])} {prose(61)}", "en"),  # twelve words aren't one
        (102, f"{', '.join(words[5:30])}!", "en"), (103, f"{prose(63, n=3000)} {' '.join(words[:13])}", "en"),  # below one in twenty
        (104, "two\nWORDS", "en"), (105, "nothing of vague nameless item text here", "en"), (106, "a " * 12, "en"),
        (107, " ".join(words + words), "en"), (108, "brücke straße ÉTÉ une", "de"), (109, "brücke straße été une", "de"),
    ]
    docs = documents(spark, extra)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs.write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 5_000, 200])
def test_edges_equal_sql(spark, folder, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, items = _fixture(spark, folder)
    compare(QUERIES["op2_decontaminate"](spark, folder), connect(folder), "op2_decontaminate")
    found = {r["row"]["doc_id"]: r for r in benchmark_hits(docs, items).collect()}
    assert found[100]["n_hit"] == 13 and found[100]["items"] == ["1", "7", "9"] and found[100]["contaminated"]
    assert found[101]["n_hit"] == 0 and found[103]["n_hit"] == 13 and not found[103]["contaminated"]
    assert found[109]["n_hit"] == 0 and found[108]["n_hit"] == 4 and found[105]["items"] == [""]
    assert found[5]["n_words"] == 0 and not found[5]["contaminated"]
    kept = without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r["contaminated"] for r in benchmark_hits(docs, items).collect())


@pytest.mark.parametrize("shingle", [1, 2, 5, 13])
def test_any_shingle_gives_the_same(spark, folder, shingle):
    docs, items = _fixture(spark, folder)
    assert as_set(benchmark_hits(docs, items, shingle=shingle)) == as_set(benchmark_hits(docs, items))


def test_more_than_a_few_blocks_are_joined_by_shuffle(spark, folder, monkeypatch):
    docs, items = _fixture(spark, folder)
    want = as_set(benchmark_hits(docs, items))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    ways = []
    shuffled = decontaminate._shuffled_occurrences
    monkeypatch.setattr(decontaminate, "_shuffled_occurrences", lambda *given: ways.append(1) or shuffled(*given))
    got = benchmark_hits(docs, items)
    assert as_set(got) == want and ways == [1]
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_window_of_very_many_items(spark):
    items = spark.createDataFrame([(i, UNIQUE if i % 3 else prose(i)) for i in range(600)], "item_id bigint, text string")
    rows = [(i, f"{prose(900 + i)} {UNIQUE}") for i in range(50)] + [(99, prose(99))]
    found = {r["row"]["doc_id"]: r["items"] for r in benchmark_hits(spark.createDataFrame(rows, "doc_id bigint, text string"), items).collect()}
    want = sorted(str(i) for i in range(600) if i % 3)
    assert all(found[i] == want for i in range(50)) and len(found) == 51


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert as_set(benchmark_hits(empty(spark), items)) == []
    for none in (items.limit(0), items.filter("text = '?!'")):
        got = benchmark_hits(documents(spark), none).collect()
        assert len(got) == documents(spark).count() and all(r["n_hit"] == 0 and not r["contaminated"] for r in got)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    compare(QUERIES["op2_decontaminate"](spark, sf), connect(sf), "op2_decontaminate")


def test_plan_is_native(spark):
    docs, items = documents(spark), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    plan = benchmark_hits(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
