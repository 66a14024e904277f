"""A stored index under changes, and rankings that skip blocks, against a rebuilt index and full scores."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from filmloom.operators import index as idx
from filmloom.operators import search as srch
from filmloom.operators.fuzzy import fuzzy_matches
from filmloom.queries import QUERIES

FIELDS = (idx.Field("title"), idx.Field("text", "plain"), idx.Field("kinds", "keyword"))
DDL = "id bigint, title string, text string, kinds array<string>"


def rows(seed, ids):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    odds = [1 / (i + 1) for i in range(60)]
    some = lambda n: " ".join(rng.choices(words, odds, k=rng.randint(1, n)))
    return [(i, some(4) if i % 9 else None, some(30), [rng.choice(("a", "b"))] if i % 4 else None) for i in ids]


def frame(spark, found):
    return spark.createDataFrame(found, DDL)


def texts(spark, k=None):
    asked = [("w0 w3", ), ("w50 w7 w0",), ("w1",), ("a",), ("w59 w58 w57",), ("w2 w2 w9 none",), ("none",), (None,)]
    made = spark.createDataFrame(asked, "query string")
    return made.withColumn("k", F.lit(k)) if k else made


def state(index):
    held = [index.postings.drop("bucket", "level"), index.forward.drop("bucket"), index.vocabulary, index.stats]
    return [sorted(map(repr, df.select(*sorted(df.columns)).collect())) for df in held]


def best(scored, k):
    place = F.row_number().over(Window.partitionBy("query_key").orderBy(F.desc("score"), "doc"))
    return sorted(map(tuple, scored.withColumn("place", place).filter(F.col("place") <= k).select("query_key", "place", "doc", "score").collect()))


@pytest.fixture(scope="module")
def large(spark):
    return idx.build_index(frame(spark, rows(1, range(1500))), FIELDS)


@pytest.mark.parametrize("k", [1, 3, 40, 2000])
def test_skipping_blocks_keeps_the_best(spark, large, monkeypatch, k):
    monkeypatch.setattr(srch, "FEW_HITS", 0)
    assert best(srch.top_scores(texts(spark, k), large), k) == best(srch.score(texts(spark), large), k)


def test_fewer_postings_are_read_for_fewer_documents(spark, large):
    def opened(k):
        asked = texts(spark).filter("query IS NOT NULL").select(srch.query_key(), F.lit(k).alias("k"))
        weights = srch.weighted_terms(texts(spark), large)
        blocks = srch.query_blocks(weights, large)
        plan = srch.opened_blocks(blocks, srch.least_scores(blocks, weights, asked, large))
        return plan.filter("opened").agg(F.sum("rows")).first()[0]

    few, some, every = opened(1), opened(20), opened(2000)
    assert few < some < every and 2 * few < every


def test_no_gain_exceeds_its_block(spark, large):
    blocks = srch.query_blocks(srch.weighted_terms(texts(spark), large), large)
    weights = srch.weighted_terms(texts(spark), large)
    gains = srch.term_hits(large, blocks.drop("rows", "bound"), blocks=True)
    gains = gains.select("query_key", "field", "term", "level", srch.gain(F.col("tf"), F.col("dl")).alias("g"))
    over = gains.join(blocks, ["query_key", "field", "term", "level"]).filter("g > bound")
    assert over.count() == 0 and gains.count() == srch.term_hits(large, weights).count()


def test_changes_equal_a_rebuild(spark, folder, monkeypatch):
    held = {r[0]: r for r in rows(2, range(120))}
    index = idx.write_index(frame(spark, list(held.values())), FIELDS, f"{folder}/i", buckets=3)
    analysed = []
    counted = idx.counted_terms
    monkeypatch.setattr(idx, "counted_terms", lambda docs, *a: (analysed.append(docs.count()), counted(docs, *a))[1])
    steps = [(rows(3, [5, 6, 200, 201]), []), ([], [7, 8, 200, 999]), (rows(4, [5, 7, 300]), [0, 6]), (rows(5, [200]), [])]
    for changed, deleted in steps:
        before = index
        index = index.update(frame(spark, changed) if changed else None, spark.createDataFrame([(i,) for i in deleted], "id bigint") if deleted else None)
        held = {i: r for i, r in held.items() if i not in deleted} | {r[0]: r for r in changed}
        assert before.gens[-1] + 1 == index.gens[-1]
    assert analysed == [4, 3, 1]
    monkeypatch.undo()
    rebuilt = idx.build_index(frame(spark, list(held.values())), FIELDS)
    assert state(index) == state(rebuilt)
    full = best(srch.score(texts(spark), rebuilt), 50)
    assert best(srch.score(texts(spark), index), 50) == full
    monkeypatch.setattr(srch, "FEW_HITS", 0)
    assert best(srch.top_scores(texts(spark, 5), index), 5) == best(srch.score(texts(spark), rebuilt), 5)
    near = lambda i: sorted(map(tuple, fuzzy_matches(texts(spark), i).collect()))
    assert near(index) == near(rebuilt)
    merged = index.merged()
    assert len(merged.gens) == 1 and state(merged) == state(rebuilt) and best(srch.score(texts(spark), merged), 50) == full


def test_a_generation_of_a_lost_writer_is_not_read(spark, folder, monkeypatch):
    index = idx.write_index(frame(spark, rows(6, range(20))), FIELDS, f"{folder}/i", buckets=2)
    before = state(index)
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        docs = spark.range(3).selectExpr("id", "'lost' title", "'lost' text", "array('l') kinds")
        with pytest.raises(RuntimeError, match="lost"):
            index.update(docs)
    assert state(idx.open_index(spark, f"{folder}/i", FIELDS)) == before
    added = idx.open_index(spark, f"{folder}/i", FIELDS).update(frame(spark, rows(7, [50])))
    assert added.vocabulary.filter("term = 'lost'").count() == 0 and added.forward.filter("doc = 50").count() > 0


def test_an_empty_index(spark):
    index = idx.build_index(frame(spark, []), FIELDS)
    assert srch.top_scores(texts(spark, 3), index).count() == 0 and fuzzy_matches(texts(spark), index).count() == 0
    assert index.update(frame(spark, rows(8, [1]))).stats.count() > 0


def test_a_search_sees_what_was_loaded_after_the_first(spark, folder):
    index = idx.write_index(frame(spark, rows(9, range(30))), FIELDS, f"{folder}/i", buckets=2)
    asked = spark.createDataFrame([("zebra", 5)], "query string, k int")
    assert srch.top_scores(asked, index).count() == 0
    index.update(frame(spark, [(77, "Zebra", "stripes", None)]))
    assert [r["doc"] for r in srch.top_scores(asked, idx.open_index(spark, f"{folder}/i", FIELDS)).collect()] == [77]


@pytest.mark.parametrize("name", ["r1_film_search", "x6_relevance_order"])
def test_order_does_not_depend_on_the_partitions(spark, monkeypatch, name):
    found = []
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for n, few in ((1, 1 << 40), (3, 0), (50, 0)):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        monkeypatch.setattr(srch, "FEW_HITS", few)
        found.append(sorted(map(tuple, QUERIES[name](spark, "/root/testdata/sf0.001").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert found[0] == found[1] == found[2] and found[0]


def test_terms_are_counted_without_a_shuffle_of_their_occurrences(spark):
    docs = frame(spark, rows(10, range(50)))
    plan = idx.counted_terms(docs, FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "posexplode" not in plan


@pytest.mark.parametrize("most", [1, 7, 1 << 40])
def test_counted_terms_of_repeated_ids_and_long_documents(spark, monkeypatch, most):
    monkeypatch.setattr(idx, "OCCURRENCES", most)
    none = [(None, *r[1:]) for r in rows(12, range(3))]
    docs = frame(spark, [*rows(11, range(40)), *rows(11, range(20)), *rows(12, [5]), *none])
    found = idx.terms_of(docs, FIELDS).groupBy("doc", "field", "dl", "term").agg(F.count("*").alias("tf"), F.sort_array(F.collect_list("at")).alias("at"))
    assert sorted(map(repr, idx.counted_terms(docs, FIELDS).collect())) == sorted(map(repr, found.collect()))


def test_scores_by_document_and_of_pairs(spark, large):
    asked = texts(spark)
    full = srch.score(asked, large)
    weights = srch.materialise(srch.weighted_terms(asked, large), "weights")
    found = srch._whole_scores(weights, large)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, full.collect()))
    dealt = srch.document_hits(large, weights).groupBy("query_key", "doc").count()
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc") == 1 and "Exchange hashpartitioning(query_key" not in plan
    pairs = full.filter("doc % 7 = 0").select("query_key", "doc")
    twice = pairs.unionByName(pairs).unionByName(pairs.withColumn("doc", F.lit(10**9)))
    assert sorted(map(tuple, srch.scores_of(twice, asked, large).collect())) == sorted(map(tuple, full.filter("doc % 7 = 0").collect()))


@pytest.mark.parametrize("sums, postings", [(srch.SUMS, srch.POSTINGS), (40, 100)])
def test_best_by_document_equal_full_scores(spark, folder, monkeypatch, sums, postings):
    monkeypatch.setattr(srch, "SUMS", sums)
    monkeypatch.setattr(srch, "POSTINGS", postings)
    # One id twice with two lengths, null ids, and documents that ended.
    docs = frame(spark, rows(1, range(300)) + [(7, "w0", "w0 w3 w0", ["a"]), (None, "w1", "w50 w7", None), (None, "w3", "w2", ["b"])])
    index = idx.write_index(docs, FIELDS, f"{folder}/i").update(frame(spark, rows(2, range(280, 330))), spark.createDataFrame([(3,)], "id bigint"))
    asked, full = texts(spark, 5).unionByName(texts(spark, 2)), srch.score(texts(spark), index)
    monkeypatch.setattr(srch, "FEW_HITS", 0)
    monkeypatch.setattr(srch, "SHARED", 0)
    calls, made = [], srch.document_scores
    monkeypatch.setattr(srch, "document_scores", lambda *a: calls.append(1) or made(*a))
    found = srch.top_scores(asked, index)
    assert best(found, 5) == best(full, 5) and calls and (found.count() < full.count() or sums == 40)
    pairs = sorted(map(repr, srch.matches(texts(spark), index).collect()))
    monkeypatch.setattr(srch, "FEW_HITS", 1 << 40)
    assert pairs == sorted(map(repr, srch.matches(texts(spark), index).collect())) and len(calls) == 2


def test_hits_are_not_shuffled(spark, large, monkeypatch):
    monkeypatch.setattr(srch, "FEW_HITS", 0)
    counted = srch.matches(texts(spark), large).groupBy("query_key").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(query_key") == 1 and "Exchange hashpartitioning(query_key#" in plan and ", doc#" not in plan.split("Exchange hashpartitioning(query_key")[1].split("ENSURE")[0]


def test_an_index_of_few_folders_is_written_where_it_lies(spark, folder, monkeypatch):
    plans, save = [], idx.save

    def seen(spark, writer, path):
        plans.append(writer._df._jdf.queryExecution().optimizedPlan().toString())
        save(spark, writer, path)

    monkeypatch.setattr(idx, "save", seen)
    index = idx.write_index(frame(spark, rows(1, range(40))), FIELDS, f"{folder}/i", buckets=4)
    assert len(plans) == 5 and not any("RebalancePartitions" in p for p in plans)
    assert index.postings.count() == index.forward.count() > 0
