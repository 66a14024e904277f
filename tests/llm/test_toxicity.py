import numpy as np
from edges import as_set, documents, empty, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from filmloom.llm.queries import QUERIES
from filmloom.llm.toxicity import fit_toxicity, maximal_segments, passage_texts, score_toxicity


def by_definition(scores):
    """Maximal-scoring segments: the best segment (shortest, then first), then the same on both sides of it."""

    def split(a, b):
        best, found = 0, None
        for i in range(a, b):
            total = 0
            for j in range(i, b):
                total += scores[j]
                if total > best or (total == best and found and j + 1 - i < found[1] - found[0]):
                    best, found = total, (i, j + 1)
        if found is None:
            return []
        return [*split(a, found[0]), (*found, best), *split(found[1], b)]

    return split(0, len(scores))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-50, 50), max_size=14))
def test_segments_have_the_scores_of_the_definition(scores):
    scores = [s + i * 1e-4 for i, s in enumerate(scores)]  # no ties, for which the definition leaves a choice
    got = maximal_segments(np.array(scores))
    assert [s for _, _, s in got] == sorted([s for _, _, s in got], key=lambda _: 0)
    want = by_definition(scores)
    assert np.allclose([s for *_, s in got], [s for *_, s in want])
    assert all(abs(sum(scores[a:b]) - s) < 1e-6 for a, b, s in got)


def test_a_million_words_take_linear_time():
    scores = np.tile(np.array([1.0, -0.6, -0.6, 2.0, -1.0]), 200_000)
    assert maximal_segments(scores)
    assert len(maximal_segments(np.tile(np.array([1.0, -2.0]), 300_000))) == 300_000


def _labelled(spark):
    bad = [(1000 + i, f"{prose(i)} vermin wretch {prose(i + 1)} vermin wretch", "en") for i in range(60)]
    good = [(2000 + i, prose(500 + i, n=120), "en") for i in range(200)]
    labels = spark.createDataFrame([(i, 1) for i, *_ in bad] + [(i, 0) for i, *_ in good] + [(1, None), (None, 1), (9, 0), (9, 0)], "doc_id bigint, toxic int")
    return documents(spark, bad + good), labels


def test_finds_passages_and_leaves_clean_documents(spark):
    docs, labels = _labelled(spark)
    scored = score_toxicity(docs, fit_toxicity(docs, labels)).collect()
    assert len(scored) == docs.count()
    for r in scored:
        toxic = "vermin" in (r["row"]["text"] or "")
        assert (r["score"] >= 0.5) == toxic and 0 <= r["score"] <= 1
        assert toxic or not r["passages"]
        if toxic:
            assert any("vermin" in t for t in passage_texts(r["row"]["text"], r["passages"]))
    plain = {r["score"] for r in scored if not r["passages"]}
    assert len(plain) == 1  # null, empty and wordless texts have the score of a text without evidence
    assert scored[0]["row"]["row"] in ("row!", None)


def test_without_both_classes_all_score_alike(spark):
    docs = documents(spark)
    for rows in ([], [(1, 0)], [(1, 1)]):
        labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
        assert len({r["score"] for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()}) == 1


def test_empty_tables(spark):
    docs = empty(spark)
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert as_set(score_toxicity(docs, fit_toxicity(docs, labels))) == []


def test_query_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op1_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    rows = found.selectExpr("held_out", "predicted", "size(regexp_extract_all(lower(text), '(idiot|moron|scum|worthless)', 1)) > 0 AS insult").collect()
    assert len(rows) == 1000
    assert sum(r["insult"] and not r["predicted"] for r in rows) <= 1
    assert sum(r["predicted"] for r in rows) < 100


def test_rare_toxic_words_keep_their_own_counts_in_a_large_vocabulary(spark):
    """Two toxic words of 40 documents each, beside 1.8 million words of one document each."""
    fresh = lambda i: " ".join(f"w{i}x{j}" for j in range(4000))
    bad = ["vermin", "wretch"]
    clean = [(i, fresh(i), "en") for i in range(300)]
    toxic = [(1000 + i, f"{fresh(1000 + i)} {' '.join([bad[i % 2]] * 5)} {fresh(2000 + i)}", "en") for i in range(80)]
    labels = spark.createDataFrame([(i, 0) for i, *_ in clean] + [(i, 1) for i, *_ in toxic], "doc_id bigint, toxic int")
    docs = documents(spark, clean + toxic)
    for r in score_toxicity(docs, fit_toxicity(docs, labels)).filter("row.source = 'src9'").collect():
        assert (r["score"] >= 0.5) == (r["row"]["doc_id"] >= 1000)


def test_too_many_scored_words_are_joined(spark, monkeypatch):
    docs, labels = _labelled(spark)
    sent = as_set(score_toxicity(docs, fit_toxicity(docs, labels)))
    monkeypatch.setattr("filmloom.llm.toxicity.SENT_WORDS", 0)
    model = fit_toxicity(docs, labels)
    assert model.scored is not None and not model.scores
    assert as_set(score_toxicity(docs, model)) == sent


def test_a_repeated_labelled_id_is_learned_from_once(spark, monkeypatch):
    docs, labels = _labelled(spark)
    often = documents(spark, [(1, f"{prose(800)} oddity", "en")] * 400).filter("source = 'src9'")
    fitted = []
    monkeypatch.setattr("filmloom.llm.toxicity.logistic", lambda x, y: fitted.append(len(x)) or (0.0, 1.0))
    model = fit_toxicity(docs.union(often), labels.filter("doc_id <> 1").union(spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")))
    assert fitted == [60 + 200 + 2] and b"oddity" not in model.scores
