import random

import numpy as np
from edges import as_set, documents, empty, prose

from filmloom.llm import language
from filmloom.llm.language import fit_languages, predict_languages
from filmloom.llm.queries import QUERIES


def _learned(spark):
    train = [(100 + i, prose(i, lang), lang) for i in range(40) for lang in ("en", "de", "fr")]
    docs = documents(spark, train)
    return docs, fit_languages(docs)


def test_languages_and_edges(spark):
    docs, model = _learned(spark)
    assert model.langs == ["de", "en", "fr"]
    found = predict_languages(docs, model).collect()
    assert len(found) == docs.count()
    for r in found:
        text, known = r["row"]["text"], r["row"]["lang"]
        assert 0 <= r["score"] <= 1
        if not text or not any(map(str.isalpha, text)):
            assert (r["lang_pred"], r["score"], r["shares"]) == ("und", 0.0, [])
        else:
            assert r["lang_pred"] in model.langs
            assert abs(sum(s["share"] for s in r["shares"]) - 1) < 1e-6
            if known and len(text) > 100 and not text.startswith("a a"):
                assert r["lang_pred"] == known


def test_mixture_has_both_languages_in_proportion(spark):
    _, model = _learned(spark)
    text = prose(900, "en", 900) + " " + prose(901, "fr", 300)
    r = predict_languages(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).first()
    shares = {s["lang"]: s["share"] for s in r["shares"]}
    assert set(shares) == {"en", "fr"} and r["lang_pred"] == "en" and 0.6 < shares["en"] < 0.85 and r["score"] == shares["en"]


def test_nothing_learned_and_nothing_to_predict(spark):
    model = fit_languages(empty(spark))
    assert model.langs == []
    assert {r["lang_pred"] for r in predict_languages(documents(spark), model).collect()} == {"und"}
    assert as_set(predict_languages(empty(spark), _learned(spark)[1])) == []


def test_query_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op3_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    assert found.count() == 1000
    assert found.filter("held_out AND lang_pred <> lang").count() <= 3


def _tongue(spark, n):
    """So many languages of ten words each, all of the same letters."""
    rng = random.Random(7)
    words = [["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(10)] for _ in range(n)]
    rows = [(2 * i + j, " ".join(rng.choice(words[i]) for _ in range(60)), f"l{i:03}") for i in range(n) for j in range(2)]
    more = [(9000 + i, "12 34", f"none{i}") for i in range(200) for _ in range(3)]  # codes without a letter take no place
    return spark.createDataFrame(rows + more, "doc_id bigint, text string, lang string")


def test_every_language_with_a_letter_is_learned(spark):
    docs = _tongue(spark, 200)
    model = fit_languages(docs)
    assert model.langs == [f"l{i:03}" for i in range(200)]
    for r in predict_languages(docs, model).collect():
        assert r["lang_pred"] == (r["row"]["lang"] if r["row"]["doc_id"] < 9000 else "und")


def test_parts_of_a_long_text_give_the_same_shares(spark, monkeypatch):
    _, model = _learned(spark)
    text = prose(900, "en", 3000) + " " + prose(901, "fr", 1000)
    ((whole, sure),) = language.proportions([text], model)
    monkeypatch.setattr("filmloom.llm.language.CELLS", 600)
    ((parts, again),) = language.proportions([text], model)
    assert np.allclose(whole, parts) and np.isclose(sure, again) and (whole > 0).sum() == 2


def test_shares_do_not_depend_on_the_neighbours(spark):
    _, model = _learned(spark)
    rng = random.Random(3)
    texts = [prose(i, "en", rng.randint(20, 80)) + " " + prose(i + 50, rng.choice(("de", "fr")), rng.randint(1, 60)) + " " + prose(i + 90, "fr", rng.randint(1, 40)) for i in range(60)]
    together = list(language.proportions(texts, model))
    for text, (shares, sure) in zip(texts, together, strict=True):
        ((alone, own),) = language.proportions([text], model)
        assert np.array_equal(alone, shares) and own == sure
