import math
import random
from collections import Counter

import edges
import pytest
from oracle_llm import compare, connect

from filmloom.llm import lexical
from filmloom.llm.common import words_of
from filmloom.llm.lexical import ranked_documents
from filmloom.llm.queries import QUERIES


def _brute(docs, items, k=10):
    counted = [(i, Counter(words_of(t or ""))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    size, words = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 100 - 90 + 90 * c.total() * size // words
            score = 0
            for t in set(words_of(text or "")) & set(c):
                w = math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(map(repr, out))


def _answers(spark, docs, items, k=10):
    docs = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    items = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted(repr(tuple(r)) for r in ranked_documents(docs, items, k).collect())


def _corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(120)]
    odds = [1 / (i + 1) for i in range(120)]
    texts = [" ".join(rng.choices(words, odds, k=rng.randint(1, 40))) for _ in range(n)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(10_000 + i, texts[0]) for i in range(n // 3)] + [(5, texts[5])] * 3
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(12)] + [(50, " ".join(words)), (51, "T1 t1 none"), (52, texts[0])]
    return docs, items


@pytest.mark.parametrize(("documents", "occurrences", "limit", "groups"), [(32_768, 4_000_000, 1 << 25, 16), (50, 300, 200, 1), (7, 10, 1, 2)])
def test_equals_brute_force(spark, monkeypatch, documents, occurrences, limit, groups):
    monkeypatch.setattr(lexical, "DOCUMENTS", documents)
    monkeypatch.setattr(lexical, "OCCURRENCES", occurrences)
    monkeypatch.setattr(lexical, "GROUPS", groups)
    blocks = lexical.item_blocks
    monkeypatch.setattr(lexical, "item_blocks", lambda rows: blocks(rows, limit))
    docs, items = _corpus(documents)
    assert _answers(spark, docs, items) == _brute(docs, items)


def test_more_terms_than_a_word_of_bits(spark):
    rng = random.Random(1)
    words = [f"t{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, k=60))) for i in range(150)]
    items = [(1, " ".join(words)), (2, " ".join(words[:64])), (3, " ".join(words[:65]))]
    assert _answers(spark, docs, items, 7) == _brute(docs, items, 7)


def test_edge_rows(spark):
    docs = [(r[0], r[1]) for r in edges.rows()]
    items = [(1, edges.PROSE["en"]), (2, None), (3, ""), (4, "!!"), (None, "word"), (6, "日本語のテキスト à À"), (6, "the"), (7, "a"), (8, "x" * 300_000), (9, "unheard")]
    frame = spark.createDataFrame([(*i, "c", "d") for i in items], "item_id bigint, text string, doc_id string, rank string")
    got = sorted(repr(tuple(r)) for r in ranked_documents(edges.documents(spark), frame).collect())
    assert got == _brute(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert _answers(spark, [], items) == [] and _answers(spark, docs, []) == []
    assert _answers(spark, [(1, None), (2, "")], items) == []
    assert ranked_documents(edges.empty(spark), spark.createDataFrame(items, "item_id bigint, text string")).collect() == []


def test_groups_below_the_best_are_passed_over(monkeypatch):
    """With one mask far above the rest, only its documents are added."""
    import numpy as np

    sizes = np.array([2, 1, 1, 1, 1, 1])
    terms, gains = np.array([0, 1, 1, 1, 1, 1, 1]), np.full(7, 10)
    best = lexical.Best(1, 1)
    added = []
    monkeypatch.setattr(lexical, "GROUPS", 1)
    add = best.add
    best.add = lambda item, scores, ids, none: (added.append(ids.tolist()), add(item, scores, ids, none))
    items = lexical.Items(np.array([9]), [np.array([0, 1])], {})
    lexical._rank_block(best, items, np.array([5, 3]), (np.arange(6), np.zeros(6, bool)), sizes, terms, gains)
    assert added == [[0]] and best.found[0][0].tolist() == [80]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    compare(QUERIES["op12_lexical_search"](spark, folder), connect(folder), "op12_lexical_search")
