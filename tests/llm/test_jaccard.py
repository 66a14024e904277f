import random

import edges
import numpy as np
import pytest
from pyspark.sql import functions as F

from filmloom.llm import jaccard
from filmloom.llm.jaccard import jaccard_components
from filmloom.llm.queries import QUERIES


def _set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def _linked(a, b, percent=90):
    both = len(a & b)
    return bool(a and b) and 100 * both >= percent * (len(a) + len(b) - both)


def _brute(rows, percent=90):
    """Sorted (doc_id, set size, smallest id reached) by comparing all pairs of rows."""
    sets, root = [_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if _linked(a, sets[j], percent):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        reached = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(reached, default=None)))
    return sorted(map(repr, out))


def _answers(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    return sorted(repr(tuple(r)) for r in jaccard_components(frame, **options).collect())


def _changed(rng, words, n):
    out = list(words)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(out))
        if kind == 0:
            out[at] = f"w{rng.randrange(40)}"
        elif kind == 1:
            out.insert(at, f"w{rng.randrange(40)}")
        elif len(out) > 1:
            del out[at]
    return out


def _families(seed, families=12, members=14, size=120, vocabulary=60):
    """Families of texts at every distance around the limit, some with a text of their own sort between them."""
    rng, rows = random.Random(seed), []
    for f in range(families):
        words = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(1, size))]
        for m in range(members):
            rows.append((f * 100 + m, " ".join(words)))
            words = _changed(rng, words, rng.randrange(4)) if rng.random() < 0.6 else words
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("percent", [90, 75])
def test_equals_all_pairs(spark, seed, percent):
    rows = _families(seed)
    assert _answers(spark, rows, percent=percent) == _brute(rows, percent)


def test_large_bundles_are_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SETS", 8)
    monkeypatch.setattr(jaccard, "TOKENS", 2_000)
    rows = _families(9, families=5, members=60)
    assert _answers(spark, rows) == _brute(rows)


def test_exactly_at_the_limit(spark):
    """18 of 20 n-grams are 0.9; 17 of 19 are less."""
    base = [f"a{i}" for i in range(21)]
    at = " ".join(base)
    rows = [(1, at), (2, " ".join(base[:20])), (3, " ".join([*base[:19], "x"])), (4, " ".join(base[1:20]))]
    sets = {i: _set(t) for i, t in rows}
    assert _linked(sets[1], sets[2]) and not _linked(sets[1], sets[4])
    assert _answers(spark, rows) == _brute(rows)


def test_edge_rows(spark):
    rows = [(r[0], r[1]) for r in edges.rows()]
    docs = edges.documents(spark).withColumn("least", F.lit("clash"))
    got = sorted(repr(tuple(r)) for r in jaccard_components(docs).collect())
    assert got == _brute(rows)
    assert jaccard_components(edges.empty(spark)).collect() == []


def test_wordless_texts_link_with_nothing(spark):
    rows = [(3, None), (4, ""), (5, " \n"), (6, None), (7, "one two"), (8, "One  TWO"), (9, "two one"), (None, "one two"), (None, None)]
    assert _answers(spark, rows) == _brute(rows)


def test_one_id_with_several_texts(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(99)}" for _ in range(80)]
    rows = [(1, " ".join(words)), (1, "quite another text of some words"), (1, None), (2, " ".join(words + ["more"])), (3, "Quite another text of some words")]
    assert _answers(spark, rows) == _brute(rows)


def test_trie_shares_paths_and_prunes():
    sets = [np.array(s) for s in ([0, 1, 2, 3], [0, 1, 2, 4], [0, 1, 5], [0, 1, 2, 3], [6])]
    trie = jaccard.Trie(sets, np.array([4, 4, 3, 5, 1]), run=2)
    assert sorted(trie.order.tolist()) == [0, 1, 2, 3, 4]
    root = np.array([0])
    nodes, _ = trie.below(root)
    # One child holds 0 1 for four sets, the other 6.
    assert sorted((trie.last[nodes] - trie.first[nodes]).tolist()) == [1, 4]
    found = set()
    for x, y in jaccard.trie_links(trie, sets, np.array([4, 4, 3, 5, 1]), np.full(5, -1), 7, 60):
        found |= {(int(a), int(trie.order[b])) for a, b in zip(x, y, strict=True)}
    sizes = [4, 4, 3, 5, 1]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(set(a) & set(b))
            assert ((i, j) in found) == (100 * both >= 60 * (sizes[i] + sizes[j] - both))


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(repr(tuple(r)) for r in QUERIES["op11_jaccard_join"](spark, sf).collect())
    assert got == _brute(rows)
