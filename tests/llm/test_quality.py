import random
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from edges import documents, empty, prose
from pyspark.sql import functions as F

from filmloom.llm import quality
from filmloom.llm.quality import BUCKETS, SHAPES, fit_shapes, gram_odds, grams, log_odds, prior_size, score_quality, shape
from filmloom.llm.queries import QUERIES

LABELS = "doc_id bigint, quality int"


def _judged(spark, docs, rows):
    return score_quality(docs, spark.createDataFrame(rows, LABELS), F.col("source"), F.col("lang"))


def _mixed():
    good = [(100 + i, prose(i), "en") for i in range(60)]
    bad = [(300 + i, " ".join(w + random.Random(i).choice(["###", "$$$", "%%"]) for w in prose(i).split()), "en") for i in range(60)]
    return good, bad


def test_separates_and_keeps_every_row(spark):
    good, bad = _mixed()
    docs = documents(spark, good + bad)
    labels = [(i, 1) for i, *_ in good[::2]] + [(i, 0) for i, *_ in bad[::2]] + [(None, 1), (1, None), (4, 1), (4, 1)]
    rows = _judged(spark, docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in docs.collect())
    found = {r["doc_id"]: r for r in rows}
    assert all(found[i]["score"] > 0.5 for i, *_ in good) and all(found[i]["score"] < 0.5 for i, *_ in bad)
    assert all(0 <= r[c] <= 1 for r in rows for c in ("score", "evidence", "host_posterior"))


def test_sparse_paths_lean_on_their_host(spark):
    good, bad = _mixed()
    rows = [(i, t, "clean", "big") for i, t, _ in good[:50]] + [(i, t, "junk", "big") for i, t, _ in bad[:50]] + [(900, prose(1), "junk", "tiny"), (901, prose(1), "clean", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    found = {r["doc_id"]: r for r in _judged(spark, docs, [(i, 1) for i, *_ in good[:40]] + [(i, 0) for i, *_ in bad[:40]]).collect()}
    assert found[900]["host_posterior"] < 0.5 < found[901]["host_posterior"]
    # The only document of a path learns nothing from itself.
    assert found[900]["path_posterior"] == pytest.approx(found[900]["host_posterior"])


def test_classifier_in_the_plan_equals_the_fit(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(200, SHAPES)), rng.integers(0, 2, 200)
    model = fit_shapes(x, y.astype(float))
    scaled = np.clip((x - model.mean) / model.spread, -8, 8)
    want = np.clip(model.weights[0] + np.concatenate((scaled, scaled**2), 1) @ model.weights[1:], -12, 12)
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, s array<double>")
    got = [r["o"] for r in frame.select("i", log_odds(F.col("s"), model).alias("o")).orderBy("i").collect()]
    assert np.allclose(got, want)


def test_prior_size(spark):
    rng = np.random.default_rng(1)
    means = rng.normal(0.5, 0.1, 400)
    rows = [(50, float(rng.normal(50 * m, np.sqrt(50 * 0.04)))) for m in means]
    got = prior_size(spark.createDataFrame(rows, "n bigint, s double"), F.lit(0.5), 0.04)
    assert 2.5 < got < 6.5  # 0.04 / 0.01


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, 0)]])
def test_few_labels_and_empty_tables(spark, rows):
    assert len(_judged(spark, documents(spark), rows).collect()) == documents(spark).count()
    assert _judged(spark, empty(spark), rows).collect() == []


@pytest.mark.parametrize("text", [None, "", "\n", "a", "A A\n\nA", "é ###"])
def test_shape(text):
    assert len(shape(text)) == SHAPES and all(np.isfinite(shape(text)))


def test_query_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op6_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left")
    rows = found.select("held_out", "predicted", "quality").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert sum(r["predicted"] != r["quality"] for r in held) <= 2


def test_a_repeated_labelled_id_is_learned_from_once(spark, monkeypatch):
    good, bad = _mixed()
    docs = documents(spark, good + bad + [(300, bad[0][1], "en")] * 300)
    fitted = []
    monkeypatch.setattr("filmloom.llm.quality.fit_shapes", lambda shapes, y: fitted.append(len(shapes)) or fit_shapes(shapes, y))
    rows = _judged(spark, docs, [(i, 1) for i, *_ in good] + [(i, 0) for i, *_ in bad]).collect()
    assert fitted == [120] and len(rows) == docs.count()


def _grams_by_hand(text):
    mixed = lambda code: (code * 0x9E3779B97F4A7C15 % 2**64) >> 48
    data = (text or "").encode().lower()
    codes = [crc32(w) for w in re.findall(rb"[0-9a-z\x80-\xff]+", data)]
    pairs = [a * 1_000_003 + b + (1 << 60) for a, b in zip(codes, codes[1:])]
    runs = [int.from_bytes(data[i : i + 4], "little") for i in range(len(data) - 3)]
    return sorted({mixed(c % 2**64) for c in codes + pairs} | {BUCKETS + mixed(r) for r in runs})


@pytest.mark.parametrize("text", [None, "", "a", "abc", "Abcd", "É ### été", prose(3), prose(4, n=900), "x" * 257])
@pytest.mark.parametrize("step", [16, 1 << 20])
def test_grams_equal_plain_loops_in_any_step(monkeypatch, text, step):
    monkeypatch.setattr(quality, "STEP_BYTES", step)
    assert grams(text).tolist() == _grams_by_hand(text)


def test_log_odds_of_buckets_equal_plain_counts(spark):
    rows = [(i % 2, i % 3 % 2, prose(i) if i % 5 else None) for i in range(40)]
    found = gram_odds(spark.createDataFrame(rows, "half int, good int, text string").repartition(3))
    for at, chosen in enumerate([[r for r in rows if r[0] == 0], [r for r in rows if r[0] == 1], rows]):
        held, kinds = [defaultdict(int), defaultdict(int)], [0, 0]
        for _, good, text in chosen:
            kinds[good] += 1
            for b in _grams_by_hand(text):
                held[good][b] += 1
        want = np.zeros(2 * BUCKETS)
        for b in held[0].keys() | held[1].keys():
            want[b] = np.log((held[1][b] + 1) / (kinds[1] + 2)) - np.log((held[0][b] + 1) / (kinds[0] + 2))
        assert np.allclose(found[at], want, atol=1e-6)


def test_texts_of_one_shape_are_told_apart_by_their_words(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("bcdfglmnprstaeiou", k=6)) for _ in range(400)]
    text = lambda pool: " ".join(rng.choices(pool, k=60))
    rows = [(i, text(words[:200] if i % 2 else words[200:]), "one", "site") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    found = _judged(spark, docs, [(i, i % 2) for i in range(200)]).collect()
    assert all((r["score"] > 0.5) == bool(r["doc_id"] % 2) for r in found if r["doc_id"] >= 200)


def test_posteriors_equal_grouped_sums_by_hand(spark):
    good, bad = _mixed()
    sites = [("a", "x"), ("a", "y"), (None, "x"), ("b", None), ("c", "x")]
    rows = [(i, t, *sites[i * i % 5 if n else i % 3]) for n, group in enumerate((good, bad)) for i, t, _ in group]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    labels = [(i, 1) for i, *_ in good[:45]] + [(i, 0) for i, *_ in bad[:45]]
    found = {r["doc_id"]: r for r in _judged(spark, docs, labels).collect()}
    p = {i: found[i]["evidence"] for i, *_ in rows}
    mean = sum(p.values()) / len(p)

    def grouped(place):
        groups = defaultdict(list)
        for row in rows:
            groups[place(row)].append(p[row[0]])
        return groups

    def prior(groups, above):
        between = (sum(len(g) * (np.mean(g) - above(k)) ** 2 for k, g in groups.items()) - len(groups) * within) / len(p)
        return np.clip(within / between if between > 0 else 1e6, 1, 1e6)

    paths, hosts = grouped(lambda r: (r[2], r[3])), grouped(lambda r: r[2])
    within = max(sum(((np.array(g) - np.mean(g)) ** 2).sum() for g in paths.values()) / len(p), 1e-9)
    k = prior(hosts, lambda _: mean)
    host = {h: (sum(g) + k * mean) / (len(g) + k) for h, g in hosts.items()}
    m = prior(paths, lambda site: host[site[0]])
    for i, _, h, path in rows:
        others = paths[h, path]
        assert found[i]["host_posterior"] == pytest.approx(host[h], abs=1e-9)
        assert found[i]["path_posterior"] == pytest.approx((sum(others) - p[i] + m * host[h]) / (len(others) - 1 + m), abs=1e-9)
