import random

import numpy as np
import pytest
import xxhash
from edges import CLASHING, as_set, documents, empty, prose

from filmloom.llm import simhash
from filmloom.llm.components import components
from filmloom.llm.simhash import block_count, fingerprint, keys_of, near_duplicates, near_links, within, without_duplicates


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> i & 1 for h in hashes) > len(hashes)) << i for i in range(64))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def family(rng, centre, n, bits):
    return [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits))) for _ in range(n)]


def signed(fps):
    return [f - (1 << 64) if f >> 63 else f for f in fps]


def frame(spark, fps):
    return spark.createDataFrame([(f,) for f in signed(sorted(set(fps)))], "fp bigint")


@pytest.mark.parametrize("text", ["", None, " \n", "a", "A b", "One two THREE", prose(3), "É é\x1cx  y\tz\x0bq", prose(4, n=400)])
def test_fingerprint(text):
    assert fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 7])
def test_bit_sliced_distances(radius):
    rng = random.Random(radius)
    fps = np.array([f for _ in range(9) for f in family(rng, rng.getrandbits(64), 15, 8)], np.uint64)
    q, p = within(fps[:77], fps[40:], radius)
    a, b = np.nonzero(np.bitwise_count(fps[:77, None] ^ fps[None, 40:]) <= radius)
    assert sorted(zip(q, p, strict=True)) == sorted(zip(a, b, strict=True))
    far = np.array([0], np.uint64), np.array([2**64 - 1], np.uint64)
    assert len(within(*far, radius)[0]) == 0


def test_pairs_in_the_radius_share_a_key(spark):
    rng = random.Random(5)
    for blocks in (4, 5, 6, 8):
        a = rng.getrandbits(63)
        b = a ^ sum(1 << x for x in rng.sample(range(63), 3))
        rows = spark.createDataFrame([(a,), (b,)], "fp bigint").select(*[k.alias(f"k{i}") for i, k in enumerate(keys_of(blocks))]).collect()
        assert any(x == y for x, y in zip(rows[0], rows[1], strict=True))
    assert block_count(1000) == 4 and block_count(10**7) == 5 and block_count(10**12) == 7


@pytest.mark.parametrize("group", [simhash.GROUP, 32])
def test_links_join_what_all_pairs_join(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = random.Random(7)
    fps = [f for n in (900, 60, 5) for f in family(rng, rng.getrandbits(64), n, 4)] + [rng.getrandbits(64) for _ in range(300)]
    fps = sorted(set(fps))
    array = np.array(fps, np.uint64)
    pairs = [(fps[i], fps[j + i + 1]) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= 3)]
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in near_links(frame(spark, fps)).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in found)
    assert brute_components(fps, found) == brute_components(fps, pairs)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(150)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5000, 5000), (6000, 6001), (6001, 6000)]
    found = components(spark.createDataFrame(edges + [(None, 4)], "a bigint, b bigint")).collect()
    root = {r["node"]: r["root"] for r in found}
    assert len(root) == len(found)
    want = brute_components({x for e in edges for x in e if x != 5000}, [e for e in edges if 5000 not in e])
    assert {tuple(sorted(n for n in root if root[n] == r)) for r in root.values()} == {tuple(sorted(n for n in want if want[n] == r)) for r in want.values()}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def _copies():
    """Texts of one thousand words, one word of which is changed: fingerprints of few differing bits."""
    out = []
    for k in range(4):
        words = prose(50 + k, "en", 4000).split()
        for j in range(8):
            own = list(words)
            own[j * 7] = f"changed{j}"
            out.append((100 + 10 * k + j, " ".join(own), "en"))
    return out


def test_documents_against_brute_force(spark):
    docs = documents(spark, _copies())
    got = near_duplicates(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    fps = {(r["doc_id"], r["text"]): fingerprint(r["text"]) for r in rows}
    nodes = sorted(set(fps.values()))
    comp = brute_components(nodes, [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if (a ^ b).bit_count() <= 3])
    least = {}
    for (i, _), f in fps.items():
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    want = sorted(repr((r["doc_id"], f, least.get(comp[f]))) for r in rows for f in [fps[r["doc_id"], r["text"]]])
    assert sorted(repr((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"])) for r in got) == want
    assert len(nodes) > len(set(comp.values()))  # some differ and are linked

    kept = without_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(str(least.get(c)) for c in set(comp.values()))
    assert {c for c in CLASHING} <= set(kept.columns)


def test_empty_tables(spark):
    assert as_set(near_duplicates(empty(spark))) == [] and as_set(without_duplicates(empty(spark))) == []
