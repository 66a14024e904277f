"""Clause requests against a plain reading of the same documents."""

import random
import re

import pytest

from filmloom.operators import index as idx
from filmloom.operators.clauses import clause_search

FIELDS = (idx.Field("title", "plain"), idx.Field("text", "plain"), idx.Field("kind", "keyword"))
DDL = "request_id int, occur string, field string, text string, phrase boolean"


def _documents():
    rng = random.Random(4)
    some = lambda n: " ".join(rng.choice("abcde") for _ in range(rng.randint(1, n)))
    return [(i, some(3), some(12) if i % 8 else None, rng.choice(("x y", "z"))) for i in range(80)]


@pytest.fixture(scope="module")
def index(spark):
    return idx.build_index(spark.createDataFrame(_documents(), "id int, title string, text string, kind string"), FIELDS)


def _hits(doc, field, text, phrase):
    terms = (text or "").split()
    if not terms:
        return text is not None and text in (doc[3],) and field in (None, "kind")
    values = {"title": doc[1].split(), "text": (doc[2] or "").split()}
    found = field in (None, "kind") and text == doc[3]
    for name, held in values.items():
        if field in (None, name):
            if phrase:
                found |= any(held[i : i + len(terms)] == terms for i in range(len(held)))
            else:
                found |= bool(set(held) & set(terms))
    return found


def _brute(clauses):
    out = []
    for request in {c[0] for c in clauses}:
        own = {c[1:] for c in clauses if c[0] == request}
        own = {(o, f, t, bool(p)) for o, f, t, p in own}
        for doc in _documents():
            hit = {c: _hits(doc, *c[1:]) for c in own}
            count = lambda kind, hit=hit: sum(v for c, v in hit.items() if c[0] == kind)
            if count("must") == sum(c[0] == "must" for c in own) and not count("must_not") and count("must") + count("should"):
                out.append((request, doc[0], count("must") + count("should")))
    return sorted(out)


def _random_clauses():
    rng = random.Random(8)
    return [
        (request, rng.choice(("must", "should", "must_not")), rng.choice((None, "title", "text", "kind")),
         rng.choice(("a", "b c", "a b a", "x y", "z", "e e", "d c b a", "")), rng.choice((True, False, None)))
        for request in range(40) for _ in range(rng.randint(1, 3))
    ]


def test_any_mix_of_clauses_equals_a_plain_reading(spark, index):
    clauses = [*_random_clauses(), (90, "must", "text", "a b", True), (90, "must", "text", "a b", True), (91, "must_not", None, "a", False), (92, "should", None, None, True)]
    got = sorted(map(tuple, clause_search(spark.createDataFrame(clauses, DDL), index).collect()))
    assert got == _brute(clauses) and len(got) > 100
    assert {r for r, *_ in got}.isdisjoint({91, 92})


def test_unknown_fields_and_kinds_fail_by_name(spark, index):
    with pytest.raises(ValueError, match="no field 'titel'.*title, text, kind"):
        clause_search(spark.createDataFrame([(1, "must", "titel", "a", False)], DDL), index)
    with pytest.raises(ValueError, match="can't be 'perhaps'"):
        clause_search(spark.createDataFrame([(1, "perhaps", "title", "a", False)], DDL), index)


def test_no_requests(spark, index):
    assert clause_search(spark.createDataFrame([], DDL), index).collect() == []


def test_places_follow_the_order_of_the_text(spark, index):
    held = {(r["doc"], r["term"]): r["at"] for r in index.forward.filter("field = 'text'").collect()}
    for doc in _documents():
        for term in set(re.findall("[a-e]", doc[2] or "")):
            assert held[doc[0], term] == [i for i, t in enumerate(doc[2].split()) if t == term]
