"""Analysers, scoring against plain Python, fuzzy terms against all pairs."""

import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from filmloom.functions import text
from filmloom.functions.stem import ENGLISH, RUSSIAN, stemmed
from filmloom.operators import index as idx
from filmloom.operators import search as srch
from filmloom.operators.fuzzy import close_index_terms, close_terms, dictionary, edit_budget, fuzzy_matches, vocabulary_rests, within
from filmloom.queries.search import mixed_sql, stems_sql, tokens_sql


def analyse(spark, value, fn=text.mixed_terms):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("Don't stop, O’Neil's U.S.A. at 3.14 or 1,000!", ["don't", "stop", "o’neil's", "u.s.a", "at", "3.14", "or", "1,000"]),
        ("snake_case a.1 1.a x--y", ["snake_case", "a", "1", "1", "a", "x", "y"]),
        ("mail@host.example http://a.b/c?d=1", ["mail", "host.example", "http", "a.b", "c", "d", "1"]),
        ("Ärger ÉTÉ Фильм", ["ärger", "été", "фильм"]),
        ("", []),
        (None, []),
    ],
)
def test_plain_tokens(spark, value, want):
    assert analyse(spark, value, text.plain_terms) == want


def test_a_token_ends_at_255_characters(spark):
    assert [len(t) for t in analyse(spark, "x" * 600, text.plain_terms)] == [255, 255, 90]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("The films and the stories", ["film", "stori"]),
        ("classes buses glass bus gas goes", ["class", "buse", "glass", "bu", "ga", "goe"]),
        # The stem runs before the possessive rule and takes its "s".
        ("the dog's bone", ["dog'", "bone"]),
        ("и фильмы не книгами", ["фильм", "книг"]),
        ("not it will", []),
        (None, []),
    ],
)
def test_mixed_terms(spark, value, want):
    assert analyse(spark, value) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("日本語 ひらがな", list("日本語ひらがな")),
        ("カタカナとデータベース", ["カタカナ", "と", "データベース"]),
        ("abc日本x1", ["abc", "日", "本", "x1"]),
        ("ภาษาไทย 한국어 말", ["ภาษาไทย", "한국어", "말"]),
    ],
)
def test_scripts_without_blanks(spark, value, want):
    assert analyse(spark, value, text.plain_terms) == want
    assert duckdb.execute(f"SELECT {tokens_sql('t')} FROM (SELECT ? AS t)", [value]).fetchone()[0] == want


# Words with their stems as the algorithms are published with them.
PORTER = (
    "caresses>caress ponies>poni ties>ti cats>cat feed>feed agreed>agre plastered>plaster bled>bled motoring>motor sing>sing "
    "conflated>conflat troubled>troubl sized>size hopping>hop tanned>tan falling>fall hissing>hiss fizzed>fizz failing>fail "
    "filing>file happy>happi sky>sky relational>relat conditional>condit rational>ration valenci>valenc hesitanci>hesit "
    "digitizer>digit conformabli>conform radicalli>radic differentli>differ vileli>vile analogousli>analog "
    "vietnamization>vietnam predication>predic operator>oper feudalism>feudal decisiveness>decis hopefulness>hope "
    "callousness>callous formaliti>formal sensitiviti>sensit sensibiliti>sensibl triplicate>triplic formative>form "
    "formalize>formal electriciti>electr electrical>electr hopeful>hope goodness>good revival>reviv allowance>allow "
    "inference>infer airliner>airlin gyroscopic>gyroscop adjustable>adjust defensible>defens irritant>irrit "
    "replacement>replac adjustment>adjust dependent>depend adoption>adopt homologou>homolog communism>commun "
    "activate>activ angulariti>angular homologous>homolog effective>effect bowdlerize>bowdler probate>probat rate>rate "
    "cease>ceas controll>control roll>roll generalizations>gener oscillators>oscil us>us ay>ay ays>ai enjoy>enjoi cement>cement"
)
SNOWBALL = (
    "вавиловка>вавиловк вагнера>вагнер вагоне>вагон вагонов>вагон вагоном>вагон вагоны>вагон важная>важн важнее>важн "
    "важнейшие>важн важнейшими>важн важничал>важнича важного>важн важность>важност павлиний>павлин павильонам>павильон "
    "падает>пада падай>пада падал>пада падать>пада падают>пада падшего>падш падшую>падш книгами>книг фильмы>фильм "
    "сделав>сдела смотревшись>смотревш ёлки>елк радостью>радост длинный>длин дав>дав"
)


@pytest.mark.parametrize(("stemmer", "pairs"), [(ENGLISH, PORTER), (RUSSIAN, SNOWBALL)])
def test_stems_of_published_words(spark, stemmer, pairs):
    words, want = zip(*(pair.split(">") for pair in pairs.split()), strict=True)
    found = spark.createDataFrame([(list(words),)], "w array<string>").select(stemmed(F.col("w"), stemmer)).first()[0]
    assert found == list(want)
    assert duckdb.execute(f"SELECT {stems_sql('w', stemmer)} FROM (SELECT ? AS w)", [list(words)]).fetchone()[0] == list(want)


def test_a_stemmer_leaves_the_other_script_alone(spark):
    words = ["вагонами", "ñandú", "x1", "1977", "", "日"]
    frame = spark.createDataFrame([(words,), (None,), ([],)], "w array<string>")
    assert [r[0] for r in frame.select(stemmed(F.col("w"), ENGLISH)).collect()] == [words, None, []]
    latin = ["wagons", "x1", "", "日"]
    assert spark.createDataFrame([(latin,)], "w array<string>").select(stemmed(F.col("w"), RUSSIAN)).first()[0] == latin


def test_stems_meet_in_a_mixed_text(spark):
    value = "Вагоны, ВАГОНОВ и вагоном: the relational adoption's of Ёлки"
    want = ["вагон", "вагон", "вагон", "relat", "adoption'", "елк"]
    assert analyse(spark, value) == want
    assert duckdb.execute(f"SELECT {mixed_sql('t')} FROM (SELECT ? AS t)", [value]).fetchone()[0] == want


def test_unescape(spark):
    assert analyse(spark, "N\\A a\\\\b", text.unescape) == "NA a\\b"


DOCS = [
    (1, "star wars", "a long story of stars", ["Ann Lee", "Bob Ray"], ["drama"]),
    (2, "the war", "star star star", [], ["war", "drama"]),
    (3, "quiet film", None, ["Lee Star"], []),
    (4, None, "nothing here at all " * 20, ["Zed"], ["comedy"]),
]
QUERIES = ["star", "stars lee", "war", "drama", "star star", "the", "comedy zed film", "absent"]
FIELDS = (idx.Field("title"), idx.Field("description"), idx.Field("names"), idx.Field("kinds", "keyword"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, title string, description string, names array<string>, kinds array<string>")


@pytest.fixture(scope="module")
def index(docs):
    return idx.build_index(docs, FIELDS)


@pytest.fixture(scope="module")
def terms(spark):
    """Analysed terms of every text used below, in one job."""
    values = {v for d in DOCS for v in (d[1], d[2], *d[3])} | set(QUERIES)
    frame = spark.createDataFrame([(v,) for v in values if v is not None], "t string")
    known = {r["t"]: r["terms"] for r in frame.select("t", text.mixed_terms(F.col("t")).alias("terms")).collect()}
    return lambda value: known.get(value, [])


def brute_scores(terms, query):
    fields = {
        "title": {d[0]: terms(d[1]) for d in DOCS},
        "description": {d[0]: terms(d[2]) for d in DOCS},
        "names": {d[0]: [t for n in d[3] for t in terms(n)] for d in DOCS},
    }
    best = {}
    for held in fields.values():
        held = {k: v for k, v in held.items() if v}
        mean = sum(map(len, held.values())) / len(held)
        for doc, have in held.items():
            total = 0.0
            for t in terms(query):
                df = sum(t in v for v in held.values())
                tf = have.count(t)
                if tf:
                    total += math.log(1 + (len(held) - df + 0.5) / (df + 0.5)) * 2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * len(have) / mean))
            if total:
                best[doc] = max(best.get(doc, 0), round(total, 6))
    kinds = {d[0]: set(d[4]) for d in DOCS if d[4]}
    df = sum(query in v for v in kinds.values())
    for doc, have in kinds.items():
        if query in have:
            best[doc] = max(best.get(doc, 0), round(math.log(1 + (len(kinds) - df + 0.5) / (df + 0.5)), 6))
    return best


def test_scores_equal_plain_python_alone_and_in_a_batch(spark, index, terms):
    frame = spark.createDataFrame([(q,) for q in [*QUERIES, None]], "query string")
    got = srch.score(frame, index).join(frame.select("query", srch.query_key()), "query_key").collect()
    for q in QUERIES:
        batch = {r["doc"]: r["score"] for r in got if r["query"] == q}
        assert batch == pytest.approx(brute_scores(terms, q), abs=2e-6), q
    alone = srch.score(frame.filter("query = 'stars lee'"), index).collect()
    assert {r["doc"]: r["score"] for r in alone} == {r["doc"]: r["score"] for r in got if r["query"] == "stars lee"}


def test_hot_terms_are_salted_to_the_same_hits(spark, index, monkeypatch):
    frame = spark.createDataFrame([(q,) for q in QUERIES], "query string")
    rows = lambda: sorted(map(tuple, srch.score(frame, index).collect()))
    plain = rows()
    monkeypatch.setattr(srch, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(srch, "HOT_ROWS", 1)
    assert rows() == plain


def test_a_written_index_answers_alike(spark, docs, index, folder):
    frame = spark.createDataFrame([(q,) for q in QUERIES], "query string")
    idx.write_index(docs, FIELDS, folder, buckets=8)
    opened = idx.open_index(spark, folder, FIELDS)
    assert sorted(map(tuple, srch.score(frame, opened).collect())) == sorted(map(tuple, srch.score(frame, index).collect()))
    plan = srch.term_hits(opened, srch.weighted_terms(frame, opened))._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan


def test_exact_and_nested(spark, docs):
    """Documents by a member: the whole name, or a term of it."""
    links = lambda c: docs.select(F.col("id").alias("doc"), F.explode(c).alias("id"))
    members = lambda c: docs.select(F.explode(c).alias("id")).distinct().select("id", F.col("id").alias("name"))
    asked = spark.createDataFrame([("drama",), ("dram",), (None,)], "query string")
    found = srch.member_matches(asked, members("kinds"), links("kinds"), idx.Field("name"), analysed=False)
    assert sorted(map(tuple, found.collect())) == [("drama", 1), ("drama", 2)]
    people = spark.createDataFrame([("Lee Camp",)], "query string")
    found = srch.member_matches(people, members("names"), links("names"), idx.Field("name"))
    assert sorted(r["doc"] for r in found.collect()) == [1, 3]


def osa_all(a, b):
    """Edit distance with swaps of neighbours, by the textbook table."""
    last, table = {}, {(-1, -1): len(a) + len(b)}
    for i in range(len(a) + 1):
        table[i, -1], table[i, 0] = len(a) + len(b), i
    for j in range(len(b) + 1):
        table[-1, j], table[0, j] = len(a) + len(b), j
    for i in range(1, len(a) + 1):
        row = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), row
            cost = int(a[i - 1] != b[j - 1])
            if not cost:
                row = j
            table[i, j] = min(
                table[i - 1, j - 1] + cost, table[i, j - 1] + 1, table[i - 1, j] + 1,
                table[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1),
            )
        last[a[i - 1]] = i
    return table[len(a), len(b)]


def budget(term):
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(5)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 11))) for _ in range(500)}
    long = ["prefixed" + "".join(rng.choice("abc") for _ in range(6)) for _ in range(60)]
    return sorted(words | set(long) | {"camp", "cmap", "damp", "camps", "caamp", "ac", "ca", "abc"})


def test_close_terms_equal_all_pairs(spark, vocabulary):
    asked = vocabulary[::4] + ["camp", "cmap", "ca", "abc"]
    got = close_terms(
        spark.createDataFrame([(a,) for a in asked], "asked string"),
        vocabulary_rests(spark.createDataFrame([(v,) for v in vocabulary], "term string")),
    )
    want = {(a, v) for a in set(asked) for v in vocabulary if osa_all(a, v) <= budget(a)}
    assert {tuple(r) for r in got.collect()} == want


def test_distance_predicate_equals_the_table(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(0, 7)))
    pairs = [(word(), word(), d) for d in (0, 1, 2) for _ in range(400)]
    frame = spark.createDataFrame(pairs, "a string, b string, d int")
    for r in frame.withColumn("ok", within(F.col("a"), F.col("b"), F.col("d"))).collect():
        assert bool(r["ok"]) == (osa_all(r["a"], r["b"]) <= r["d"]), tuple(r)


def test_edit_budget(spark):
    frame = spark.createDataFrame([("ab", 0), ("abc", 1), ("abcde", 1), ("abcdef", 2)], "t string, want int")
    assert all(r["got"] == r["want"] for r in frame.withColumn("got", edit_budget(F.col("t"))).collect())


def test_fuzzy_search_finds_a_swapped_name(spark):
    docs = spark.createDataFrame([(1, "Greg Camp"), (2, "boot damp"), (3, "Cmap"), (4, "campus"), (5, "cost"), (6, "campaign")], "id int, title string")
    frame = spark.createDataFrame([("camp",)], "query string")
    found = fuzzy_matches(frame, idx.build_index(docs, (idx.Field("title"),)))
    # The stem of campus is campu, one letter from camp.
    assert sorted(r["doc"] for r in found.collect()) == [1, 2, 3, 4]
    assert re.match("^[0-9a-f]{32}$", found.first()["query_key"])


def test_close_index_terms_equal_all_pairs(spark, vocabulary):
    """Over two generations, with terms that share their first seven characters or are asked for at other lengths."""
    ends = ["", "x", "xy", "yx", "xyz"]
    held = sorted({*vocabulary, "", *("abcabca" + e for e in ends)})
    docs = spark.createDataFrame(list(enumerate(held)), "id int, title string")
    index = idx.build_index(docs.filter("id % 3 <> 0"), (idx.Field("title", "keyword"),)).update(docs.filter("id % 3 = 0"))
    asked = [*vocabulary[::5], "", "ca", "abcabc", "abcacba", "bacabcaxy", "prefixed"]
    got = close_index_terms(spark.createDataFrame([(a,) for a in [*asked, None]], "asked string"), index)
    want = sorted((a, v) for a in set(asked) for v in held if osa_all(a, v) <= budget(a))
    assert sorted(map(tuple, got.collect())) == want and len(index.gens) == 2


def test_terms_that_share_a_beginning_are_expanded_once(spark):
    docs = spark.createDataFrame([(i, f"prefixed{i}") for i in range(300)], "id int, title string")
    words, rests = dictionary(idx.build_index(docs, (idx.Field("title", "keyword"),)))
    assert words.count() == 300
    # Once as a whole, and without one or two of seven characters, of which two may be the same.
    assert rests.select("prefix").distinct().count() == 1 and rests.count() == rests.distinct().count() <= 1 + 7 + 21


def test_common_runs_are_read_as_by_the_plain_pattern(spark):
    import random

    plain = text.TOKEN[text.TOKEN.index(f"[{text.SINGLE}]") : -1]
    rng, parts = random.Random(1), [*"ab1_é'’.,;:· -ñя́あア漢ー²ßÿ÷*\n\x00٣", "a" * 120, "7" * 254, "я" * 255]
    rows = spark.createDataFrame([("".join(rng.choices(parts, k=rng.randint(0, 30))),) for _ in range(5000)], "t string")
    found = lambda pattern: F.regexp_extract_all("t", F.lit(pattern), F.lit(0))
    assert rows.filter(~found(plain).eqNullSafe(found(text.TOKEN))).count() == 0 and "++(?!" not in plain and "}+(?!" in text.TOKEN
