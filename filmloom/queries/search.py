"""Text analysis, index, relevance and fuzzy search."""

from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from filmloom.catalog import documents_catalog, orders_catalog, read_table
from filmloom.functions import text
from filmloom.functions.stem import ENGLISH, RUSSIAN, Swap
from filmloom.operators import index as idx
from filmloom.operators import search as srch
from filmloom.operators.clauses import clause_search
from filmloom.operators.fuzzy import fuzzy_matches
from filmloom.operators.paging import pages_for, result_order
from filmloom.operators.skew import skew_join
from filmloom.plans.documents import film_documents, genre_pairs
from filmloom.queries.registry import DOCUMENTS_SQL, DOCUMENT_FROM_SQL, ORDERS_SQL, members_sql, query, snapshot
from filmloom.session import materialise, scratch_path, scratch_root, short_lived

TEXT = (idx.Field("text"),)
SEP = ""


def tokens_sql(value: str) -> str:
    """Tokens, with the marks that stay inside a token fenced by a private character."""
    inner = rf"regexp_replace(lower({value}), '([\p{{Han}}\p{{Hiragana}}]\p{{M}}*|[\p{{Katakana}}ー][\p{{Katakana}}ー\p{{M}}]*)', ' \1 ', 'g')"
    for left, marks, right in (
        (r"[\p{L}\p{M}]", "''’‘.:·", r"\p{L}"),
        (r"\p{N}", "''’‘.,;", r"\p{N}"),
    ):
        for _ in range(2):
            inner = f"regexp_replace({inner}, '({left})([{marks}])({right})', '\\1{SEP}\\2{SEP}\\3', 'g')"
    found = rf"regexp_extract_all({inner}, '(?:[\p{{L}}\p{{M}}\p{{N}}_]|{SEP}[^{SEP}]{SEP})+')"
    return f"[replace(x, '{SEP}', '') for x in coalesce({found}, [])]"


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in text.ENGLISH_STOP) + "]"
RUSSIAN_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in text.RUSSIAN_STOP) + "]"
POSSESSIVE_SQL = "CASE WHEN ends_with(t, '''s') OR ends_with(t, '’s') THEN left(t, length(t) - 2) ELSE t END"


def step_sql(step) -> str:
    """A step of a stemmer over the token ``t``."""
    if isinstance(step, Swap):
        return f"regexp_replace(t, '{step.pattern}', '{step.put}', 'g')"
    cases = []
    for rule in step.rules:
        before = f"left(t, length(t) - {len(rule.suffix)})"
        fits = f"regexp_matches({before}, '{rule.before}')" if rule.before else "true"
        put = f"{before} || '{rule.put}'"
        if step.strict:
            cases.append(f"WHEN ends_with(t, '{rule.suffix}') THEN CASE WHEN {fits} THEN {put} ELSE t END")
        else:
            cases.append(f"WHEN ends_with(t, '{rule.suffix}') AND {fits} THEN {put}")
    other = f"WHEN t < '{step.script[0]}' OR t >= '{step.script[1]}' THEN t" if step.script else ""
    return f"CASE {other} {' '.join(cases)} ELSE t END"


def stems_sql(tokens: str, stemmer) -> str:
    for step in stemmer:
        tokens = f"[{step_sql(step)} for t in {tokens}]"
    return tokens


def mixed_sql(value: str) -> str:
    """Terms of mixed text."""
    english = stems_sql(f"[t for t in {tokens_sql(value)} if NOT list_contains({STOP_SQL}, t)]", ENGLISH)
    kept = f"[t for t in [{POSSESSIVE_SQL} for t in {english}] if NOT list_contains({RUSSIAN_STOP_SQL}, t)]"
    return stems_sql(kept, RUSSIAN)


def score_ctes(fields: list[tuple[str, str, str]], docs: str, queries: str) -> str:
    """CTEs ending in ``scored(query, doc, score)``.

    ``fields``: name, kind, SQL list of terms over a row of ``docs`` (which has ``id``).
    ``queries``: relation with ``query``.
    """
    exact = ", ".join(f"'{name}'" for name, kind, _ in fields if kind == "keyword") or "''"
    long = " UNION ALL ".join(f"SELECT id AS doc, '{name}' AS field, {terms} AS terms FROM {docs}" for name, _, terms in fields)
    analysed = {"mixed": mixed_sql("query"), "plain": tokens_sql("query"), "keyword": "[query]"}
    asked = " UNION ALL ".join(
        f"SELECT query, '{name}' AS field, unnest({analysed[kind]}) AS term FROM (SELECT DISTINCT query FROM {queries})"
        for name, kind, _ in fields
    )
    return f"""
long_form AS ({long}),
postings AS (
  SELECT doc, field, dl, term, count(*) AS tf
  FROM (SELECT doc, field, len(terms) AS dl, unnest(terms) AS term FROM long_form) GROUP BY ALL),
stats AS (SELECT field, count(*) AS docs, avg(dl) AS avg_dl FROM (SELECT DISTINCT doc, field, dl FROM postings) GROUP BY field),
dfs AS (SELECT field, term, count(*) AS df FROM postings GROUP BY field, term),
asked AS (SELECT query, field, term, count(*) AS times FROM ({asked}) GROUP BY ALL),
by_field AS (
  SELECT query, doc, field, sum(CAST(floor(times * ln(1 + (docs - df + 0.5e0) / (df + 0.5e0)) *
    CASE WHEN field IN ({exact}) THEN 1e0 ELSE 2.2e0 * tf / (tf + 1.2e0 * (0.25e0 + 0.75e0 * dl / avg_dl)) END * 4294967296e0 + 0.5e0) AS BIGINT)) AS s
  FROM asked JOIN postings USING (field, term) JOIN dfs USING (field, term) JOIN stats USING (field) GROUP BY ALL),
scored AS (SELECT query, doc, CAST(max(s) AS BIGINT) / 4294967296e0 AS score FROM by_field GROUP BY query, doc)"""


TEXT_FIELDS_SQL = [("text", "mixed", mixed_sql("text"))]
TEXT_DOCS_SQL = "(SELECT doc_id AS id, text FROM documents)"
FILM_FIELDS_SQL = [
    ("title", "mixed", mixed_sql("title")),
    ("description", "mixed", mixed_sql("description")),
    *[(f"{r}_names", "mixed", mixed_sql(f"array_to_string({r}_names, ' ')")) for r in ("actors", "directors", "writers")],
    ("genres_names", "keyword", "coalesce(genres_names, [])"),
    ("id", "keyword", "[CAST(id AS VARCHAR)]"),
    ("title_raw", "keyword", "[title]"),
    # The rating matches a query that is a number; no text here is one.
]
FILM_DOCS_SQL = f"""{DOCUMENTS_SQL}, {members_sql()},
film_docs AS (
  SELECT f.id, f.title, f.description, f.rating, actors_names, directors_names, writers_names, genres_names {DOCUMENT_FROM_SQL})"""


def corpus(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def benchmark(spark, sf_dir):
    return read_table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("query"))


def text_films(spark, sf_dir):
    """Film documents over the text corpus."""
    return film_documents(documents_catalog(spark, sf_dir))


def _named(found, queries):
    """Results by query text instead of its key."""
    texts = queries.select("query").distinct().select("query", srch.query_key())
    return found.join(texts, "query_key").drop("query_key")


BUCKETS = 4


def kept_index(spark, sf_dir, name, docs, fields, tables):
    """The index of a corpus: written by the first query that asks, opened by all after it while its files stay the same.

    ``docs`` makes the documents from ``tables``, and is called for the first only.
    """
    path = f"{scratch_root(spark)}/index-{name}-{spark.sparkContext.applicationId}-{snapshot(spark, sf_dir, tables)}"
    try:
        return idx.open_index(spark, path, fields)
    except AnalysisException:
        with short_lived(spark):
            made = docs(spark, sf_dir)
            return idx.write_index(made, fields, path, buckets=BUCKETS)


def text_index(spark, sf_dir):
    return kept_index(spark, sf_dir, "text", corpus, TEXT, ["documents"])


def film_index(spark, sf_dir):
    return kept_index(spark, sf_dir, "films", text_films, idx.FILM_FIELDS, ["documents", "lineitem", "part", "supplier"])


def customers(spark, sf_dir):
    return read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def people_index(spark, sf_dir):
    return kept_index(spark, sf_dir, "people", customers, idx.PERSON_FIELDS, ["customer"])


def _top(found, size, *order, of="query"):
    """The first documents of each query; every task keeps so many before it hands them on."""
    rank = F.row_number().over(Window.partitionBy(of).orderBy(*order, "doc"))
    return found.withColumn("_rank", rank).filter(F.col("_rank") <= size).drop("_rank")


def _item_page(requests, index, number, size):
    """One page of the documents of each benchmark item, best first; items may share a text."""
    scored = srch.top_scores(requests.select("query", F.lit(number * size).alias("k")), index)
    asked = requests.select(F.col("item_id").alias("request_id"), srch.query_key(), F.lit(number).alias("page_number"), F.lit(size).alias("page_size"))
    pages = pages_for(asked, scored.withColumnRenamed("doc", "id"), result_order(score="score"), ["query_key"])
    return pages.select(F.col("request_id").alias("item_id"), F.col("place").cast("bigint").alias("place"), F.col("id").alias("doc"), F.round("score", 6).alias("score"))


def ranked_sql(where, source="scored"):
    return f"ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS place FROM {source} {where})"


@query("x1_mixed_analyser", f"SELECT doc_id, array_to_string({mixed_sql('text')}, ' ') AS terms FROM documents")
def x1_mixed_analyser(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(text.mixed_terms(F.col("text")), " ").alias("terms"))


@query("x2_plain_analyser", f"SELECT conv_id, turn, array_to_string({tokens_sql('text')}, ' ') AS terms FROM conversations")
def x2_plain_analyser(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", F.array_join(text.plain_terms(F.col("text")), " ").alias("terms"))


@query(
    "x3_postings",
    f"""SELECT doc, term, dl, count(*) AS tf FROM (
  SELECT doc_id AS doc, len(terms) AS dl, unnest(terms) AS term FROM (SELECT doc_id, {mixed_sql('text')} AS terms FROM documents))
GROUP BY ALL""",
)
def x3_postings(spark, sf_dir):
    index = text_index(spark, sf_dir)
    return index.postings.select("doc", "term", F.col("dl").cast("bigint").alias("dl"), "tf")


@query(
    "x3_vocabulary",
    f"""WITH {score_ctes(TEXT_FIELDS_SQL, TEXT_DOCS_SQL, "(SELECT text AS query FROM benchmark)")}
SELECT field, term, df, docs, round(avg_dl, 6) AS avg_dl FROM dfs JOIN stats USING (field)""",
)
def x3_vocabulary(spark, sf_dir):
    index = text_index(spark, sf_dir)
    joined = index.vocabulary.join(F.broadcast(index.stats), "field")
    return joined.select("field", "term", "df", "docs", F.round("avg_dl", 6).alias("avg_dl"))


CHANGED_TEXT_SQL = "CASE WHEN doc_id % 7 = 0 THEN source || ' ' || text ELSE text END"
CHANGED_DOCS_SQL = f"(SELECT doc_id AS id, {CHANGED_TEXT_SQL} AS text FROM documents WHERE doc_id % 11 <> 0 OR doc_id % 7 = 0)"


def changed_index(spark, sf_dir):
    """An index of two documents in three; then the others are added, some replaced and some taken out."""
    docs = corpus(spark, sf_dir)
    index = idx.write_index(docs.filter("id % 3 <> 0"), TEXT, scratch_path(spark, "index-changing"), buckets=BUCKETS)
    index = index.update(docs.filter("id % 3 = 0"))
    longer = read_table(spark, sf_dir, "documents").filter("doc_id % 7 = 0").select(F.col("doc_id").alias("id"), F.concat_ws(" ", "source", "text").alias("text"))
    return index.update(longer, docs.filter("id % 11 = 0 AND id % 7 <> 0"))


@query(
    "x3_incremental_index",
    f"""WITH {score_ctes([("text", "mixed", mixed_sql("text"))], CHANGED_DOCS_SQL, "(SELECT text AS query FROM benchmark)")}
SELECT field, term, df, docs, round(avg_dl, 6) AS avg_dl FROM dfs JOIN stats USING (field)""",
)
def x3_incremental_index(spark, sf_dir):
    index = changed_index(spark, sf_dir)
    return index.vocabulary.join(F.broadcast(index.stats), "field").select("field", "term", "df", "docs", F.round("avg_dl", 6).alias("avg_dl"))


@query(
    "x6_search_after_changes",
    f"""WITH {score_ctes(TEXT_FIELDS_SQL, CHANGED_DOCS_SQL, "(SELECT text AS query FROM benchmark)")}, {ranked_sql("")}
SELECT item_id, place, doc, round(score, 6) AS score FROM benchmark JOIN ranked ON query = text WHERE place <= 10""",
)
def x6_search_after_changes(spark, sf_dir):
    return _item_page(benchmark(spark, sf_dir), changed_index(spark, sf_dir), 1, 10)


# Three words of an item.
SHORT_SQL = "(SELECT item_id, array_to_string(string_split(text, ' ')[3:5], ' ') AS query FROM benchmark)"


@query(
    "x6_short_texts",
    f"""WITH {score_ctes(TEXT_FIELDS_SQL, TEXT_DOCS_SQL, SHORT_SQL)}, {ranked_sql("")}
SELECT item_id, place, doc, round(score, 6) AS score FROM {SHORT_SQL} b JOIN ranked USING (query) WHERE place <= 10""",
)
def x6_short_texts(spark, sf_dir):
    queries = benchmark(spark, sf_dir).withColumn("query", F.array_join(F.slice(F.split("query", " "), 3, 3), " "))
    return _item_page(queries, text_index(spark, sf_dir), 1, 10)


@query(
    "x4_multi_field_match",
    f"""WITH {FILM_DOCS_SQL}, {score_ctes(FILM_FIELDS_SQL, "film_docs", "(SELECT text AS query FROM benchmark)")}, {ranked_sql("")}
SELECT item_id, place - 50 AS place, doc, round(score, 6) AS score FROM benchmark JOIN ranked ON query = text WHERE place > 50 AND place <= 100""",
)
def x4_multi_field_match(spark, sf_dir):
    queries = benchmark(spark, sf_dir)
    return _item_page(queries, film_index(spark, sf_dir), 2, 50)


@query(
    "x5_single_field_match",
    f"""WITH {score_ctes([("name", "plain", tokens_sql("name"))], "(SELECT c_custkey AS id, c_name AS name FROM customer)", "(SELECT s_name AS query FROM supplier)")},
{ranked_sql("")} SELECT query, doc, round(score, 6) AS score FROM ranked WHERE place <= 20""",
)
def x5_single_field_match(spark, sf_dir):
    queries = read_table(spark, sf_dir, "supplier").select(F.col("s_name").alias("query"))
    scored = _named(srch.top_scores(queries.withColumn("k", F.lit(20)), people_index(spark, sf_dir)), queries)
    return _top(scored, 20, F.desc("score")).select("query", "doc", F.round("score", 6).alias("score"))


@query(
    "x6_relevance_order",
    f"""WITH {score_ctes(TEXT_FIELDS_SQL, TEXT_DOCS_SQL, "(SELECT text AS query FROM benchmark)")}, {ranked_sql("")}
SELECT item_id, place, doc, round(score, 6) AS score FROM benchmark JOIN ranked ON query = text WHERE place <= 10""",
)
def x6_relevance_order(spark, sf_dir):
    queries = benchmark(spark, sf_dir)
    return _item_page(queries, text_index(spark, sf_dir), 1, 10)


# One byte for each character, as the distance there counts bytes.
FOLD_SQL = "translate({}, 'èéßêçíöüóäñ', '#$%&*+-/<=>')"


@query(
    "x7_fuzzy_match",
    f"""WITH t AS (SELECT doc_id AS doc, unnest({mixed_sql('text')}) AS term FROM documents),
p AS (SELECT DISTINCT doc, term FROM t),
v AS (SELECT DISTINCT term FROM p),
q AS (SELECT DISTINCT p_name AS query, unnest({mixed_sql('p_name')}) AS asked FROM part),
a AS (SELECT DISTINCT asked, CASE WHEN length(asked) <= 2 THEN 0 WHEN length(asked) <= 5 THEN 1 ELSE 2 END AS budget FROM q),
c AS (SELECT asked, term FROM a JOIN v ON abs(length(term) - length(asked)) <= budget
      AND damerau_levenshtein({FOLD_SQL.format('term')}, {FOLD_SQL.format('asked')}) <= budget)
SELECT query, doc FROM (SELECT DISTINCT query, doc FROM q JOIN c USING (asked) JOIN p USING (term))
QUALIFY row_number() OVER (PARTITION BY query ORDER BY doc) <= 20""",
)
def x7_fuzzy_match(spark, sf_dir):
    queries = read_table(spark, sf_dir, "part").select(F.col("p_name").alias("query"))
    found = fuzzy_matches(queries, text_index(spark, sf_dir))
    return _named(_top(found, 20, of="query_key"), queries).select("query", "doc")


@query(
    "x8_nested_match",
    f"""WITH {ORDERS_SQL}, q AS (SELECT DISTINCT lpad(CAST(user_id AS VARCHAR), 9, '0') AS query FROM events)
SELECT DISTINCT query, film_work_id AS doc FROM q JOIN person ON full_name = 'Supplier#' || query
JOIN person_film ON person_id = person.id AND role = 'actor'""",
)
def x8_nested_match(spark, sf_dir):
    queries = read_table(spark, sf_dir, "events").select(F.lpad(F.col("user_id").cast("string"), 9, "0").alias("query"))
    cat = orders_catalog(spark, sf_dir)
    people = cat.person.select("id", F.col("full_name").alias("name"))
    links = cat.person_film.filter("role = 'actor'").select(F.col("film_work_id").alias("doc"), F.col("person_id").alias("id"))
    found = srch.member_matches(queries, people, links, idx.Field("name"))
    return found.join(cat.film.select(F.col("id").alias("doc")), "doc", "left_semi").select("query", "doc")


@query(
    "x9_query_string",
    f"""WITH q AS (SELECT DISTINCT text AS query, unnest({mixed_sql('text')}) AS term FROM benchmark),
p AS (SELECT DISTINCT doc_id AS doc, unnest({mixed_sql('text')}) AS term FROM documents)
SELECT query, count(DISTINCT doc) AS hits FROM q JOIN p USING (term) GROUP BY query""",
)
def x9_query_string(spark, sf_dir):
    escaped = benchmark(spark, sf_dir).select(F.regexp_replace("query", "([.,+-])", r"\\$1").alias("query"))
    queries = escaped.select(text.unescape(F.col("query")).alias("query"))
    found = srch.matches(queries, text_index(spark, sf_dir))
    return _named(found.groupBy("query_key").agg(F.count("*").alias("hits")), queries)


# Of each item: a phrase of two words that must be there, one word that may, and one that may not.
CLAUSES_SQL = f"""WITH i AS (SELECT item_id, string_split(text, ' ') AS w FROM benchmark),
q AS (SELECT item_id, {mixed_sql("array_to_string(w[3:4], ' ')")} AS phrase, {mixed_sql("w[6]")} AS may, {mixed_sql("w[9]")} AS never FROM i),
d AS (SELECT doc_id AS doc, {mixed_sql("text")} AS terms FROM documents),
f AS (
  SELECT item_id, doc, terms, may, never FROM q JOIN d ON len(phrase) > 0 AND list_has_all(terms, phrase)
  WHERE len(list_filter(range(1, len(terms) + 1), lambda x: terms[x : x + len(phrase) - 1] = phrase)) > 0)
SELECT item_id AS request_id, doc, CAST(1 + CASE WHEN list_has_any(terms, may) THEN 1 ELSE 0 END AS BIGINT) AS hits
FROM f WHERE NOT list_has_any(terms, never)"""


@query("x9_clauses", CLAUSES_SQL)
def x9_clauses(spark, sf_dir):
    words = F.split("text", " ")
    items = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("request_id"), words.alias("w"))
    clause = lambda occur, text, phrase: F.struct(F.lit(occur).alias("occur"), F.lit("text").alias("field"), text.alias("text"), F.lit(phrase).alias("phrase"))
    one = lambda i: F.try_element_at("w", F.lit(i))
    rows = F.array(clause("must", F.array_join(F.slice("w", 3, 2), " "), True), clause("should", one(6), False), clause("must_not", one(9), False))
    return clause_search(items.select("request_id", F.inline(rows)), text_index(spark, sf_dir))


@query(
    "x10_exact_keyword",
    """SELECT DISTINCT p_name AS query, l_orderkey AS doc FROM lineitem JOIN part ON p_partkey = l_partkey
    JOIN orders ON o_orderkey = l_orderkey""",
)
def x10_exact_keyword(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    links = genre_pairs(cat).select(F.col("id").alias("doc"), F.col("genre_id").alias("id"))
    found = srch.member_matches(cat.genre.select(F.col("name").alias("query")), cat.genre.select("id", "name"), links, idx.Field("name"), analysed=False)
    return found.join(cat.film.select(F.col("id").alias("doc")), "doc", "left_semi").select("query", "doc")


@query(
    "x11_search_in_genre",
    f"""WITH {FILM_DOCS_SQL}, {score_ctes(FILM_FIELDS_SQL, "film_docs", "(SELECT text AS query FROM benchmark)")},
inside AS (SELECT DISTINCT item_id, doc, score FROM benchmark JOIN scored ON query = text JOIN lineitem ON l_orderkey = doc AND l_partkey = item_id)
SELECT item_id, doc, round(score, 6) AS score FROM inside QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc) <= 10""",
)
def x11_search_in_genre(spark, sf_dir):
    queries = benchmark(spark, sf_dir)
    items = materialise(queries.select("item_id", srch.query_key()), "items")
    links = genre_pairs(documents_catalog(spark, sf_dir)).select(F.col("id").alias("doc"), F.col("genre_id").alias("item_id"))
    # The documents of the genres asked for, before any score: a common genre is salted by its documents.
    inside = skew_join(links.distinct(), items, ["item_id"], "inner", salt_by=["doc"], measure=links.select("item_id"))
    inside = materialise(inside, "genre-films")
    scored = srch.scores_of(inside, queries, film_index(spark, sf_dir))
    found = scored.join(inside, ["query_key", "doc"]).withColumnRenamed("item_id", "query")
    return _top(found, 10, F.desc("score")).select(F.col("query").alias("item_id"), "doc", F.round("score", 6).alias("score"))
