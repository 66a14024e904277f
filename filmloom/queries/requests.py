"""The catalogue's named queries, each answering a whole request table."""

from pyspark.sql import functions as F

from filmloom.catalog import documents_catalog, orders_catalog, read_table
from filmloom.operators.aggregates import genre_documents, roles_of_persons
from filmloom.plans import requests as req
from filmloom.plans.documents import film_documents, genre_pairs, restrict
from filmloom.queries.registry import (
    DOCUMENT_COLUMNS_SQL,
    DOCUMENT_FROM_SQL,
    ORDERS_SQL,
    documents_sql,
    documents_text,
    members_sql,
    objects_sql,
    query,
)
from filmloom.queries.relations import ADMIN_SQL, admin_text
from filmloom.queries.search import FILM_DOCS_SQL, FILM_FIELDS_SQL, benchmark, customers, film_index, people_index, score_ctes, tokens_sql


def _placed(df):
    return df.withColumn("place", F.col("place").cast("bigint"))


def _paged(df, number, size):
    return df.withColumns({"page_number": F.lit(number), "page_size": F.lit(size)})


def _lookups(spark, sf_dir, c="user_id"):
    return read_table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), F.col(c).alias("id"))


def _region_pages(spark, sf_dir, size):
    region = read_table(spark, sf_dir, "region")
    return region.select(
        F.col("r_regionkey").alias("request_id"), (F.col("r_regionkey") + 1).alias("page_number"), F.lit(size).alias("page_size")
    )


SEARCH_REQUESTS_SQL = """
r AS (SELECT 2 * item_id AS request_id, text AS query, CAST(NULL AS BIGINT) AS genre_id FROM benchmark
      UNION ALL SELECT 2 * item_id + 1, text, item_id FROM benchmark)"""


@query(
    "r1_film_search",
    f"""WITH {FILM_DOCS_SQL}, {score_ctes(FILM_FIELDS_SQL, "film_docs", "(SELECT text AS query FROM benchmark)")}, {SEARCH_REQUESTS_SQL},
hits AS (
  SELECT request_id, doc, score FROM r JOIN scored USING (query)
  WHERE genre_id IS NULL OR EXISTS (SELECT 1 FROM genre_film g WHERE g.film_work_id = doc AND g.genre_id = r.genre_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, doc) AS place FROM hits)
SELECT request_id, place, id AS uuid, title, rating AS imdb_rating FROM ranked JOIN film ON film.id = doc WHERE place <= 50""",
)
def r1_film_search(spark, sf_dir):
    texts = benchmark(spark, sf_dir)
    plain = texts.select((2 * F.col("item_id")).alias("request_id"), "query", F.lit(None).cast("bigint").alias("genre_id"))
    within = texts.select((2 * F.col("item_id") + 1).alias("request_id"), "query", F.col("item_id").alias("genre_id"))
    cat, index = documents_catalog(spark, sf_dir), film_index(spark, sf_dir)
    requests = _paged(plain.unionByName(within), 1, 50)
    return _placed(req.film_search(requests, req.listing_fields(cat.film), index, genre_pairs(cat)))


@query(
    "r1_film_search_without_text",
    """WITH r AS (SELECT p_partkey AS genre_id, 2 AS page_number, 5 AS page_size FROM part),
f AS (SELECT l_partkey AS genre_id, l_orderkey AS id, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey) AS rn
      FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem JOIN documents ON doc_id = l_orderkey))
SELECT genre_id AS request_id, rn - 5 AS place, doc_id AS uuid, source AS title, CAST(n_chars AS DOUBLE) AS imdb_rating
FROM r JOIN f USING (genre_id) JOIN documents ON doc_id = f.id WHERE rn > 5 AND rn <= 10""",
)
def r1_film_search_without_text(spark, sf_dir):
    cat = documents_catalog(spark, sf_dir)
    films = req.listing_fields(cat.film)
    links = genre_pairs(cat).join(films.select("id"), "id", "left_semi")
    requests = cat.genre.select(
        F.col("id").alias("request_id"), F.lit(None).cast("string").alias("query"), F.col("id").alias("genre_id")
    )
    return _placed(req.film_search(_paged(requests, 2, 5), films, None, links))


def _film_list_sql(order: str) -> str:
    return f"""WITH n AS (SELECT l_orderkey AS id, min(p_name) AS first_genre, max(p_name) AS last_genre FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
f AS (SELECT o_orderkey AS id, o_orderpriority AS title, o_totalprice AS imdb_rating, first_genre, last_genre FROM orders LEFT JOIN n ON n.id = o_orderkey),
g AS (SELECT l_partkey AS genre_id, f.*, row_number() OVER (PARTITION BY l_partkey ORDER BY {order}, id) AS rn
      FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) JOIN f ON id = l_orderkey),
a AS (SELECT f.*, row_number() OVER (ORDER BY {order}, id) AS rn FROM f)
SELECT p_partkey AS request_id, rn AS place, id AS uuid, title, imdb_rating FROM part JOIN g ON genre_id = p_partkey WHERE rn <= 5
UNION ALL SELECT -1 - r_regionkey, rn - 5 * r_regionkey, id, title, imdb_rating FROM region JOIN a ON rn > 5 * r_regionkey AND rn <= 5 * (r_regionkey + 1)"""


def _film_lists(spark, sf_dir, sort):
    cat = orders_catalog(spark, sf_dir)
    by_genre = _paged(cat.genre.select(F.col("id").alias("request_id"), F.col("id").alias("genre_id")), 1, 5)
    every = _region_pages(spark, sf_dir, 5).select(
        (-1 - F.col("request_id")).cast("bigint").alias("request_id"), F.lit(None).cast("bigint").alias("genre_id"), "page_number", "page_size"
    )
    return _placed(req.film_list(by_genre.unionByName(every), cat.film, genre_pairs(cat), sort, cat.genre))


@query("r2_film_list", _film_list_sql("imdb_rating DESC"))
def r2_film_list(spark, sf_dir):
    return _film_lists(spark, sf_dir, "imdb_rating")


@query("r2_film_list_rising", _film_list_sql("imdb_rating"))
def r2_film_list_rising(spark, sf_dir):
    return _film_lists(spark, sf_dir, "-imdb_rating")


@query("r2_film_list_by_title", _film_list_sql("title"))
def r2_film_list_by_title(spark, sf_dir):
    return _film_lists(spark, sf_dir, "-title.raw")


@query("r2_film_list_by_genre_name", _film_list_sql("first_genre NULLS LAST"))
def r2_film_list_by_genre_name(spark, sf_dir):
    return _film_lists(spark, sf_dir, "-genres_names")


@query("r2_film_list_by_genre_name_falling", _film_list_sql("last_genre DESC NULLS LAST"))
def r2_film_list_by_genre_name_falling(spark, sf_dir):
    return _film_lists(spark, sf_dir, "genres_names")


@query(
    "r3_film_details",
    f"""WITH {ORDERS_SQL}, {members_sql()} SELECT e.event_id AS request_id, f.id IS NOT NULL AS found, e.c AS uuid, f.title,
f.rating AS imdb_rating, f.description, {", ".join(objects_sql(c) for c in ("genres", "actors", "writers", "directors"))}
FROM (SELECT event_id, 2 * event_id AS c FROM events) e LEFT JOIN film f ON f.id = e.c
LEFT JOIN cast_of c ON c.film_work_id = f.id LEFT JOIN kinds_of k ON k.film_work_id = f.id""",
)
def r3_film_details(spark, sf_dir):
    requests = _lookups(spark, sf_dir, "event_id").withColumn("id", 2 * F.col("id"))
    cut = restrict(orders_catalog(spark, sf_dir), requests.select("id"))
    full = req.film_details(requests, film_documents(cut))
    text = lambda c, name: F.coalesce(
        F.array_join(F.transform(c, lambda x: F.concat(x["uuid"].cast("string"), F.lit(":"), x[name])), "|"), F.lit("")
    ).alias(c)
    people = [text(c, "full_name") for c in ("actors", "writers", "directors")]
    return full.select("request_id", "found", "uuid", "title", "imdb_rating", "description", text("genres", "name"), *people)


@query(
    "r4_genre_details",
    """SELECT event_id AS request_id, p_partkey IS NOT NULL AS found, event_id AS uuid, p_name AS name
    FROM events LEFT JOIN part ON p_partkey = event_id""",
)
def r4_genre_details(spark, sf_dir):
    return req.genre_details(_lookups(spark, sf_dir, "event_id"), genre_documents(orders_catalog(spark, sf_dir).genre))


@query(
    "r5_genre_list",
    """WITH g AS (SELECT p_partkey AS uuid, p_name AS name, row_number() OVER (ORDER BY p_partkey) AS rn FROM part)
    SELECT r_regionkey AS request_id, rn - 50 * r_regionkey AS place, uuid, name FROM region
    JOIN g ON rn > 50 * r_regionkey AND rn <= 50 * (r_regionkey + 1)""",
)
def r5_genre_list(spark, sf_dir):
    genres = genre_documents(orders_catalog(spark, sf_dir).genre)
    return _placed(req.genre_list(_region_pages(spark, sf_dir, 50), genres))


def _key_pages_sql(fk: str, table: str, key: str, size: int) -> str:
    return f"""WITH f AS (SELECT o_orderkey AS id, o_orderpriority AS title, o_totalprice AS imdb_rating FROM orders),
g AS (SELECT {fk} AS k, f.*, row_number() OVER (PARTITION BY {fk} ORDER BY imdb_rating, id) AS rn
      FROM (SELECT DISTINCT {fk}, l_orderkey FROM lineitem) JOIN f ON id = l_orderkey)
SELECT {key} AS request_id, rn - {size} AS place, id AS uuid, title, imdb_rating FROM {table} JOIN g ON k = {key}
WHERE rn > {size} AND rn <= {2 * size}"""


@query("r6_genre_films", _key_pages_sql("l_partkey", "part", "p_partkey", 3))
def r6_genre_films(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    requests = cat.genre.select(F.col("id").alias("request_id"), F.col("id").alias("genre_id"))
    return _placed(req.films_of_genre(_paged(requests, 2, 3), cat))


@query(
    "r7_person_search",
    f"""WITH {score_ctes([("name", "plain", tokens_sql("name"))], "(SELECT c_custkey AS id, c_name AS name FROM customer)", "(SELECT s_name AS query FROM supplier)")},
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS place FROM scored)
SELECT s_suppkey AS request_id, place, doc AS uuid, c_name AS full_name FROM supplier JOIN ranked ON query = s_name
JOIN customer ON c_custkey = doc WHERE place <= 50""",
)
def r7_person_search(spark, sf_dir):
    requests = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("request_id"), F.col("s_name").alias("query"))
    return _placed(req.person_search(_paged(requests, 1, 50), customers(spark, sf_dir), people_index(spark, sf_dir)))


@query(
    "r8_person_details",
    """SELECT event_id AS request_id, s_suppkey IS NOT NULL AS found, user_id AS uuid, s_name AS full_name
    FROM events LEFT JOIN supplier ON s_suppkey = user_id""",
)
def r8_person_details(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    return req.person_details(_lookups(spark, sf_dir), roles_of_persons(cat.person, cat.person_film))


@query(
    "r9_person_list",
    """WITH p AS (SELECT s_suppkey AS uuid, s_name AS full_name, row_number() OVER (ORDER BY s_suppkey) AS rn FROM supplier)
    SELECT r_regionkey AS request_id, rn - 20 * r_regionkey AS place, uuid, full_name FROM region
    JOIN p ON rn > 20 * r_regionkey AND rn <= 20 * (r_regionkey + 1)""",
)
def r9_person_list(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    people = roles_of_persons(cat.person, cat.person_film)
    return _placed(req.person_list(_region_pages(spark, sf_dir, 20), people))


@query("r10_person_films", _key_pages_sql("l_suppkey", "supplier", "s_suppkey", 10))
def r10_person_films(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    requests = cat.person.select(F.col("id").alias("request_id"), F.col("id").alias("person_id"))
    return _placed(req.films_of_person(_paged(requests, 2, 10), cat))


@query("r11_admin_list", ADMIN_SQL + " ORDER BY f.id LIMIT 50 OFFSET 100")
def r11_admin_list(spark, sf_dir):
    return admin_text(req.admin_list(orders_catalog(spark, sf_dir), number=3))


@query(
    "r11_admin_envelope",
    """WITH c AS (SELECT count(*) AS n, greatest(CAST(ceil(count(*) / 50.0) AS BIGINT), 1) AS p FROM orders)
    SELECT n AS count, p AS total_pages, CAST(2 AS BIGINT) AS prev, CASE WHEN p > 3 THEN CAST(4 AS BIGINT) END AS next, CAST(3 AS BIGINT) AS page FROM c""",
)
def r11_admin_envelope(spark, sf_dir):
    return req.admin_envelope(orders_catalog(spark, sf_dir), 3)


@query(
    "r12_admin_details",
    f"SELECT e.doc_id AS request_id, a.*, true AS found FROM labels e JOIN ({ADMIN_SQL}) a ON a.id = e.doc_id",
)
def r12_admin_details(spark, sf_dir):
    requests = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("request_id"), F.col("doc_id").alias("id"))
    return admin_text(req.admin_details(requests, orders_catalog(spark, sf_dir)))


@query("r13_film_documents", documents_sql())
def r13_film_documents(spark, sf_dir):
    return documents_text(film_documents(orders_catalog(spark, sf_dir)))


@query(
    "r13_text_film_documents",
    FILM_DOCS_SQL.join(["WITH ", ""])
    + f" SELECT f.id, f.rating AS imdb_rating, f.title, f.description, {DOCUMENT_COLUMNS_SQL} {DOCUMENT_FROM_SQL}",
)
def r13_text_film_documents(spark, sf_dir):
    return documents_text(film_documents(documents_catalog(spark, sf_dir)))
