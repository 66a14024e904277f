"""Projections and scalar functions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.catalog import orders_catalog, read_table, role_of_flag
from filmloom.functions import scalar
from filmloom.operators import projections as proj
from filmloom.operators.aggregates import genre_documents, roles_of_persons
from filmloom.operators.paging import page_numbers
from filmloom.plans.documents import film_documents, genre_pairs
from filmloom.queries.registry import (
    ORDERS_SQL,
    documents_sql,
    documents_text,
    members_sql,
    names_sql,
    names_text,
    query,
)


@query("p1_rename_columns", "SELECT o_orderkey AS id, o_orderpriority AS title, o_orderdate AS created, o_orderdate AS modified FROM orders")
def p1_rename_columns(spark, sf_dir):
    source = orders_catalog(spark, sf_dir).film.select(
        "id", "title", F.col("modified").alias("created_at"), F.col("modified").alias("updated_at")
    )
    return proj.rename_loaded(source)


@query(
    "p2_null_default",
    """SELECT o_orderkey AS id, coalesce(nullif(o_orderpriority, '5-LOW'), 'EMPTY_STR') AS title,
    coalesce(nullif(o_orderstatus, 'O'), 'EMPTY_STR') AS type FROM orders""",
)
def p2_null_default(spark, sf_dir):
    film = orders_catalog(spark, sf_dir).film.select(
        "id", F.expr("nullif(title, '5-LOW')").alias("title"), F.expr("nullif(type, 'O')").alias("type")
    )
    return proj.default_text(film, "title", "type")


@query("p3_listing_fields", f"WITH {ORDERS_SQL} SELECT id, title, description, creation_date, rating, type FROM film")
def p3_listing_fields(spark, sf_dir):
    return proj.listing(orders_catalog(spark, sf_dir).film)


@query("p4_document_shape", documents_sql())
def p4_document_shape(spark, sf_dir):
    return documents_text(proj.document_shape(film_documents(orders_catalog(spark, sf_dir))))


@query("p5_partial_film", f"WITH {ORDERS_SQL} SELECT id AS uuid, title, rating AS imdb_rating FROM film")
def p5_partial_film(spark, sf_dir):
    return proj.partial_film(film_documents(orders_catalog(spark, sf_dir)))


@query(
    "p6_full_film",
    f"""WITH {ORDERS_SQL}
SELECT f.id AS uuid, f.title, f.description, f.rating AS imdb_rating, m.role, m.id AS member_uuid, m.full_name
FROM film f JOIN (SELECT DISTINCT film_work_id, role, p.id, p.full_name FROM person_film JOIN person p ON p.id = person_id) m
  ON m.film_work_id = f.id
UNION ALL
SELECT f.id, f.title, f.description, f.rating, 'genre', m.id, m.name
FROM film f JOIN (SELECT DISTINCT film_work_id, g.id, g.name FROM genre_film JOIN genre g ON g.id = genre_id) m
  ON m.film_work_id = f.id""",
)
def p6_full_film(spark, sf_dir):
    full = proj.full_film(film_documents(orders_catalog(spark, sf_dir)))
    tag = lambda c, role, name: F.transform(
        c, lambda x: F.struct(F.lit(role).alias("role"), x["uuid"].alias("member_uuid"), x[name].alias("full_name"))
    )
    members = F.concat(
        tag("actors", "actor", "full_name"), tag("directors", "director", "full_name"),
        tag("writers", "writer", "full_name"), tag("genres", "genre", "name"),
    )
    return full.select("uuid", "title", "description", "imdb_rating", F.explode(members).alias("m")).select(
        "uuid", "title", "description", "imdb_rating", "m.*"
    )


@query("p7_partial_genre", "SELECT p_partkey AS uuid, p_name AS name FROM part")
def p7_partial_genre(spark, sf_dir):
    return proj.partial_genre(genre_documents(orders_catalog(spark, sf_dir).genre))


@query("p7_partial_person", "SELECT s_suppkey AS uuid, s_name AS full_name FROM supplier")
def p7_partial_person(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    return proj.partial_person(roles_of_persons(cat.person, cat.person_film))


@query("p8_admin_grid", f"WITH {ORDERS_SQL} SELECT title, type, creation_date, rating FROM film")
def p8_admin_grid(spark, sf_dir):
    return proj.grid(orders_catalog(spark, sf_dir).film)


@query(
    "p9_names_of_objects",
    f"""WITH {ORDERS_SQL}, {members_sql()}
SELECT f.id, coalesce(array_to_string([x.name for x in genres], '|'), '') AS genres
FROM film f LEFT JOIN kinds_of k ON k.film_work_id = f.id""",
)
def p9_names_of_objects(spark, sf_dir):
    docs = film_documents(orders_catalog(spark, sf_dir))
    return docs.select("id", proj.names_of("genres").alias("genres")).select("id", names_text("genres"))


def _json_documents(spark, sf_dir):
    """Documents as a database query returns them: every array is JSON text."""
    docs = film_documents(orders_catalog(spark, sf_dir))
    relations = ("genres", "actors", "directors", "writers")
    text_ids = lambda x: scalar.id_name(x["id"].cast("string"), x["name"])
    return docs.select(
        "id",
        *[F.to_json(F.transform(c, text_ids)).alias(c) for c in relations],
        *[F.to_json(f"{c}_names").alias(f"{c}_names") for c in relations],
    )


@query(
    "c1_parse_objects",
    f"""WITH {ORDERS_SQL}
SELECT DISTINCT f.id, CAST(g.id AS VARCHAR) AS genre_id, g.name FROM film f
JOIN genre_film ON film_work_id = f.id JOIN genre g ON g.id = genre_id""",
)
def c1_parse_objects(spark, sf_dir):
    parsed = scalar.parse_document(_json_documents(spark, sf_dir))
    return parsed.select("id", F.explode("genres").alias("g")).select("id", F.col("g.id").alias("genre_id"), "g.name")


@query(
    "c2_parse_names",
    f"""WITH {ORDERS_SQL}, {members_sql()}
SELECT f.id, {names_sql("actors_names")}, {names_sql("writers_names")}
FROM film f LEFT JOIN cast_of c ON c.film_work_id = f.id""",
)
def c2_parse_names(spark, sf_dir):
    parsed = scalar.parse_document(_json_documents(spark, sf_dir))
    return parsed.select("id", names_text("actors_names"), names_text("writers_names"))


@query("c3_json_object", """SELECT p_partkey, '{"id":' || p_partkey || ',"name":"' || p_name || '"}' AS object FROM part""")
def c3_json_object(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return part.select("p_partkey", F.to_json(scalar.id_name("p_partkey", "p_name")).alias("object"))


@query("c4_row_to_json", """SELECT '{"id":' || s_suppkey || ',"full_name":"' || s_name || '"}' AS document FROM supplier""")
def c4_row_to_json(spark, sf_dir):
    person = orders_catalog(spark, sf_dir).person
    return person.select(scalar.document_json(person).alias("document"))


@query(
    "c5_empty_array",
    f"""WITH {ORDERS_SQL}, k AS (SELECT film_work_id, count(DISTINCT genre_id) AS n FROM genre_film GROUP BY 1)
SELECT f.id, coalesce(k.n, 0) AS n FROM film f LEFT JOIN k ON k.film_work_id = f.id""",
)
def c5_empty_array(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    # Distinct links merge before they move; no array is built where its size is all that is asked.
    kinds = genre_pairs(cat).dropna().distinct().groupBy("id").agg(F.count("*").alias("n"))
    joined = cat.film.select("id").join(kinds, "id", "left")
    return joined.select("id", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "c6_missing_to_null",
    "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS rating FROM orders",
)
def c6_missing_to_null(spark, sf_dir):
    film = orders_catalog(spark, sf_dir).film
    injected = film.withColumn("rating", F.when(F.col("type") == "F", F.lit(float("nan"))).otherwise(F.col("rating")))
    return injected.select("id", scalar.missing_to_null("rating", T.DoubleType()).alias("rating"))


@query(
    "c7_time_text",
    "SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS text, date_trunc('second', ts) AS time FROM events",
)
def c7_time_text(spark, sf_dir):
    text = read_table(spark, sf_dir, "events").select("event_id", scalar.time_to_text("ts").alias("text"))
    return text.withColumn("time", scalar.text_to_time("text").cast("timestamp_ntz"))


@query(
    "c8_never_loaded",
    """SELECT p_partkey AS id, coalesce(max(ts), TIMESTAMP '1700-02-08 01:40:27.425337') AS mark
    FROM part LEFT JOIN events ON user_id = p_partkey GROUP BY p_partkey""",
)
def c8_never_loaded(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(F.max("ts").alias("mark"))
    genre = orders_catalog(spark, sf_dir).genre.select("id").join(events, "id", "left")
    return genre.select("id", scalar.since_or_never(F.col("mark")).cast("timestamp_ntz").alias("mark"))


@query("c9_now", "SELECT event_id, true AS past FROM events")
def c9_now(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("event_id", (F.current_timestamp() > F.col("ts")).alias("past"))


@query(
    "c10_natural_uuid",
    """WITH d AS (SELECT l_orderkey, l_linenumber, md5('["' || l_orderkey || '","' || l_linenumber || '"]') AS h FROM lineitem)
SELECT l_orderkey, l_linenumber, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
       substr(h, 17, 4) || '-' || substr(h, 21, 12) AS id, true AS valid FROM d""",
)
def c10_natural_uuid(spark, sf_dir):
    line = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    keyed = line.withColumn("id", scalar.natural_uuid("l_orderkey", "l_linenumber"))
    return keyed.withColumn("valid", scalar.is_uuid("id"))


@query(
    "c11_page_count",
    "SELECT l_partkey AS genre_id, CAST(ceil(count(*) / 7.0) AS BIGINT) AS pages FROM lineitem GROUP BY l_partkey",
)
def c11_page_count(spark, sf_dir):
    counted = orders_catalog(spark, sf_dir).genre_film.groupBy("genre_id").agg(F.count("*").alias("n"))
    return counted.select("genre_id", page_numbers(F.col("n"), 7).alias("pages"))


@query(
    "c12_display_label",
    """SELECT l_orderkey, l_linenumber,
  CASE l_returnflag WHEN 'A' THEN 'Actor' WHEN 'N' THEN 'Writer' WHEN 'R' THEN 'Director' END AS label_en,
  CASE l_returnflag WHEN 'A' THEN 'Актёр' WHEN 'N' THEN 'Сценарист' WHEN 'R' THEN 'Режисёр' END AS label_ru
FROM lineitem""",
)
def c12_display_label(spark, sf_dir):
    line = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", role_of_flag().alias("role"))
    both = scalar.with_label(line, "role", "role", "en", "label_en")
    return scalar.with_label(both, "role", "role", "ru", "label_ru").drop("role")
