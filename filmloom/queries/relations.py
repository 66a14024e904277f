"""Filters, joins and aggregations over the catalogue."""

from pyspark.sql import functions as F

from filmloom.catalog import Catalog, documents_catalog, orders_catalog, read_table
from filmloom.operators import aggregates as agg
from filmloom.operators import filters as flt
from filmloom.operators.paging import page, result_order
from filmloom.operators.skew import matching, skew_join
from filmloom.plans.documents import (
    admin_rows,
    film_documents,
    films_with_genre,
    films_with_person,
    genre_members,
    person_members,
    person_pairs,
    restrict,
)
from filmloom.plans.joins import full_outer_counts, linked_pairs, presence
from filmloom.plans.refresh import films_of
from filmloom.queries.registry import (
    DOCUMENT_FROM_SQL,
    ORDERS_SQL,
    documents_sql,
    documents_text,
    members_sql,
    names_sql,
    names_text,
    query,
)

SINCE = "1998-01-01"


def _purchases(spark, sf_dir):
    return read_table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(F.col("event_id").alias("id"))


@query("f1_changed_since", "SELECT o_orderkey AS id, o_orderdate AS modified FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def f1_changed_since(spark, sf_dir):
    return flt.changed_since(orders_catalog(spark, sf_dir).film, F.lit(SINCE).cast("timestamp_ntz")).select("id", "modified")


@query(
    "f2_id_in_list",
    "SELECT o_orderkey AS id, o_totalprice AS rating FROM orders WHERE o_orderkey IN (SELECT event_id FROM events WHERE event_type = 'purchase')",
)
def f2_id_in_list(spark, sf_dir):
    return matching(orders_catalog(spark, sf_dir).film, _purchases(spark, sf_dir), ["id"]).select("id", "rating")


@query(
    "f3_foreign_key_in_list",
    """SELECT l_orderkey AS film_work_id, l_suppkey AS person_id FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""",
)
def f3_foreign_key_in_list(spark, sf_dir):
    low = read_table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("person_id"))
    links = orders_catalog(spark, sf_dir).person_film.select("film_work_id", "person_id")
    return matching(links, low, ["person_id"], salt_by=["film_work_id"])


@query(
    "f4_lookup",
    """SELECT event_id AS request_id, user_id AS id, s_name AS full_name, s_suppkey IS NOT NULL AS found
    FROM events LEFT JOIN supplier ON s_suppkey = user_id""",
)
def f4_lookup(spark, sf_dir):
    requests = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), F.col("user_id").alias("id"))
    return flt.lookup(requests, orders_catalog(spark, sf_dir).person)


@query("f5_role_equality", f"WITH {ORDERS_SQL} SELECT film_work_id, person_id FROM person_film WHERE role = 'writer'")
def f5_role_equality(spark, sf_dir):
    return orders_catalog(spark, sf_dir).person_film.filter("role = 'writer'").select("film_work_id", "person_id")


@query("f6_has_genre", "SELECT DISTINCT l_orderkey AS id FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_partkey = 7")
def f6_has_genre(spark, sf_dir):
    return films_with_genre(orders_catalog(spark, sf_dir), 7)


@query("f7_has_person", "SELECT DISTINCT l_orderkey AS id FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_suppkey = 5")
def f7_has_person(spark, sf_dir):
    return films_with_person(orders_catalog(spark, sf_dir), 5)


@query(
    "f8_conjunction",
    """SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000
    AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey = 5)""",
)
def f8_conjunction(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    films = cat.film.filter(flt.boolean(must=[F.col("type") == "F", F.col("rating") > 250_000]))
    wanted = films.select("id").join(films_with_person(cat, 5), "id", "left_semi")
    return wanted.join(films_with_genre(cat, None), "id", "left_semi")


@query(
    "f9_disjunction",
    "SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice < 50000",
)
def f9_disjunction(spark, sf_dir):
    clauses = [F.col("title") == "1-URGENT", F.col("rating") < 50_000]
    return orders_catalog(spark, sf_dir).film.filter(flt.boolean(should=clauses)).select("id")


@query("f10_type_facet", "SELECT o_orderkey AS id, o_orderpriority AS title FROM orders WHERE o_orderstatus = 'P'")
def f10_type_facet(spark, sf_dir):
    return orders_catalog(spark, sf_dir).film.filter("type = 'P'").select("id", "title")


@query(
    "f11_aggregate_filter",
    """SELECT l_orderkey AS film_work_id, count(DISTINCT l_suppkey) FILTER (WHERE l_returnflag = 'A') AS actors,
    count(DISTINCT l_suppkey) FILTER (WHERE l_returnflag = 'R') AS directors FROM lineitem GROUP BY l_orderkey""",
)
def f11_aggregate_filter(spark, sf_dir):
    # Links are made distinct once, rather than once more for each count.
    links = orders_catalog(spark, sf_dir).person_film.select("film_work_id", "role", "person_id").distinct()
    in_role = lambda r: F.count(F.when(F.col("role") == r, F.col("person_id")))
    return links.groupBy("film_work_id").agg(in_role("actor").alias("actors"), in_role("director").alias("directors"))


@query("f12_exact_term", "SELECT o_orderkey AS id, o_orderpriority AS title FROM orders WHERE o_orderkey = 10")
def f12_exact_term(spark, sf_dir):
    return flt.by_id(orders_catalog(spark, sf_dir).film, 10).select("id", "title")


@query("f13_match_all", "SELECT count(*) AS hits FROM orders")
def f13_match_all(spark, sf_dir):
    return agg.row_count(orders_catalog(spark, sf_dir).film.filter(flt.boolean()), "hits")


WIDE_SQL = """
FROM film f LEFT JOIN person_film pf ON pf.film_work_id = f.id LEFT JOIN person p ON p.id = pf.person_id
LEFT JOIN genre_film gf ON gf.film_work_id = f.id LEFT JOIN genre g ON g.id = gf.genre_id"""


@query(
    "j1_star_left_joins",
    f"""WITH {ORDERS_SQL} SELECT f.id, f.rating AS imdb_rating,
coalesce(array_to_string(list_sort(list(DISTINCT p.full_name) FILTER (WHERE pf.role = 'actor')), '|'), '') AS actors_names,
coalesce(array_to_string(list_sort(list(DISTINCT g.name) FILTER (WHERE g.id IS NOT NULL)), '|'), '') AS genres_names
{WIDE_SQL} GROUP BY f.id, f.rating""",
)
def j1_star_left_joins(spark, sf_dir):
    docs = film_documents(orders_catalog(spark, sf_dir))
    return docs.select("id", "imdb_rating", names_text("actors_names"), names_text("genres_names"))


def _gappy_catalog(spark, sf_dir):
    """Stand-ins with gaps on every side: films, people and genres without links, links without either."""
    events, labels = read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "labels")
    return Catalog(
        film=read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")),
        person=read_table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("id")),
        genre=read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")),
        person_film=labels.select(F.col("doc_id").alias("film_work_id"), F.col("quality").cast("bigint").alias("person_id")),
        genre_film=events.select(F.col("user_id").alias("film_work_id"), F.col("event_id").alias("genre_id")),
    )


@query(
    "j2_full_outer_chain",
    """SELECT f.s_suppkey AS id, count(DISTINCT g.p_partkey) AS genres, count(DISTINCT p.r_regionkey) AS people
FROM supplier f FULL JOIN events gf ON gf.user_id = f.s_suppkey FULL JOIN part g ON g.p_partkey = gf.event_id
FULL JOIN labels pf ON pf.doc_id = f.s_suppkey FULL JOIN region p ON p.r_regionkey = pf.quality
GROUP BY f.s_suppkey""",
)
def j2_full_outer_chain(spark, sf_dir):
    return full_outer_counts(_gappy_catalog(spark, sf_dir))


NEGATIVE_SQL = "(SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)"


@query(
    "j3_affected_distinct",
    f"SELECT DISTINCT o_orderkey AS id FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_suppkey IN {NEGATIVE_SQL}",
)
def j3_affected_distinct(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    low = read_table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("id"))
    return matching(cat.film.select("id"), films_of(cat.person_film, "person_id", low), ["id"])


@query(
    "j3_affected_with_repeats",
    f"""SELECT o_orderkey AS id, o_orderdate AS modified FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    WHERE l_suppkey IN {NEGATIVE_SQL}""",
)
def j3_affected_with_repeats(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    low = read_table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("person_id"))
    return linked_pairs(cat.film.select("id", "modified"), cat.person_film, "person_id", low)


ADMIN_SQL = f"""WITH {ORDERS_SQL}, {members_sql()}
SELECT f.id, f.title, f.description, f.creation_date, f.rating, f.type, {names_sql("genres_names", "genres")},
{names_sql("actors_names", "actors")}, {names_sql("writers_names", "writers")}, {names_sql("directors_names", "directors")}
{DOCUMENT_FROM_SQL}"""


def admin_text(rows):
    arrays = ("genres", "actors", "writers", "directors")
    return rows.select(*[c for c in rows.columns if c not in arrays], *[names_text(c) for c in arrays])


@query("j4_admin_annotations", ADMIN_SQL)
def j4_admin_annotations(spark, sf_dir):
    return admin_text(admin_rows(orders_catalog(spark, sf_dir)))


@query(
    "j5_relation_prefetch",
    f"""WITH {ORDERS_SQL}, pg AS (SELECT id, title FROM film ORDER BY id LIMIT 50)
SELECT pg.id, pg.title, 'genre' AS relation, g.id AS member FROM pg JOIN genre_film ON film_work_id = pg.id JOIN genre g ON g.id = genre_id
UNION SELECT pg.id, pg.title, 'person', p.id FROM pg JOIN person_film ON film_work_id = pg.id JOIN person p ON p.id = person_id""",
)
def j5_relation_prefetch(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    first = page(cat.film.select("id", "title"), result_order())
    cut = restrict(cat, first.select("id"))
    relations = (
        genre_members(cut).select("film_work_id", F.lit("genre").alias("relation"), F.col("id").alias("member"))
        .unionByName(person_members(cut).select("film_work_id", F.lit("person").alias("relation"), F.col("id").alias("member")).distinct())
    )
    return first.join(relations.withColumnRenamed("film_work_id", "id"), "id").select("id", "title", "relation", "member")


@query(
    "j6_work_set_join",
    documents_sql() + " WHERE f.id IN (SELECT event_id FROM events WHERE event_type = 'purchase')",
)
def j6_work_set_join(spark, sf_dir):
    return documents_text(film_documents(restrict(orders_catalog(spark, sf_dir), _purchases(spark, sf_dir))))


@query(
    "j7_presence_compare",
    """SELECT coalesce(o_orderkey, event_id) AS id, CASE WHEN event_id IS NULL THEN 'source only'
    WHEN o_orderkey IS NULL THEN 'target only' ELSE 'both' END AS side
    FROM orders FULL JOIN events ON event_id = o_orderkey""",
)
def j7_presence_compare(spark, sf_dir):
    source = orders_catalog(spark, sf_dir).film.select("id")
    return presence(source, read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id")), "id")


@query(
    "a1_names_by_role",
    f"""WITH {ORDERS_SQL}, {members_sql()} SELECT film_work_id, {names_sql("actors_names")},
{names_sql("directors_names")}, {names_sql("writers_names")} FROM cast_of""",
)
def a1_names_by_role(spark, sf_dir):
    members = person_members(orders_catalog(spark, sf_dir))
    arrays = {f"{r}s_names": agg.names_in_role(r) for r in ("actor", "director", "writer")}
    rows = members.groupBy("film_work_id").agg(*[c.alias(n) for n, c in arrays.items()])
    return rows.select("film_work_id", *[names_text(n) for n in arrays])


@query(
    "a2_objects_by_role",
    f"""WITH {ORDERS_SQL} SELECT DISTINCT film_work_id, role, p.id, p.full_name AS name
FROM person_film JOIN person p ON p.id = person_id""",
)
def a2_objects_by_role(spark, sf_dir):
    return person_members(orders_catalog(spark, sf_dir)).select("film_work_id", "role", "id", "name")


@query(
    "a3_genre_names",
    f"""WITH {ORDERS_SQL}, {members_sql()} SELECT f.id, {names_sql("genres_names")}, coalesce(len(genres_names), 0) AS n {DOCUMENT_FROM_SQL}""",
)
def a3_genre_names(spark, sf_dir):
    docs = film_documents(orders_catalog(spark, sf_dir))
    return docs.select("id", names_text("genres_names"), F.size("genres_names").cast("bigint").alias("n"))


@query(
    "a4_filtered_arrays",
    f"""WITH {ORDERS_SQL}, {members_sql()} SELECT f.id, {names_sql("genres_names", "genres")}, {names_sql("actors_names", "actors")}
{DOCUMENT_FROM_SQL}""",
)
def a4_filtered_arrays(spark, sf_dir):
    return admin_text(admin_rows(orders_catalog(spark, sf_dir))).select("id", "genres", "actors")


@query(
    "a5_group_with_fields",
    f"""WITH {ORDERS_SQL} SELECT f.id, any_value(f.title) AS title, any_value(f.rating) AS rating,
count(DISTINCT p.id) AS people, count(DISTINCT g.id) AS genres {WIDE_SQL} GROUP BY f.id""",
)
def a5_group_with_fields(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    people = person_pairs(cat).distinct().groupBy("id").agg(F.count("*").alias("people"))
    genres = genre_members(cat).groupBy(F.col("film_work_id").alias("id")).agg(F.count("*").alias("genres"))
    joined = cat.film.select("id", "title", "rating").join(people, "id", "left").join(genres, "id", "left")
    return joined.fillna(0, ["people", "genres"])


@query("a6_group_documents", documents_sql())
def a6_group_documents(spark, sf_dir):
    return documents_text(film_documents(orders_catalog(spark, sf_dir)))


@query(
    "a7_first_value",
    f"WITH {ORDERS_SQL} SELECT f.id, any_value(f.rating) AS rating, any_value(f.title) AS title, any_value(f.description) AS description {WIDE_SQL} GROUP BY f.id",
)
def a7_first_value(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    linked = skew_join(cat.person_film.select(F.col("film_work_id").alias("id")), cat.film.select("id", "rating", "title", "description"), ["id"], "inner")
    idle = cat.film.join(cat.person_film.select(F.col("film_work_id").alias("id")), "id", "left_anti").select("id", "rating", "title", "description")
    first = [F.first(c).alias(c) for c in ("rating", "title", "description")]
    return linked.select(*idle.columns).unionByName(idle).groupBy("id").agg(*first)


@query(
    "a8_row_counts",
    """SELECT 'film' AS t, count(*) AS n FROM orders UNION ALL SELECT 'person', count(*) FROM supplier
    UNION ALL SELECT 'genre', count(*) FROM part UNION ALL SELECT 'person_film', count(*) FROM lineitem""",
)
def a8_row_counts(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    counted = [
        agg.row_count(df).select(F.lit(t).alias("t"), "n")
        for t, df in (("film", cat.film), ("person", cat.person), ("genre", cat.genre), ("person_film", cat.person_film))
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


@query("a9_distinct_projection", f"WITH {ORDERS_SQL} SELECT DISTINCT person_id, role FROM person_film")
def a9_distinct_projection(spark, sf_dir):
    return orders_catalog(spark, sf_dir).person_film.select("person_id", "role").distinct()


PERSON_DOCUMENTS_SQL = f"""WITH {ORDERS_SQL}
SELECT p.id, p.full_name AS name, coalesce(array_to_string(list_sort(list(DISTINCT role) FILTER (WHERE role IS NOT NULL)), '|'), '') AS roles
FROM person p LEFT JOIN person_film ON person_id = p.id GROUP BY p.id, p.full_name"""


@query("a10_person_documents", PERSON_DOCUMENTS_SQL)
def a10_person_documents(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    return agg.roles_of_persons(cat.person, cat.person_film).select("id", "name", names_text("roles"))


@query("a11_genre_documents", "SELECT p_partkey AS id, p_name AS name FROM part")
def a11_genre_documents(spark, sf_dir):
    return agg.genre_documents(documents_catalog(spark, sf_dir).genre)
