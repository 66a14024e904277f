"""Sorting, paging, set operations and data checks."""

from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from filmloom.catalog import PERSON_DOCUMENT, ROLES, orders_catalog, read_table
from filmloom.operators import checks, sets
from filmloom.operators import paging as pg
from filmloom.operators.filters import changed_since
from filmloom.operators.listing import Listing
from filmloom.plans.documents import film_documents, genre_pairs
from filmloom.plans.refresh import Marks, affected_films, changed_page, changes_after, films_of
from filmloom.plans.requests import with_links
from filmloom.queries.registry import DOCUMENT_COLUMNS_SQL, DOCUMENT_FROM_SQL, ORDERS_SQL, documents_text, members_sql, query, snapshot
from filmloom.session import scratch_path, scratch_root

DAY = lambda text: F.lit(text).cast("timestamp_ntz")
PAGE_KEYS = (pg.SortKey("rating", ascending=False), pg.SortKey("id"))


def _film(spark, sf_dir):
    return orders_catalog(spark, sf_dir).film


CHANGED_PAGE_SQL = """SELECT o_orderkey AS id, o_orderdate AS modified FROM orders WHERE o_orderdate > TIMESTAMP '1995-06-01'
    ORDER BY o_orderdate, o_orderkey LIMIT 256 OFFSET 512"""


@query("o1_changed_page", CHANGED_PAGE_SQL)
def o1_changed_page(spark, sf_dir):
    return changed_page(_film(spark, sf_dir), DAY("1995-06-01"), 512, 256)


@query("o1_changes_after_cursor", CHANGED_PAGE_SQL)
def o1_changes_after_cursor(spark, sf_dir):
    """The same page from the cursor at the end of the pages before it; days hold many orders, so it falls among equal times."""
    changed = changed_since(_film(spark, sf_dir), DAY("1995-06-01"))
    last = changes_after(changed, None, 512).orderBy(F.desc("modified"), F.desc("id")).first()
    return changes_after(changed, (last["modified"], last["id"]), 256)


@query(
    "o2_affected_in_order",
    """WITH a AS (SELECT DISTINCT o_orderkey AS id, o_orderdate AS modified FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0))
    SELECT id, modified, row_number() OVER (ORDER BY modified, id) AS position FROM a""",
)
def o2_affected_in_order(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    low = read_table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("id"))
    films = cat.film.select("id", "modified").join(films_of(cat.person_film, "person_id", low), "id")
    return pg.number_rows(films, [F.col("modified").asc_nulls_last(), F.col("id").asc()])


@query(
    "o3_result_order",
    """WITH f AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS rating FROM orders)
    SELECT id, row_number() OVER (ORDER BY rating DESC NULLS LAST, id) AS down, row_number() OVER (ORDER BY rating ASC NULLS LAST, id) AS up FROM f""",
)
def o3_result_order(spark, sf_dir):
    film = _film(spark, sf_dir).select("id", F.expr("CASE WHEN type = 'P' THEN NULL ELSE rating END").alias("rating"))
    down = pg.number_rows(film, pg.result_order("rating"), "down").select("id", "down")
    up = pg.number_rows(film, pg.result_order("-rating"), "up").select("id", "up")
    return down.join(up, "id")


@query("o4_page", "SELECT o_orderkey AS id, o_totalprice AS rating FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def o4_page(spark, sf_dir):
    return pg.page(_film(spark, sf_dir).select("id", "rating"), pg.result_order("rating"), number=3)


@query(
    "o4_pages_for_requests",
    """WITH r AS (SELECT n_nationkey AS request_id, n_nationkey + 1 AS page_number, 20 AS page_size FROM nation),
    f AS (SELECT o_orderkey AS id, o_totalprice AS rating, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    SELECT request_id, CAST(rn - (page_number - 1) * page_size AS BIGINT) AS place, id, rating FROM r
    JOIN f ON rn > (page_number - 1) * page_size AND rn <= page_number * page_size""",
)
def o4_pages_for_requests(spark, sf_dir):
    requests = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("request_id"), (F.col("n_nationkey") + 1).alias("page_number"), F.lit(20).alias("page_size")
    )
    pages = pg.pages_for(requests, _film(spark, sf_dir).select("id", "rating"), pg.result_order("rating"))
    return pages.withColumn("place", F.col("place").cast("bigint"))


@query(
    "o5_deep_page",
    "SELECT o_orderkey AS id, o_totalprice AS rating FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 12000",
)
def o5_deep_page(spark, sf_dir):
    return pg.deep_page(_film(spark, sf_dir).select("id", "rating"), PAGE_KEYS, number=241, size=50)


def kept_listing(spark, sf_dir):
    """All films by rating: written by the first query that asks, opened by all after it while the files of the table stay the same."""
    path = f"{scratch_root(spark)}/listing-{spark.sparkContext.applicationId}-{snapshot(spark, sf_dir, ['orders'])}"
    listing = Listing(spark, path, "id long, rating double", PAGE_KEYS)
    try:
        listing.directory()
    except AnalysisException:
        listing.write(_film(spark, sf_dir).select("id", "rating"))
    return listing


@query(
    "o5_listing_page",
    """SELECT * FROM (SELECT o_orderkey AS id, o_totalprice AS rating, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders)
    WHERE position > 1200 AND position <= 1250""",
)
def o5_listing_page(spark, sf_dir):
    return kept_listing(spark, sf_dir).page(25, 50)


@query(
    "o5_listing_after_cursor",
    "SELECT o_orderkey AS id, o_totalprice AS rating FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 1000",
)
def o5_listing_after_cursor(spark, sf_dir):
    listing = kept_listing(spark, sf_dir)
    last = listing.page(20, 50).orderBy("position").tail(1)[0]
    return listing.after((last["rating"], last["id"]), 50)


@query(
    "o5_listing_changes",
    """WITH f AS (
    SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN o_totalprice ELSE round(o_totalprice / 2) END AS rating
    FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-01'
    UNION ALL SELECT -o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1992-03-01')
    SELECT id, rating, row_number() OVER (ORDER BY rating DESC NULLS LAST, id) AS position FROM f""",
)
def o5_listing_changes(spark, sf_dir):
    """Films that go, come, lose their rating, or move by a new one that many share, in two changes to one listing."""
    film = _film(spark, sf_dir)
    listing = Listing(spark, scratch_path(spark, "listing"), "id long, rating double", PAGE_KEYS, range_rows=5_000)
    listing.write(film.select("id", "rating"))
    ended, early = film.filter(F.col("modified") > DAY("1998-06-01")), film.filter(F.col("modified") < DAY("1992-03-01"))
    listing.change(ended, early.select((-F.col("id")).alias("id"), "rating"))
    moved = film.filter((F.col("modified") <= DAY("1998-06-01")) & (F.col("type") != "F"))
    rating = F.when(F.col("type") != "P", F.round(F.col("rating") / 2))
    listing.change(moved, moved.select("id", rating.alias("rating")))
    return listing.numbered()


@query(
    "o5_all_pages",
    """SELECT o_orderkey AS id, (row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) // 50 + 1 AS page_number FROM orders""",
)
def o5_all_pages(spark, sf_dir):
    numbered = pg.number_rows(_film(spark, sf_dir).select("id", "rating"), pg.result_order("rating"))
    return numbered.select("id", (F.floor((F.col("position") - 1) / 50) + 1).alias("page_number"))


@query(
    "o5_deep_pages_by_genre",
    """WITH r AS (SELECT p_partkey AS genre_id, 3 AS page_number, 4 AS page_size FROM part),
    f AS (SELECT l_partkey AS genre_id, o_orderkey AS id, row_number() OVER (PARTITION BY l_partkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
          FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) JOIN orders ON o_orderkey = l_orderkey)
    SELECT genre_id AS request_id, genre_id, CAST(rn - 8 AS BIGINT) AS place, id FROM r JOIN f USING (genre_id) WHERE rn > 8 AND rn <= 12""",
)
def o5_deep_pages_by_genre(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    rows = with_links(cat.film.select("id", "rating"), genre_pairs(cat))
    requests = cat.genre.select(
        F.col("id").alias("request_id"), F.col("id").alias("genre_id"), F.lit(3).alias("page_number"), F.lit(4).alias("page_size")
    )
    pages = pg.pages_for(requests, rows, pg.result_order("rating"), ["genre_id"], shallow=0)
    return pages.select("request_id", "genre_id", F.col("place").cast("bigint").alias("place"), "id")


@query(
    "o6_admin_envelope",
    """WITH c AS (SELECT count(*) AS n, greatest(CAST(ceil(count(*) / 50.0) AS BIGINT), 1) AS p FROM orders)
    SELECT n AS count, p AS total_pages, CASE WHEN p > 1 THEN p - 1 END AS prev, CAST(NULL AS BIGINT) AS next, p AS page FROM c""",
)
def o6_admin_envelope(spark, sf_dir):
    return pg.envelope(_film(spark, sf_dir), "last")


@query("o7_fixed_batches", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS oversized, true AS cut FROM lineitem")
def o7_fixed_batches(spark, sf_dir):
    path, limit = scratch_path(spark, "batches"), 1_000
    orders_catalog(spark, sf_dir).person_film.write.option("maxRecordsPerFile", limit).parquet(path)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    oversized = F.count(F.when(F.col("n") > limit, 1)).alias("oversized")
    return files.agg(F.sum("n").alias("rows"), oversized, (F.count("*") >= F.sum("n") / limit).alias("cut"))


@query("o8_order_by_id_desc", "SELECT s_suppkey AS id, s_name AS full_name, row_number() OVER (ORDER BY s_suppkey DESC) AS position FROM supplier")
def o8_order_by_id_desc(spark, sf_dir):
    return pg.number_rows(orders_catalog(spark, sf_dir).person, [F.col("id").desc()])


AFFECTED_SQL = """
SELECT o_orderkey AS id FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-01'
UNION SELECT l_orderkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
UNION SELECT l_orderkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 48)"""


def changing_catalog(spark, sf_dir):
    """The orders catalogue with times of change on people and genres too."""
    cat = orders_catalog(spark, sf_dir)
    new, old = DAY("1999-01-01"), DAY("1990-01-01")
    person = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("full_name"),
        F.when(F.col("s_acctbal") < 0, new).otherwise(old).alias("modified"),
    )
    genre = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 48, new).otherwise(old).alias("modified"),
    )
    return replace(cat, person=person, genre=genre), Marks(*[DAY("1998-06-01")] * 3)


@query("u1_union_of_affected", AFFECTED_SQL)
def u1_union_of_affected(spark, sf_dir):
    return affected_films(*changing_catalog(spark, sf_dir))


@query("u2_set_add", "SELECT DISTINCT user_id AS id FROM events UNION SELECT s_suppkey FROM supplier")
def u2_set_add(spark, sf_dir):
    users = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    people = orders_catalog(spark, sf_dir).person.select("id")
    return sets.add_ids(sets.add_ids(people, users), users)


@query(
    "u3_table_difference",
    """SELECT o_orderkey AS id, o_orderpriority AS title, 'source' AS side FROM orders WHERE o_totalprice < 50000
    UNION ALL SELECT o_orderkey, 'changed', 'target' FROM orders WHERE o_totalprice < 50000""",
)
def u3_table_difference(spark, sf_dir):
    film = _film(spark, sf_dir)
    changed = film.withColumn("title", F.when(F.col("rating") < 50_000, "changed").otherwise(F.col("title")))
    return sets.table_diff(film.select("id", "title"), changed.select("id", "title"))


@query("u4_common_names", "SELECT DISTINCT o_orderstatus AS name FROM orders INTERSECT SELECT DISTINCT l_linestatus FROM lineitem")
def u4_common_names(spark, sf_dir):
    left = _film(spark, sf_dir).select(F.col("type").alias("name"))
    return sets.common_names(left, read_table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("name")))


@query("q1_unique_genre_name", "SELECT p_name AS name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def q1_unique_genre_name(spark, sf_dir):
    return checks.repeated(orders_catalog(spark, sf_dir).genre, ["name"])


@query(
    "q2_unique_role_link",
    f"WITH {ORDERS_SQL} SELECT role, person_id, film_work_id, count(*) AS n FROM person_film GROUP BY ALL HAVING count(*) > 1",
)
def q2_unique_role_link(spark, sf_dir):
    return checks.repeated(orders_catalog(spark, sf_dir).person_film, ["role", "person_id", "film_work_id"])


@query(
    "q3_primary_key",
    """SELECT nullif(l_orderkey, 3) AS id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 OR nullif(l_orderkey, 3) IS NULL""",
)
def q3_primary_key(spark, sf_dir):
    return checks.key_faults(read_table(spark, sf_dir, "lineitem").select(F.expr("nullif(l_orderkey, 3)").alias("id")))


@query(
    "q4_orphan_links",
    "SELECT user_id AS person_id, count(*) AS n FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1",
)
def q4_orphan_links(spark, sf_dir):
    links = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("person_id"))
    return checks.orphans(links, "person_id", orders_catalog(spark, sf_dir).person)


@query("q5_rating_range", "SELECT s_suppkey AS id, s_acctbal AS rating FROM supplier WHERE s_acctbal < 0 OR s_acctbal > 9000")
def q5_rating_range(spark, sf_dir):
    rated = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("rating"))
    return checks.out_of_range(rated, "rating", 0, 9000)


@query(
    "q6_domain",
    "SELECT l_orderkey, l_linenumber, l_returnflag AS role FROM lineitem WHERE l_returnflag = 'R'",
)
def q6_domain(spark, sf_dir):
    line = read_table(spark, sf_dir, "lineitem")
    coded = line.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("role"))
    named = F.when(F.col("role") == "A", ROLES[0]).when(F.col("role") == "N", ROLES[2]).otherwise(F.col("role"))
    bad = checks.out_of_domain(coded.withColumn("named", named), "named", ROLES)
    return bad.select("l_orderkey", "l_linenumber", "role")


@query("q7_max_length", "SELECT doc_id, length(text) AS n FROM documents WHERE length(text) > 255")
def q7_max_length(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return checks.too_long(docs, "text", 255).select("doc_id", F.length("text").cast("bigint").alias("n"))


@query("q8_strict_schema", "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, true AS roles_missing FROM supplier")
def q8_strict_schema(spark, sf_dir):
    person = orders_catalog(spark, sf_dir).person.select(F.col("id").cast("string").alias("id"), F.col("full_name").alias("name"))
    shaped = checks.conform(person, PERSON_DOCUMENT)
    return shaped.select("id", "name", F.col("roles").isNull().alias("roles_missing"))


@query(
    "q9_cascade_delete",
    """SELECT l_orderkey AS film_work_id, l_suppkey AS person_id FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""",
)
def q9_cascade_delete(spark, sf_dir):
    deleted = read_table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("id"))
    links = orders_catalog(spark, sf_dir).person_film.select("film_work_id", "person_id")
    return checks.cascade(links, "person_id", deleted)


def _document_candidates(spark, sf_dir):
    docs = film_documents(orders_catalog(spark, sf_dir), extra=["type"])
    return docs.withColumn("title", F.expr("nullif(title, '5-LOW')")).withColumn(
        "genres", F.expr("CASE WHEN type = 'P' THEN NULL ELSE genres END")
    )


@query(
    "q10_quarantine",
    """SELECT o_orderkey AS id, concat_ws(',', CASE WHEN o_orderpriority = '5-LOW' THEN 'title' END,
    CASE WHEN o_orderstatus = 'P' THEN 'genres,genres_items' END) AS reason
    FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderstatus = 'P'""",
)
def q10_quarantine(spark, sf_dir):
    _, bad = checks.split_valid(_document_candidates(spark, sf_dir), checks.document_rules())
    return bad.select("id", "reason")


@query(
    "q10_valid_documents",
    f"""WITH {ORDERS_SQL}, {members_sql()} SELECT f.id, f.rating AS imdb_rating, f.title, f.description, {DOCUMENT_COLUMNS_SQL}
    {DOCUMENT_FROM_SQL} WHERE f.title <> '5-LOW' AND f.type <> 'P'""",
)
def q10_valid_documents(spark, sf_dir):
    valid, _ = checks.split_valid(_document_candidates(spark, sf_dir), checks.document_rules())
    return documents_text(valid.drop("type"))


@query(
    "q11_reconcile_counts",
    """SELECT 'film' AS table_name, (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM orders) AS target_rows, true AS equal
    UNION ALL SELECT 'links', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem)),
    (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem))""",
)
def q11_reconcile_counts(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    return checks.reconcile(
        {"film": cat.film, "links": cat.person_film}, {"film": cat.film, "links": cat.person_film.distinct()}
    )


@query(
    "q12_completeness",
    """SELECT id, 'target' AS side FROM (SELECT o_orderkey AS id FROM orders EXCEPT SELECT l_orderkey FROM lineitem)""",
)
def q12_completeness(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    reached = sets.union_ids(
        cat.person_film.select(F.col("film_work_id").alias("id")), cat.genre_film.select(F.col("film_work_id").alias("id"))
    )
    return sets.table_diff(reached, cat.film.select("id"))
