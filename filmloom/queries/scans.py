"""Sources and sinks."""

from pyspark.sql import functions as F

from filmloom.catalog import orders_catalog, read_table
from filmloom.operators.checks import reconcile
from filmloom.operators.skew import skew_join
from filmloom.queries.registry import query
from filmloom.session import materialise, scratch_path
from filmloom.sources.documents import DocumentTable
from filmloom.sources.load import bootstrap, published, touch
from filmloom.sources.state import add_to_ids, read_ids, read_state, write_state

GENRES = "id bigint, name string"
FILMS = "id bigint, title string, type string, rating double"


def _table(spark, label, ddl):
    return DocumentTable(spark, scratch_path(spark, label), ddl, buckets=8)


def _films(spark, sf_dir):
    return orders_catalog(spark, sf_dir).film.select("id", "title", "type", "rating")


@query("s3_snapshot_scan", "SELECT p_partkey AS id, p_name AS name FROM part")
def s3_snapshot_scan(spark, sf_dir):
    table = _table(spark, "snapshots", GENRES)
    table.append(orders_catalog(spark, sf_dir).genre)
    # What is read page by page while the table changes is a copy of its rows.
    snapshot = materialise(table.read(), "snapshot")
    table.delete(F.col("name").startswith("b"))
    return snapshot


@query("s4_work_set_scan", "SELECT DISTINCT user_id AS id FROM events")
def s4_work_set_scan(spark, sf_dir):
    path = scratch_path(spark, "ids")
    ids = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    for _ in range(2):
        add_to_ids(ids, path, "id bigint")
    return read_ids(spark, path, "id bigint")


def _marks(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.groupBy(F.col("event_type").alias("name")).agg(
        F.max("ts").alias("mark"), F.max_by("event_id", F.struct("ts", "event_id")).alias("last_id"), F.min("ts").alias("first")
    )


@query(
    "s5_progress_state",
    """SELECT event_type AS name, max(ts) AS mark, CAST(arg_max(event_id, (ts, event_id)) AS VARCHAR) AS last_id
    FROM events GROUP BY event_type""",
)
def s5_progress_state(spark, sf_dir):
    path, marks = scratch_path(spark, "state"), _marks(spark, sf_dir)
    write_state(marks.withColumn("mark", F.col("first")), path)
    write_state(marks, path)
    return read_state(spark, path).select("name", F.col("mark").cast("timestamp_ntz").alias("mark"), "last_id")


@query("k1_batched_insert", "SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS type, o_totalprice AS rating FROM orders")
def k1_batched_insert(spark, sf_dir):
    table, films = _table(spark, "insert", FILMS), _films(spark, sf_dir)
    table.insert(films.filter("type = 'F'"))
    table.insert(films.filter("type <> 'F'"))
    return table.read()


@query("k2_touch_on_load", "SELECT o_orderkey AS id, o_orderdate AS created, true AS touched FROM orders")
def k2_touch_on_load(spark, sf_dir):
    film = orders_catalog(spark, sf_dir).film.select("id", F.col("modified").alias("created"), "modified")
    return touch(film).select("id", "created", (F.col("modified") > F.col("created")).alias("touched"))


@query(
    "k3_upsert_idempotent",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'changed' ELSE o_orderpriority END AS title,
    o_orderstatus AS type, o_totalprice AS rating FROM orders""",
)
def k3_upsert_idempotent(spark, sf_dir):
    table, films = _table(spark, "upsert", FILMS), _films(spark, sf_dir)
    table.append(films)
    changed = films.filter("type = 'F'").withColumn("title", F.lit("changed"))
    for _ in range(2):
        table.upsert(changed)
    return table.read()


@query(
    "k3_upsert_latest",
    """SELECT user_id AS id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def k3_upsert_latest(spark, sf_dir):
    table = _table(spark, "latest", "id bigint, event_type string, value double")
    events = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), "event_type", "value", F.struct("ts", "event_id").alias("at")
    )
    table.upsert(events, order="at")
    return table.read()


@query("k4_document_append", "SELECT p_partkey AS id, CAST(2 AS BIGINT) AS n FROM part")
def k4_document_append(spark, sf_dir):
    table = _table(spark, "append", GENRES)
    for _ in range(2):
        table.append(orders_catalog(spark, sf_dir).genre)
    return table.read().groupBy("id").agg(F.count("*").alias("n"))


@query("k5_truncate", "SELECT p_partkey AS id, p_name AS name FROM part WHERE false")
def k5_truncate(spark, sf_dir):
    table = _table(spark, "truncate", GENRES)
    table.append(orders_catalog(spark, sf_dir).genre)
    table.truncate()
    return table.read()


@query(
    "k6_delete_by_query",
    "SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS type, o_totalprice AS rating FROM orders WHERE o_orderstatus <> 'P'",
)
def k6_delete_by_query(spark, sf_dir):
    table = _table(spark, "delete", FILMS)
    table.append(_films(spark, sf_dir))
    table.delete(F.col("type") == "P")
    return table.read()


def bootstrap_sources(spark, sf_dir):
    """The driver tables in the shape of the five source tables, duplicates removed."""
    cat = orders_catalog(spark, sf_dir)
    stamps = [F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at")]
    text = lambda c, name: F.col(c).cast("string").alias(name)
    kinds = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("genre_id"), F.col("p_type").alias("kind"))
    named = skew_join(cat.genre_film, kinds, ["genre_id"], "inner", salt_by=["film_work_id"])
    genre_links = named.select(text("film_work_id", "film_work_id"), F.col("kind").alias("genre_id"))
    person_links = cat.person_film.select(text("film_work_id", "film_work_id"), text("person_id", "person_id"), "role")
    link_id = lambda df: df.distinct().select(
        F.concat_ws("-", *df.columns).alias("id"), *df.columns, stamps[0]
    )
    return {
        "genre": kinds.select(F.col("kind").alias("id"), F.col("kind").alias("name")).distinct().select("*", *stamps),
        "person": cat.person.select(text("id", "id"), "full_name", *stamps),
        "film_work": cat.film.select(
            text("id", "id"), "title", "description", F.expr("nullif(type, 'P')").alias("type"),
            (F.col("rating") / 10_000).alias("rating"), *stamps,
        ),
        "genre_film_work": link_id(genre_links),
        "person_film_work": link_id(person_links),
    }


@query(
    "k7_bootstrap",
    """
WITH n AS (
  SELECT 'genre' AS table_name, count(DISTINCT p_type) AS source_rows FROM part
  UNION ALL SELECT 'person', count(*) FROM supplier
  UNION ALL SELECT 'film_work', count(*) FROM orders
  UNION ALL SELECT 'genre_film_work', count(*) FROM (SELECT DISTINCT l_orderkey, p_type FROM lineitem JOIN part ON p_partkey = l_partkey)
  UNION ALL SELECT 'person_film_work', count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem))
SELECT table_name, source_rows, source_rows AS target_rows, true AS equal FROM n""",
)
def k7_bootstrap(spark, sf_dir):
    path, sources = scratch_path(spark, "bootstrap"), bootstrap_sources(spark, sf_dir)
    bootstrap(spark, sources, path)
    return reconcile(sources, published(spark, path))


@query(
    "k7_bootstrap_films",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title,
    CASE WHEN o_orderstatus = 'P' THEN 'EMPTY_STR' ELSE o_orderstatus END AS type, o_totalprice / 10000 AS rating FROM orders""",
)
def k7_bootstrap_films(spark, sf_dir):
    path = scratch_path(spark, "bootstrap")
    bootstrap(spark, bootstrap_sources(spark, sf_dir), path)
    return published(spark, path)["film_work"].select("id", "title", "type", "rating")


@query(
    "k8_progress_write",
    """SELECT 'film' AS name, max(o_orderdate) AS mark,
    CAST(arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS VARCHAR) AS last_id FROM orders""",
)
def k8_progress_write(spark, sf_dir):
    film, path = orders_catalog(spark, sf_dir).film, scratch_path(spark, "state")
    stored = materialise(film, "films")
    newest = stored.agg(F.max(F.struct(F.col("modified").cast("timestamp").alias("t"), "id")).alias("m"))
    write_state(newest.select(F.lit("film").alias("name"), F.col("m.t").alias("mark"), F.col("m.id").alias("last_id")), path)
    return read_state(spark, path).select("name", F.col("mark").cast("timestamp_ntz").alias("mark"), "last_id")
