"""Change capture, propagation and streaming refresh."""

from dataclasses import replace

from pyspark.sql import functions as F

from filmloom.catalog import document_ddl, orders_catalog, read_table
from filmloom.plans.documents import film_documents
from filmloom.plans.refresh import StoredCatalog, changed_ids, films_of, next_mark, refresh, refresh_from_state, refresh_links
from filmloom.queries.order import AFFECTED_SQL, DAY, changing_catalog
from filmloom.queries.registry import DOCUMENT_COLUMNS_SQL, DOCUMENT_FROM_SQL, LINKS_SQL, ORDERS_SQL, documents_sql, documents_text, members_sql, query
from filmloom.session import materialise, scratch_path
from filmloom.sources.documents import DocumentTable
from filmloom.sources.state import add_to_ids, read_ids
from filmloom.streaming import changes

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
USER_FILMS_SQL = "SELECT l_orderkey FROM lineitem WHERE l_suppkey IN (SELECT user_id FROM events)"


def event_log(spark, sf_dir, files: int | None = None):
    """The events as a folder of change-log files; the path is returned."""
    path = scratch_path(spark, "event-log")
    events = read_table(spark, sf_dir, "events").drop("props")
    (events.repartition(files, "event_id") if files else events).write.parquet(path)
    return path


@query("t1_change_capture", "SELECT o_orderkey AS id FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-01'")
def t1_change_capture(spark, sf_dir):
    return changed_ids(orders_catalog(spark, sf_dir).film, DAY("1998-06-01"))


@query(
    "t1_next_mark",
    "SELECT 'film' AS name, max(o_orderdate) AS mark, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_id FROM orders",
)
def t1_next_mark(spark, sf_dir):
    return next_mark(orders_catalog(spark, sf_dir).film, DAY("1998-06-01"), "film")


@query("t1_stream_capture", "SELECT event_id, user_id AS id FROM events WHERE event_type = 'purchase'")
def t1_stream_capture(spark, sf_dir):
    out = scratch_path(spark, "captured")
    stream = changes.read_changes(spark, event_log(spark, sf_dir), EVENTS)
    picked = stream.filter("event_type = 'purchase'").select("event_id", F.col("user_id").alias("id"))
    changes.run_to_files(picked, out, scratch_path(spark, "checkpoint"))
    return spark.read.schema("event_id bigint, id bigint").parquet(out)


@query("t2_change_propagation", "SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 48)")
def t2_change_propagation(spark, sf_dir):
    cat, marks = changing_catalog(spark, sf_dir)
    return films_of(cat.genre_film, "genre_id", changed_ids(cat.genre, marks.genre))


@query("t3_stream_first_seen", "SELECT DISTINCT user_id AS id FROM events")
def t3_stream_first_seen(spark, sf_dir):
    out = scratch_path(spark, "first-seen")
    stream = changes.read_changes(spark, event_log(spark, sf_dir), EVENTS).select(F.col("user_id").alias("id"), "event_id")
    changes.run_to_files(changes.first_seen(stream, "id", "event_id").select("id"), out, scratch_path(spark, "checkpoint"))
    return spark.read.schema("id bigint").parquet(out)


# Ids of one batch, others four days later, and the first again: by then they are forgotten.
FORGET_SQL = """WITH h AS (SELECT date_trunc('day', min(ts)) + INTERVAL 15 DAY AS half FROM events)
SELECT DISTINCT user_id AS id, 1 AS batch FROM events, h WHERE user_id % 2 = 0 AND ts < half
UNION ALL SELECT DISTINCT user_id, 2 FROM events, h WHERE user_id % 2 = 1 AND ts >= half + INTERVAL 4 DAY AND ts < half + INTERVAL 6 DAY
UNION ALL SELECT DISTINCT user_id, 3 FROM events, h WHERE user_id % 2 = 0 AND ts >= half + INTERVAL 6 DAY"""


@query("t3_stream_first_seen_within", FORGET_SQL)
def t3_stream_first_seen_within(spark, sf_dir):
    out, log, checkpoint = scratch_path(spark, "first-seen"), scratch_path(spark, "log"), scratch_path(spark, "checkpoint")
    half = F.date_trunc("day", F.min("ts")).cast("timestamp_ntz") + F.expr("INTERVAL 15 DAYS")
    events = read_table(spark, sf_dir, "events").drop("props")
    half = F.lit(events.agg(half.alias("half")).first()["half"])
    days, even = lambda n: half + F.expr(f"INTERVAL {n} DAYS"), F.col("user_id") % 2 == 0
    ts = F.col("ts")
    parts = (even & (ts < half), ~even & (ts >= days(4)) & (ts < days(6)), even & (ts >= days(6)))
    for batch, part in enumerate(parts, 1):
        events.filter(part).withColumn("batch", F.lit(batch)).write.mode("append").parquet(log)
        stream = changes.read_changes(spark, log, f"{EVENTS}, batch int").select(F.col("user_id").alias("id"), "ts", "batch")
        changes.run_to_files(changes.first_seen_within(stream, "id", "ts", "1 day").select("id", "batch"), out, checkpoint)
    return spark.read.schema("id bigint, batch int").parquet(out)


@query("t4_set_to_set", f"SELECT DISTINCT l_orderkey AS id FROM ({USER_FILMS_SQL})")
def t4_set_to_set(spark, sf_dir):
    people, films = scratch_path(spark, "people"), scratch_path(spark, "films")
    add_to_ids(read_table(spark, sf_dir, "events").select(F.col("user_id").alias("id")), people, "id bigint")
    links = orders_catalog(spark, sf_dir).person_film
    add_to_ids(films_of(links, "person_id", read_ids(spark, people, "id bigint")), films, "id bigint")
    return read_ids(spark, films, "id bigint")


USER_DOCUMENTS_SQL = f"""WITH {ORDERS_SQL}, {members_sql()}
SELECT f.id, f.rating AS imdb_rating, f.title, f.description, {DOCUMENT_COLUMNS_SQL} {DOCUMENT_FROM_SQL}
WHERE f.id IN ({USER_FILMS_SQL})"""


def _user_changes(spark, sf_dir, files=None):
    stream = changes.read_changes(spark, event_log(spark, sf_dir, files), EVENTS)
    return stream.select(F.lit("person").alias("entity"), F.col("user_id").alias("id"))


def _documents(spark):
    return DocumentTable(spark, scratch_path(spark, "documents"), document_ddl("bigint"), buckets=8)


def _stored(spark, sf_dir):
    return StoredCatalog.write(orders_catalog(spark, sf_dir), scratch_path(spark, "links"), buckets=8)


@query("t2_from_stored_links", "SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_suppkey = 7 OR l_partkey IN (11, 12) UNION SELECT 4")
def t2_from_stored_links(spark, sf_dir):
    ids = lambda *values: spark.createDataFrame([(v,) for v in values], "id bigint")
    _, films = _stored(spark, sf_dir).around({"film": ids(4), "person": ids(7), "genre": ids(11, 12)})
    return films


@query("t5_stream_to_documents", USER_DOCUMENTS_SQL)
def t5_stream_to_documents(spark, sf_dir):
    table = _documents(spark)
    sink = changes.refresh_sink(_stored(spark, sf_dir), table)
    changes.run_batches(_user_changes(spark, sf_dir), sink, scratch_path(spark, "checkpoint"))
    return documents_text(table.read())


@query("t6_replay_after_failure", USER_DOCUMENTS_SQL)
def t6_replay_after_failure(spark, sf_dir):
    """The sink fails after it has written: the batch comes again and changes nothing more."""
    table, checkpoint = _documents(spark), scratch_path(spark, "checkpoint")
    sink, stream = changes.refresh_sink(_stored(spark, sf_dir), table), _user_changes(spark, sf_dir)

    def failing(batch, number):
        sink(batch, number)
        raise RuntimeError("lost after the write")

    try:
        changes.run_batches(stream, failing, checkpoint)
    except Exception as failure:  # the stream reports the sink's error in its own class
        if "lost after the write" not in str(failure):
            raise
    changes.run_batches(stream, sink, checkpoint)
    return documents_text(table.read())


@query("t6_append_once", "SELECT event_id, user_id FROM events")
def t6_append_once(spark, sf_dir):
    """The sink appends, and fails after the first batch is written: the batch that comes again replaces its own rows."""
    out, checkpoint = scratch_path(spark, "appended"), scratch_path(spark, "checkpoint")
    path, sink = event_log(spark, sf_dir, files=4), changes.append_sink(out)

    def failing(batch, number):
        sink(batch, number)
        raise RuntimeError("lost after the write")

    stream = changes.read_changes(spark, path, EVENTS, 2).select("event_id", "user_id")
    try:
        changes.run_batches(stream, failing, checkpoint)
    except Exception as failure:  # the stream reports the sink's error in its own class
        if "lost after the write" not in str(failure):
            raise
    changes.run_batches(stream, sink, checkpoint)
    return spark.read.schema("event_id bigint, user_id bigint, _batch bigint").parquet(out).drop("_batch")


@query("t7_files_per_batch", "SELECT count(*) AS rows, true AS even_batches FROM events")
def t7_files_per_batch(spark, sf_dir):
    out, sizes = scratch_path(spark, "batches"), []
    path = event_log(spark, sf_dir, files=max(spark.sparkContext.defaultParallelism, 8))
    files = len(spark.read.schema(EVENTS).parquet(path).inputFiles())
    files_per_batch = -(-files // 4)

    append = changes.append_sink(out)

    def sink(batch, number):
        sizes.append(1)
        append(batch.select("event_id"), number)

    stream = changes.read_changes(spark, path, EVENTS, files_per_batch)
    changes.run_batches(stream, sink, scratch_path(spark, "checkpoint"))
    rows = spark.read.schema("event_id bigint, _batch bigint").parquet(out).agg(F.count("*").alias("rows"))
    return rows.withColumn("even_batches", F.lit(len(sizes) == -(-files // files_per_batch)))


@query(
    "r14_incremental_refresh",
    f"""WITH {ORDERS_SQL}, {members_sql()}, affected AS ({AFFECTED_SQL})
SELECT f.id, f.rating AS imdb_rating, CASE WHEN a.id IS NULL THEN 'stale' ELSE f.title END AS title, f.description, {DOCUMENT_COLUMNS_SQL}
{DOCUMENT_FROM_SQL} LEFT JOIN affected a ON a.id = f.id""",
)
def r14_incremental_refresh(spark, sf_dir):
    cat, marks = changing_catalog(spark, sf_dir)
    table = _documents(spark)
    table.append(film_documents(cat).withColumn("title", F.lit("stale")))
    refresh(cat, marks, table)
    return documents_text(table.read())


@query("r14_two_refreshes", documents_sql())
def r14_two_refreshes(spark, sf_dir):
    """The first refresh sees no order of an odd key on the latest day; those are stored late, with the same time as its mark."""
    cat, _ = changing_catalog(spark, sf_dir)
    last = materialise(cat.film.agg(F.max("modified").alias("last")), "last-day")
    late = cat.film.join(F.broadcast(last), F.col("modified") == F.col("last"), "left_semi").filter("id % 2 = 1").select("id")
    early = replace(cat, film=cat.film.join(late, "id", "left_anti"))
    table, state = _documents(spark), scratch_path(spark, "marks")
    refresh_from_state(early, state, table)
    refresh_from_state(StoredCatalog.write(cat, scratch_path(spark, "links"), buckets=8), state, table)
    return documents_text(table.read())


# Links of every seventh order go; those of every fifth of the rest move to the next supplier; some orders gain a link.
MOVED_SQL = f"""film AS (
  SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS description, o_orderstatus AS type,
         o_orderdate AS creation_date, o_totalprice AS rating, o_orderdate AS modified
  FROM orders), {LINKS_SQL.replace("person_film AS (", "links AS (")},
person_film AS (
  SELECT film_work_id, CASE WHEN film_work_id % 5 = 0 THEN person_id + 1 ELSE person_id END AS person_id, role FROM links WHERE film_work_id % 7 <> 0
  UNION SELECT film_work_id, 3, 'writer' FROM links WHERE film_work_id % 13 = 0)"""


def link_changes(links):
    """The log of those changes; a link changed twice counts by its last change."""
    gone = links.filter("film_work_id % 7 = 0 OR film_work_id % 5 = 0").select(F.lit("delete").alias("op"), F.lit(1).alias("seq"), "*")
    moved = links.filter("film_work_id % 7 <> 0 AND film_work_id % 5 = 0").withColumn("person_id", F.col("person_id") + 1)
    # The new place of a link may be the old one of another.
    moved = moved.select(F.lit("insert").alias("op"), F.lit(2).alias("seq"), "*")
    fresh = links.filter("film_work_id % 13 = 0").select("film_work_id").distinct()
    fresh = fresh.withColumns({"person_id": F.lit(3).cast("bigint"), "role": F.lit("writer"), "op": F.lit("insert"), "seq": F.lit(3)})
    return gone.unionByName(moved).unionByName(fresh)


def _refreshed_by_links(spark, sf_dir):
    cat, _ = changing_catalog(spark, sf_dir)
    stored, table = StoredCatalog.write(cat, scratch_path(spark, "links"), buckets=8), _documents(spark)
    table.append(film_documents(cat))
    return stored, table, refresh_links(stored, table, person=materialise(link_changes(cat.person_film), "link-log"))


@query(
    "r14_link_changes",
    f"WITH {MOVED_SQL}, {members_sql()} SELECT f.id, f.rating AS imdb_rating, f.title, f.description, {DOCUMENT_COLUMNS_SQL} {DOCUMENT_FROM_SQL}",
)
def r14_link_changes(spark, sf_dir):
    """Documents of stored links after links were inserted, moved and deleted."""
    return documents_text(_refreshed_by_links(spark, sf_dir)[1].read())


@query(
    "t2_films_of_link_changes",
    """SELECT DISTINCT o_orderkey AS id FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 13 = 0""",
)
def t2_films_of_link_changes(spark, sf_dir):
    return _refreshed_by_links(spark, sf_dir)[2]


@query("t5_stream_of_links", f"WITH {MOVED_SQL}, {members_sql()} SELECT f.id, f.rating AS imdb_rating, f.title, f.description, {DOCUMENT_COLUMNS_SQL} {DOCUMENT_FROM_SQL}")
def t5_stream_of_links(spark, sf_dir):
    """The same changes as a stream of log files."""
    cat, log = orders_catalog(spark, sf_dir), scratch_path(spark, "link-log")
    stored, table = StoredCatalog.write(cat, scratch_path(spark, "links"), buckets=8), _documents(spark)
    table.append(film_documents(cat))
    link_changes(cat.person_film).write.parquet(log)
    stream = changes.read_changes(spark, log, "op string, seq int, film_work_id bigint, person_id bigint, role string")
    changes.run_batches(stream, changes.link_sink(stored, table), scratch_path(spark, "checkpoint"))
    return documents_text(table.read())
