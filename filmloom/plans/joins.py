"""Join shapes the catalogue needs beyond the document build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.catalog import Catalog
from filmloom.operators.skew import matching, skew_join
from filmloom.session import materialise


def _reached(cat: Catalog, links: DataFrame, fk: str, member: DataFrame) -> DataFrame:
    """``(id, member)`` pairs of a full outer chain film - link - member.

    A link without its film belongs to the null film, and so does a member that
    no link reaches. A link without its member, or a film without links, brings
    a null member.
    """
    used = links.select(F.col("film_work_id").alias("id"), F.col(fk).alias("member")).distinct()
    films = cat.film.select("id", F.col("id").alias("film"))
    known = member.select(F.col("id").alias("member"), F.col("id").alias("known"))
    raw = links.select(F.col("film_work_id").alias("id"), F.col(fk).alias("member"))
    to_film = skew_join(used, films, ["id"], "left", salt_by=["member"], measure=raw)
    to_member = skew_join(to_film.select("film", "member"), known, ["member"], "left", salt_by=["film"], measure=raw)
    linked = to_member.select(F.col("film").alias("id"), F.col("known").alias("member"))
    unused = known.join(used.select("member").distinct(), "member", "left_anti")
    idle = cat.film.select("id").join(used.select("id").distinct(), "id", "left_anti")
    return linked.unionByName(unused.select(F.lit(None).cast(films.schema["id"].dataType).alias("id"), "member")).unionByName(
        idle.select("id", F.lit(None).cast(known.schema["member"].dataType).alias("member"))
    )


def full_outer_counts(cat: Catalog) -> DataFrame:
    """Distinct genres and people of each film id in the full outer join of all tables.

    The null id stands for everything without a film. Each chain is reduced to
    distinct pairs first, so films x genres x people is never formed.
    """
    genres = _reached(cat, cat.genre_film, "genre_id", cat.genre).groupBy("id").agg(F.count_distinct("member").alias("genres"))
    people = _reached(cat, cat.person_film, "person_id", cat.person).groupBy("id").agg(
        F.count_distinct("member").alias("people")
    )
    joined = genres.alias("g").join(people.alias("p"), F.col("g.id").eqNullSafe(F.col("p.id")), "full")
    return joined.select(
        F.coalesce("g.id", "p.id").alias("id"),
        F.coalesce("genres", F.lit(0)).alias("genres"),
        F.coalesce("people", F.lit(0)).alias("people"),
    )


def linked_pairs(film: DataFrame, links: DataFrame, fk: str, keys: DataFrame) -> DataFrame:
    """Films once for each link that holds one of the keys: repeats are kept."""
    hit = matching(links.select(F.col("film_work_id").alias("id"), fk), keys, [fk], salt_by=["id"])
    pairs = materialise(hit, "film-links")
    return skew_join(pairs, film, ["id"], "inner", salt_by=[fk]).drop(fk)


def presence(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Where each row's key is found: both sides, source only or target only.

    A row of the result for each pair of equal keys, and for each row without one, as in a full
    join. Both sides are counted by key first, so a repeated key moves once and its
    pairs are made only where they are returned.
    """
    sides = source.select(key, F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(target.select(key, F.lit(0).alias("s"), F.lit(1).alias("t")))
    counts = sides.groupBy(key).agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    null = F.col(key).isNull()
    side = F.when(F.col("t") == 0, "source only").when(F.col("s") == 0, "target only").otherwise("both")
    # Null keys equal nothing: each is a row of its own side.
    found = F.when(null, F.array(F.struct(F.lit("source only").alias("side"), F.col("s").alias("n")), F.struct(F.lit("target only").alias("side"), F.col("t").alias("n"))))
    found = found.otherwise(F.array(F.struct(side.alias("side"), F.when((F.col("s") == 0) | (F.col("t") == 0), F.col("s") + F.col("t")).otherwise(F.col("s") * F.col("t")).alias("n"))))
    rows = counts.select(key, F.inline(found)).filter("n > 0")
    return rows.select(key, "side", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))).drop("col")
