"""Incremental refresh: changed rows, affected films, rebuilt documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.catalog import Catalog
from filmloom.operators.filters import changed_from, changed_since
from filmloom.operators.paging import SortKey, next_page, rows_between
from filmloom.operators.sets import union_ids
from filmloom.operators.skew import matching
from filmloom.plans.documents import film_documents, restrict
from filmloom.session import materialise, short_lived
from filmloom.sources.documents import DocumentTable
from filmloom.sources.state import mark_of, write_state


@dataclass(frozen=True)
class Marks:
    """What was read up to, for each entity."""

    film: Column
    person: Column
    genre: Column


ENTITIES = ("film", "person", "genre")
CURSOR = (SortKey("modified"), SortKey("id"))


def changed_ids(df: DataFrame, mark: Column, key: str = "id", at_mark: bool = False) -> DataFrame:
    """Ids changed since the mark; with ``at_mark`` those changed at the mark itself too."""
    found = changed_from(df, mark) if at_mark else changed_since(df, mark)
    return found.select(F.col(key).alias("id")).distinct()


def changed_page(df: DataFrame, mark: Column, offset: int, limit: int) -> DataFrame:
    """One page of changed ids in order of change; equal times are ordered by id."""
    rows = changed_since(df, mark).select("id", "modified")
    return rows_between(rows, [F.col("modified"), F.col("id")], offset, limit)


def changes_after(df: DataFrame, last: Sequence[object] | None, limit: int) -> DataFrame:
    """The next changes behind the cursor ``(modified, id)`` of the last one read. Equal times split over pages lose
    no row, and no page reads the rows of those before it twice."""
    return next_page(df.select("id", "modified"), CURSOR, last, limit)


def next_mark(df: DataFrame, mark: Column, name: str, at_mark: bool = False) -> DataFrame:
    """Mark after reading the changes: the latest time read and its highest id."""
    last = F.struct("modified", "id")
    return (
        (changed_from(df, mark) if at_mark else changed_since(df, mark))
        .agg(F.max(last).alias("m"))
        .filter("m IS NOT NULL")
        .select(F.lit(name).alias("name"), F.col("m.modified").alias("mark"), F.col("m.id").alias("last_id"))
    )


# What a change does with a link: both make it one row at most, so doing it twice changes nothing more.
INSERT, DELETE = "insert", "delete"


@dataclass(frozen=True)
class StoredLinks:
    """A link table kept twice, in folders by film and by member, so that a few keys read their folders only."""

    by_film: DocumentTable
    by_member: DocumentTable

    @staticmethod
    def write(links: DataFrame, fk: str, path: str, buckets: int) -> StoredLinks:
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in links.schema)
        kept = [DocumentTable(links.sparkSession, f"{path}/{key}", ddl, key, buckets) for key in ("film_work_id", fk)]
        for table in kept:
            table.append(links)
        return StoredLinks(*kept)

    def apply(self, changes: DataFrame) -> DataFrame:
        """Apply a log of changes ``(op, seq, <columns of a link>)`` to both forms; returns the ids of the films they touch.

        Of several changes of one link the last by ``seq`` counts; a link that moves is deleted and inserted. The films
        are those of the old links and of the new ones. A log may be applied again after a failure.
        """
        columns = [f.name for f in T.StructType.fromDDL(self.by_film.ddl)]
        last = changes.groupBy(*columns).agg(F.max_by("op", "seq").alias("op"))
        last = materialise(last, "link-changes")
        added = last.filter(F.col("op") == INSERT).select(*columns)
        for table in (self.by_film, self.by_member):
            table.replace(last.select(*columns), added, columns)
        return last.select(F.col("film_work_id").alias("id")).distinct()


@dataclass(frozen=True)
class StoredCatalog:
    """A catalogue whose links are stored. Films, people and genres are read as they are."""

    catalog: Catalog
    person: StoredLinks
    genre: StoredLinks

    @staticmethod
    def write(cat: Catalog, path: str, buckets: int = 64) -> StoredCatalog:
        return StoredCatalog(
            cat,
            StoredLinks.write(cat.person_film, "person_id", f"{path}/person", buckets),
            StoredLinks.write(cat.genre_film, "genre_id", f"{path}/genre", buckets),
        )

    def seen_with(self, catalog: Catalog) -> StoredCatalog:
        """The same stored links beside newer films, people and genres."""
        return replace(self, catalog=catalog)

    def apply(self, person: DataFrame | None = None, genre: DataFrame | None = None) -> DataFrame:
        """Apply changes of links to people and genres; returns the ids of the films they touch."""
        touched = [links.apply(log) for links, log in ((self.person, person), (self.genre, genre)) if log is not None]
        return union_ids(*touched)

    def around(self, changed: dict[str, DataFrame]) -> tuple[Catalog, DataFrame]:
        """The part of the catalogue that changes of ``film``, ``person`` and ``genre`` ids reach, and the films in it.

        Its links are scans of those films' links alone, so documents are built from it as it is.
        """
        reached = [changed["film"].select("id")] if "film" in changed else []
        for entity, links in (("person", self.person), ("genre", self.genre)):
            if entity in changed:
                reached.append(films_of(links.by_member.rows_of(changed[entity]), f"{entity}_id", changed[entity]))
        ids = materialise(union_ids(*reached), "film-ids")
        links = {c: materialise(kept.by_film.rows_of(ids), "near-links") for c, kept in (("person_film", self.person), ("genre_film", self.genre))}
        return replace(self.catalog, film=self.catalog.film.join(ids, "id", "left_semi"), **links), ids


def films_of(links: DataFrame, fk: str, ids: DataFrame) -> DataFrame:
    """Films linked to any of the given people or genres, each once."""
    keys = ids.select(F.col("id").alias(fk))
    hit = matching(links.select("film_work_id", fk), keys, [fk], salt_by=["film_work_id"])
    return hit.select(F.col("film_work_id").alias("id")).distinct()


def affected_films(cat: Catalog, marks: Marks, at_mark: bool = False) -> DataFrame:
    """Ids of films that changed or that a changed person or genre belongs to.

    A link may name a film that is not there; such ids bring no document.
    """
    return union_ids(
        films_of(cat.person_film, "person_id", changed_ids(cat.person, marks.person, at_mark=at_mark)),
        films_of(cat.genre_film, "genre_id", changed_ids(cat.genre, marks.genre, at_mark=at_mark)),
        changed_ids(cat.film, marks.film, at_mark=at_mark),
    )


def rebuilt(cat: Catalog, ids: DataFrame) -> DataFrame:
    """Documents of the films in the work-set."""
    return film_documents(restrict(cat, ids))


def refresh(cat: Catalog, marks: Marks, table: DocumentTable, at_mark: bool = False) -> None:
    """Rebuild every affected document and upsert it."""
    with short_lived(table.spark):
        table.upsert(rebuilt(cat, affected_films(cat, marks, at_mark)), unique=True)


def refresh_links(stored: StoredCatalog, table: DocumentTable, person: DataFrame | None = None, genre: DataFrame | None = None) -> DataFrame:
    """Apply changes of links, then rebuild the documents of the films on either side of them, whose ids are returned.

    After a failure the same log is given again: the links are then as they should be, and the documents follow.
    """
    with short_lived(table.spark):
        films = materialise(stored.apply(person, genre), "film-ids", outlives=True)
        refresh_around(stored, table, {"film": films})
    return films


def refresh_around(stored: StoredCatalog, table: DocumentTable, changed: dict[str, DataFrame]) -> None:
    """Rebuild the documents that the changed ids reach."""
    with short_lived(table.spark):
        near, _ = stored.around(changed)
        table.upsert(film_documents(near), unique=True)


def refresh_from_state(source: Catalog | StoredCatalog, state: str, table: DocumentTable) -> None:
    """Refresh from the marks kept at ``state``, and move them once the documents are written.

    Rows at a mark are read again, as one with the same time may have been stored after the last run; the upsert makes
    that harmless. New marks are taken before the rows are read, so a row that arrives meanwhile is at worst read
    twice. A run that fails leaves the marks as they were. With a ``StoredCatalog`` only the folders of the changed
    keys are read from the links.
    """
    cat = source.catalog if isinstance(source, StoredCatalog) else source
    spark = cat.film.sparkSession
    marks = {e: mark_of(spark, state, e) for e in ENTITIES}
    moved = [next_mark(getattr(cat, e), marks[e], e, at_mark=True) for e in ENTITIES]
    moved = [m.select("name", F.col("mark").cast("timestamp").alias("mark"), F.col("last_id").cast("string").alias("last_id")) for m in moved]
    held = materialise(moved[0].unionByName(moved[1]).unionByName(moved[2]), "marks")
    if isinstance(source, StoredCatalog):
        refresh_around(source, table, {e: changed_ids(getattr(cat, e), marks[e], at_mark=True) for e in ENTITIES})
    else:
        refresh(cat, Marks(**marks), table, at_mark=True)
    write_state(held, state)
