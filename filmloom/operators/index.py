"""A stored text index that takes changes.

Every table lies in folders of generations. The first generation holds all documents; each later one the postings of the
documents that changed, and the ids whose earlier rows it ends. Document frequencies and lengths are kept as signed
sums, so they need no second look at what didn't change. ``merged`` writes all that lives as one generation again.

* ``forward``: doc, field, dl, term, tf, at (places of the term) - by hash of the document, so what a document held is read from its folder;
* ``postings``: the same rows by hash of the term and by level: a level holds the postings whose gain lies in one range,
  so the best of a term are read without the rest;
* ``blocks``: field, term, level, rows, most, at_dl - the postings of a term in a level are a block; ``most`` is its
  highest saturation, for the mean length ``at_dl``. Rows without a level are subtracted from the sums;
* ``stats``: field, docs, total - signed; ``dead``: doc; ``commits``: gen, base - written last, so a generation of a
  writer that was lost is never read, and is written over by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.functions.text import ANALYSERS
from filmloom.operators.skew import fits_broadcast, spread
from filmloom.session import by_folder, materialise, save, scratch_path, short_lived

# Relevance parameters.
K1 = 1.2
B = 0.75
# Saturations from which a posting lies in level 0, 1 and 2; the rest is level 3. They may change from one generation
# to the next.
LEVELS = (1.5, 1.1, 0.7)
# Occurrences of terms that are counted at once; a longer document is counted alone.
OCCURRENCES = 200_000


@dataclass(frozen=True)
class Field:
    """A searchable field of a document, read from ``column`` (default: its name).

    ``kind`` is an analyser's name, ``keyword`` for whole values, or ``number``
    for values equal to the query as a single-precision number.
    """

    name: str
    kind: str = "mixed"
    column: str | None = None

    @property
    def source(self) -> str:
        return self.column or self.name


# Fields of a film document that a search over all fields reads.
FILM_FIELDS = (
    Field("title"),
    Field("description"),
    Field("actors_names"),
    Field("directors_names"),
    Field("writers_names"),
    Field("genres_names", "keyword"),
    Field("id", "keyword"),
    Field("title_raw", "keyword", "title"),
    Field("imdb_rating", "number"),
)
PERSON_FIELDS = (Field("name", "plain"),)


def number_text(c: Column) -> Column:
    return c.try_cast("float").cast("string")


def _texts(field: Field, dtype: T.DataType) -> Column:
    """The values of a field as an array; those that aren't analysed are its terms."""
    c = F.col(field.source)
    many = isinstance(dtype, T.ArrayType)
    if field.kind == "number":
        return F.array_compact(F.array(number_text(c)))
    values = F.coalesce(c if many else F.array(c), F.array()).cast("array<string>")
    return F.array_distinct(F.array_compact(values)) if field.kind == "keyword" else values


def analysed(docs: DataFrame, fields: Sequence[Field], key: str = "id") -> DataFrame:
    """``(doc, field, terms)``: one row for each field of a document, in one pass over ``docs``.

    The fields become rows before they are analysed, so the plan holds each analyser once.
    """
    named = [F.struct(F.lit(f.name).alias("field"), F.lit(f.kind).alias("kind"), _texts(f, docs.schema[f.source].dataType).alias("texts")) for f in fields]
    rows = spread(docs, key).select(F.col(key).alias("doc"), F.inline(F.array(*named)))
    terms = F.col("texts")
    for kind in sorted({f.kind for f in fields} & set(ANALYSERS)):
        terms = F.when(F.col("kind") == kind, F.flatten(F.transform("texts", ANALYSERS[kind]))).otherwise(terms)
    return rows.select("doc", "field", terms.alias("terms"))


def terms_of(docs: DataFrame, fields: Sequence[Field], key: str = "id") -> DataFrame:
    """``(doc, field, dl, at, term)``: one row for each term occurrence and its place."""
    return analysed(docs, fields, key).select("doc", "field", F.size("terms").alias("dl"), F.posexplode("terms").alias("at", "term"))


def counting(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for Arrow tasks: the distinct terms of each row ``doc, field, terms``, with their places in rising order.
    About ``most`` occurrences are counted at once. It is sent by value, so workers need not find this package."""

    def count(batches):
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column("terms")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
                part, sizes = batch.slice(start, stop - start), np.diff(ends[start:stop], prepend=before)
                start, total = stop, int(sizes.sum())
                if not total:
                    continue
                coded = pc.dictionary_encode(part.column("terms").flatten())
                code = coded.indices.to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                group = row * len(coded.dictionary) + code
                order = np.argsort(group, kind="stable")
                heads = np.flatnonzero(np.diff(group[order], prepend=-1))
                first = order[heads]
                of_row = pa.array(row[first])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(of_row), part.column("field").take(of_row), pa.array(sizes[row[first]].astype(np.int32)),
                        coded.dictionary.take(pa.array(code[first])), pa.array(np.diff(heads, append=total).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.append(heads, total).astype(np.int32)), pa.array(place[order].astype(np.int32))),
                    ],
                    names=["doc", "field", "dl", "term", "tf", "at"],
                )

    return count


def counted_terms(docs: DataFrame, fields: Sequence[Field], key: str = "id") -> DataFrame:
    """``(doc, field, dl, term, tf, at)``, a document's rows side by side; ``at`` are the places of a term.

    A document is one input row, so its terms are counted where it is analysed and no occurrence is shuffled. Rows of one
    id are counted together if they have one length.
    """
    kind = docs.schema[key].dataType.simpleString()
    counted = lambda rows: analysed(rows, fields, key).mapInArrow(counting(OCCURRENCES), f"doc {kind}, field string, dl int, term string, tf bigint, at array<int>")
    again = materialise(docs.groupBy(key).count().filter("count > 1").select(F.col(key).alias("_again")), "repeated-ids")
    if again.isEmpty():
        return counted(docs)
    again = F.broadcast(again) if fits_broadcast(again) else again
    same = F.col(key).eqNullSafe(F.col("_again"))
    merged = counted(docs.join(again, same, "left_semi")).groupBy("doc", "field", "dl", "term")
    merged = merged.agg(F.sum("tf").alias("tf"), F.sort_array(F.flatten(F.collect_list("at"))).alias("at"))
    return counted(docs.join(again, same, "left_anti")).unionByName(merged)


def saturation(tf: Column, dl: Column, avg_dl: Column) -> Column:
    return (K1 + 1) * tf / (tf + K1 * (1 - B + B * dl / avg_dl))


def hash_bucket(column: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Index:
    """One state of the index at ``path``: the generations committed when it was opened. ``ended`` tells up to which
    generation the rows of a document are over; None while no document has changed."""

    spark: SparkSession
    path: str
    fields: tuple[Field, ...]
    buckets: int
    key: str
    gens: tuple[int, ...]
    ended: DataFrame | None

    def rows(self, table: str, ddl: str) -> DataFrame:
        found = self.spark.read.schema(f"{ddl}, gen int").parquet(f"{self.path}/{table}")
        return found.filter(F.col("gen").isin(list(self.gens)))

    def _living(self, rows: DataFrame) -> DataFrame:
        if self.ended is None:
            return rows.drop("gen")
        alive = F.col("ended").isNull() | (F.col("gen") >= F.col("ended"))
        return rows.join(self.ended, "doc", "left").filter(alive).drop("gen", "ended")

    @property
    def forward(self) -> DataFrame:
        """``doc, field, dl, term, tf, bucket``: the terms of each document; ``bucket`` is that of the document."""
        return self._living(self.rows("forward", f"doc {self.key}, field string, dl int, term string, tf bigint, at array<int>, bucket int"))

    @property
    def postings(self) -> DataFrame:
        """``doc, field, dl, term, tf, bucket, level``: the documents of each term; ``bucket`` is that of the term."""
        return self._living(self.rows("postings", f"doc {self.key}, field string, dl int, term string, tf bigint, at array<int>, bucket int, level int"))

    @property
    def _sums(self) -> DataFrame:
        return self.rows("blocks", "field string, term string, level int, rows bigint, most double, at_dl double")

    @property
    def vocabulary(self) -> DataFrame:
        """``field, term, df``."""
        return self.vocabulary_of()

    def vocabulary_of(self, terms: DataFrame | None = None) -> DataFrame:
        """``vocabulary``, or the rows of ``terms`` (field, term; a scan) alone."""
        return self._sums_of(terms).groupBy("field", "term").agg(F.sum("rows").alias("df")).filter("df > 0")

    @property
    def blocks(self) -> DataFrame:
        """``field, term, level, rows, most``: no saturation in a block exceeds ``most``; rows that ended since still count.

        A saturation grows with the mean length, but by no greater share than that.
        """
        return self.blocks_of()

    def blocks_of(self, terms: DataFrame | None = None) -> DataFrame:
        """``blocks``, or those of ``terms`` (field, term; a scan) alone."""
        # The statistics have one row for each field, of which there are a fixed few.
        known = self._sums_of(terms).filter("level IS NOT NULL").join(F.broadcast(self.stats), "field")
        most = F.max(F.col("most") * F.greatest(F.lit(1.0), F.col("avg_dl") / F.col("at_dl")))
        return known.groupBy("field", "term", "level").agg(F.sum("rows").alias("rows"), most.alias("most"))

    def _sums_of(self, terms: DataFrame | None) -> DataFrame:
        """The sums of a few terms are picked out before anything is shuffled."""
        if terms is None or not fits_broadcast(terms):
            return self._sums
        return self._sums.join(F.broadcast(terms.select("field", "term").distinct()), ["field", "term"], "left_semi")

    @property
    def stats(self) -> DataFrame:
        """One row for each field: documents holding it and their mean length."""
        held = self.rows("stats", "field string, docs bigint, total bigint").groupBy("field")
        held = held.agg(F.sum("docs").alias("docs"), F.sum("total").alias("total")).filter("docs > 0")
        return held.select("field", "docs", (F.col("total") / F.col("docs")).alias("avg_dl"))

    def forward_of(self, docs: DataFrame) -> DataFrame:
        """The terms of the documents ``doc``, from their folders alone."""
        wanted = materialise(docs.select(F.col("doc").cast(self.key)).distinct(), "index-docs")
        # At most ``buckets`` numbers.
        places = [r[0] for r in wanted.select(hash_bucket("doc", self.buckets)).distinct().collect()]
        found = self.forward.filter(F.col("bucket").isin(places))
        return found.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "doc", "left_semi").drop("bucket")

    def update(self, docs: DataFrame | None = None, deleted: DataFrame | None = None, key: str = "id") -> Index:
        """Add or replace ``docs``, each given once, and take out the ids ``deleted``; returns the new state.

        Only the given documents are analysed, and only the folders that held them are read.
        """
        ids = [df.select(F.col(key).cast(self.key).alias("doc")) for df in (docs, deleted) if df is not None]
        with short_lived(self.spark):
            gone = materialise(ids[0].unionByName(ids[-1]).distinct(), "changed-docs")
            old = materialise(self.forward_of(gone), "former-terms")
            fresh = counted_terms(docs, self.fields, key).withColumn("doc", F.col("doc").cast(self.key)) if docs is not None else old.limit(0)
            _write(self, self.gens[-1] + 1, fresh, old, gone, base=False)
        return open_index(self.spark, self.path, self.fields)

    def merged(self) -> Index:
        """The same documents as one generation; nothing is analysed again."""
        none = self.forward.drop("bucket").limit(0)
        _write(self, self.gens[-1] + 1, self.forward.drop("bucket"), none, none.select("doc"), base=True)
        return open_index(self.spark, self.path, self.fields)


def _stats_of(rows: DataFrame, sign: int) -> DataFrame:
    lengths = rows.select("doc", "field", "dl").distinct().groupBy("field")
    return lengths.agg((sign * F.count("*")).alias("docs"), (sign * F.sum("dl")).alias("total"))


def _write(index: Index, gen: int, fresh: DataFrame, old: DataFrame, gone: DataFrame, base: bool) -> None:
    """Write the generation: the terms of new documents, less those of old ones."""
    spark, place = index.spark, lambda table: f"{index.path}/{table}/gen={gen}"
    put = lambda df, table, *folders: save(df.sparkSession, df.write.mode("overwrite").partitionBy(*folders), place(table))
    # A document's rows come side by side.
    put(by_folder(fresh.withColumn("bucket", hash_bucket("doc", index.buckets)), index.buckets, "bucket").sortWithinPartitions("bucket"), "forward", "bucket")
    alone = Index(spark, index.path, index.fields, index.buckets, index.key, (gen,), None)
    written = alone.forward.drop("bucket")
    put(_stats_of(written, 1).unionByName(_stats_of(old, -1)).coalesce(1), "stats")
    seen = Index(spark, index.path, index.fields, index.buckets, index.key, (gen,) if base else (*index.gens, gen), None)
    gained = saturation(F.col("tf"), F.col("dl"), F.col("avg_dl"))
    level = F.lit(len(LEVELS))
    for i, least in reversed(list(enumerate(LEVELS))):
        level = F.when(gained >= least, i).otherwise(level)
    # The statistics have one row for each field, of which there are a fixed few.
    by_term = written.join(F.broadcast(seen.stats), "field").withColumn("level", level).withColumn("bucket", hash_bucket("term", index.buckets))
    by_term = by_folder(by_term.select("doc", "field", "dl", "term", "tf", "at", "bucket", "level"), index.buckets * (len(LEVELS) + 1), "bucket", "level")
    put(by_term.sortWithinPartitions("bucket", "level", "term"), "postings", "bucket", "level")
    bound = [F.count("*").alias("rows"), F.max(gained).alias("most"), F.first("avg_dl").alias("at_dl")]
    blocks = alone.postings.join(F.broadcast(seen.stats), "field").groupBy("field", "term", "level").agg(*bound)
    lost = old.groupBy("field", "term").agg((-F.count("*")).alias("rows"))
    put(blocks.unionByName(lost, allowMissingColumns=True), "blocks")
    put(gone, "dead")
    entry = spark.createDataFrame([(gen, base, index.key, index.buckets)], "gen int, base boolean, key string, buckets int")
    entry.coalesce(1).write.mode("append").parquet(f"{index.path}/commits")


def write_index(docs: DataFrame, fields: Sequence[Field], path: str, key: str = "id", buckets: int = 256) -> Index:
    """Write an index of ``docs``, each given once. ``buckets`` are the folders of a level: thousands for a large corpus.

    A folder holds files of even size, each sorted by term.
    """
    doc = docs.schema[key].dataType.simpleString()
    empty = Index(docs.sparkSession, path, tuple(fields), buckets, doc, (), None)
    none = docs.sparkSession.createDataFrame([], f"doc {doc}, field string, dl int, term string, tf bigint, at array<int>")
    with short_lived(docs.sparkSession):
        _write(empty, 1, counted_terms(docs, fields, key), none, none.select("doc"), base=True)
    return open_index(docs.sparkSession, path, fields)


def build_index(docs: DataFrame, fields: Sequence[Field], key: str = "id", buckets: int = 4) -> Index:
    """An index in the shared folder, for this session's queries."""
    return write_index(docs, fields, scratch_path(docs.sparkSession, "index"), key, buckets)


def open_index(spark: SparkSession, path: str, fields: Sequence[Field]) -> Index:
    """The state of the index now; changes committed later are seen by who opens it again."""
    # A row for each change since the last merge, and the merges.
    commits = spark.read.schema("gen int, base boolean, key string, buckets int").parquet(f"{path}/commits").collect()
    base = max(c["gen"] for c in commits if c["base"])
    gens = tuple(sorted({c["gen"] for c in commits if c["gen"] >= base}))
    index = Index(spark, path, tuple(fields), commits[0]["buckets"], commits[0]["key"], gens, None)
    if len(gens) == 1:
        return index
    ended = index.rows("dead", f"doc {index.key}").groupBy("doc").agg(F.max("gen").alias("ended"))
    ended = materialise(ended, "ended-docs")
    return Index(spark, path, index.fields, index.buckets, index.key, gens, F.broadcast(ended) if fits_broadcast(ended) else ended)
