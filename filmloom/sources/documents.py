"""A document table in plain Parquet: append, idempotent upsert, delete.

Rows lie in folders by hash of their id. A change reads the folders of its ids, and writes them anew by dynamic partition
overwrite; no other folder is touched. Each folder keeps one row that is no document (``_live`` false), so a folder whose
documents are all gone is written like any other. Versions, and writers of one folder at one time, are left to the
table format of the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.operators.checks import conform, repeated, require_none
from filmloom.session import by_folder, materialise, save, short_lived


@dataclass(frozen=True)
class DocumentTable:
    """``buckets`` bounds what a small change rewrites: give a large table thousands."""

    spark: SparkSession
    path: str
    ddl: str
    key: str = "id"
    buckets: int = 64
    rows_per_file: int = 5_000_000

    def _stored(self) -> DataFrame:
        schema = f"{self.ddl}, _live boolean, _bucket int"
        try:
            return self.spark.read.schema(schema).parquet(self.path).filter("_live")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        return self._stored().drop("_live", "_bucket")

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("int")

    def _near(self, keys: DataFrame, key: str) -> tuple[DataFrame, list[int]]:
        """The rows in the folders of the keys, and those folders: at most ``buckets`` numbers."""
        places = sorted(r[0] for r in keys.select(self._bucket(key)).distinct().collect())
        return self._stored().filter(F.col("_bucket").isin(places)).drop("_live", "_bucket"), places

    def rows_of(self, keys: DataFrame, column: str = "id") -> DataFrame:
        """The rows of the given keys; only their folders are read."""
        wanted = materialise(keys.select(F.col(column).alias(self.key)).distinct(), "keys")
        return self._near(wanted, self.key)[0].join(wanted, self.key, "left_semi")

    def _write(self, rows: DataFrame, places: list[int] | None) -> None:
        """Put ``rows`` in the place of all rows of the folders, or beside them for an append (None). A folder can't be
        read while it is replaced, so its rows must have been written aside."""
        live = rows.withColumn("_live", F.lit(True)).withColumn("_bucket", self._bucket(self.key))
        if places:
            none = self.spark.createDataFrame([(b, False) for b in places], "_bucket int, _live boolean")
            live = live.unionByName(none, allowMissingColumns=True)
        made = by_folder(live, len(places or range(self.buckets)), "_bucket").write.option("maxRecordsPerFile", self.rows_per_file).partitionBy("_bucket")
        save(live.sparkSession, made.mode("overwrite").option("partitionOverwriteMode", "dynamic") if places else made.mode("append"), self.path)

    def append(self, docs: DataFrame) -> None:
        """Add documents as they are: an id that exists already is then held twice."""
        self._write(conform(docs, self.ddl), None)

    def insert(self, docs: DataFrame) -> None:
        """Add rows with new ids; an id held already, or given twice, fails the batch."""
        with short_lived(self.spark):
            source = materialise(docs, "insert")
            held = self._near(source, self.key)[0].select(self.key)
            require_none({"repeated id": repeated(source, [self.key]), "existing id": source.select(self.key).join(held, self.key, "left_semi")})
            self.append(source)

    def latest(self, docs: DataFrame, order: str | None = None) -> DataFrame:
        """One row for each id, the one highest in ``order`` (default: the whole row)."""
        row = F.struct(*docs.columns)
        by = F.struct(F.col(order), row) if order else row
        return docs.groupBy(F.col(self.key).alias("_key")).agg(F.max_by(row, by).alias("_row")).select("_row.*")

    def upsert(self, docs: DataFrame, order: str | None = None, unique: bool = False) -> None:
        """Replace documents by id, add new ones; doing it twice changes nothing more.

        ``unique`` says that ``docs`` holds each document once already.
        """
        newest = docs if unique else self.latest(docs, order)
        with short_lived(self.spark):
            source = materialise(conform(newest.select(*T.StructType.fromDDL(self.ddl).names), self.ddl), "upsert")
            self.replace(source.select(self.key), source, [self.key])

    def replace(self, gone: DataFrame, rows: DataFrame, on: Sequence[str]) -> None:
        """Take out the rows equal to one of ``gone`` in the columns ``on`` (the key among them), and put in ``rows``.

        Both should be scans, and not of this table. Null equals null. Only the folders of their keys are written.
        """
        kept, places = self._near(gone.select(self.key).unionByName(rows.select(self.key)), self.key)
        ended = gone.select(*[F.col(c).alias(f"_{c}") for c in on]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
        if places:
            # New rows lie elsewhere already, so they aren't written aside.
            with short_lived(self.spark):
                self._write(materialise(kept.join(ended, same, "left_anti"), "kept-rows").unionByName(rows), places)

    def delete(self, condition: Column) -> None:
        """Drop the rows for which ``condition`` holds; null keeps the row. Only their folders are written."""
        gone = F.coalesce(condition, F.lit(False))
        rows, places = self._near(self.read().filter(gone), self.key)
        if places:
            with short_lived(self.spark):
                self._write(materialise(rows.filter(~gone), "kept-rows"), places)

    def truncate(self) -> None:
        self.read().limit(0).write.mode("overwrite").parquet(self.path)
