"""A listing kept in order, so that a page or a cursor opens a file or two however many rows lie before it.

Rows lie in ranges of the sort order: a folder and a file for each, and in it their places from 0. The directory has one
row for each range: its rank in the order, its number of rows, its first and its last key. A page is found by the sums
of those numbers, a cursor by the last keys. A change finds the range of each of its rows, and writes only those ranges
anew, in folders that no range uses; the directory follows last. A range over twice ``range_rows`` is divided.
Folders that a change frees are taken by later changes. Two writers at one time are left to the cluster's table format.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.operators.checks import conform
from filmloom.operators.paging import SortKey, after, number_rows
from filmloom.operators.skew import skew_join
from filmloom.session import materialise

RANGE_ROWS = 100_000


@dataclass(frozen=True)
class Listing:
    """Rows of the fields ``ddl`` in the order of ``keys``, which should be total; rows of equal keys lie in any order.

    Nulls come last either way. The directory grows by a row for each ``range_rows`` rows, and is windowed in one task.
    """

    spark: SparkSession
    path: str
    ddl: str
    keys: tuple[SortKey, ...]
    range_rows: int = RANGE_ROWS

    @property
    def _order(self) -> list[Column]:
        return [k.order() for k in self.keys]

    @property
    def _columns(self) -> list[str]:
        return [k.column for k in self.keys]

    def _key(self) -> Column:
        return F.struct(*self._columns)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(f"{self.ddl}, _place long, _range long").parquet(f"{self.path}/rows")

    def _directory_schema(self) -> T.StructType:
        """Every folder as ``_range, rank, rows, first, last``; a free one has no rows and no rank."""
        fields = {f.name: f for f in T.StructType.fromDDL(self.ddl)}
        key = T.StructType([fields[c] for c in self._columns])
        plain = T.StructType.fromDDL("_range long, rank long, rows long")
        return T.StructType([*plain, T.StructField("first", key), T.StructField("last", key)])

    def _directory(self) -> DataFrame:
        return self.spark.read.schema(self._directory_schema()).parquet(f"{self.path}/directory")

    def directory(self) -> DataFrame:
        """The ranges in use, with the number of rows ``before`` each."""
        before = F.sum("rows").over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, -1))
        return self._directory().filter("rows > 0").withColumn("before", F.coalesce(before, F.lit(0)))

    def _opened(self, ranges: list[int]) -> DataFrame:
        return self._rows().filter(F.col("_range").isin(ranges)) if ranges else self._rows().limit(0)

    def numbered(self, into: str = "position") -> DataFrame:
        """All rows with their numbers from 1; nothing is sorted."""
        ranges = self.directory().select("_range", "before")
        return self._rows().join(ranges, "_range").withColumn(into, F.col("before") + F.col("_place") + 1).drop("_range", "_place", "before")

    def ranges_between(self, offset: int, limit: int) -> list[tuple[int, int]]:
        """The ranges that hold rows ``offset + 1`` to ``offset + limit``, and the number of rows before each."""
        held = (F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset)
        return [(r[0], r[1]) for r in self.directory().filter(held).orderBy("rank").select("_range", "before").collect()]

    def page(self, number: int, size: int) -> DataFrame:
        """The rows of page ``number`` (from 1) with their ``position``; past the end there are none."""
        offset = (number - 1) * size
        found = self.ranges_between(offset, size)
        before = F.lit(0).cast("long")
        for folder, rows in found:
            before = F.when(F.col("_range") == folder, F.lit(rows).cast("long")).otherwise(before)
        rows = self._opened([r for r, _ in found]).withColumn("position", before + F.col("_place") + 1)
        return rows.filter((F.col("position") > offset) & (F.col("position") <= offset + size)).drop("_range", "_place")

    def after(self, last: Sequence[object], size: int) -> DataFrame:
        """The next ``size`` rows behind the key ``last``, which need not be in the listing; in no order."""
        ends = [replace(k, column=f"last.{k.column}") for k in self.keys]
        # Of the first range only some rows lie behind the key; as many as are wanted may come from those that follow.
        rows = W.orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
        behind = after(self._directory().filter("rows > 0"), ends, last)
        behind = behind.select("_range", F.sum("rows").over(rows).alias("sum"), F.first("rows").over(rows).alias("own"))
        wanted = behind.filter(F.coalesce(F.col("sum") - F.col("own"), F.lit(0)) < size).select("_range").collect()
        return after(self._opened([r[0] for r in wanted]), self.keys, last).orderBy(*self._order).limit(size).drop("_range", "_place")

    def write(self, rows: DataFrame) -> None:
        """Make the listing of ``rows``, in a new or empty folder."""
        none = self.spark.createDataFrame([], self._directory_schema())
        self._put(conform(rows, self.ddl).withColumn("rank", F.lit(0).cast("long")), none, none)

    def change(self, gone: DataFrame, rows: DataFrame) -> None:
        """Take out the rows with a key of ``gone`` or of ``rows`` (null equals null), then put in ``rows``.

        A row that moves is in ``gone`` with its former key and in ``rows`` with its new one. A key that isn't held is passed
        over, and repeats in ``rows`` all stay. The same change again changes nothing more.
        """
        source = materialise(conform(rows, self.ddl), "listed")
        keys = gone.select(*self._columns).unionByName(source.select(*self._columns)).distinct()
        marked = source.withColumn("_gone", F.lit(False)).unionByName(keys.withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        directory = materialise(self._directory(), "directory")
        owned = materialise(self._owned(marked, directory), "owned")
        touched = materialise(directory.filter("rows > 0").join(owned.select("rank").distinct(), "rank", "left_semi"), "touched")
        held = self._opened([r[0] for r in touched.select("_range").collect()])
        held = held.join(touched.select("_range", "rank"), "_range").drop("_range", "_place")
        ended = owned.filter("_gone").select(F.col("rank").alias("_rank"), *[F.col(c).alias(f"_{c}") for c in self._columns])
        same = [F.col("rank") == F.col("_rank"), *[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self._columns]]
        self._put(held.join(ended, same, "left_anti").unionByName(owned.filter("NOT _gone").drop("_gone")), directory, touched)

    def _owned(self, marked: DataFrame, directory: DataFrame) -> DataFrame:
        """The new rows with the rank of the range that takes them: the last that doesn't begin behind them. Keys that go
        with the rank of each range that may hold them: from the first that doesn't end before them to that same one.

        The ends of the ranges are sorted among the rows; the highest rank seen so far is what is sought. Sorting is by
        parts, whose own highest ranks (a row for each part) are then carried on.
        """
        live = directory.filter("rows > 0")
        mixed = marked.withColumn("_side", F.lit(1))
        for end, side in (("first", 0), ("last", 2)):
            mixed = mixed.unionByName(live.select(f"{end}.*", F.lit(side).alias("_side"), F.col("rank").alias(f"_{end}")), allowMissingColumns=True)
        order = [*self._order, F.col("_side").asc()]
        parts = materialise(mixed.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mixed")
        earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        highest = parts.groupBy("_part").agg(F.max("_first").alias("f"), F.max("_last").alias("l"))
        carried = highest.select("_part", F.max("f").over(earlier).alias("_f"), F.max("l").over(earlier).alias("_l"))
        seen = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        found = parts.withColumn("_first", F.max("_first").over(seen)).withColumn("_last", F.max("_last").over(seen))
        found = found.filter("_side = 1").join(F.broadcast(carried), "_part")
        owner = F.coalesce(F.greatest("_first", "_f"), F.lit(0))
        least = F.coalesce(F.greatest("_last", "_l") + 1, F.lit(0))
        some = F.when(least <= owner, F.sequence(least, owner))
        ranks = F.when(F.col("_gone"), some).otherwise(F.array(owner))
        return found.select(*T.StructType.fromDDL(self.ddl).names, "_gone", F.explode(ranks).alias("rank"))

    def _put(self, rows: DataFrame, directory: DataFrame, touched: DataFrame) -> None:
        """Write ``rows`` (with ``rank``) for the ranges ``touched``, then the directory."""
        numbered = number_rows(rows, [F.col("rank").asc(), *self._order], "_at")
        spans = materialise(numbered.groupBy("rank").agg(F.min("_at").alias("_start"), F.count("*").alias("_rows")), "spans")
        pieces = F.when(F.col("_rows") > 2 * self.range_rows, F.ceil(F.col("_rows") / self.range_rows)).otherwise(1)
        spans = spans.select("rank", "_start", F.ceil(F.col("_rows") / pieces).alias("_size"))
        spanned = skew_join(numbered, spans, ["rank"], "inner", salt_by=["_at"])  # one rank may hold all rows
        at = F.col("_at") - F.col("_start")
        cut = spanned.withColumn("_piece", F.floor(at / F.col("_size"))).withColumn("_place", at % F.col("_size"))
        made = cut.groupBy("rank", "_piece").agg(
            F.count("*").alias("rows"), F.min_by(self._key(), "_place").alias("first"), F.max_by(self._key(), "_place").alias("last")
        )
        made = materialise(made.withColumn("_n", F.row_number().over(W.orderBy("rank", "_piece"))), "made")
        free = directory.filter("rows = 0").select(F.col("_range").alias("_free"), F.row_number().over(W.orderBy("_range")).alias("_n"))
        top = directory.agg(F.max("_range")).first()[0]
        folder = F.coalesce("_free", F.col("_n") + (-1 if top is None else top)).cast("long")
        made = materialise(made.join(free, "_n", "left").withColumn("_range", folder).drop("_n", "_free"), "ranges")
        stored = cut.join(made.select("rank", "_piece", "_range"), ["rank", "_piece"])
        stored = stored.select(*T.StructType.fromDDL(self.ddl).names, "_place", "_range").repartition("_range").sortWithinPartitions("_range", "_place")
        stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_range").parquet(f"{self.path}/rows")
        kept = directory.filter("rows > 0").join(touched.select("_range"), "_range", "left_anti").withColumn("_piece", F.lit(0).cast("long"))
        used = kept.unionByName(made).withColumn("rank", F.row_number().over(W.orderBy("rank", "_piece")).cast("long") - 1).drop("_piece")
        ended = directory.join(used.select("_range"), "_range", "left_anti")
        ended = ended.withColumn("rank", F.lit(None).cast("long")).withColumn("rows", F.lit(0).cast("long"))
        materialise(used.unionByName(ended), "directory").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/directory")
