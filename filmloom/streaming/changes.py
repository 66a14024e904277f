"""Change capture and document refresh as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.plans.refresh import ENTITIES, StoredCatalog, refresh_around, refresh_links
from filmloom.session import materialise, short_lived
from filmloom.sources.documents import DocumentTable


def read_changes(
    spark: SparkSession, folder: str, ddl: str, files_per_batch: int = 1_000, glob: str | None = None
) -> DataFrame:
    """Stream of an append-only change log kept as Parquet files."""
    reader = spark.readStream.schema(ddl).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def first_seen(stream: DataFrame, key: str, spread_by: str, salts: int = 16) -> DataFrame:
    """Each key once over the whole stream.

    Repeats are dropped in two steps. The first keeps state by key and a salt,
    so repeats of a hot key are dropped by many tasks; the second sees a key at
    most ``salts`` times.
    """
    salted = stream.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    return salted.dropDuplicates([key, "_salt"]).drop("_salt").dropDuplicates([key])


def first_seen_within(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """As ``first_seen`` for unbounded input: keys are forgotten ``delay`` after their time."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return timed.dropDuplicatesWithinWatermark([key])


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available, then stop; a rerun continues where this ended."""
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )


def run_batches(stream: DataFrame, sink: Callable[[DataFrame, int], object], checkpoint: str) -> None:
    """Hand each micro-batch and its number to ``sink``; progress is saved after the sink returns.

    A batch whose sink fails comes again on the next run, with the same number, so sinks must be
    safe to repeat.
    """
    (
        stream.writeStream.foreachBatch(lambda batch, number: sink(batch, number) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Sink that appends each batch once: the rows lie in a folder of their batch, which a batch that comes again
    writes anew. A folder of a failed write is replaced, one of a whole write by the same rows."""

    def sink(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("_batch", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)

    return sink


def refresh_sink(stored: StoredCatalog, table: DocumentTable) -> Callable[[DataFrame, int], None]:
    """Sink for changes ``(entity, id)``: rebuild the affected documents and upsert them.

    A batch reads the folders of its own keys in the stored links, never the whole link tables.
    """

    def sink(batch: DataFrame, _: int) -> None:
        # Written once: the branches below would each read the batch again.
        with short_lived(table.spark):
            ids = materialise(batch.select("entity", "id").distinct(), "changed")
            refresh_around(stored, table, {e: ids.filter(F.col("entity") == e).select("id") for e in ENTITIES})

    return sink


def link_sink(stored: StoredCatalog, table: DocumentTable) -> Callable[[DataFrame, int], None]:
    """Sink for changes of links to people ``(op, seq, film_work_id, person_id, role)``: apply them, and rebuild the films
    on either side."""

    def sink(batch: DataFrame, _: int) -> None:
        refresh_links(stored, table, person=materialise(batch, "link-log"))

    return sink
