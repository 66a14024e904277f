"""Bootstrap: load, check and publish the five catalogue tables together."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from filmloom.catalog import MAX_NAME_LENGTH, RATING_RANGE, TABLES
from filmloom.operators.checks import conform, key_faults, orphans, out_of_range, repeated, require_none, too_long
from filmloom.operators.projections import default_text, rename_loaded

RELEASE = "release string, at timestamp, seq bigint"


def touch(df: DataFrame) -> DataFrame:
    """Stamp ``modified`` with the load time, in the same pass as the write."""
    return df.withColumn("modified", F.current_timestamp()) if "modified" in df.columns else df


def prepared(name: str, df: DataFrame) -> DataFrame:
    """A source table in the shape of its target."""
    df = rename_loaded(df)
    if name == "film_work":
        df = default_text(df, "title", "type")
    return touch(conform(df, TABLES[name]))


def catalogue_faults(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every constraint a load must hold, by name, as frames of offenders."""
    faults = {f"{name}_key": key_faults(df) for name, df in tables.items()}
    faults["genre_name"] = repeated(tables["genre"], ["name"])
    faults["genre_name_length"] = too_long(tables["genre"], "name", MAX_NAME_LENGTH)
    faults["film_rating"] = out_of_range(tables["film_work"], "rating", *RATING_RANGE)
    # A null role is never equal to another, so it does not repeat a link.
    roles = tables["person_film_work"].filter(F.col("role").isNotNull())
    faults["person_role"] = repeated(roles, ["role", "person_id", "film_work_id"])
    for link, parent in (("genre_film_work", "genre"), ("person_film_work", "person")):
        faults[f"{link}_film"] = orphans(tables[link], "film_work_id", tables["film_work"])
        faults[f"{link}_{parent}"] = orphans(tables[link], f"{parent}_id", tables[parent])
    return faults


def bootstrap(spark: SparkSession, sources: dict[str, DataFrame], path: str, rows_per_file: int = 5_000_000) -> str:
    """Write all tables aside, check them, then publish them with one log line."""
    release = uuid.uuid4().hex
    staged: dict[str, DataFrame] = {}
    for name in TABLES:
        folder = f"{path}/releases/{release}/{name}"
        prepared(name, sources[name]).write.option("maxRecordsPerFile", rows_per_file).parquet(folder)
        staged[name] = spark.read.schema(TABLES[name]).parquet(folder)
    require_none(catalogue_faults(staged))
    newest = _newest(spark, path)
    entry = spark.createDataFrame([(release,)], "release string").withColumn("at", F.current_timestamp())
    # The number is the order of releases; a second writer of the same number is refused.
    entry.coalesce(1).write.parquet(f"{path}/log/seq={(newest['seq'] if newest else 0) + 1}")
    return release


def _newest(spark: SparkSession, path: str) -> Row | None:
    try:
        return spark.read.schema(RELEASE).parquet(f"{path}/log").orderBy(F.desc("seq")).first()
    except AnalysisException:
        return None


def published(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the latest release; before the first, empty ones."""
    row = _newest(spark, path)
    if row is None:
        return {name: spark.createDataFrame([], ddl) for name, ddl in TABLES.items()}
    return {
        name: spark.read.schema(ddl).parquet(f"{path}/releases/{row['release']}/{name}")
        for name, ddl in TABLES.items()
    }
