"""Progress marks and id work-sets kept as small append-only tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.functions.scalar import since_or_never

# Marks of a later epoch count before those of an earlier one.
STATE = "name string, mark timestamp, last_id string, at timestamp, epoch int"


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Latest mark of each name; no file yet means no marks."""
    try:
        log = spark.read.schema(STATE).parquet(path)
    except AnalysisException:
        log = spark.createDataFrame([], STATE)
    fields = ("mark", "last_id", "at", "epoch")
    newest = F.max_by(F.struct(*fields), F.struct(F.coalesce("epoch", F.lit(0)), "mark", "last_id", "at"))
    return log.groupBy("name").agg(newest.alias("s")).select("name", "s.*")


def write_state(df: DataFrame, path: str, move_back: bool = False) -> None:
    """Append marks ``(name, mark, last_id)``; call it after the sink has succeeded.

    A mark never falls behind an earlier one, unless ``move_back`` starts a new epoch, in which it counts alone.
    """
    spark = df.sparkSession
    epoch = read_state(spark, path).agg(F.max("epoch")).first()[0] or 0
    df.select("name", F.col("mark").cast("timestamp").alias("mark"), F.col("last_id").cast("string").alias("last_id")).withColumn(
        "at", F.current_timestamp()
    ).withColumn("epoch", F.lit(epoch + move_back)).coalesce(1).write.mode("append").parquet(path)


def mark_of(spark: SparkSession, path: str, name: str) -> Column:
    """The mark as a literal column; the floor date before the first load."""
    row = read_state(spark, path).filter(F.col("name") == name).first()
    return since_or_never(F.lit(row["mark"] if row else None).cast("timestamp"))


def read_ids(spark: SparkSession, path: str, ddl: str = "id string") -> DataFrame:
    """Work-set scan; ids added more than once appear once."""
    try:
        return spark.read.schema(ddl).parquet(path).distinct()
    except AnalysisException:
        return spark.createDataFrame([], ddl)


def add_to_ids(ids: DataFrame, path: str, ddl: str = "id string") -> None:
    """Insert ids into a work-set, leaving out those it holds."""
    known = read_ids(ids.sparkSession, path, ddl)
    ids.distinct().join(known, known.columns, "left_anti").write.mode("append").parquet(path)
