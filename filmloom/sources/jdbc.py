"""JDBC scans and sinks. Tables are read in parallel and joined in Spark."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        given = {"url": self.url, "driver": self.driver, "fetchsize": str(self.fetch_size)}
        if self.user:
            given |= {"user": self.user, "password": self.password}
        return given

    def table(
        self,
        spark: SparkSession,
        name: str,
        partition_column: str | None = None,
        bounds: tuple[object, object] | None = None,
        partitions: int = 1,
    ) -> DataFrame:
        """Scan a table; with a partition column, in ``partitions`` parallel ranges.

        Column selection and filters put on the result are sent to the database.
        """
        reader = spark.read.format("jdbc").options(**self.options()).option("dbtable", name)
        if partition_column is not None and bounds is not None:
            reader = reader.options(
                partitionColumn=partition_column,
                lowerBound=str(bounds[0]),
                upperBound=str(bounds[1]),
                numPartitions=str(partitions),
            )
        return reader.load()

    def ranged_table(self, spark: SparkSession, name: str, column: str, partitions: int) -> DataFrame:
        """``table`` with the bounds of ``column`` asked from the database first (one row)."""
        ends = self.table(spark, name).agg(F.min(column), F.max(column)).first()
        if ends[0] is None:
            return self.table(spark, name)
        return self.table(spark, name, column, (ends[0], ends[1]), partitions)

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """Result of a query that runs in the database, as one partition."""
        return spark.read.format("jdbc").options(**self.options()).option("query", sql).load()

    def append(self, df: DataFrame, name: str, batch_size: int = 1_000, connections: int = 16) -> None:
        """Insert rows in batches; a duplicate key fails the job, an empty frame does nothing."""
        if df.isEmpty():
            return
        (
            df.write.format("jdbc")
            .options(**self.options())
            .option("dbtable", name)
            .option("batchsize", str(batch_size))
            .option("numPartitions", str(connections))
            .mode("append")
            .save()
        )

    def truncate(self, spark: SparkSession, name: str, cascade: bool = True) -> None:
        """Empty a table, keeping its definition."""
        (
            self.table(spark, name)
            .limit(0)
            .write.format("jdbc")
            .options(**self.options())
            .option("dbtable", name)
            .option("truncate", "true")
            .option("cascadeTruncate", str(cascade).lower())
            .mode("overwrite")
            .save()
        )
