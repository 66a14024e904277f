"""Shards of near equal bytes: sampled splitters, range partitioning, and subdivision of overfull ranges.

Keys are drawn with a probability in proportion to their record's size, so quantiles of the sample cut the bytes evenly.
The ranges between the quantiles are many more than the shards. Exact range sizes are then counted; a range that is
overfull, as one key may hold most of the data, is divided by a hash of the row. Prefix sums over the ranges and a
running sum inside each range give every record its exact place in the bytes of the whole, and that place decides the
shard. Only keys and sizes are shuffled, in DataFrame operations only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.session import materialise

#: Bytes that a range should hold, and bounds on the number of ranges for each shard and in all.
RANGE_BYTES = 256 << 20
RANGES_PER_SHARD, MAX_RANGES = 8, 100_000
#: Expected draws for each range: the length of a range is then off by about a sixth.
DRAWS = 32
#: A range of more than so many times the mean is divided.
OVERFULL = 2


def draw_splitters(keyed: DataFrame, total: int, ranges: int) -> list[int]:
    """At most ``ranges - 1`` distinct splitters of the column ``k``, at the quantiles of a sample weighted by ``size``.

    About ``DRAWS * ranges`` draws are made, so what reaches the driver has a bound that doesn't depend on the rows.
    A draw depends on the row number alone, so a lost task draws the same again.
    """
    step = max(1.0, total / (DRAWS * ranges))
    luck = F.pmod(F.xxhash64("rid"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = keyed.select("k", F.floor(F.col("size") / F.lit(step) + luck).alias("w")).filter("w > 0").toPandas()
    if drawn.empty:
        return []
    drawn = drawn.sort_values("k")
    sums = drawn["w"].to_numpy(np.int64).cumsum()
    wanted = sums[-1] * np.arange(1, ranges) / ranges
    return sorted({int(k) for k in drawn["k"].to_numpy()[np.searchsorted(sums, wanted, "right").clip(max=len(sums) - 1)]})


def range_of(key: Column, splitters: list[int]) -> Column:
    """How many splitters are at most the key, by binary search in a constant array."""
    if not splitters:
        return F.lit(0)
    array = F.split(F.lit(",".join(map(str, splitters))), ",").cast("array<bigint>")

    def halve(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["low"] + acc["high"], 1)
        right = (acc["low"] < acc["high"]) & (F.get(array, middle) <= key)
        return F.struct(
            F.when(right, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(right | (acc["low"] >= acc["high"]), acc["high"]).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(splitters)).alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(splitters).bit_length())), start, halve, lambda acc: acc["low"])


def assign_shards(records: DataFrame, key: Column, size: Column, shards: int) -> DataFrame:
    """Every record as ``row`` (a struct of its own columns) with its ``shard`` (from 0) and ``slot`` (gapless from 0).

    Records are in order of ``key``, a long; null keys come first. A shard holds the records whose middle byte falls
    into its share of all bytes, so its size is off by at most the half of the two records at its ends. Records with
    one key stand together unless they were divided, and may then be in several shards. Equal records each get a slot
    of their own. Sizes are at least 0; a null size is 0. An empty table gives no rows.
    """
    least = F.lit(-(1 << 63)).cast("long")
    rows = records.select(
        F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("row"),
        F.coalesce(key.cast("long"), least).alias("k"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
    )
    keyed = materialise(rows.withColumn("rid", F.monotonically_increasing_id()), "keyed")
    total = keyed.agg(F.sum("size")).first()[0] or 0
    ranges = min(MAX_RANGES, max(RANGES_PER_SHARD * shards, -(-total // RANGE_BYTES)))
    ranged = keyed.withColumn("range", range_of(F.col("k"), draw_splitters(keyed, total, ranges)))

    # One row for each range, or each part of a range: their number is bounded by that of the ranges.
    mean = max(1, total // ranges)
    sizes = ranged.groupBy("range").agg(F.sum("size").alias("bytes"))
    parts = sizes.select("range", F.when(F.col("bytes") > OVERFULL * mean, F.ceil(F.col("bytes") / F.lit(mean))).otherwise(1).alias("parts"))
    divided = ranged.join(F.broadcast(materialise(parts, "parts")), "range")
    divided = divided.withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts"))).drop("parts")
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = divided.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).select(
        "range", "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
    )

    inside = Window.partitionBy("range", "part").orderBy("k", "rid")
    placed = divided.withColumn("nth", F.row_number().over(inside)).withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(F.broadcast(materialise(bases, "bases")), ["range", "part"])
    middle = 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2 * max(1, total)))).cast("int")
    numbered = materialise(placed.select("row", shard.alias("shard"), (F.col("rows_before") + F.col("nth") - 1).alias("nth")), "numbered")
    firsts = numbered.groupBy("shard").agg(F.min("nth").alias("first"))
    return numbered.join(F.broadcast(firsts), "shard").select("row", "shard", (F.col("nth") - F.col("first")).alias("slot"))


def write_shards(assigned: DataFrame, path: str, tasks: int) -> None:
    """Write the records of ``assign_shards`` as one folder for each shard, in order of their slots."""
    dealt = assigned.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.select("row.*", "shard").write.partitionBy("shard").parquet(path)
