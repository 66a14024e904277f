"""Result order, single pages, keyset hops, and pages for whole request tables.

Rows are numbered without a single-task window: they are range-partitioned on
the sort key, each part is numbered on its own, and the part sizes (one row for
each part) shift the local numbers. A hot group is then just more parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from filmloom.operators.skew import fits_broadcast, heavy_keys, salted_join, skew_join
from filmloom.session import materialise

# Page defaults.
PAGE_NUMBER = 1
PAGE_SIZE = 50
# Pages that end at or before this row are taken with a limit for each group,
# applied before the shuffle; deeper ones read a numbered listing.
SHALLOW = 1_000
# Rows that one task may sort and skip to reach a single page.
NEAR = 100_000
# Hops of the cursor that are cheaper than numbering the listing.
HOPS = 4


def result_order(sort: str | None = None, score: str | None = None, key: str = "id") -> list[Column]:
    """Order columns of a listing, nulls last.

    The sign is inverted: ``field`` sorts downwards and ``-field`` upwards.
    """
    order = []
    if sort:
        order.append(F.col(sort[1:]).asc_nulls_last() if sort.startswith("-") else F.col(sort).desc_nulls_last())
    if score:
        order.append(F.col(score).desc_nulls_last())
    if (sort or "").lstrip("-") != key:
        order.append(F.col(key).asc_nulls_last())
    return order


def rows_between(df: DataFrame, order: Sequence[Column], offset: int, limit: int, near: int = NEAR) -> DataFrame:
    """``limit`` rows behind the first ``offset``. Rows far from the start are found by number, as the rows before
    them would else all meet in one task."""
    if offset + limit <= near:
        return df.orderBy(*order).offset(offset).limit(limit)
    numbered = number_rows(df, order, "_position")
    return numbered.filter((F.col("_position") > offset) & (F.col("_position") <= offset + limit)).drop("_position")


def page(df: DataFrame, order: Sequence[Column], number: int = PAGE_NUMBER, size: int = PAGE_SIZE) -> DataFrame:
    return rows_between(df, order, (number - 1) * size, size)


@dataclass(frozen=True)
class SortKey:
    column: str
    ascending: bool = True

    def order(self) -> Column:
        c = F.col(self.column)
        return c.asc_nulls_last() if self.ascending else c.desc_nulls_last()

    def beyond(self, last: object) -> Column:
        """Rows whose value sorts after ``last``; nulls sort after every value."""
        c = F.col(self.column)
        if last is None:
            return F.lit(False)
        step = c > F.lit(last) if self.ascending else c < F.lit(last)
        return step | c.isNull()

    def same(self, last: object) -> Column:
        return F.col(self.column).eqNullSafe(F.lit(last))


def after(df: DataFrame, keys: Sequence[SortKey], last: Sequence[object]) -> DataFrame:
    """Rows that sort after the cursor ``last``: a plain predicate, so it is pushed down."""
    predicate = F.lit(False)
    for k, value in reversed(list(zip(keys, last, strict=True))):
        predicate = k.beyond(value) | (k.same(value) & predicate)
    return df.filter(predicate)


def next_page(df: DataFrame, keys: Sequence[SortKey], last: Sequence[object] | None, size: int) -> DataFrame:
    rows = df if last is None else after(df, keys, last)
    return rows.orderBy(*[k.order() for k in keys]).limit(size)


def deep_page(df: DataFrame, keys: Sequence[SortKey], number: int, size: int, hop: int = 10_000) -> DataFrame:
    """Page by cursor hops of at most ``hop`` rows; past the end it is empty.

    Each hop brings one cursor row to the driver and never the rows it skips.
    A hop is a scan, so a page more than ``HOPS`` hops away is read from a numbered listing.
    """
    columns = [k.column for k in keys]
    to_skip, last = (number - 1) * size, None
    if to_skip > HOPS * hop:
        return rows_between(df, [k.order() for k in keys], to_skip, size, near=0)
    while to_skip > 0:
        step = min(hop, to_skip)
        end = next_page(df.select(*columns), keys, last, step).offset(step - 1).first()
        if end is None:
            return df.limit(0)
        last, to_skip = tuple(end), to_skip - step
    return next_page(df, keys, last, size)


def number_rows(df: DataFrame, order: Sequence[Column], into: str = "position") -> DataFrame:
    """Number all rows 1..n in a total order, kept as a written listing."""
    local = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    # The upper bits of a slot are its part, the lower 33 the place inside it.
    stored = materialise(local, "listing").withColumn("_part", F.shiftright("_slot", 33))
    parts = stored.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    place = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.join(F.broadcast(shifts), "_part")
        .withColumn(into, F.col("_shift") + place + 1)
        .drop("_slot", "_part", "_shift")
    )


def number_in_groups(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], into: str = "position"
) -> tuple[DataFrame, DataFrame]:
    """Rows numbered by group then order, and each group's span ``(first, last)``."""
    numbered = number_rows(df, [*[F.col(g).asc_nulls_last() for g in groups], *order], into)
    spans = numbered.groupBy(*groups).agg(F.min(into).alias("first"), F.max(into).alias("last"))
    return numbered, materialise(spans, "spans")


def pages_for(
    requests: DataFrame,
    rows: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    shallow: int = SHALLOW,
) -> DataFrame:
    """Pages of many requests ``(request_id, <groups>, page_number, page_size)`` at once.

    A group is ranked once however many requests ask for it. Result: the rows
    of each page with ``request_id`` and ``place`` (1-based place on the page).
    """
    groups = list(groups)
    wanted = requests.select(
        "request_id", *groups, "page_number", "page_size",
        F.explode(F.sequence(F.lit(1), F.col("page_size"))).alias("place"),
    ).withColumn("_rank", (F.col("page_number") - 1) * F.col("page_size") + F.col("place"))
    wanted = wanted.select("request_id", *groups, "place", F.col("_rank").cast("bigint"))
    deepest = requests.agg(F.max(F.col("page_number") * F.col("page_size"))).first()[0] or 0
    if groups:
        asked = materialise(requests.select(*groups).distinct(), "groups")
        if fits_broadcast(asked):
            rows = rows.join(F.broadcast(asked), groups, "left_semi")
    if deepest <= shallow:
        top = rows if groups else rows.orderBy(*order).limit(deepest)
        rank = F.row_number().over(W.partitionBy(*groups).orderBy(*order))
        ranked = top.withColumn("_rank", rank).filter(F.col("_rank") <= deepest)
        ranked = ranked.withColumn("_rank", F.col("_rank").cast("bigint"))
        on = [*groups, "_rank"]
    else:
        if groups:
            ranked, spans = number_in_groups(rows, groups, order, "_rank")
            wanted = (
                skew_join(wanted, spans, groups, "inner", salt_by=["request_id", "place"])
                .withColumn("_rank", F.col("first") + F.col("_rank") - 1)
                .filter(F.col("_rank") <= F.col("last"))
                .drop("first", "last")
            )
            wanted = materialise(wanted, "wanted-rows")
            ranked = ranked.drop(*groups)
        else:
            ranked = number_rows(rows, order, "_rank")
        on = ["_rank"]
    # A page asked for by very many requests is the hot key here.
    return salted_join(wanted, ranked, on, heavy_keys(wanted, on), "inner", salt_by=["request_id"]).drop("_rank")


def page_numbers(total: Column, size: int) -> Column:
    """Pages needed for ``total`` rows; an empty listing still has one."""
    return F.greatest(F.ceil(total / F.lit(size)), F.lit(1)).cast("bigint")


def envelope(df: DataFrame, page_name: str | int = PAGE_NUMBER, size: int = PAGE_SIZE) -> DataFrame:
    """One row: count, total_pages, prev, next and the resolved page number."""
    counted = df.agg(F.count("*").alias("count")).withColumn("total_pages", page_numbers(F.col("count"), size))
    if page_name == "last":
        asked = F.col("total_pages")
    else:
        asked = F.lit(1 if page_name == "first" else int(page_name)).cast("bigint")
    number = F.greatest(F.least(asked, F.col("total_pages")), F.lit(1))
    return counted.withColumn("page", number).select(
        "count",
        "total_pages",
        F.when(F.col("page") > 1, F.col("page") - 1).alias("prev"),
        F.when(F.col("page") < F.col("total_pages"), F.col("page") + 1).alias("next"),
        "page",
    )
