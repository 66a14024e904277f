"""Scalar expressions over built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.catalog import DISPLAY_LABELS

# Fixed values.
EMPTY_TEXT = "EMPTY_STR"
STATE_TIME_FORMAT = "yyyyMMddHHmmss"
NEVER_LOADED = "1700-02-08 01:40:27.425337"
OBJECT_LIST = "array<struct<id:string,name:string>>"
UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def text_or_default(c: str, default: str = EMPTY_TEXT) -> Column:
    return F.coalesce(F.col(c), F.lit(default))


def parse_objects(c: str) -> Column:
    """JSON text of ``[{id, name}, ...]`` to an array of structs; bad text is null."""
    return F.from_json(F.col(c), OBJECT_LIST)


def parse_names(c: str) -> Column:
    return F.from_json(F.col(c), "array<string>")


def parse_document(df: DataFrame) -> DataFrame:
    """Parse the JSON-text arrays of a film document read from a database query."""
    objects = {c: parse_objects(c) for c in ("actors", "writers", "genres", "directors")}
    names = {
        c: parse_names(c)
        for c in ("genres_names", "directors_names", "actors_names", "writers_names")
    }
    return df.withColumns({**objects, **names})


def id_name(key: str | Column, name: str | Column) -> Column:
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.struct(as_col(key).alias("id"), as_col(name).alias("name"))


def or_empty(c: Column) -> Column:
    """``c`` with a missing array replaced by an empty one."""
    return F.coalesce(c, F.array())


def document_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def missing_to_null(c: str, dtype: T.DataType) -> Column:
    """NaN counts as missing for floating columns; other types pass through."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), F.col(c))
    return F.col(c)


def time_to_text(c: str) -> Column:
    return F.date_format(F.col(c), STATE_TIME_FORMAT)


def text_to_time(c: str | Column) -> Column:
    return F.to_timestamp(c, STATE_TIME_FORMAT)


def since_or_never(c: Column) -> Column:
    """A progress mark, or the floor date before the first load."""
    return F.coalesce(c, F.lit(NEVER_LOADED).cast("timestamp"))


def is_uuid(c: str) -> Column:
    return F.col(c).rlike(UUID_PATTERN)


def natural_uuid(*cols: str) -> Column:
    """Reproducible id: a digest of the natural key in UUID form."""
    digest = F.md5(F.to_json(F.array(*[F.col(c).cast("string") for c in cols])))
    pieces = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in pieces])


def labels(spark: SparkSession, domain: str, language: str) -> DataFrame:
    rows = [(code, text) for dom, code, lang, text in DISPLAY_LABELS if (dom, lang) == (domain, language)]
    return spark.createDataFrame(rows, "code string, label string")


def with_label(df: DataFrame, c: str, domain: str, language: str, into: str) -> DataFrame:
    """Display label of a code; the label table has a handful of fixed rows."""
    table = labels(df.sparkSession, domain, language).select(F.col("code").alias(c), F.col("label").alias(into))
    return df.join(F.broadcast(table), c, "left")
