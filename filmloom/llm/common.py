"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that one step of a Python task works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20

#: Bytes of a text to bytes of its words: A-Z lower-cased, every other ASCII byte but a-z and 0-9 a blank.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str) -> list[bytes]:
    """Words of a text: runs of ASCII letters, ASCII digits and all that is not ASCII, with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def id_text(column: str = "doc_id") -> Column:
    """An id as text; a null id is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``: the fold of a row."""
    return F.crc32(id_text(column).cast("binary")) % modulus


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``: no added column can clash with a column of the caller."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def steps(batches: Iterator[pa.RecordBatch], text_of: Callable[[pa.RecordBatch], pa.Array]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Arrow batches cut to about ``STEP_BYTES`` of text, with their texts (None for null)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = text_of(batch)
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        step = np.cumsum(sizes) // STEP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                yield batch.slice(a, b - a), texts.slice(a, b - a).to_pylist()


def struct_text(batch: pa.RecordBatch, field: str = "text") -> pa.Array:
    """The text inside the packed row, null where the row or the text is null."""
    return pc.struct_field(batch.column("row"), field).cast(pa.string())


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


def added(df: DataFrame, fields: str) -> T.StructType:
    """Schema of ``df`` with the fields of a DDL string behind it."""
    return T.StructType([*df.schema.fields, *T._parse_datatype_string(fields).fields])


def by_size(spark: SparkSession, rows: int, per_task: int, least: int = 1) -> int:
    """Number of partitions for so many rows, never fewer than the session's own."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))
