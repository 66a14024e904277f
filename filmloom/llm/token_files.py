"""Token ids as flat binary files with 64-bit document offsets, written and read by Spark tasks.

Documents are range-partitioned and sorted by id. Each partition writes two files into one folder: ``part-N.bin`` holds
the ids of its documents as little-endian unsigned integers of 2 bytes (4 if the vocabulary needs them), one document
after another; ``part-N.idx`` holds, as 64-bit integers, a magic number, the bytes of an id, the number of documents and
that of null ids (which come first), the offset of each document and the end, and the document ids. A partition's base,
the number of ids in all partitions before it, is a prefix sum over the partitions' counts. Files are written under a
name of the attempt and then renamed, so a repeated task leaves the same files.

The folder must be reachable from all tasks: a path or ``file:`` URI of a shared folder, which is memory-mapped when
read, or a URI of a store that pyarrow knows, from which whole files are read.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.common import steps
from filmloom.llm.lexicon_bpe import SAFE

MAGIC = 0x4449584E454B4F54
#: Text bytes that a pair of files holds about.
PART_BYTES = 32 << 20
#: Pieces of text that a worker remembers at a time, and the longest of them.
REMEMBERED, LONGEST = 1_000_000, 64

_unsafe = re.compile(f"[^{SAFE}]").search
_letters = "A-Za-zÀ-ÖØ-öø-ž"  # of SAFE
_pieces = re.compile(rf" ?[{_letters}]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\s0-9{_letters}]+|\s+(?!\S)|\s+").findall


class _Remembered(dict):
    def __init__(self, encode, kind: str) -> None:
        super().__init__()
        self._encode, self._kind = encode, kind

    def __missing__(self, piece: str) -> bytes:
        ids = np.asarray(self._encode(piece, add_special_tokens=False).ids, self._kind).tobytes()
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


class ByteBpe:
    """The tokenizer of a byte-level vocabulary file. It encodes each piece of a text by itself, so pieces are looked up
    once found. Texts of other than common characters, and those that hold a special token, go to it whole."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self.width = 2 if self._tokenizer.get_vocab_size() <= 1 << 16 else 4
        specials = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, specials))).search if specials else lambda text: None
        self._known = _Remembered(self._tokenizer.encode, f"<u{self.width}")

    def encode(self, text: str) -> bytes:
        if _unsafe(text) or self._special(text):
            return np.asarray(self._tokenizer.encode(text, add_special_tokens=False).ids, f"<u{self.width}").tobytes()
        return b"".join(map(self._known.__getitem__, _pieces(text)))


@cache
def tokenizer(vocabulary: str) -> ByteBpe:
    return ByteBpe(vocabulary)


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def _write(folder: str, vocabulary: str, end: int | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, bpe, (fs, root) = TaskContext.get().partitionId(), tokenizer(vocabulary), _place(folder)
    tail = b"" if end is None else np.asarray([end], f"<u{bpe.width}").tobytes()
    names = {kind: f"{root}/part-{part:06d}.{kind}" for kind in ("bin", "idx")}
    attempt = {kind: f"{name}-{uuid.uuid4().hex}" for kind, name in names.items()}
    offsets, ids, nulls = [0], [], 0
    with fs.open_output_stream(attempt["bin"]) as out:
        for batch, texts in steps(batches, lambda b: b.column("text")):
            own = batch.column("doc_id")
            nulls += own.null_count
            ids.append(own.fill_null(0).to_numpy())
            for text in texts:
                data = bpe.encode(text or "") + tail
                out.write(data)
                offsets.append(offsets[-1] + len(data) // bpe.width)
    n = len(offsets) - 1
    with fs.open_output_stream(attempt["idx"]) as out:
        for column in (np.array([MAGIC, bpe.width, n, nulls]), np.array(offsets), np.concatenate(ids) if ids else np.empty(0)):
            out.write(column.astype("<i8").tobytes())
    for kind, name in names.items():
        fs.move(attempt[kind], name)
    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([offsets[-1]], pa.int64())], names=["part", "docs", "tokens"])


def write_token_files(docs: DataFrame, vocabulary: str, folder: str, end: int | None = None) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) to ``folder``, each document followed by the id ``end``, in ascending
    order of doc_id; the partitions come back as ``part, docs, tokens, base``.

    Null ids come first. Rows of one doc_id are in order of their text's hash, then of their place in the input; they
    may lie in several partitions. A null or empty text has only the end id. An empty table gives empty files.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fs, root = _place(folder)
    fs.create_dir(root, recursive=True)
    parts = max(1, -(-total // PART_BYTES))
    order = ["doc_id", "_hash", "_row"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    kind = "part int, docs bigint, tokens bigint"
    found = dealt.mapInArrow(lambda it: _write(folder, vocabulary, end, it), kind).toPandas().sort_values("part")
    found["base"] = found["tokens"].cumsum() - found["tokens"]
    return spark.createDataFrame(found.astype({"part": "int32"}), f"{kind}, base bigint")


def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    fs, root = _place(folder)
    path = f"{root}/{name}"
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _read(folder: str, batches: Iterator[pa.RecordBatch], step: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist(), strict=True):
            index = _mapped(folder, f"part-{part:06d}.idx", "<i8")
            magic, width, n, nulls = index[:4].tolist()
            if magic != MAGIC:
                raise ValueError(f"part {part} of {folder} is no token file")
            ids, offsets, doc_ids = _mapped(folder, f"part-{part:06d}.bin", f"<u{width}"), index[4 : 5 + n], index[5 + n :]
            for a in range(0, n, step):
                b = min(a + step, n)
                at = offsets[a : b + 1]
                own = [ids[i:j].astype("<u4").tobytes() for i, j in zip(at.tolist(), at[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.asarray(doc_ids[a:b]), pa.int64(), mask=np.arange(a, b) < nulls),
                        pa.array(base + np.asarray(at[:-1]), pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(own, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )


def read_token_files(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files of ``parts`` (part, base): the number of ids of
    all documents before it, its own number, and its ids as little-endian unsigned 32-bit numbers."""
    n = max(1, parts.count())
    return parts.select("part", "base").repartition(n).mapInArrow(lambda it: _read(folder, it), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


__all__ = ["ByteBpe", "read_token_files", "write_token_files"]
