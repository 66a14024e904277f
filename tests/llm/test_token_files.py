import struct
import zlib

import public_tokenizers
import pytest
from edges import documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from filmloom.llm import token_files
from filmloom.llm.queries import QUERIES
from filmloom.llm.token_files import ByteBpe, read_token_files, write_token_files

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
_BPE = ByteBpe(VOCABULARY)


def _ids(data, kind):
    return list(struct.unpack(f"<{len(data) // struct.calcsize(kind)}{kind}", data))


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text("abcdeinth'rlsv AÀé19_!?\n\t<|>endoftext", max_size=60))
def test_encodes_as_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert _ids(_BPE.encode(text), "H") == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("part", [token_files.PART_BYTES, 20_000])
def test_round_trip_of_edges(spark, folder, monkeypatch, part):
    monkeypatch.setattr(token_files, "PART_BYTES", part)
    docs = documents(spark)
    parts = write_token_files(docs, VOCABULARY, f"file://{folder}/tokens", end=0)
    got = sorted(read_token_files(spark, f"file://{folder}/tokens", parts).collect(), key=lambda r: r["start"])
    assert (parts.count() > 1) == (part == 20_000)
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:i]) for i in range(len(got))]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    want = sorted((str(r["doc_id"]), LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in docs.collect())
    assert sorted((str(r["doc_id"]), _ids(r["ids"], "I")) for r in got) == want


def test_empty_table(spark, folder):
    parts = write_token_files(empty(spark), VOCABULARY, f"{folder}/tokens")
    assert read_token_files(spark, f"{folder}/tokens", parts).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = {r["doc_id"]: r for r in QUERIES["op8_token_files"](spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        own = found.pop(r["doc_id"])
        assert (own["start"], own["n_tokens"], own["ids_crc32"]) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert not found
