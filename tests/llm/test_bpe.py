import hashlib
import struct

import public_tokenizers
import pytest
from edges import as_set, documents, empty, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from filmloom.llm.lexicon_bpe import WordBpe, build_lexicon, encode_documents
from filmloom.llm.queries import QUERIES
from filmloom.llm.transducer import Lexicon, compile_words

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)


def _ids(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 5), max_size=4)))
def test_transducer_maps_exactly_its_words(tmp_path_factory, entries):
    path = tmp_path_factory.mktemp("lexicon") / "words.bin"
    path.write_bytes(compile_words(sorted((w, tuple(o)) for w, o in entries.items())))
    lexicon = Lexicon(str(path))
    assert all(lexicon.get(w) == o for w, o in entries.items())
    for w in entries:
        for other in (w[:-1], w + b"\x00", w[::-1]):
            assert lexicon.get(other) == entries.get(other)


def test_common_endings_are_shared(tmp_path):
    words = sorted((f"{a}{b}ation".encode(), (i,)) for i, a in enumerate("abcdefgh") for b in "xyz")
    path = tmp_path / "words.bin"
    path.write_bytes(compile_words(words))
    assert Lexicon(str(path)).states == 1 + 1 + 6  # a first letter's output stands on its arc, all else is shared
    with pytest.raises(ValueError):
        compile_words([(b"b", (1,)), (b"a", (2,))])


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text("abcdeinth'rlsv AÀé19_!?\n<|>endoftext", max_size=60))
def test_encodes_and_decodes_as_the_library(text):
    bpe = _BPE
    text = text.encode("utf-8", "ignore").decode()
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert _ids(bpe.encode(text)) == want
    assert bpe.decode(bpe.encode(text)) == LIBRARY.decode(want, skip_special_tokens=False)


_BPE = WordBpe(VOCABULARY)


@pytest.mark.parametrize("text", ["x" * 5000, "ab" * 400, "?!" * 900, "a<|endoftext|>b <|startoftext|>", "ΣΑΣ İ ŉ ﬁ é", "thee" * 7])
def test_long_and_special_texts(text):
    assert _ids(_BPE.encode(text)) == LIBRARY.encode(text, add_special_tokens=False).ids


def _check(rows):
    for r in rows:
        ids = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("words", [0, 20, 50_000])
def test_documents_with_any_lexicon(spark, words):
    docs = documents(spark, [(200 + i, prose(i), "en") for i in range(20)])
    rows = encode_documents(docs, VOCABULARY, words=words).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = LIBRARY.encode(r["row"]["text"] or "", add_special_tokens=False).ids
        assert _ids(r["ids"]) == want and r["n_tokens"] == len(want) and r["row"]["ids"] in ("ids!", None)
        assert r["decoded"] == LIBRARY.decode(want, skip_special_tokens=False)


def test_lexicon_holds_the_most_frequent_words(spark, tmp_path):
    docs = spark.createDataFrame([("b b a a c",), ("B <|endoftext|> d e",), ("e " * 9,)], "text string")
    path = tmp_path / "words.bin"
    path.write_bytes(build_lexicon(docs, VOCABULARY, 3))
    lexicon = Lexicon(str(path))
    assert all(map(lexicon.get, (b"a", b"b", b"e"))) and lexicon.get(b"c") is None
    path.write_bytes(build_lexicon(docs, VOCABULARY, 2))
    assert Lexicon(str(path)).get(b"b") and Lexicon(str(path)).get(b"a") is None


def test_empty_table(spark):
    assert as_set(encode_documents(empty(spark), VOCABULARY)) == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = QUERIES["op4_bpe"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    assert len(found) == 200
    _check(found)
