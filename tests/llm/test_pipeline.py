import hashlib
import struct

import public_tokenizers
import pytest
from edges import documents, empty, prose
from tokenizers import Tokenizer

import corpus_pipeline
from filmloom.llm.queries import ORACLES, QUERIES

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture
def folder_of(spark, tmp_path):
    def write(docs, labels=(), items=()):
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        spark.createDataFrame(list(items), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return write


def test_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "encoding"]
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in QUERIES} and set(ORACLES) < set(QUERIES)


def test_each_stage_takes_effect(spark, folder_of):
    clean = [(1000 + i, prose(i, n=120), "en") for i in range(150)] + [(1500 + i, prose(i, "de", 120), "de") for i in range(50)]
    toxic = [(2000 + i, f"{prose(700 + i)} vermin wretch {prose(900 + i)} wretch vermin", "en") for i in range(60)]
    copies = [(3000 + i, clean[0][1], "en") for i in range(5)] + [(3100, clean[0][1].upper(), "en")]
    passage = " ".join(f"secret{i}" for i in range(40))
    leaked = [(4000, f"{prose(950)} {passage} {prose(951)}", "en")]
    labels = [(i, 1, 0) for i, *_ in clean] + [(i, 1, 1) for i, *_ in toxic] + [(None, None, None), (1, None, None)]
    docs = documents(spark, clean + toxic + copies + leaked)
    folder = folder_of(docs, labels, [(1, passage), (2, None)])
    frame, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        frame = spark.read.parquet(f"{folder}/{name}")
        seen[name] = [r["doc_id"] for r in frame.collect()]
    assert not {i for i, *_ in toxic} & set(seen["toxicity"]) and {i for i, *_ in clean + copies + leaked} <= set(seen["toxicity"])
    assert not {6, 7, 8, 15} & set(seen["language"]) and {i for i, *_ in clean + copies + leaked} <= set(seen["language"])
    assert len(seen["near_duplicates"]) == len(set(seen["near_duplicates"])) and not {i for i, *_ in copies} & set(seen["near_duplicates"])
    assert {i for i, *_ in clean + leaked} <= set(seen["near_duplicates"])
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) == {4000}

    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(map(str, seen["decontamination"]))
    for r in rows:
        ids = LIBRARY.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_empty_documents(spark, folder_of):
    assert corpus_pipeline.run(spark, folder_of(empty(spark))).collect() == []


def test_no_labels_and_no_benchmark_reject_no_prose(spark, folder_of):
    rows = corpus_pipeline.run(spark, folder_of(documents(spark))).collect()
    assert {1, 2, 3} <= {r["doc_id"] for r in rows}


def test_without_any_language_documents_with_letters_stay(spark, folder_of):
    docs = documents(spark).drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    found = corpus_pipeline.language(spark, docs, folder_of(docs))
    assert found.columns == docs.columns
    assert {r["doc_id"] for r in found.collect()} == {None, 1, 2, 3, 4, 9, 10, 11, 12, 13, 14, 16}
