"""The training-corpus pipeline: five stages, each over all that the stage before it kept.

Every stage but the last returns rows of ``documents`` as they are, with all their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.common import remainder, table
from filmloom.llm.decontaminate import without_contaminated
from filmloom.llm.language import UNKNOWN, fit_languages, predict_languages
from filmloom.llm.lexicon_bpe import encode_documents
from filmloom.llm.queries import token_digests
from filmloom.llm.simhash import without_duplicates
from filmloom.llm.toxicity import fit_toxicity, score_toxicity
from filmloom.session import materialise

#: A document whose main language has a smaller share isn't written in any one language.
LEAST_SHARE = 0.4


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely clean than toxic. Labels of one fold in five are held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(remainder(5) != 0)
    return score_toxicity(docs, fit_toxicity(docs, labels)).filter("score < 0.5").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language: not those without letters, nor even mixtures of several languages.

    Where no language could be learned, all documents with letters.
    """
    model = fit_languages(docs.filter(remainder(3) != 1))
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = predict_languages(docs, model)
    main = F.array_max(F.col("shares.share"))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (main >= LEAST_SHARE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return without_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a passage of the benchmark."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text of every document."""
    return token_digests(encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL can't express the fitted stages, the hashes or the merges; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
