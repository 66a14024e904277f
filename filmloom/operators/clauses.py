"""Requests of required, optional and forbidden clauses, phrases among them, over a stored index.

A request is a set of rows, one for each clause, so any number of requests of any shape are one job: clauses are matched
by joins with the postings, phrases by the places of their terms, and requests by counting the clauses that hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.operators.index import Index
from filmloom.operators.search import analysed_query, term_hits
from filmloom.operators.skew import fits_broadcast, skew_join
from filmloom.session import materialise

MUST, SHOULD, MUST_NOT = "must", "should", "must_not"


def _check(clauses: DataFrame, index: Index) -> None:
    """Unknown fields and kinds of clause fail, each named."""
    names = [f.name for f in index.fields]
    wrong = clauses.filter(F.col("field").isNotNull() & ~F.col("field").isin(names)).select("field").first()
    if wrong:
        raise ValueError(f"no field {wrong[0]!r} to search; fields: {', '.join(names)}")
    wrong = clauses.filter(F.col("occur").isNull() | ~F.col("occur").isin(MUST, SHOULD, MUST_NOT)).select("occur").first()
    if wrong:
        raise ValueError(f"a clause can't be {wrong[0]!r}; it is {MUST}, {SHOULD} or {MUST_NOT}")


def _parts(clauses: DataFrame, index: Index) -> DataFrame:
    """``part, phrase, field, term, place, size``: the terms of each distinct clause, for each field that it searches."""
    distinct = clauses.filter(F.col("text").isNotNull()).select("part", "field", "text", "phrase").distinct()
    rows = distinct.select("part", "phrase", F.col("field").alias("only"), F.explode(analysed_query(F.col("text"), index.fields)).alias("f"))
    rows = rows.filter(F.col("only").isNull() | (F.col("only") == F.col("f.field")))
    return rows.select("part", "phrase", "f.field", F.size("f.terms").alias("size"), F.posexplode("f.terms").alias("place", "term"))


def clause_hits(clauses: DataFrame, index: Index) -> DataFrame:
    """Distinct ``(part, doc)``: documents with a term of the clause, or with its whole phrase in one field.

    Places are counted after stop words are left out. In a phrase a term stands at the same distance from the start
    in the document as in the clause, so its places less that distance meet in the start.
    """
    terms = materialise(_parts(clauses, index), "clause-terms")
    loose = terms.filter(~F.col("phrase") | (F.col("size") == 1)).select("part", "field", "term").distinct()
    found = term_hits(index, materialise(loose, "loose-terms")).select("part", "doc")
    tight = materialise(terms.filter(F.col("phrase") & (F.col("size") > 1)).select("part", "field", "term", "place", "size"), "phrase-terms")
    places = term_hits(index, tight).select("part", "doc", "field", "size", "place", F.explode("at").alias("at"))
    starts = places.groupBy("part", "doc", "field", "size", (F.col("at") - F.col("place")).alias("start")).agg(F.count("*").alias("met"))
    return found.unionByName(starts.filter(F.col("met") == F.col("size")).select("part", "doc")).distinct()


def clause_search(clauses: DataFrame, index: Index) -> DataFrame:
    """``(request_id, doc, hits)``: the documents that each request finds, and how many clauses hit there.

    ``clauses`` are (request_id, occur, field, text, phrase). Every ``must`` clause has to hit and no ``must_not``
    clause may; without a ``must`` clause some ``should`` clause has to hit, so a request of forbidden
    clauses alone finds nothing. A null field stands for all fields, a null phrase for none. A clause given twice
    counts once. A clause without terms (null or empty text, stop words alone) hits nothing.
    """
    _check(clauses, index)
    asked = clauses.select("request_id", "occur", "field", "text", F.coalesce("phrase", F.lit(False)).alias("phrase")).distinct()
    part = F.sha2(F.to_json(F.struct("field", "text", "phrase")), 256)
    asked = materialise(asked.withColumn("part", part), "clauses")
    hits = clause_hits(asked, index)
    wanted = asked.select("request_id", "occur", "part")
    # One clause may belong to very many requests.
    pairs = hits.join(F.broadcast(wanted), "part") if fits_broadcast(wanted) else skew_join(wanted, materialise(hits, "clause-hits"), ["part"], "inner", salt_by=["request_id"])
    of_kind = lambda kind: F.count(F.when(F.col("occur") == kind, 1))
    needed = asked.groupBy("request_id").agg(of_kind(MUST).alias("needed"))
    counted = pairs.groupBy("request_id", "doc").agg(of_kind(MUST).alias("must"), of_kind(SHOULD).alias("should"), of_kind(MUST_NOT).alias("must_not"))
    fit = (F.col("must") == F.col("needed")) & (F.col("must_not") == 0) & (F.col("must") + F.col("should") > 0)
    return counted.join(needed, "request_id").filter(fit).select("request_id", "doc", (F.col("must") + F.col("should")).alias("hits"))
