"""The registered queries of the corpus operators, each over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.chat import format_conversations, loss_text, parse_turn, text_part, turn_texts
from filmloom.llm.common import remainder, table
from filmloom.llm.decontaminate import benchmark_hits
from filmloom.llm.knn import integer_vectors, top_products
from filmloom.llm.jaccard import jaccard_components
from filmloom.llm.language import fit_languages, predict_languages
from filmloom.llm.lexical import ranked_documents
from filmloom.llm.lexicon_bpe import encode_documents
from filmloom.llm.quality import score_quality
from filmloom.llm.sharding import assign_shards
from filmloom.llm.simhash import near_duplicates
from filmloom.llm.token_files import read_token_files, write_token_files
from filmloom.llm.toxicity import fit_toxicity, score_toxicity
from filmloom.llm.whitening import integer_rows, long_deviation, whiten
from filmloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(remainder(5) != 0)
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select(
        "row.doc_id", (remainder(5, "row.doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages",
    )


@query("op3_language")
def op3_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs.filter(remainder(3) != 1))
    found = predict_languages(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", (remainder(3, "row.doc_id") == 1).alias("held_out"), "lang_pred", "score", "shares")


@query("op10_simhash")
def op10_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


OP2_SQL = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, least(len(w), 13) AS n, array_to_string(w[s : s + 12], ' ') AS k
  FROM b, unnest(generate_series(1, greatest(1, len(w) - 12))) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
spot AS (
  SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS k
  FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS u(p) WHERE len(w) >= n),
hit AS (SELECT r, p, win.n, item FROM spot JOIN win ON spot.n = win.n AND spot.k = win.k),
places AS (SELECT r, count(DISTINCT x) AS n_hit FROM hit, unnest(generate_series(p, p + n - 1)) AS u(x) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN found USING (r)
"""


@query("op2_decontaminate", OP2_SQL)
def op2_decontaminate(spark, sf_dir):
    found = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def token_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op4_bpe")
def op4_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


@query("op9_top_k", """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""")
def op9_top_k(spark, sf_dir):
    vectors = integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_products(vectors, vectors.filter("id % 20 = 0"))


@query("op5_sharding")
def op5_sharding(spark, sf_dir):
    text = F.col("text")
    records = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = assign_shards(records, F.col("text_crc32"), F.col("size"), 40)
    return placed.select("row.*", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP7_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(replace(replace(text, '\', '\b'), '<', '\l')) AS text_chars,
         length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g')) AS role_chars
  FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(6 + role_chars + 2 + text_chars + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op7_chat", OP7_SQL)
def op7_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    turns = rows.union(probe).select("conv_id", "turn", "role", text_part(F.col("text")).alias("content"))
    made = format_conversations(turns)
    parsed = F.transform(turn_texts(F.col("formatted")), parse_turn)
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    read = made.select("conv_id", parsed.alias("turns"), loss.alias("loss"), "formatted")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op8_token_files")
def op8_token_files(spark, sf_dir):
    docs, folder = table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "tokens")
    parts = write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), folder, end=0)
    return read_token_files(spark, folder, parts).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op6_quality")
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(remainder(5) != 0)
    scored = score_quality(docs, labels, F.col("source"), F.col("lang"))
    return scored.select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence", "host_posterior", "path_posterior",
    )


@query("op11_jaccard_join")
def op11_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


TERMS_SQL = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
OP12_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {TERMS_SQL} AS w FROM documents),
b AS (SELECT item_id, row_number() OVER () AS i, {TERMS_SQL} AS w FROM benchmark),
n AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
p AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT i, item_id, unnest(w) AS term FROM b),
s AS (
  SELECT i, item_id, r, doc_id,
         CAST(sum(CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
                  * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * tf.n * docs) // words))))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), n GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""


@query("op12_lexical_search", OP12_SQL)
def op12_lexical_search(spark, sf_dir):
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    found = whiten(integer_rows(table(spark, sf_dir, "embeddings")))
    return found.select(F.col("id").alias("vec_id"), "component", "n", long_deviation().alias("deviation"), "whitened", "explained", "identity_error")
