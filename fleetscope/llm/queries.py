"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import (
    bpe, langid, mixing, mtree, ngram_join, nn_descent, quality, spelling, suffix_dedup, token_alignment, token_codes,
    url_filter, warc,
)
from fleetscope.llm.common import ship_package, table
from fleetscope.session import fresh_folder

TOKENIZER = "word_bpe_49k.json"
QUALITY_FROM = 0.3
QUERIES = {}
ORACLES = {}


def query(function):
    """Register a query under its name."""

    def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = registered
    return function


@query
def op1_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.join(table(spark, d, "documents")).select("doc_id", "class_id", "n_links", "kept")


def _fold(modulus: int):
    """A document's fold, from its id alone."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query
def op2_quality(spark: SparkSession, d: str) -> DataFrame:
    docs, held_out = table(spark, d, "documents"), _fold(5) == 0
    model = quality.fit(docs, table(spark, d, "labels").filter(~held_out))
    scored = quality.score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= QUALITY_FROM).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op3_language(spark: SparkSession, d: str) -> DataFrame:
    docs, held_out = table(spark, d, "documents"), _fold(4) == 2
    model = langid.fit(docs.filter(~held_out))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op4_mixing(spark: SparkSession, d: str) -> DataFrame:
    mixed = mixing.mix(table(spark, d, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
sources AS (
  SELECT source, source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)),
budget AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS words FROM sources),
filled AS (
  SELECT *, 2 * source_size / weight::DOUBLE AS full_at,
         coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE AS used,
         sum(weight) OVER (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open
  FROM sources
  WINDOW before AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min((words - used) / open, full_at) AS level
  FROM filled, budget WHERE full_at > (words - used) / open),
queued AS (
  SELECT docs.*, source_size, weight, least((2 * source_size)::DOUBLE, level * weight) AS target,
         sum(size) OVER (PARTITION BY docs.source ORDER BY h, doc_id NULLS FIRST, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS queue_end
  FROM docs JOIN sources ON docs.source IS NOT DISTINCT FROM sources.source CROSS JOIN level),
served AS (
  SELECT doc_id, source, turn, size, (queue_end + turn * source_size)::DOUBLE / weight AS finish
  FROM queued, (VALUES (0), (1)) AS turns(turn) WHERE size > 0),
cut AS (
  SELECT max(finish) AS last FROM (
    SELECT finish, sum(size) OVER (ORDER BY finish, source NULLS LAST, doc_id NULLS FIRST, turn
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS words_to
    FROM served), budget WHERE words_to <= words)
SELECT doc_id, size, source_size, target,
       (size * ((queue_end::DOUBLE / weight <= last)::BIGINT
                + ((queue_end + source_size)::DOUBLE / weight <= last)::BIGINT))::BIGINT AS taken
FROM queued CROSS JOIN cut
"""


@query
def op5_nn_descent(spark: SparkSession, d: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, d, "embeddings"))


@query
def op6_mtree(spark: SparkSession, d: str) -> DataFrame:
    return mtree.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op6_mtree"] = """
WITH rows AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_dot_product(q.v, r.v)::BIGINT AS score
  FROM rows q JOIN rows r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


@query
def op7_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.judge(table(spark, d, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op8_token_codes(spark: SparkSession, d: str) -> DataFrame:
    folder = fresh_folder(spark, "codes")
    token_codes.write(table(spark, d, "documents"), folder, public_tokenizers.path(TOKENIZER))
    return token_codes.read_documents(token_codes.read_shards(spark, folder))


@query
def op9_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, d, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op10_bpe(spark: SparkSession, d: str) -> DataFrame:
    coded = bpe.encode(table(spark, d, "documents"), public_tokenizers.path(TOKENIZER), decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query
def op11_spelling(spark: SparkSession, d: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, d, "documents"), one_in=199))


@query
def op12_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = fresh_folder(spark, "warc")
    warc.write(table(spark, d, "pages"), folder)
    found = warc.read(spark, folder, with_payload=False)
    return found.select(
        F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op13_alignment(spark: SparkSession, d: str) -> DataFrame:
    sides = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align_tokens(token_alignment.code(table(spark, d, "documents"), *sides))
