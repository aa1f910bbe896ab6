"""From raw documents to an encoded training mix, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import bpe, mixing, ngram_join, quality, suffix_dedup
from fleetscope.llm.common import ship_package, table
from fleetscope.session import fresh_folder, write_and_forget

TOKENIZER = "word_bpe_49k.json"
QUALITY_FROM = 0.3


def _free(name: str, docs: DataFrame) -> str:
    """The name, or a longer one if the documents have a column of that name in any case."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, does not reject."""
    ship_package(spark)
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(learn))
    score = _free("_score", docs)
    return quality.score(docs, model, name=score).filter(F.col(score) >= QUALITY_FROM).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    mark, one, of = (_free(name, docs) for name in ("_mark", "_id", "_of"))
    kept = ngram_join.join(docs).filter("kept").select(F.col("doc_id").alias(one), F.col("mark").alias(of))
    rows = docs.withColumn(mark, ngram_join.text_mark("text"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col(one)) & (F.col(mark) == F.col(of)), "left_semi")
    return rows.dropDuplicates(["doc_id", mark]).select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that an earlier one has."""
    ship_package(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    shape = docs.select(others).schema
    kept = suffix_dedup.remove_repeats(docs, carry=F.to_json(F.struct(*others)), as_text=True)
    kept = kept.select("doc_id", F.col("kept").alias("text"), F.from_json("carry", shape).alias("_others"))
    kept = kept.select("doc_id", "text", "_others.*")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    ship_package(spark)
    mark, one, of, times, turn = (_free(name, docs) for name in ("_mark", "_id", "_of", "_times", "_turn"))
    rows = docs.withColumn(mark, ngram_join.text_mark("text"))
    shares = mixing.mix(rows, carry=[mark]).filter("repeats > 0")
    shares = shares.select(F.col("doc_id").alias(one), F.col(mark).alias(of), F.col("repeats").alias(times))
    rows = rows.join(shares, F.col("doc_id").eqNullSafe(F.col(one)) & (F.col(mark) == F.col(of)))
    return rows.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times)))).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids of the text and the text that they decode to."""
    ship_package(spark)
    coded = bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("repeats", without_repeats),
    ("mix", mixed),
    ("encode", encoded),
]

# MinHash, suffix arrays and BPE have no SQL. Tests hold the stages against labels, brute-force cuts, the tokenizer and
# their operators, which have brute-force tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back before the next."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        folder = fresh_folder(spark, "stage")
        write_and_forget(stage(spark, docs, sf_dir), folder)
        docs = spark.read.parquet(folder)
        if before:  # the stage that read it is written
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = folder
    return docs
