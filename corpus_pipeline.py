"""Corpus pipeline over ``documents``: five stages of the operators in barlake.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's
docs. All but the last return the columns of documents; rows with a null
doc_id pass the stages that decide by document. No SQL can express the
MinHash and tokenizer stages, so ORACLE_SQL is None and tests/llm compares a
small run with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import decontaminate, line_dedup, near_dup, queries, quality_rules, sentencepiece_fst
from barlake.llm.names import quoted
from barlake.session import scratch_path

ORACLE_SQL = None


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    ratios = quality_rules.fit_ratios(docs, queries.trusted(spark, sf_dir))
    return quality_rules.score_rules(docs, ratios).where("__kept").select(*map(quoted, docs.columns))


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs)
    text = F.when(F.col("__n_dropped") > 0, F.col("__kept")).otherwise(F.col("text"))
    chars = F.when(F.col("__n_dropped") > 0, F.length("__kept").cast("long")).otherwise(F.col("n_chars"))
    new = {"text": text.alias("text"), "n_chars": chars.alias("n_chars")}
    return out.select(*[new.get(c, F.col(quoted(c))) for c in docs.columns])


def stage_near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_dup.keep_one(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept document."""
    return sentencepiece_fst.encode(docs.select("doc_id", "text"))


STAGES = [
    ("quality_rules", stage_quality),
    ("line_dedup", stage_line_dedup),
    ("ngram_jaccard", stage_near_dup),
    ("decontaminate", stage_decontaminate),
    ("sentencepiece", stage_encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's output written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name, unique=True)
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
