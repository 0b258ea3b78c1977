"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

The first four return the columns of ``documents``; the last one returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import decontam, langid, packing, secret_scan
from lotwise.llm.jaccard import jaccard_components
from lotwise.sources.staging import stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Language predictions below this probability are rejected; four languages by chance have 0.25 each.
MIN_SCORE = 0.3


def _kept(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns an operator needs, and the whole row as one column, so that no name of its own meets one of the caller's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *needed)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised; those without letters or with no likely language go."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    net = langid.fit(docs.where((remainder != 2) & F.col("lang").isNotNull()).select("text", "lang"))
    found = langid.predict(_kept(docs, "text"), net)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked texts: that with the smallest doc_id, then the least hash of the text.

    Rows without a doc_id come after those with one. Rows that repeat a doc_id and its text count once.
    """
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(key.alias("row"), "doc_id", F.xxhash64("text").alias("hash")).distinct()
    linked = jaccard_components(docs.select(key.alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "hash", "row")
    found = rows.join(linked, "row").groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.row").alias("row"))
    # Whole rows are dealt out once: the join and the choice among repeated rows have the same key.
    return _kept(docs, key.alias("row")).join(found, "row", "left_semi").dropDuplicates(["row"]).select("_row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    found = decontam.contamination(_kept(docs, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.col("n_hit") == 0).select("_row.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark, and n_chars follows."""
    texts = docs.select("doc_id", "text")
    found = secret_scan.scan(_kept(docs, "text"), secret_scan.train(secret_scan.labelled_samples(texts)))
    clean = found.withColumn("text", secret_scan.redact(F.col("text"), F.col("spans")))
    changed = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("_row.n_chars"))
    new = {"text": F.col("text"), "n_chars": changed}
    return clean.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces with their token ids; every document is packed whole."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("packing", pack_documents),
]
#: The trained models and the tokenizer are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
