"""From raw documents to token ids: five stages, each over all that the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a table; ``run`` writes each
stage's table to the shared folder and reads it again for the next. All but the
last have the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelab.llm import bpe, chunk_dedup, language, mixing, simhash
from ratelab.llm.queries import HELD_OUT, fold
from ratelab.shared import scratch_table_path

#: Documents go if the languages learned from have in common with them a smaller share of their words.
LEAST_KNOWN = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are in no learned language: ``und``, or mostly of words that none of them has."""
    model = language.fit_language_model(docs.where(fold(F.col("doc_id")) != HELD_OUT))
    return language.keep_known_languages(docs, model, LEAST_KNOWN)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return chunk_dedup.keep_first_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by fingerprints of 3-word shingles at 2 or fewer differing bits."""
    return simhash.keep_representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come near their targets."""
    return mixing.repeat_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, ids, n_tokens, decoded_sha256`` of every row, the hash of the text the ids decode to."""
    encoded = bpe.encode_documents(
        docs, public_tokenizers.path("word_bpe_49k.json"), carry=("lang", "source"), decoded=True
    )
    return encoded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"), "decoded_sha256"
    )


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("tokenize", tokenize),
]

#: SQL can't state the model of the first stage, the fingerprints of the third, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_table_path(spark, name)
        done = stage(spark, docs, sf_dir)
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
