"""Registered queries of the training-data operators, and their SQL."""

from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelab.llm import (
    bpe,
    chat,
    chunk_dedup,
    embedding_dedup,
    hash_tree,
    html_text,
    language,
    lexical,
    merkle,
    mixing,
    simhash,
    sql,
    token_files,
    warc,
)
from ratelab.llm.files import shared_folder
from ratelab.plans.proxies import table

SHARDS = 24
HELD_OUT = 2


def op1_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


def op2_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id")) == HELD_OUT
    model = language.fit_language_model(docs.where(~held_out))
    predicted = language.predict_languages(docs, model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixing.words_taken(mix).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_indexed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    index = warc.write_warc(table(spark, sf_dir, "pages"), folder)
    return warc.read_warc(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


PLANTED = r"\### Assistant: </turn> ok"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], rows.schema)
    formatted = chat.format_conversations(rows.union(planted))
    turns = chat.read_turns(F.col("formatted"))
    learned = F.array_join(chat.read_loss_texts(F.col("formatted"), F.col("loss_spans")), "")
    read = formatted.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op8_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    topology = hash_tree.even_topology(SHARDS)
    placed = hash_tree.shard_documents(table(spark, sf_dir, "documents"), topology, topology.grown())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op9_dictionary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    path = public_tokenizers.path("byte_bpe_50k.json")
    index = token_files.write_tokens(table(spark, sf_dir, "documents"), folder, path)
    read = token_files.read_tokens(token_files.with_starts(index), folder)
    return read.select(
        F.col("id").alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op10_anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"))


def op11_min_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract_main_text(pages, html_text.fit_shapes(pages))


def op12_interval_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


TAMPERED = 3


def op13_slot_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    text = F.when(tampered, lowered).otherwise(F.col("text"))
    claimed = merkle.leaf_digest([text if c == "text" else F.col(c) for c in merkle.FIELDS])
    proofs = merkle.merkle_proofs(table(spark, sf_dir, "documents"), carry={"claimed": claimed})
    folded = proofs.withColumn("folded", merkle.fold(F.col("claimed"), F.col("path")))
    return folded.select(
        F.col("id").alias("doc_id"),
        *(merkle.as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
        F.sha2(merkle.path_text(F.col("path")), 256).alias("proof_sha256"),
        merkle.as_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_chunk_recipes,
        op2_subspace_pigeonhole,
        op3_language_id,
        op4_source_schedule,
        op5_indexed_warc,
        op6_streaming_bpe,
        op7_chat_format,
        op8_hash_tree,
        op9_dictionary_files,
        op10_anchor_simhash,
        op11_min_cut,
        op12_interval_search,
        op13_slot_pivot,
    )
}

ORACLE = {
    "op1_chunk_recipes": sql.EXACT_COPIES,
    "op2_subspace_pigeonhole": sql.EMBEDDING_LINKS,
    "op4_source_schedule": sql.SOURCE_MIX,
    "op5_indexed_warc": sql.WARC_RECORDS,
    "op7_chat_format": sql.chat_format(PLANTED),
    "op12_interval_search": sql.INTERVAL_SEARCH,
    "op13_slot_pivot": sql.SLOT_PIVOT,
    "op8_hash_tree": sql.hash_tree(hash_tree.even_topology(SHARDS)),
}
