"""Exact dedup by content-defined chunk recipes.

A text is cut where its content says so: after a sentence end, once the chunk
has a least length. Chunks get short identifiers, which are verified: over all
chunks of the table, no two different ones share an identifier. A document is
then the ordered list of its identifiers, and texts are equal exactly when
these lists are. Chunk contents move once, partially deduplicated; afterwards
only lists move, however long the documents are.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelab.llm.rows import KEY, keep_one, row_key
from ratelab.llm.skew import join_unique
from ratelab.shared import cut_lineage


@dataclass(frozen=True)
class ChunkRule:
    """Chunks end at the first ``ends`` character after ``least`` characters, at ``most`` at the latest."""

    least: int = 256
    most: int = 4096
    ends: str = r"[.!?\n]"

    def chunks(self, text: Column) -> Column:
        pattern = f"(?s).{{{self.least - 1},{self.most - 1}}}?{self.ends}|.{{1,{self.most}}}"
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def short_hash(chunk: Column) -> Column:
    return F.struct(
        F.xxhash64(chunk).alias("h"), F.hash(chunk).alias("g"), F.octet_length(chunk).alias("n")
    )


def long_hash(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def content(chunk: Column) -> Column:
    return chunk


#: Tried in turn until one gives different chunks different identifiers; the last cannot fail.
IDENTIFIERS = (short_hash, long_hash, content)


def verified_identifier(
    texts: DataFrame, text: Column, rule: ChunkRule, identifiers=IDENTIFIERS
) -> Callable[[Column], Column]:
    """The first of ``identifiers`` that no two different chunks of the table share. Runs a job for each tried."""
    for identify in identifiers[:-1]:
        chunks = texts.select(F.explode(rule.chunks(text)).alias("chunk"))
        distinct = chunks.select(identify(F.col("chunk")).alias("key"), "chunk").distinct()
        shared = distinct.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        if shared.isEmpty():
            return identify
    return identifiers[-1]


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: ChunkRule = ChunkRule(),
    identifiers=IDENTIFIERS,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256, n_chunks``.

    Of equal texts the row with the largest id is kept. A null text counts as
    empty, so nulls and empty texts are one group with an empty recipe. Null
    ids come last: one is kept only where its whole group has no id. Rows that
    repeat an id and its text are one document: all of them carry its decision.
    Other columns, whatever their names, are not looked at; an empty table
    gives an empty result.
    """
    return _decided(docs, id_col, text_col, rule, identifiers).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256", "n_chunks"
    )


def _decided(docs, id_col, text_col, rule=ChunkRule(), identifiers=IDENTIFIERS, **more: Column) -> DataFrame:
    """The report under inner names, with columns ``more`` of the documents."""
    text = F.coalesce(text_col, F.lit(""))
    identify = verified_identifier(docs, text, rule, identifiers)
    listed = cut_lineage(
        docs.select(
            F.col(id_col).alias("id"),
            F.transform(rule.chunks(text), identify).alias("recipe"),
            F.sha2(text, 256).alias("text_sha256"),
            *(column.alias(name) for name, column in more.items()),
        )
    )
    groups = listed.groupBy("recipe").agg(
        F.max("id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return join_unique(listed, groups, "recipe").select(
        "id",
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        F.size("recipe").alias("n_chunks"),
        *more,
    )


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Exactly one document of each group of equal texts, all columns as they were.

    It has the id that ``exact_dedup`` keeps; of rows that repeat this id and
    text, or of a group without any id, any one row is kept. Each text is
    decided by itself, so an id with two texts may keep one and lose the other.
    Null and empty texts are one group. An empty table gives an empty table;
    columns keep their names, whatever they are.
    """
    report = _decided(docs, id_col, text_col, **options, **{KEY: row_key(id_col, text_col)})
    keys = report.where("kept").groupBy(KEY).agg(F.count("*").alias("_row_count"))
    return keep_one(docs, keys, id_col, text_col)
