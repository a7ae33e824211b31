"""Decisions on single rows of tables whose ids may be null or repeat."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "_row_key"


def quoted(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """This name, or a longer one if a column has it already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(id_col: str, text_col: str) -> Column:
    """A hash of id and text: null ids differ from all others, null texts count as empty."""
    named = quoted(id_col).cast("string")
    marked = F.coalesce(F.concat(F.octet_length(named).cast("string"), F.lit(":"), named), F.lit("-"))
    return F.unhex(F.sha2(F.concat_ws("|", marked, F.coalesce(quoted(text_col), F.lit(""))), 256))


def with_key(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str, list[str]]:
    """``docs`` joined to ``keys`` (``_row_key`` and more) under names that no column of ``docs`` has.

    Returns the rows, the name of the key and those of the other columns of ``keys``.
    """
    key = unused(docs, KEY)
    more = {c: unused(docs, c) for c in keys.columns if c != KEY}
    named = keys.select(F.col(KEY).alias(key), *(F.col(c).alias(new) for c, new in more.items()))
    return docs.withColumn(key, row_key(id_col, text_col)).join(named, key), key, list(more.values())


def columns_of(docs: DataFrame) -> list[Column]:
    return [quoted(c) for c in docs.columns]


def keep_one(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each key, all columns as they were.

    ``keys`` has distinct ``_row_key`` with their number ``_row_count`` of rows.
    Of rows that repeat an id and its text, any one is kept. Rows with a key of
    their own pass at once; only repeated ones are grouped.
    """
    met, key, (count,) = with_key(docs, keys, id_col, text_col)
    repeated = met.where(F.col(count) > 1).dropDuplicates([key])
    return met.where(F.col(count) == 1).unionByName(repeated).select(columns_of(docs))
