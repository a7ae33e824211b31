"""Chat formatting as relations: sorted turn structs, runs of one role, one string.

``<|turn|>role\\n`` opens a run of turns of one role, ``<|and|>`` stands between
two turns of a run, ``<|end|>\\n`` closes it. Inside roles and texts a backslash
becomes ``\\b``, ``<|`` becomes ``\\l``, and in roles a line feed becomes ``\\n``;
so no text can hold a control string, and reading gives every turn back.
Only Spark expressions are used.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, AND, END = "<|turn|>", "<|and|>", "<|end|>\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def format_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learned_role: str = LEARNED_ROLE,
) -> DataFrame:
    """One row per conversation: ``conv, formatted, loss_spans``.

    ``loss_spans`` are ``start, length`` in UTF-8 bytes of ``formatted``: each
    text of the learned role, without control strings. Turns are sorted by
    turn number, nulls first; turns that tie go by role, then text, and repeated
    rows stay. Null roles and texts count as empty. Rows without a conversation
    form one of their own. Turns are shuffled once, by conversation; a
    conversation becomes one string, so it has to fit in a row.
    """
    turns = rows.select(
        F.col(conv_col).alias("conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(role_col, F.lit("")).alias("role"),
            F.coalesce(text_col, F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = turns.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Runs: a turn starts one where the role before it is another.
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", F.greatest(i - 1, F.lit(0)))["role"]),
    )
    bounded = sorted_turns.withColumn("starts", starts)
    run = F.transform(
        "starts",
        lambda s, j: F.slice("turns", s + 1, F.coalesce(F.get("starts", j + 1), F.size("turns")) - s),
    )
    runs = bounded.select("conv", run.alias("runs"))
    pieces = F.flatten(F.transform("runs", lambda r: F.transform(r, lambda t, i: _piece(t, i, F.size(r), learned_role))))
    laid = runs.select("conv", pieces.alias("pieces"))
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"])), "")
    return laid.select(F.col("conv").alias(conv_col), formatted.alias("formatted"), _loss_spans().alias("loss_spans"))


def _piece(turn: Column, i: Column, n: Column, learned_role: str) -> Column:
    opening = F.concat(F.lit(TURN), escape_role(turn["role"]), F.lit("\n"))
    return F.struct(
        F.when(i == 0, opening).otherwise(F.lit(AND)).alias("before"),
        escape(turn["text"]).alias("text"),
        F.when(i == n - 1, F.lit(END)).otherwise(F.lit("")).alias("after"),
        (turn["role"] == learned_role).alias("learned"),
    )


def _loss_spans() -> Column:
    """Spans of the learned texts, in one pass that carries the bytes so far."""
    nothing = F.struct(
        F.lit(0).cast("bigint").alias("upto"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )

    def add(acc, p):
        start = acc["upto"] + F.octet_length(p["before"])
        length = F.octet_length(p["text"]).cast("bigint")
        span = F.struct(start.alias("start"), length.alias("length"))
        return F.struct(
            (start + length + F.octet_length(p["after"])).alias("upto"),
            F.when(p["learned"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate("pieces", nothing, add, lambda acc: acc["spans"])


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of ``role, text``."""
    blocks = F.slice(F.split(formatted, r"\Q" + TURN + r"\E", -1), 2, F.length(formatted) + 1)

    def of_block(block):
        role = unescape_role(F.substring_index(block, "\n", 1))
        body = F.substr(block, F.locate("\n", block) + 1)
        body = F.substr(body, F.lit(1), F.length(body) - len(END))
        texts = F.split(body, r"\Q" + AND + r"\E", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, of_block))


def read_loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, in order, unescaped."""
    data = F.encode(formatted, "UTF-8")
    return F.transform(
        spans,
        lambda s: unescape(
            F.decode(F.substr(data, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")
        ),
    )
