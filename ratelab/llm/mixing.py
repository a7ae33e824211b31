"""Mixing sources to target weights with a low-discrepancy schedule.

Slot k of the mix draws the point k * golden ratio mod 1. Laid over the
cumulative shares of the sources it names a source, and within any stretch of
slots every source comes up almost exactly as often as its share says. The r-th
slot of a source takes the r-th block of words of that source's documents,
which are laid end to end in shuffled order, again and again up to ``epochs``
times. What rounding to whole slots leaves short is taken in closing slots.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratelab.llm.ordered import ordered_totals
from ratelab.llm.rows import KEY, columns_of, quoted, row_key, unused
from ratelab.llm.skew import join_unique
from ratelab.shared import cut_lineage

GOLDEN = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixRule:
    """Weights repeat over the sources in code point order, nulls last.

    A source is repeated up to ``epochs`` times. A block holds ``block_words``
    words, or one part in ``fewest_slots`` of the mix where that is less.
    """

    weights: Sequence[float] = (1, 2, 3)
    epochs: int = 3
    block_words: int = 4096
    fewest_slots: int = 65_536
    seed: int = 1

    def __post_init__(self):
        if not self.weights or min(self.weights) < 0.001:
            raise ValueError("weights are 0.001 or more")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """``source, source_size, target`` of every source of ``sizes`` (``source, size``).

    The whole is the sum of all sizes. Shares follow the weights; a target
    stops at ``epochs`` times the size of its source, and what it can't take
    goes to the others by weight until none is above. Sources with the lowest
    size per weight fill first, so one pass in that order finds the level.
    """
    sources = cut_lineage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = ordered_totals(
        sources.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"rank": "one"}
    )
    # Weights in thousandths, as whole numbers: their sums are exact in any order.
    units = F.array(*(F.lit(round(w * 1000)).cast("bigint") for w in rule.weights))
    weighted = ranked.select(
        "source",
        "source_size",
        (F.col("source_size") * rule.epochs).alias("cap"),
        F.get(units, (F.col("rank") % len(rule.weights)).cast("int")).alias("unit"),
    )
    filled = cut_lineage(
        ordered_totals(
            weighted,
            [F.col("cap") / F.col("unit"), F.col("source").asc_nulls_last()],
            {"caps": "cap", "units": "unit"},
        )
    )
    whole = filled.agg(F.sum("source_size").alias("whole"), F.sum("unit").alias("all_units")).first()
    total, units = whole["whole"] or 0, whole["all_units"] or 0
    # Sources from this one on would share what is left by weight: full if that is above its cap.
    left = (F.lit(total) - F.col("caps")).cast("double") * F.col("unit")
    over = left > F.col("cap").cast("double") * (F.lit(units) - F.col("units"))
    full = filled.where(over).agg(F.sum("cap").alias("caps"), F.sum("unit").alias("units")).first()
    rest, rest_units = total - (full["caps"] or 0), units - (full["units"] or 0)
    level = rest / rest_units if rest_units else 0.0
    target = F.least(F.col("cap").cast("double"), F.col("unit") * F.lit(level))
    return filled.select("source", "source_size", target.alias("target"))


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """``slot, source, first, words``: which words of a source's stream each slot takes.

    ``targets`` has ``source, target, source_size, words`` (whole words to
    take). Slots run from 0; closing slots follow after the drawn ones.
    """
    spark = targets.sparkSession
    laid = cut_lineage(
        ordered_totals(
            targets.where("words > 0"),
            [F.col("source").asc_nulls_last()],
            {"low": "words"},
        )
    )
    total = laid.agg(F.sum("words")).first()[0] or 0
    slots = -(-total // block)
    # Lay whole-number points over the line of all words; the grid cells that a
    # source's stretch of the line touches are known, so an equi-join finds it.
    cells = 4096
    point = F.floor(F.pmod((F.col("slot") + 1) * F.lit(GOLDEN), F.lit(1.0)) * total)
    drawn = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", point.cast("bigint"))
    width = max(1, -(-total // cells))
    drawn = drawn.withColumn("cell", F.floor(F.col("point") / width).cast("bigint"))
    lines = laid.withColumn("high", F.col("low") + F.col("words"))
    lines = lines.withColumn(
        "cell",
        F.explode(
            F.sequence(
                F.floor(F.col("low") / width).cast("bigint"),
                F.floor((F.col("high") - 1) / width).cast("bigint"),
            )
        ),
    )
    named = drawn.join(lines, "cell").where("point >= low AND point < high")
    named = named.select("slot", "low", "words")
    ranked = ordered_totals(
        named.withColumn("one", F.lit(1)), ["low", "slot"], {"before": "one"}
    )
    ranked = cut_lineage(ranked)
    counts = ranked.groupBy("low").agg(F.min("before").alias("base"), F.count("*").alias("n"))
    taken = join_unique(ranked.drop("words"), counts.join(laid, "low"), "low").select(
        "slot",
        "source",
        ((F.col("before") - F.col("base")) * block).alias("first"),
        F.col("words").alias("all_words"),
    )
    open_slots = taken.where("first < all_words").select(
        "slot",
        "source",
        "first",
        F.least(F.lit(block), F.col("all_words") - F.col("first")).cast("bigint").alias("words"),
    )
    short = (
        laid.join(counts, "low", "left")
        .withColumn("first", F.coalesce("n", F.lit(0)) * block)
        .where("first < words")
        .withColumn("at", F.explode(F.sequence(F.col("first"), F.col("words") - 1, F.lit(block).cast("bigint"))))
    )
    closing = ordered_totals(
        short.withColumn("one", F.lit(1)), ["low", "at"], {"nth": "one"}
    ).select(
        (F.col("nth") + slots).alias("slot"),
        "source",
        F.col("at").alias("first"),
        F.least(F.lit(block), F.col("words") - F.col("at")).cast("bigint").alias("words"),
    )
    return open_slots.union(closing)


def shuffled_streams(docs: DataFrame, rule: MixRule) -> DataFrame:
    """Adds ``at``, the words before a document in its source's shuffled stream.

    ``docs`` has ``source, id, size, tie``. The shuffle goes by a hash of the id
    and the seed; ties go by id, size and ``tie``, a hash of the text.
    """
    shuffled = docs.withColumn(
        "draw", F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(str(rule.seed))))
    )
    ordered = [F.col("source").asc_nulls_last(), "draw", F.col("id").asc_nulls_last(), "size", "tie"]
    return ordered_totals(shuffled, ordered, {"before": "size"}).drop("draw", "tie")


@dataclass(frozen=True)
class Mix:
    """``documents``: every row with ``id, source, size, source_size, target, at``.
    ``parts``: the mix, as rows ``slot, source, id, size, at, epoch, start, words``: in
    slot order the mix takes these words of these documents."""

    documents: DataFrame
    parts: DataFrame


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    rule: MixRule = MixRule(),
    **more: Column,
) -> Mix:
    """The mix of all documents. Runs jobs; equal input gives equal output.

    Columns ``more`` of the documents are passed on to both tables.

    A null text has size 0; documents of size 0 are never taken. A null source
    is a source of its own, the last. Rows that repeat an id are documents of
    their own, with places of their own in the stream. An empty table gives an
    empty mix. Texts are read once, to be counted; all else moves narrow rows.
    Blocks are joined with slots by source and block number, so a hot source is
    spread over as many keys as it has blocks.
    """
    sizes = cut_lineage(
        docs.select(
            quoted(source_col).alias("source"),
            quoted(id_col).alias("id"),
            word_count(quoted(text_col)).alias("size"),
            F.xxhash64(quoted(text_col)).alias("tie"),
            *(column.alias(name) for name, column in more.items()),
        )
    )
    targets = source_targets(sizes, rule)
    wanted = F.least(F.round("target"), F.col("source_size") * rule.epochs).cast("bigint")
    targets = cut_lineage(targets.withColumn("words", wanted))
    total = targets.agg(F.sum("words")).first()[0] or 0
    block = max(1, min(rule.block_words, total // rule.fewest_slots))

    streamed = cut_lineage(shuffled_streams(sizes, rule))
    # Null sources must meet in joins: a source goes by a number from here on.
    numbers = cut_lineage(
        streamed.groupBy("source").agg(F.min("before").alias("base"))
        .join(targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
        .drop("name")
        .withColumn("no", F.monotonically_increasing_id())
    )
    placed = streamed.join(
        numbers.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))
    )
    placed = cut_lineage(
        placed.select(
            "no", "source", "id", "size", "source_size", "target",
            F.col("words").alias("wanted"), (F.col("before") - F.col("base")).alias("at"), *more,
        )
    )
    slots = schedule(
        numbers.select(F.col("no").alias("source"), "target", "source_size", "words"), block
    )
    # A slot's words in stream coordinates, cut where an epoch ends.
    sized = numbers.select(F.col("no").alias("source"), "source_size")
    ranges = join_unique(slots, sized, "source").select(
        "slot", "source", "source_size", "first", (F.col("first") + F.col("words")).alias("last")
    )
    epochs = F.sequence(
        F.floor(F.col("first") / F.col("source_size")).cast("bigint"),
        F.floor((F.col("last") - 1) / F.col("source_size")).cast("bigint"),
    )
    laps = ranges.withColumn("epoch", F.explode(epochs)).select(
        "slot",
        "source",
        "epoch",
        F.greatest(F.lit(0), F.col("first") - F.col("epoch") * F.col("source_size")).alias("low"),
        F.least("source_size", F.col("last") - F.col("epoch") * F.col("source_size")).alias("high"),
    )
    cells = F.sequence(
        F.floor(F.col("low") / block).cast("bigint"), F.floor((F.col("high") - 1) / block).cast("bigint")
    )
    laps = laps.withColumn("cell", F.explode(cells))
    pieces = placed.where("size > 0").withColumn(
        "cell",
        F.explode(
            F.sequence(
                F.floor(F.col("at") / block).cast("bigint"),
                F.floor((F.col("at") + F.col("size") - 1) / block).cast("bigint"),
            )
        ),
    ).select(F.col("no").alias("source"), "cell", F.col("source").alias("name"), "id", "size", "at", *more)
    low = F.greatest("low", "at", F.col("cell") * block)
    high = F.least("high", F.col("at") + F.col("size"), (F.col("cell") + 1) * block)
    parts = (
        laps.join(pieces, ["source", "cell"])
        .withColumn("start", low - F.col("at"))
        .withColumn("words", high - low)
        .where("words > 0")
        .select("slot", F.col("source").alias("no"), F.col("name").alias("source"), "id", "size", "at", "epoch", "start", "words", *more)
    )
    return Mix(placed, parts)


def words_taken(mix: Mix) -> DataFrame:
    """Every row of the documents with ``taken``, the words the mix takes of it."""
    named = ["no", "source", "id", "size", "at", "source_size", "target"]
    taken = mix.parts.groupBy("no", "at").agg(F.sum("words").alias("taken"))
    whole = F.when(F.col("size") > 0, F.col("taken"))
    return mix.documents.select(*named).join(taken, ["no", "at"], "left").withColumn(
        "taken", F.coalesce(whole, F.lit(0)).cast("bigint")
    )


def repeat_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix as whole documents, in the order of its slots; all columns as they were.

    A document comes once for every lap in which the mix begins to take its
    words, where the schedule does so; a source's stream ends within one
    document at most, which comes whole. Rows are taken each by its own place in
    the stream, so those without an id or that repeat one don't share a number;
    of rows alike in all columns any one stands for all. Texts without a word
    and null texts never come; an empty table gives an empty table. The rows are
    range-partitioned by slot: files written from them are in mix order.
    """
    others = [
        quoted(f.name) for f in docs.schema
        if f.name not in (id_col, text_col) and f.dataType.typeName() not in ("map", "variant")
    ]
    key = unused(docs, KEY)
    named = F.unhex(F.sha2(F.concat(row_key(id_col, text_col), F.xxhash64(F.lit(0), *others).cast("string").cast("binary")), 256))
    rows = docs.withColumn(key, named)
    mix = mix_sources(rows, id_col, text_col, source_col, row=F.col(key), **options)
    alike = mix.documents.where("size > 0").groupBy("row").agg(F.count("*").alias("copies"))
    laps = mix.parts.groupBy("no", "at", "epoch", "row").agg(F.min("slot").alias("slot"))
    slot, at = unused(docs, "_mix_slot"), unused(docs, "_mix_at")
    times = laps.join(alike, "row").select(F.col("row").alias(key), F.col("slot").alias(slot), F.col("at").alias(at), "copies")
    times = cut_lineage(times)
    repeated = times.where("copies > 1").select(key).distinct()
    first = rows.join(repeated, key, "left_semi").dropDuplicates([key])
    taken = rows.join(times.where("copies = 1").drop("copies"), key).unionByName(
        first.join(times.where("copies > 1").drop("copies"), key)
    )
    return taken.repartitionByRange(slot, at).sortWithinPartitions(slot, at).select(columns_of(docs))
