"""SimHash near-dedup with the anchors of a covering code.

Two 64-bit fingerprints that differ in at most 2 bits differ in at most 1 bit
of one of their 32-bit halves. The anchors of a half are the codewords of the
Hamming code over 31 of its bits: every word has exactly one codeword within
covering radius 1. A fingerprint lives at that home anchor and is replicated to
every anchor within radius 1 plus threshold 1, 15 or 16 of them, so the partner
of any close pair is found at the other's home anchor. There are 2^26 anchors
per half; at one of them fingerprints meet, and the full distance decides.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelab.llm.components import connected_components
from ratelab.llm.rows import KEY, columns_of, row_key, with_key
from ratelab.llm.skew import join_unique
from ratelab.llm.tasks import map_batches
from ratelab.shared import cut_lineage

SEED = 42
WORDS = 3
MAX_BITS = 2
#: Bytes of a text and shingles that are in memory at once.
PIECE_BYTES = 1 << 22
BLOCK = 1 << 14

# Masks of the Hamming code: bit i of a half (i from 0) is position i + 1.
_PARITY = [sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1) for k in range(5)]


def shingle_hashes(text: str | None, words: int = WORDS) -> Iterator[np.ndarray]:
    """Hashes of all word shingles of a whole text, in blocks.

    A-Z are lower-cased, words are runs of anything but space and \\t to \\r.
    Fewer words than a shingle make one shingle; no word makes none.
    """
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    kept: list[bytes] = []
    start, any_full = 0, False
    while start < len(data):
        end = start + PIECE_BYTES
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        kept += data[start:end].split()
        start = end
        if len(kept) >= words:
            any_full = True
            for i in range(0, len(kept) - words + 1, BLOCK):
                run = kept[i : i + BLOCK + words - 1]
                joined = map(b" ".join, zip(*(run[j:] for j in range(words))))
                yield np.array([xxhash.xxh64_intdigest(s, SEED) for s in joined], dtype=np.uint64)
            kept = kept[len(kept) - words + 1 :]
    if kept and not any_full:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(kept), SEED)], dtype=np.uint64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """A bit is set if over half of the shingle hashes have it. Without a word: zero."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, words):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, **more: Column
) -> DataFrame:
    """``id, fp``: the fingerprint as a signed 64-bit number; and columns ``more`` of the documents."""
    names = list(more)

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch.column("text")]
            fps = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), fps, *batch.columns[2:]], names=["id", "fp", *names])

    extra = [column.alias(name) for name, column in more.items()]
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *extra)
    types = {f.name: f.dataType.simpleString() for f in named.schema}
    return map_batches(named, run, ", ".join([f"id {types['id']}", "fp bigint", *(f"{n} {types[n]}" for n in names)]))


def _flip(word: Column, position: Column) -> Column:
    return word.bitwiseXOR(F.call_function("shiftleft", F.lit(1), position - 1))


def anchor_rows(fps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Home and replica rows (``half, anchor, fp``) of distinct fingerprints."""
    low = F.col("fp").bitwiseAND(0x7FFFFFFF).cast("int")
    high = F.shiftright("fp", 32).bitwiseAND(0x7FFFFFFF).cast("int")
    sides = F.array(*(F.struct(F.lit(i).alias("half"), w.alias("w")) for i, w in enumerate((low, high))))
    halves = fps.select("fp", F.explode(sides).alias("x")).select("fp", "x.half", "x.w")
    syndrome = F.lit(0)
    for k, mask in enumerate(_PARITY):
        odd = F.bit_count(F.col("w").bitwiseAND(mask)).bitwiseAND(1)
        syndrome = syndrome + odd * (1 << k)
    words = halves.withColumn("s", syndrome.cast("int"))
    home = F.when(F.col("s") == 0, F.col("w")).otherwise(_flip(F.col("w"), F.col("s")))
    homes = words.select("half", home.alias("anchor"), "fp")
    # Codewords at distance 2 flip two positions whose numbers have the syndrome as their xor.
    pairs = F.filter(
        F.sequence(F.lit(1), F.lit(31)),
        lambda i: (i < i.bitwiseXOR(F.col("s"))) & (F.col("s") > 0),
    )
    second = F.transform(pairs, lambda i: _flip(_flip(F.col("w"), i), i.bitwiseXOR(F.col("s"))))
    replicas = words.select("half", F.explode(F.concat(F.array(home), second)).alias("anchor"), "fp")
    return homes, replicas


def close_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints in at most ``max_bits`` (at most 2) differing bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the two halves cover up to 2 differing bits")
    homes, replicas = anchor_rows(fps)
    left = homes.withColumnRenamed("fp", "x")
    right = replicas.withColumnRenamed("fp", "y")
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits
    met = left.join(right, ["half", "anchor"]).where(near & (F.col("x") != F.col("y")))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def simhash_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per input row: ``id, fingerprint (16 hex digits), component_id, kept``.

    ``component_id`` is the smallest id among all documents that can be reached
    over links of at most ``max_bits`` differing bits; the document with that
    id is kept. Equal fingerprints are collapsed before anything is compared,
    so a large group of copies is one fingerprint. Texts that are null, empty
    or blank have fingerprint zero and link like any other. Rows with a null id
    take part, but never name a component unless no row of it has an id; rows
    that repeat an id share its decision. Other columns are not looked at.
    """
    return _decided(docs, id_col, text_col, words, max_bits).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _decided(docs, id_col, text_col, words=WORDS, max_bits=MAX_BITS, **more: Column) -> DataFrame:
    """``id, fp, component_id``, the fingerprint ``component`` that names the group, and columns ``more``."""
    printed = cut_lineage(fingerprints(docs, id_col, text_col, words, **more))
    prints = printed.groupBy("fp").agg(F.min("id").alias("low"))
    pairs = close_pairs(prints.select("fp"), max_bits)
    linked = cut_lineage(connected_components(pairs, "a", "b"))
    lows = (
        linked.join(prints, linked["node"] == prints["fp"])
        .groupBy("component")
        .agg(F.min("low").alias("linked_low"))
    )
    named = linked.join(lows, "component").select(F.col("node").alias("fp"), "component", "linked_low")
    lowest = prints.join(named, "fp", "left").select(
        "fp",
        F.coalesce("component", "fp").alias("component"),
        F.when(F.col("linked_low").isNull(), F.col("low")).otherwise(F.col("linked_low")).alias("component_id"),
    )
    return join_unique(printed, lowest, "fp").select("id", "fp", "component", "component_id", *more)


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group that ``simhash_dedup`` links, all columns as they were.

    It has the smallest id of its group; of several texts with this id, or
    without any, one is kept. Rows that repeat its id and text stay with it.
    Texts that are null, empty or blank are one group. An empty table gives an
    empty table; columns keep their names, whatever they are.
    """
    report = _decided(docs, id_col, text_col, **options, **{KEY: row_key(id_col, text_col)})
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", KEY))
    keys = report.groupBy("component").agg(first.alias("first")).select(f"first.{KEY}")
    return with_key(docs, keys, id_col, text_col)[0].select(columns_of(docs))
