"""Equi-join of a fact table with a table that has few rows per key.

One key may own a large share of the fact rows. Such keys are found first, by
heavy-hitter sketches in one pass over the key columns: no shuffle of rows, only
of one small sketch per task. The fact rows of a hot key are spread over slices
and its rows on the other side are copied once per slice. Which keys count as
hot only decides how rows travel, never what the join returns.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_SLICE = 2_000_000

# Entries a sketch tracks: any key with more than 3.5 / SKETCH_KEYS of all rows
# is sure to be in it. Keys are hot from that share on, so that none is missed.
SKETCH_KEYS = 32_768
MAX_HOT_KEYS = SKETCH_KEYS * 2 // 7
SKETCH_GROUPS = 64

# Tables up to this many rows may be broadcast if Spark's estimate says so.
BROADCAST_ROWS = 100_000

_UNHASHED = (T.MapType, T.UserDefinedType, T.VariantType)


@dataclass(frozen=True)
class HotKeys:
    """Key hashes owning more rows than a slice should hold, with slice counts.

    ``rows`` is the number of rows of the whole table. There are at most
    ``MAX_HOT_KEYS`` entries.
    """

    on: tuple[str, ...]
    slices: dict[int, int]
    rows: int


def hot_keys(
    facts: DataFrame,
    *key_sets: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> list[HotKeys]:
    """Hot keys of ``facts`` for each set of key columns. Runs one job.

    The result is fixed on the driver, so every later use of it agrees.
    """
    sketches = [
        F.expr(f"approx_top_k_accumulate(key_{i}, {SKETCH_KEYS})").alias(f"sketch_{i}")
        for i in range(len(key_sets))
    ]
    tops = [
        F.expr(
            f"approx_top_k_estimate(approx_top_k_combine(sketch_{i}, {SKETCH_KEYS}), {MAX_HOT_KEYS})"
        ).alias(f"top_{i}")
        for i in range(len(key_sets))
    ]
    hashes = [F.xxhash64(*on).alias(f"key_{i}") for i, on in enumerate(key_sets)]
    merged = (
        facts.select(*hashes, (F.spark_partition_id() % SKETCH_GROUPS).alias("sketch_group"))
        .groupBy("sketch_group")
        .agg(*sketches, F.count(F.lit(1)).alias("n"))
        # Grouped by a constant: an empty table gives no row rather than a
        # sketch of nothing.
        .groupBy(F.lit(0).alias("all"))
        .agg(*tops, F.sum("n").alias("n"))
    )
    cut = F.greatest(F.lit(rows_per_slice), F.ceil(F.col("n") / MAX_HOT_KEYS))
    over = [
        F.filter(f"top_{i}", lambda t: t["count"] > F.col("cut")).alias(f"top_{i}")
        for i in range(len(key_sets))
    ]
    row = merged.withColumn("cut", cut).select(*over, "n", "cut").first()
    if row is None:
        return [HotKeys(tuple(on), {}, 0) for on in key_sets]
    found = []
    for i, on in enumerate(key_sets):
        slices = {t["item"]: -(-t["count"] // row["cut"]) for t in row[f"top_{i}"]}
        found.append(HotKeys(tuple(on), slices, row["n"]))
    return found


def spread(df: DataFrame, slices: Column) -> Column:
    """Slice number of a row, in [0, slices).

    Depends on the row and on its partition only, so a recomputed task puts
    every row where it was, and exact copies of a row still spread out.
    """
    plain = [f.name for f in df.schema if not isinstance(f.dataType, _UNHASHED)]
    return F.pmod(F.xxhash64(*plain, F.spark_partition_id()), slices.cast("bigint"))


def size_hint(rows: int) -> str | None:
    """A hint for the table side of a join, by its counted rows.

    Spark estimates a table from the bytes of its compressed files or from what
    its query read, which may be a small part of what it holds: many rows are
    never left to that estimate.
    """
    return "merge" if rows > BROADCAST_ROWS else None


def hinted(df: DataFrame, hint: str | None) -> DataFrame:
    return df.hint(hint) if hint else df


def skew_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: HotKeys | None = None,
    hint: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``facts.join(dim, on, how)`` where ``dim`` has few rows per key.

    ``hot`` are the hot keys of the facts when the caller has them (from a
    narrower table, say); otherwise a job finds them. ``how`` is "inner" or
    "left".
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    for c in on:
        if facts.schema[c].dataType != dim.schema[c].dataType:
            raise ValueError(f"join column {c} differs in type")
    if hot is None:
        (hot,) = hot_keys(facts, on, rows_per_slice=rows_per_slice)
    right = hinted(dim, hint)
    if not hot.slices:
        return facts.join(right, on, how)

    table = F.broadcast(
        facts.sparkSession.createDataFrame(
            list(hot.slices.items()), "key_hash bigint, slices bigint"
        )
    )
    slices = F.coalesce("slices", F.lit(1).cast("bigint"))
    left = facts.withColumn("key_hash", F.xxhash64(*on)).join(table, "key_hash", "left")
    left = left.withColumn("slice", spread(facts, slices)).drop("slices", "key_hash")
    right = dim.withColumn("key_hash", F.xxhash64(*on)).join(table, "key_hash", "left")
    first = F.lit(0).cast("bigint")
    right = right.select(*dim.columns, F.explode(F.sequence(first, slices - 1)).alias("slice"))
    right = hinted(right, hint)
    return left.join(right, [*on, "slice"], how).drop("slice")
