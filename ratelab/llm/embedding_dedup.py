"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors whose cosine is at least c are at most D = 2 - 2c apart in squared
distance. After a fixed random rotation, which spreads distances evenly over
the coordinates, a vector is cut into blocks of up to 8 coordinates. If two
vectors are within D, then in at least one block they are within that block's
share of D, in proportion to its coordinates. So each block is range-joined on
its own, the union of the pairs holds every link, and whole vectors decide.

The range join of a block lays a grid over its first coordinates, with cells
twice as wide as the block's radius. A vector lives in its own cell and asks
the cells that its ball touches, its own and those after it in order, so a pair
meets once. The distance in the block is part of the join condition.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelab.llm.components import connected_components
from ratelab.llm.skew import join_unique
from ratelab.llm.tasks import map_batches
from ratelab.shared import cut_lineage

BLOCK_DIMS = 8
#: Covers rounding of the rotated single-precision coordinates.
SLACK = 1e-5


@dataclass(frozen=True)
class PigeonholeRule:
    """Links are cosines of at least ``cosine``; cells span ``grid_dims`` coordinates of a block."""

    cosine: float = 0.98
    grid_dims: int = 3
    seed: int = 7

    def __post_init__(self):
        if not 0.5 <= self.cosine <= 1:
            raise ValueError("the cosine is from 0.5 to 1")


def rotation(dims: int, seed: int) -> np.ndarray:
    """An orthogonal matrix, the same in every task."""
    normal = np.random.default_rng([seed, dims]).standard_normal((dims, dims))
    q, r = np.linalg.qr(normal)
    return q * np.sign(np.diag(r))


def block_edges(dims: int) -> np.ndarray:
    blocks = max(1, -(-dims // BLOCK_DIMS))
    return np.linspace(0, dims, blocks + 1).astype(int)


def _place(vectors: np.ndarray, rule: PigeonholeRule, asks: bool):
    """For each block of equally long vectors, their own cells (role 0), or with ``asks`` the cells they
    ask: their own (role 1) and the later ones that their balls touch (role 2)."""
    n, dims = vectors.shape
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    turned = unit @ rotation(dims, rule.seed)
    edges = block_edges(dims)
    for b, (lo, hi) in enumerate(zip(edges, edges[1:])):
        part = turned[:, lo:hi]
        budget = (2 - 2 * rule.cosine) * (hi - lo) / dims
        radius = np.sqrt(budget + SLACK)
        width = 2 * radius
        grid = part[:, : rule.grid_dims]
        own = np.floor(grid / width).astype(np.int64)
        near = [np.floor((grid + step * radius) / width).astype(np.int64) for step in (-1, 1)]
        coords = np.zeros((n, BLOCK_DIMS), dtype=np.float32)
        coords[:, : hi - lo] = part
        key = _pack(own, b)
        if not asks:
            yield np.arange(n), np.zeros(n, dtype=np.int32), key, coords, budget
            continue
        # A ball is no wider than a cell, so per coordinate it touches one or two.
        for choice in range(2 ** grid.shape[1]):
            cell = np.stack([near[choice >> j & 1][:, j] for j in range(grid.shape[1])], axis=1)
            fresh = np.ones(n, dtype=bool)
            for j in range(grid.shape[1]):
                if choice >> j & 1:
                    fresh &= near[1][:, j] != near[0][:, j]
            asked = _pack(cell, b)
            take = np.flatnonzero(fresh & (asked >= key))
            role = np.where(asked[take] == key[take], 1, 2).astype(np.int32)
            yield take, role, asked[take], coords[take], budget


def _pack(cells: np.ndarray, block: int) -> np.ndarray:
    """One number per cell, in order; equal numbers of different cells would only add candidates."""
    key = np.full(len(cells), block, dtype=np.int64)
    for j in range(cells.shape[1]):
        key = key * 4096 + (cells[:, j] + 2048)
    return key


def _schema() -> str:
    coords = ", ".join(f"c{i} float" for i in range(BLOCK_DIMS))
    return f"grp bigint, role int, cell bigint, cls bigint, budget double, {coords}"


def block_rows(classes: DataFrame, rule: PigeonholeRule, asks: bool) -> DataFrame:
    """Own or asked cells of every class (``grp, cls, vector``), block by block."""
    names = ["grp", "role", "cell", "cls", "budget", *(f"c{i}" for i in range(BLOCK_DIMS))]

    def run(batches):
        for batch in batches:
            grp, cls = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "cls"))
            for at, vectors in _by_length(batch.column("vector")):
                for take, role, cell, coords, budget in _place(vectors, rule, asks):
                    if len(take):
                        columns = [grp[at][take], role, cell, cls[at][take]]
                        columns.append(np.full(len(take), budget))
                        columns += [coords[:, i] for i in range(BLOCK_DIMS)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return map_batches(classes.select("grp", "cls", "vector"), run, _schema())


def _by_length(column: pa.Array):
    """Rows and matrix for each length of vector in a column of lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, flat[starts[at][:, None] + np.arange(n)]


def candidate_pairs(classes: DataFrame, rule: PigeonholeRule) -> DataFrame:
    """``a < b``: classes of one group that are close in at least one block, each pair once."""
    left = block_rows(classes, rule, asks=False).drop("role")
    right = block_rows(classes, rule, asks=True).select(
        "grp", "role", "cell", F.col("cls").alias("other"), *(F.col(f"c{i}").alias(f"d{i}") for i in range(BLOCK_DIMS))
    )
    apart = sum(
        (F.col(f"c{i}") - F.col(f"d{i}")) * (F.col(f"c{i}") - F.col(f"d{i}")) for i in range(BLOCK_DIMS)
    )
    once = (F.col("role") == 2) | (F.col("cls") < F.col("other"))
    met = left.join(right, ["grp", "cell"]).where((apart <= F.col("budget") + SLACK) & once)
    return met.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()


def verified_links(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The pairs whose whole vectors have at least that cosine, in double precision."""
    vectors = classes.select("cls", "label", "vector")
    left = join_unique(pairs.withColumnRenamed("a", "cls"), vectors, "cls")
    left = left.select(
        F.col("cls").alias("a"), F.col("label").alias("label_a"), F.col("vector").alias("x"), F.col("b").alias("cls")
    )
    both = join_unique(left, vectors, "cls").where(
        (F.col("label") == F.col("label_a")) & (F.size("x") == F.size("vector"))
    )
    both = both.select("a", F.col("cls").alias("b"), "x", F.col("vector").alias("y"))

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            ys = batch.column("y")
            for at, x in _by_length(batch.column("x")):
                y = ys.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(x.shape)
                dot = np.einsum("ij,ij->i", x, y)
                keep[at] = dot / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)) >= cosine
            kept = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    return map_batches(both, run, "a bigint, b bigint")


def embedding_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    rule: PigeonholeRule = PigeonholeRule(),
) -> DataFrame:
    """One row per input row: ``id, n_links, component_id, kept``.

    Rows link when their labels are equal and not null and the cosine is at
    least ``rule.cosine``. A vector that is null, empty, zero, or holds a null
    or a component that isn't finite links with nothing, nor do vectors of
    different lengths with each other. Equal vectors of a label are one class
    and are never compared: a class counts as often as it has rows, in links
    and in memory. ``component_id`` is the smallest id reachable; rows with a
    null id take part in links, and a component of them alone has none. Rows
    that repeat an id are counted each. Ids must be whole numbers.
    """
    v = F.col(vector_col)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = (
        F.col(label_col).isNotNull()
        & v.isNotNull()
        & ~F.coalesce(F.exists(v, bad), F.lit(False))
        & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    )
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.when(usable, F.col(label_col)).alias("label"),
        F.when(usable, v.cast("array<double>")).alias("vector"),
    )
    classes = rows.where("vector IS NOT NULL").groupBy("label", "vector").agg(
        F.min("id").alias("low"), F.count("*").alias("copies")
    )
    # A class goes by a number. Label and length of a vector go by their hash; where two
    # share one, a pair of theirs could pass, so links compare both again.
    classes = cut_lineage(
        classes.withColumn("cls", F.monotonically_increasing_id()).withColumn(
            "grp", F.xxhash64("label", F.size("vector"))
        )
    )
    pairs = candidate_pairs(classes, rule)
    links = cut_lineage(verified_links(pairs, classes, rule.cosine))
    sizes = classes.select(F.col("cls").alias("b"), F.col("copies").alias("weight"))
    both = links.union(links.select("b", "a"))
    counted = join_unique(both, sizes, "b").groupBy(F.col("a").alias("cls")).agg(F.sum("weight").alias("linked"))
    parts = cut_lineage(connected_components(links, "a", "b")).withColumnRenamed("node", "cls")
    lows = parts.join(classes.select("cls", "low"), "cls").groupBy("component").agg(F.min("low").alias("lowest"))
    named = parts.join(lows, "component").select("cls", "lowest")
    report = (
        classes.select("cls", "label", "vector", "low", "copies")
        .join(counted, "cls", "left")
        .join(named, "cls", "left")
        .select(
            F.struct("label", "vector").alias("key"),
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.when(F.col("lowest").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("component_id"),
        )
    )
    usable_rows = rows.where("vector IS NOT NULL").select("id", F.struct("label", "vector").alias("key"))
    linked = join_unique(usable_rows, report, "key").select("id", "n_links", "component_id")
    alone = rows.where("vector IS NULL").select("id", F.lit(0).cast("bigint"), F.col("id"))
    return linked.union(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
