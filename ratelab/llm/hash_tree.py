"""Sharding by a weighted hash tree of regions, racks and shards.

A key descends from the root: at each level every child draws -ln(u) / weight,
u a hash of the key and the child, and the lowest draw wins, so children get
keys in proportion to their weight. A draw depends on its own child only: when
the weight of one child changes, keys move between that child's subtree and its
siblings, and nothing moves inside subtrees whose weights stay. A shard that
joins as a region of its own is the only place that keys move to.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelab.llm.ordered import ordered_totals
from ratelab.llm.skew import join_unique
from ratelab.shared import cut_lineage

#: A draw uses so many hexadecimal digits of an md5 sum: 52 bits.
DIGITS = 13


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


@dataclass(frozen=True)
class Topology:
    """The shards of a tree; numbers of shards, and of racks, are unique in the whole tree."""

    shards: tuple[Shard, ...]

    def __post_init__(self):
        numbers = [s.shard for s in self.shards]
        if not numbers or len(set(numbers)) < len(numbers):
            raise ValueError("shards need numbers of their own")
        if min(s.weight for s in self.shards) <= 0:
            raise ValueError("weights are above 0")
        if len({(s.region, s.rack) for s in self.shards}) > len({s.rack for s in self.shards}):
            raise ValueError("a rack is in one region")

    def grown(self, weight: float = 1.0) -> "Topology":
        """With one more shard, in a region and rack of its own."""
        new = Shard(
            1 + max(s.region for s in self.shards),
            1 + max(s.rack for s in self.shards),
            1 + max(s.shard for s in self.shards),
            weight,
        )
        return Topology((*self.shards, new))

    def regions(self) -> dict[int, float]:
        return _weights((s.region, s.weight) for s in self.shards)

    def racks(self, region: int) -> dict[int, float]:
        return _weights((s.rack, s.weight) for s in self.shards if s.region == region)

    def members(self, rack: int) -> dict[int, float]:
        return _weights((s.shard, s.weight) for s in self.shards if s.rack == rack)


def _weights(pairs) -> dict[int, float]:
    found: dict[int, float] = {}
    for node, weight in pairs:
        found[node] = found.get(node, 0.0) + weight
    return dict(sorted(found.items()))


def even_topology(shards: int, shards_per_rack: int = 4, racks_per_region: int = 3) -> Topology:
    """Shards of weight 1, filling rack after rack and region after region."""
    return Topology(
        tuple(
            Shard(i // (shards_per_rack * racks_per_region), i // shards_per_rack, i)
            for i in range(shards)
        )
    )


def _draw(key: Column, level: str, node: int, weight: float) -> Column:
    label = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"|{level}{node}"))
    number = F.conv(F.substring(F.md5(label), 1, DIGITS), 16, 10).cast("double")
    return -F.ln((number + 0.5) / float(16**DIGITS)) / F.lit(float(weight))


def _winner(key: Column, level: str, nodes: dict[int, float]) -> Column:
    if len(nodes) == 1:
        return F.lit(next(iter(nodes)))
    return F.array_min(
        F.array(*(F.struct(_draw(key, level, n, w).alias("d"), F.lit(n).alias("n")) for n, w in nodes.items()))
    )["n"]


def _descend(of: Column, branches: dict[int, Column]) -> Column:
    chosen = F.lit(None).cast("int")
    for node, branch in reversed(branches.items()):
        chosen = F.when(of == node, branch).otherwise(chosen)
    return chosen


def assign(df: DataFrame, key: str, topology: Topology, name: str) -> DataFrame:
    """Adds ``name``, the shard of each row's key. A null key counts as empty. No row moves.

    Only the draws along a row's own path are evaluated.
    """
    region, rack = f"_{name}_region", f"_{name}_rack"
    regions = topology.regions()
    racks = {r: topology.racks(r) for r in regions}
    members = {k: topology.members(k) for r in regions for k in racks[r]}
    col = F.col(key)
    out = df.withColumn(region, _winner(col, "region", regions))
    out = out.withColumn(rack, _descend(F.col(region), {r: _winner(col, "rack", racks[r]) for r in regions}))
    out = out.withColumn(name, _descend(F.col(rack), {k: _winner(col, "shard", members[k]) for k in members}))
    return out.drop(region, rack)


def with_slots(df: DataFrame, shard: str, order: Sequence[Column | str], name: str = "slot") -> DataFrame:
    """Adds a row's place in its shard, gapless from 0, in the given order. Runs jobs.

    Shards are as large as they are, so no task holds one: rows are placed by
    shard and order over the whole table and numbered from there.
    """
    numbered = ordered_totals(df.withColumn("_one", F.lit(1)), [F.col(shard), *order], {"_before": "_one"})
    numbered = cut_lineage(numbered.drop("_one"))
    firsts = numbered.groupBy(shard).agg(F.min("_before").alias("_first"))
    placed = join_unique(numbered, firsts, shard)
    return placed.withColumn(name, F.col("_before") - F.col("_first")).select(*df.columns, name)


def shard_documents(
    docs: DataFrame,
    topology: Topology,
    grown: Topology | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id, size, text_crc32, shard, slot``, and ``grown_shard`` with ``grown``.

    The id and the topology decide, nothing else, so rows that repeat an id
    share its shard and take slots one after the other; a null id counts as
    empty. Size is the text's UTF-8 bytes (a null text: none) plus 8. Slots go
    by id, size and checksum; rows equal in all three tie. An empty table gives
    an empty result. Other columns are not looked at.
    """
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = assign(rows, "id", topology, "shard")
    if grown is not None:
        rows = assign(rows, "id", grown, "grown_shard")
    order = [F.col("id").asc_nulls_first(), "size", "text_crc32"]
    return with_slots(rows, "shard", order).withColumnRenamed("id", id_col)


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Writes the documents, all columns, as one Parquet folder per shard."""
    where = placed.select(F.col(id_col).alias("_id"), "shard").distinct()
    joined = docs.drop("shard").join(where, F.col(id_col).eqNullSafe(F.col("_id"))).drop("_id")
    joined.write.partitionBy("shard").parquet(path)
