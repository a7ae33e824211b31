"""A manifest of a table as a tree of hashes, with a proof for every row.

Each row is a leaf, the leaves of a group in id order form a tree, and the
groups' subroots in group order form one more tree above them. A level is one
aggregation: conditional aggregates spread the children of a parent into as
many columns as the fanout. All columns joined together hash to the parent;
all but a child's own are its siblings. Proofs go down the same tables, so a
row's whole path is put together where its run of leaves is, once a run.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelab.llm.ordered import ordered_totals
from ratelab.llm.skew import join_unique
from ratelab.shared import cut_lineage

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def written(value: Column) -> Column:
    """A value as its byte count, a colon and its text, or ``-``: no two lists of values read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def as_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def leaf_digest(values: Sequence[Column]) -> Column:
    """The 32 bytes of a row's leaf."""
    return _hash(F.concat(*map(written, values)))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its ``path`` of siblings lead to."""
    step = lambda digest, level: _hash(F.concat(as_text(level["before"]), as_text(digest), as_text(level["after"])))
    return F.aggregate(path, leaf, step)


def path_text(path: Column) -> Column:
    """All siblings of a path, level by level and left to right."""
    return F.array_join(F.transform(path, lambda level: as_text(F.concat(level["before"], level["after"]))), "")


def _runs(nodes: DataFrame, carried: Sequence[str], fanout: int) -> DataFrame:
    """``tree, place, size`` of the parents and their children ``c0, c1, ...``, one struct a column."""
    slot = F.col("place") % fanout
    child = F.struct("digest", *carried)
    children = [F.first(F.when(slot == i, child), ignorenulls=True).alias(f"c{i}") for i in range(fanout)]
    parent = F.floor(F.col("place") / fanout).cast("bigint").alias("place")
    above = F.ceil(F.col("size") / fanout).cast("bigint").alias("size")
    return nodes.groupBy("tree", parent, above).agg(*children)


def _joined(slots) -> str:
    """SQL for the digests of these children, one after the other; missing ones add nothing."""
    return "concat(X''" + "".join(f", coalesce(c{i}.digest, X'')" for i in slots) + ")"


def _grow(leaves: DataFrame, carried: Sequence[str], fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level from the leaves (``tree, place, size, digest``) up, and the
    trees' tops ``tree, digest, height``. Runs a job a level."""
    levels, nodes = [], leaves
    largest = leaves.agg(F.max("size")).first()[0] or 0
    tops = nodes.where("size = 1").select("tree", "digest", F.lit(0).alias("height"))
    while largest > 1:
        runs = cut_lineage(_runs(nodes.where("size > 1"), carried if not levels else (), fanout))
        levels.append(runs)
        nodes = runs.select("tree", "place", "size", _hash(as_text(F.expr(_joined(range(fanout))))).alias("digest"))
        tops = tops.union(nodes.where("size = 1").select("tree", "digest", F.lit(len(levels))))
        largest = -(-largest // fanout)
    return levels, cut_lineage(tops)


def _descend(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, carried: Sequence[str], fanout: int):
    """The leaves with ``path`` and what else ``tops`` (``tree, height, path, ...``) holds for their tree."""
    above = [c for c in tops.columns if c not in ("tree", "height", "path")]

    def start(height):
        return tops.where(F.col("height") == height).select("tree", F.lit(0).cast("bigint").alias("place"), "path", *above)

    known = start(len(levels))
    for k in reversed(range(len(levels))):
        below = "".join(f", '{c}', c%d.{c}" for c in carried) if not k else ""
        children = (
            f"CASE WHEN c{i} IS NOT NULL THEN named_struct('place', {fanout} * place + {i}, 'digest', c{i}.digest, 'level',"
            f" named_struct('before', {_joined(range(i))}, 'after', {_joined(range(i + 1, fanout))})"
            f"{below.replace('%d', str(i))}) END"
            for i in range(fanout)
        )
        met = levels[k].join(known, ["tree", "place"])
        spread = met.selectExpr("tree", "path", *above, f"explode(array_compact(array({', '.join(children)}))) AS child")
        down = F.concat(F.array("child.level"), F.col("path")).alias("path")
        if k:
            known = spread.select("tree", F.col("child.place").cast("bigint").alias("place"), down, *above).union(start(k))
        else:
            known = spread.select("tree", F.col("child.place").cast("bigint").alias("place"), "child.digest", down, *above, *(f"child.{c}" for c in carried))
    alone = leaves.where("size = 1").select("tree", "place", "digest", *carried)
    single = alone.join(start(0).drop("place"), "tree").select("tree", "place", "digest", "path", *above, *carried)
    return known.union(single) if levels else single


def merkle_proofs(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    fanout: int = FANOUT,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``id, leaf, subroot, root, path`` of every row, digests as 32 bytes. Runs jobs.

    ``path`` lists from the leaf's run up to the root what stands ``before`` and
    ``after`` a node among its siblings; ``fold`` takes it. ``carry`` names
    columns of the rows to pass on beside them.

    Leaves of a group stand in id order, null ids first; rows that repeat an id
    go by their leaf, and equal rows are leaves of their own. A null group is a
    group, the first. Null values are told from empty ones. A row alone in its
    group is its subroot, a lone subroot the root. An empty table gives no row.
    Columns not among ``fields`` are not looked at; their names don't matter.
    Texts are read once, to be hashed: only digests and ids move after that. A
    hot group is dealt by place, never by its key.
    """
    if fanout < 2:
        raise ValueError("a parent has two children or more")
    carry = carry or {}
    named = {f"_carried_{i}": c for i, c in enumerate(carry.values())}
    # Ordering looks at its rows twice: hash the texts once, before.
    hashed = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{group_col}`").alias("group"),
        leaf_digest([F.col(f"`{c}`") for c in fields]).alias("digest"),
        F.lit(1).alias("one"),
        *(c.alias(name) for name, c in named.items()),
    )
    first = F.col("group").asc_nulls_first()
    order = [first, F.col("id").asc_nulls_first(), "digest"]
    placed = ordered_totals(cut_lineage(hashed), order, {"before": "one"}).withColumn("key", written(F.col("group")))
    groups = placed.groupBy("key", "group").agg(F.min("before").alias("base"), F.count("*").alias("size"))
    groups = groups.withColumn("one", F.lit(1))
    trees = cut_lineage(ordered_totals(groups, [first], {"tree": "one"}).select("key", "tree", "base", "size"))

    carried = ["id", *named]
    met = join_unique(placed.drop("group", "one"), trees, "key")
    leaves = cut_lineage(met.select("tree", (F.col("before") - F.col("base")).alias("place"), "size", "digest", *carried))
    levels, subroots = _grow(leaves, carried, fanout)

    whole = trees.agg(F.count("*").alias("n")).first()["n"]
    twigs = subroots.select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.lit(whole).cast("bigint").alias("size"),
        "digest", F.col("tree").alias("of"), F.col("height").alias("of_height"),
    )
    crown, top = _grow(twigs, ["of", "of_height"], fanout)
    empty = F.array().cast("array<struct<before:binary,after:binary>>")
    top = top.select("tree", "height", empty.alias("path"), F.col("digest").alias("root"))
    crowned = _descend(twigs, crown, top, ["of", "of_height"], fanout)
    tops = cut_lineage(
        crowned.select(
            F.col("of").alias("tree"), F.col("of_height").alias("height"), "path", F.col("digest").alias("subroot"), "root"
        )
    )
    proofs = _descend(leaves, levels, tops, carried, fanout)
    names = [F.col(name).alias(out) for name, out in zip(named, carry)]
    return proofs.select("id", F.col("digest").alias("leaf"), "subroot", "root", "path", *names)
