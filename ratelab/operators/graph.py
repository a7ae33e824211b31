"""Directed three-node cycles and two-hop paths on an edge table.

An edge table has bigint columns ``src`` and ``dst``: src follows dst. Parallel
edges count with their multiplicity and self-loops take part unless asked
otherwise, so the work starts by folding parallel edges into one row with a
``copies`` weight. All later row counts are those of the simple graph.

Counting splits the matches x->y, y->z, z->x by how many of the ends coincide:

* three different nodes: each cycle matches three times (its rotations);
* two equal nodes: a loop on x together with x->z and z->x, three placements,
  of which the path-end test (x differs from z) keeps two;
* all equal: three loops on one node, which the path-end test removes.

Cycles of three different nodes are searched from their lowest-ranked node,
ranking by (degree, id), the degree counting parallel edges. A node has at most
sqrt(2 * edges) neighbours of higher rank, so a hub that owns a third of all
edges expands almost no paths and total work is bounded by edges ** 1.5.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelab.operators.joins import MAX_HOT_KEYS, HotKeys, hot_keys, skew_join

LOOP_MODES = ("endpoint", "keep", "drop")
STRATEGIES = ("auto", "shuffle", "broadcast")

# Rows of an edge table that may be broadcast: three bigints each, so some
# 100 MB once hashed.
BROADCAST_EDGE_ROWS = 1_000_000

ADJACENCY_BLOCK = 1_000_000


def filter_max_id(edges: DataFrame, limit: int | Column) -> DataFrame:
    """Edges with both ends at or below ``limit``; there is no lower bound."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    return edges.filter((F.col("src") <= limit) & (F.col("dst") <= limit))


def reverse(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def fold_parallel(edges: DataFrame, dedup: bool = False) -> DataFrame:
    """One row per (src, dst) with the number of parallel edges as ``copies``."""
    weight = F.lit(1).cast("bigint") if dedup else F.count(F.lit(1))
    return edges.groupBy("src", "dst").agg(weight.alias("copies"))


def adjacency(edges: DataFrame, block_size: int = ADJACENCY_BLOCK) -> DataFrame:
    """Out-neighbour lists: ``src, block, neighbours``.

    ``neighbours`` is sorted and holds (dst, copies) pairs. A list covers one
    range of ``block_size`` neighbour ids, so no row outgrows that size however
    many edges a node has.
    """
    block = F.floor(F.col("dst") / F.lit(block_size)).alias("block")
    return (
        fold_parallel(edges)
        .groupBy("src", block)
        .agg(F.sort_array(F.collect_list(F.struct("dst", "copies"))).alias("neighbours"))
    )


def two_hop(
    edges: DataFrame,
    distinct_ends: bool = True,
    dedup: bool = False,
    pairs_per_task: int = 50_000_000,
) -> DataFrame:
    """Paths src->mid->dst with their multiplicity as ``copies``.

    The result is the full set of paths, so a hub with i in-edges and o
    out-edges contributes i * o rows. Hubs are cut into a grid of blocks (in
    slices by out slices) so that no task has to produce more than about
    ``pairs_per_task`` of them. Use ``two_hop_count`` when the number is enough.
    """
    folded = fold_parallel(edges, dedup)
    into = folded.select(F.col("src"), F.col("dst").alias("mid"), F.col("copies").alias("in_copies"))
    out = folded.select(F.col("src").alias("mid"), F.col("dst"), F.col("copies").alias("out_copies"))

    work = (
        into.groupBy("mid").agg(F.count(F.lit(1)).alias("n_in"))
        .join(out.groupBy("mid").agg(F.count(F.lit(1)).alias("n_out")), "mid")
        .withColumn("pairs", F.col("n_in").cast("double") * F.col("n_out"))
    )
    # Fewer than MAX_HOT_KEYS nodes can exceed this share of the total.
    total = work.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("n")).scalar()
    cut = F.greatest(F.lit(float(pairs_per_task)), total / F.lit(float(MAX_HOT_KEYS)))
    side = F.sqrt(cut)
    hubs = F.broadcast(
        work.filter(F.col("pairs") > cut).select(
            "mid",
            F.ceil(F.col("n_in") / side).alias("in_slices"),
            F.ceil(F.col("n_out") / side).alias("out_slices"),
        )
    )

    def slice_of(end: str, slices: str) -> Column:
        return F.pmod(F.xxhash64(end), F.coalesce(slices, F.lit(1)).cast("bigint"))

    def every(slices: str) -> Column:
        last = F.coalesce(slices, F.lit(1)).cast("bigint") - 1
        return F.explode(F.sequence(F.lit(0).cast("bigint"), last))

    left = into.join(hubs, "mid", "left").select(
        "src", "mid", "in_copies",
        slice_of("src", "in_slices").alias("in_slice"),
        every("out_slices").alias("out_slice"),
    )
    right = out.join(hubs, "mid", "left").select(
        "mid", "dst", "out_copies",
        slice_of("dst", "out_slices").alias("out_slice"),
        every("in_slices").alias("in_slice"),
    )
    paths = left.join(right, ["mid", "in_slice", "out_slice"])
    if distinct_ends:
        paths = paths.filter(F.col("src") != F.col("dst"))
    return paths.select(
        "src", "mid", "dst", (F.col("in_copies") * F.col("out_copies")).alias("copies")
    )


def two_hop_count(edges: DataFrame, distinct_ends: bool = True, dedup: bool = False) -> DataFrame:
    """Number of two-hop paths (``paths``), from degrees, without listing any."""
    folded = fold_parallel(edges, dedup)
    wide = F.col("copies").cast("decimal(20,0)")
    n_in = folded.groupBy(F.col("dst").alias("mid")).agg(F.sum(wide).alias("n_in"))
    n_out = folded.groupBy(F.col("src").alias("mid")).agg(F.sum(wide).alias("n_out"))
    terms = n_in.join(n_out, "mid").select(
        (F.col("n_in").cast("decimal(19,0)") * F.col("n_out").cast("decimal(18,0)")).alias("n")
    )
    if distinct_ends:
        back = folded.select(
            F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("copies").alias("back")
        )
        returning = folded.join(back, ["src", "dst"]).select(
            (-F.col("copies").cast("decimal(19,0)") * F.col("back").cast("decimal(18,0)")).alias("n")
        )
        terms = terms.unionAll(returning)
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    return terms.agg(total.alias("paths"))


def triangles(
    edges: DataFrame,
    loops: str = "endpoint",
    dedup: bool = False,
    strategy: str = "auto",
    rotations: bool = True,
    paths_per_slice: int = 1_000_000,
) -> DataFrame:
    """Matches of x->y, y->z, z->x as ``x, y, z, copies``.

    With ``rotations`` each cycle is listed from each of its three nodes;
    without, from its lowest-ranked node only (``loops="drop"`` required).
    """
    _check(loops, strategy)
    if not rotations and loops != "drop":
        raise ValueError("rotations=False lists loop-free cycles; use loops='drop'")
    hot = hot_keys(edges, ["src"], ["dst"])
    strategy = _checked(strategy, hot)
    folded = fold_parallel(edges, dedup)
    pairs = folded.filter(F.col("src") != F.col("dst"))
    ranked = _with_degrees(pairs, strategy, hot)
    # The paths that one closing edge b->a can meet are at most the smaller
    # degree of its ends, which both sides know: slice by it.
    slices = F.ceil(F.least("a_degree", "b_degree") / F.lit(paths_per_slice))
    legs = _low_paths(ranked, strategy).withColumn(
        "slice", F.pmod(F.xxhash64("mid"), slices.cast("bigint"))
    )
    closing = ranked.select(
        F.col("src").alias("b"),
        F.col("dst").alias("a"),
        F.col("copies").alias("closing_copies"),
        F.explode(
            F.sequence(
                F.lit(0).cast("bigint"),
                F.ceil(F.least("src_degree", "dst_degree") / F.lit(paths_per_slice)) - 1,
            )
        ).alias("slice"),
    )
    cycles = legs.join(_join_hint(closing, strategy), ["a", "b", "slice"]).withColumn(
        "copies", F.col("path_copies") * F.col("closing_copies")
    )
    if not rotations:
        return cycles.select(F.col("mid").alias("x"), F.col("b").alias("y"), F.col("a").alias("z"), "copies")

    def turn(x: str, y: str, z: str) -> Column:
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.col(z).alias("z"))

    turns = [turn("a", "mid", "b"), turn("mid", "b", "a"), turn("b", "a", "mid")]
    matches = cycles.select(F.explode(F.array(*turns)).alias("t"), "copies").select("t.*", "copies")
    if loops == "drop":
        return matches

    loop_rows = _loops(folded)
    by_node = HotKeys(("node",), hot[0].slices, hot[0].rows)
    there_and_back = skew_join(_mutual(pairs), loop_rows, ["node"], hot=by_node).withColumn(
        "copies", F.col("mutual") * F.col("loop_copies")
    )
    # With the loop on n and the other node o: n,n,o and o,n,n pass the
    # path-end test; n,o,n does not.
    placements = [turn("node", "node", "other"), turn("other", "node", "node")]
    if loops == "keep":
        placements.append(turn("node", "other", "node"))
        matches = matches.unionByName(
            loop_rows.select(
                F.col("node").alias("x"),
                F.col("node").alias("y"),
                F.col("node").alias("z"),
                (F.col("loop_copies") * F.col("loop_copies") * F.col("loop_copies")).alias("copies"),
            )
        )
    touching = there_and_back.select(F.explode(F.array(*placements)).alias("t"), "copies")
    return matches.unionByName(touching.select("t.*", "copies"))


def triangle_count(
    edges: DataFrame,
    loops: str = "endpoint",
    dedup: bool = False,
    strategy: str = "auto",
    fractional: bool = False,
) -> DataFrame:
    """One row: ``matches`` of the closed path and ``triangles``, a third of it.

    ``loops``: "endpoint" keeps paths whose two ends differ, "keep" keeps every
    path, "drop" ignores self-loops. The third is an integer division, or a
    double with ``fractional``. Runs one job that counts the edges and looks for
    hubs; ``strategy="broadcast"`` becomes "shuffle" above ``BROADCAST_EDGE_ROWS``.
    """
    _check(loops, strategy)
    hot = hot_keys(edges, ["src"], ["dst"])
    strategy = _checked(strategy, hot)
    folded = fold_parallel(edges, dedup)
    pairs = folded.filter(F.col("src") != F.col("dst"))
    # Paths between the same two ends are summed before they are shuffled to
    # the closing edge: two hubs may share any number of middle nodes.
    legs = (
        _low_paths(_with_degrees(pairs, strategy, hot), strategy)
        .groupBy("a", "b")
        .agg(F.sum("path_copies").alias("path_copies"))
    )
    closing = pairs.select(
        F.col("src").alias("b"), F.col("dst").alias("a"), F.col("copies").alias("closing_copies")
    )
    cycles = legs.join(_join_hint(closing, strategy), ["a", "b"])
    parts = cycles.agg((F.sum(F.col("path_copies") * F.col("closing_copies")) * 3).alias("n"))
    if loops != "drop":
        loop_rows = _loops(folded)
        mutual = _mutual(pairs).groupBy("node").agg(F.sum("mutual").alias("mutual"))
        placements = 2 if loops == "endpoint" else 3
        touching = mutual.join(loop_rows, "node").agg(
            (F.sum(F.col("mutual") * F.col("loop_copies")) * placements).alias("n")
        )
        parts = parts.unionAll(touching)
        if loops == "keep":
            cubed = F.col("loop_copies") * F.col("loop_copies") * F.col("loop_copies")
            parts = parts.unionAll(loop_rows.agg(F.sum(cubed).alias("n")))
    matches = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("matches"))
    third = F.col("matches") / F.lit(3.0) if fractional else F.expr("matches div 3")
    return matches.select("matches", third.alias("triangles"))


def _check(loops: str, strategy: str) -> None:
    if loops not in LOOP_MODES:
        raise ValueError(f"loops must be one of {LOOP_MODES}: {loops}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}: {strategy}")


def _checked(strategy: str, hot: list[HotKeys]) -> str:
    """Folding parallel edges only shrinks the table that was counted."""
    if strategy == "broadcast" and hot[0].rows > BROADCAST_EDGE_ROWS:
        return "shuffle"
    return strategy


def _join_hint(df: DataFrame, strategy: str) -> DataFrame:
    if strategy == "broadcast":
        return F.broadcast(df)
    return df.hint("merge") if strategy == "shuffle" else df


def _with_degrees(pairs: DataFrame, strategy: str, hot: list[HotKeys]) -> DataFrame:
    """Both ends' degrees, copies included: any upper bound of the neighbours
    will do, and this one reads the folded table the other branches read."""
    degrees = (
        pairs.select(F.explode(F.array("src", "dst")).alias("node"), "copies")
        .groupBy("node")
        .agg(F.sum("copies").alias("degree"))
    )
    hint = {"auto": None, "shuffle": "merge", "broadcast": "broadcast"}[strategy]
    out = pairs
    for end, owners in zip(("src", "dst"), hot):
        mine = degrees.select(F.col("node").alias(end), F.col("degree").alias(f"{end}_degree"))
        out = skew_join(out, mine, [end], hot=owners, hint=hint)
    return out


def _low_paths(ranked: DataFrame, strategy: str) -> DataFrame:
    """Paths a->mid->b whose middle node ranks below both ends."""
    src_low = (F.col("src_degree") < F.col("dst_degree")) | (
        (F.col("src_degree") == F.col("dst_degree")) & (F.col("src") < F.col("dst"))
    )
    into = ranked.filter(~src_low).select(
        F.col("dst").alias("mid"),
        F.col("src").alias("a"),
        F.col("src_degree").alias("a_degree"),
        F.col("copies").alias("in_copies"),
    )
    out = ranked.filter(src_low).select(
        F.col("src").alias("mid"),
        F.col("dst").alias("b"),
        F.col("dst_degree").alias("b_degree"),
        F.col("copies").alias("out_copies"),
    )
    return (
        into.join(_join_hint(out, strategy), "mid")
        .filter(F.col("a") != F.col("b"))
        .withColumn("path_copies", F.col("in_copies") * F.col("out_copies"))
        .drop("in_copies", "out_copies")
    )


def _loops(folded: DataFrame) -> DataFrame:
    return folded.filter(F.col("src") == F.col("dst")).select(
        F.col("src").alias("node"), F.col("copies").alias("loop_copies")
    )


def _mutual(pairs: DataFrame) -> DataFrame:
    """Ordered pairs of nodes with edges both ways, and the product of copies."""
    back = pairs.select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("copies").alias("back")
    )
    return pairs.join(back, ["src", "dst"]).select(
        F.col("src").alias("node"),
        F.col("dst").alias("other"),
        (F.col("copies") * F.col("back")).alias("mutual"),
    )
