import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratelab.operators import graph
from ratelab.operators import joins
from ratelab.sources.edges import read_edges

CASES = {
    # name: (edges, endpoint third, keep third, keep n, drop third)
    "cycle": ([(1, 2), (2, 3), (3, 1)], 1, 1, 3, 1),
    "both directions": ([(1, 2), (2, 3), (3, 1), (2, 1), (3, 2), (1, 3)], 2, 2, 6, 2),
    "loop and mutual": ([(1, 1), (1, 2), (2, 1)], 0, 1, 4, 0),
    "parallel": ([(1, 2), (1, 2), (2, 3), (3, 1)], 2, 2, 6, 2),
    "transitive": ([(1, 2), (2, 3), (1, 3)], 0, 0, 0, 0),
    "over limit": ([(1, 2), (2, 30000), (30000, 1)], 0, 0, 0, 0),
    "lone loop": ([(1, 1)], 0, 0, 1, 0),
    "cycle and loop": ([(1, 2), (2, 3), (3, 1), (1, 1)], 1, 1, 4, 1),
}


def frame(spark, edges):
    return spark.createDataFrame(edges, "src bigint, dst bigint")


def brute(edges):
    """Matches as a counter of (x, y, z)."""
    count = Counter(edges)
    found = Counter()
    for (x, y), m1 in count.items():
        for (y2, z), m2 in count.items():
            if y2 == y and (z, x) in count:
                found[(x, y, z)] += m1 * m2 * count[(z, x)]
    return found


def matches(found, loops):
    if loops == "keep":
        return found
    if loops == "endpoint":
        return Counter({t: n for t, n in found.items() if t[0] != t[2]})
    return Counter({t: n for t, n in found.items() if len(set(t)) == 3})


def random_edges(seed, nodes=9, edges=60, hub=True):
    rng = random.Random(seed)
    out = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(edges)]
    if hub:
        out += [(0, rng.randrange(nodes)) for _ in range(15)]
        out += [(rng.randrange(nodes), 0) for _ in range(15)]
        out += [(1, 2)] * 25
    return out


@pytest.mark.parametrize("name", CASES)
def test_counts_on_worked_cases(spark, name):
    edges, endpoint, keep, keep_n, drop = CASES[name]
    df = graph.filter_max_id(frame(spark, edges), 22000)
    assert graph.triangle_count(df).first()["triangles"] == endpoint
    if "loop" in name:
        row = graph.triangle_count(df, loops="keep").first()
        assert (row["matches"], row["triangles"]) == (keep_n, keep)
        row = graph.triangle_count(df, loops="keep", fractional=True).first()
        assert row["triangles"] == pytest.approx(keep_n / 3)
        assert graph.triangle_count(df, loops="drop").first()["triangles"] == drop


@pytest.mark.parametrize("loops", graph.LOOP_MODES)
def test_counts_and_listing_agree_with_brute_force(spark, loops):
    edges = random_edges(3)
    expected = matches(brute(edges), loops)
    df = frame(spark, edges)
    for strategy in graph.STRATEGIES:
        row = graph.triangle_count(df, loops=loops, strategy=strategy).first()
        assert row["matches"] == sum(expected.values()), strategy
    listed = graph.triangles(df, loops=loops, paths_per_slice=2).collect()
    assert len(listed) == len({r[:3] for r in listed})
    assert {tuple(r[:3]): r["copies"] for r in listed} == dict(expected)


def test_single_rotation_lists_each_cycle_once(spark):
    edges = random_edges(5)
    expected = matches(brute(edges), "drop")
    listed = graph.triangles(frame(spark, edges), loops="drop", rotations=False).collect()
    assert 3 * sum(r["copies"] for r in listed) == sum(expected.values())
    with pytest.raises(ValueError):
        graph.triangles(frame(spark, edges), loops="keep", rotations=False)


def test_loop_free_modes_agree_and_dedup(spark):
    edges = [(a, b) for a, b in random_edges(7) if a != b]
    df = frame(spark, edges)
    counts = {graph.triangle_count(df, loops=m).first()["matches"] for m in graph.LOOP_MODES}
    assert counts == {sum(brute(edges).values())}
    once = graph.triangle_count(df, dedup=True).first()["matches"]
    assert once == sum(brute(list(set(edges))).values())


def test_hub_keys_are_sliced_without_changing_counts(spark, monkeypatch):
    edges = random_edges(11)
    df = frame(spark, edges)
    original = joins.hot_keys

    def eager(facts, *key_sets, rows_per_slice=None):
        return original(facts, *key_sets, rows_per_slice=3)

    monkeypatch.setattr(graph, "hot_keys", eager)
    assert eager(df, ["src"])[0].slices
    expected = sum(matches(brute(edges), "keep").values())
    assert graph.triangle_count(df, loops="keep").first()["matches"] == expected


def test_two_hop_paths_whole_under_blocking(spark):
    edges = random_edges(13)
    count = Counter(edges)
    expected = Counter()
    for (x, y), m1 in count.items():
        for (y2, z), m2 in count.items():
            if y2 == y:
                expected[(x, y, z)] += m1 * m2
    df = frame(spark, edges)
    for pairs in (50_000_000, 4):
        rows = graph.two_hop(df, distinct_ends=False, pairs_per_task=pairs).collect()
        assert {tuple(r[:3]): r["copies"] for r in rows} == dict(expected)
    apart = sum(n for (x, _, z), n in expected.items() if x != z)
    assert graph.two_hop_count(df).first()["paths"] == apart
    assert graph.two_hop_count(df, distinct_ends=False).first()["paths"] == sum(expected.values())
    assert graph.two_hop(df).agg(F.sum("copies")).first()[0] == apart


def test_adjacency_blocks_hold_every_edge(spark):
    edges = random_edges(17)
    for size in (1_000_000, 2):
        rows = graph.adjacency(frame(spark, edges), size).collect()
        listed = Counter()
        for r in rows:
            assert list(r["neighbours"]) == sorted(r["neighbours"])
            assert len(r["neighbours"]) <= size
            for dst, copies in r["neighbours"]:
                listed[(r["src"], dst)] += copies
        assert listed == Counter(edges)


def test_reverse_and_filter(spark):
    df = frame(spark, [(1, 2), (-5, 3), (4, 9)])
    assert {tuple(r) for r in graph.reverse(df).collect()} == {(2, 1), (3, -5), (9, 4)}
    assert {tuple(r) for r in graph.filter_max_id(df, 4).collect()} == {(1, 2), (-5, 3)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_strategies_show_in_the_plan(spark, monkeypatch):
    df = frame(spark, random_edges(19))
    shuffle = plan(graph.triangle_count(df, strategy="shuffle"))
    assert "SortMergeJoin" in shuffle
    broadcast = plan(graph.triangle_count(df, loops="drop", strategy="broadcast"))
    assert "BroadcastHashJoin" in broadcast and "SortMergeJoin" not in broadcast
    monkeypatch.setattr(graph, "BROADCAST_EDGE_ROWS", 10)
    beyond = plan(graph.triangle_count(df, strategy="broadcast"))
    assert "SortMergeJoin" in beyond
    for text in (shuffle, broadcast, beyond):
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_read_edges(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text("1,2,extra\n3,4\nx,5\n")
    rows = read_edges(spark, str(path), mode="drop").collect()
    assert {tuple(r) for r in rows} == {(1, 2), (3, 4)}
    with pytest.raises(Exception, match="edge id is no integer"):
        read_edges(spark, str(path)).collect()


def test_unknown_options(spark):
    df = frame(spark, [(1, 2)])
    with pytest.raises(ValueError):
        graph.triangle_count(df, loops="some")
    with pytest.raises(ValueError):
        graph.triangle_count(df, strategy="magic")
