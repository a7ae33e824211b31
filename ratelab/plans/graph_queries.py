"""Registered graph queries and their SQL."""

from pyspark.sql import functions as F

from ratelab.operators import graph
from ratelab.plans import proxies

EDGES_SQL = """
e AS (SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem
      WHERE l_partkey <= (SELECT max(s_suppkey) FROM supplier)
        AND l_suppkey <= (SELECT max(s_suppkey) FROM supplier))
"""
MATCHES_SQL = """
m AS (SELECT count(*) AS n FROM e a JOIN e b ON a.dst = b.src
      JOIN e c ON c.src = b.dst AND c.dst = a.src {where})
"""


def edges_scan(spark, sf_dir):
    return proxies.all_edges(spark, sf_dir)


def edge_filter(spark, sf_dir):
    return proxies.edges(spark, sf_dir)


def edges_reverse(spark, sf_dir):
    return graph.reverse(proxies.edges(spark, sf_dir))


def adjacency(spark, sf_dir):
    lists = graph.adjacency(proxies.edges(spark, sf_dir))
    text = F.transform("neighbours", lambda n: F.concat_ws("x", n["dst"], n["copies"]))
    return lists.select("src", "block", F.array_join(text, ",").alias("neighbours"))


def two_hop_paths(spark, sf_dir):
    return graph.two_hop(proxies.edges(spark, sf_dir))


def two_hop_count(spark, sf_dir):
    return graph.two_hop_count(proxies.edges(spark, sf_dir))


def triangles(spark, sf_dir):
    return graph.triangles(proxies.edges(spark, sf_dir))


def _count(**options):
    def query(spark, sf_dir):
        return graph.triangle_count(proxies.edges(spark, sf_dir), **options)

    return query


QUERIES = {
    "edges_scan": edges_scan,
    "edge_filter": edge_filter,
    "edges_reverse": edges_reverse,
    "adjacency": adjacency,
    "two_hop_paths": two_hop_paths,
    "two_hop_count": two_hop_count,
    "triangles": triangles,
    "triangle_count": _count(loops="endpoint"),
    "triangle_count_shuffle": _count(loops="endpoint", strategy="shuffle"),
    "triangle_count_broadcast": _count(loops="endpoint", strategy="broadcast"),
    "triangle_count_unfiltered": _count(loops="keep"),
    "triangle_count_fractional": _count(loops="keep", fractional=True),
    "triangle_count_simple": _count(loops="drop"),
}

_ENDPOINT = MATCHES_SQL.format(where="WHERE a.src <> b.dst")
_KEEP = MATCHES_SQL.format(where="")
_DROP = MATCHES_SQL.format(where="WHERE a.src <> a.dst AND b.src <> b.dst AND c.src <> c.dst")
_THIRD = "SELECT CAST(n AS BIGINT) AS matches, CAST(n // 3 AS BIGINT) AS triangles FROM m"

ORACLE = {
    "edges_scan": "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem",
    "edge_filter": f"WITH {EDGES_SQL} SELECT src, dst FROM e",
    "edges_reverse": f"WITH {EDGES_SQL} SELECT dst AS src, src AS dst FROM e",
    "adjacency": f"""
        WITH {EDGES_SQL}, f AS (SELECT src, dst, count(*) AS copies FROM e GROUP BY src, dst)
        SELECT src, CAST(dst // {graph.ADJACENCY_BLOCK} AS BIGINT) AS block,
               string_agg(dst || 'x' || copies, ',' ORDER BY dst) AS neighbours
        FROM f GROUP BY src, dst // {graph.ADJACENCY_BLOCK}""",
    "two_hop_paths": f"""
        WITH {EDGES_SQL}
        SELECT a.src, a.dst AS mid, b.dst, CAST(count(*) AS BIGINT) AS copies
        FROM e a JOIN e b ON a.dst = b.src WHERE a.src <> b.dst
        GROUP BY a.src, a.dst, b.dst""",
    "two_hop_count": f"""
        WITH {EDGES_SQL}
        SELECT CAST(count(*) AS BIGINT) AS paths
        FROM e a JOIN e b ON a.dst = b.src WHERE a.src <> b.dst""",
    "triangles": f"""
        WITH {EDGES_SQL}
        SELECT a.src AS x, a.dst AS y, b.dst AS z, CAST(count(*) AS BIGINT) AS copies
        FROM e a JOIN e b ON a.dst = b.src
        JOIN e c ON c.src = b.dst AND c.dst = a.src
        WHERE a.src <> b.dst GROUP BY a.src, a.dst, b.dst""",
    "triangle_count": f"WITH {EDGES_SQL}, {_ENDPOINT} {_THIRD}",
    "triangle_count_shuffle": f"WITH {EDGES_SQL}, {_ENDPOINT} {_THIRD}",
    "triangle_count_broadcast": f"WITH {EDGES_SQL}, {_ENDPOINT} {_THIRD}",
    "triangle_count_unfiltered": f"WITH {EDGES_SQL}, {_KEEP} {_THIRD}",
    "triangle_count_fractional": f"""
        WITH {EDGES_SQL}, {_KEEP}
        SELECT CAST(n AS BIGINT) AS matches, CAST(n AS DOUBLE) / 3.0::DOUBLE AS triangles FROM m""",
    "triangle_count_simple": f"WITH {EDGES_SQL}, {_DROP} {_THIRD}",
}
