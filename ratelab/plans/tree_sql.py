"""DuckDB SQL of regression trees: the same cuts, level by level."""

from collections.abc import Sequence

from ratelab.operators.regression_trees import TreeRule
from ratelab.operators.sampling import DIGITS, poisson_steps


def _weight(key: str, seed: int) -> str:
    draw = f"CAST('0x' || substr(md5(concat_ws('|', {key}, '{seed}')), 1, {DIGITS}) AS BIGINT) / {float(16**DIGITS)!r}::DOUBLE"
    steps = " + ".join(f"CAST(u >= {step!r}::DOUBLE AS INTEGER)" for step in poisson_steps(1.0))
    return f"(SELECT {steps} FROM (SELECT {draw} AS u))"


def trees_sql(features: Sequence[str], rule: TreeRule, train: str = "train", test: str = "test", key: str = "row_key") -> str:
    """CTEs up to ``answers (row_key, predicted)``; ``train`` and ``test`` hold categories and ``rating``."""
    k = len(features)
    columns = ", ".join(f"CAST({c} AS VARCHAR) AS f{i}" for i, c in enumerate(features))
    names = ", ".join(f"f{i}" for i in range(k))
    if rule.trees == 1:
        rows = f"SELECT 0 AS tree, 1::BIGINT AS node, 1::BIGINT AS w, rating AS y, {columns} FROM {train}"
    else:
        named = f"concat_ws('|', {key}, tree)"
        drawn = f"SELECT tree, {_weight(named, rule.seed)} AS w, rating AS y, {columns}"
        rows = (
            f"SELECT tree, 1::BIGINT AS node, w, y, {names} FROM ({drawn} FROM {train}, "
            f"(SELECT unnest(range({rule.trees})) AS tree)) WHERE w > 0"
        )
    ctes = [
        f"r0 AS MATERIALIZED ({rows})",
        f"q0 AS MATERIALIZED (SELECT {key} AS row_key, tree, 1::BIGINT AS node, {columns} FROM {test}, "
        f"(SELECT unnest(range({rule.trees})) AS tree))",
    ]
    answers = []
    text = "CASE " + " ".join(f"WHEN b.feature = {i} THEN f{i}" for i in range(k)) + " END"
    for d in range(rule.max_depth + 1):
        ctes.append(f"t{d} AS MATERIALIZED (SELECT tree, node, sum(w) AS n, sum(w * y) AS s FROM r{d} GROUP BY tree, node)")
        if d == rule.max_depth:
            answers.append(f"SELECT row_key, tree, s::DOUBLE / n AS value FROM q{d} JOIN t{d} USING (tree, node)")
            break
        allowed = ""
        if rule.features_per_node is not None and rule.features_per_node < k:
            draws = ", ".join(f"{{'d': md5('{rule.seed}|' || tree || '|' || node || '|{i}'), 'f': {i}}}" for i in range(k))
            ctes.append(
                f"a{d} AS MATERIALIZED (SELECT tree, node, unnest(list_transform(list_sort([{draws}])"
                f"[1:{rule.features_per_node}], lambda x: x.f)) AS feature FROM t{d})"
            )
            allowed = f" JOIN a{d} USING (tree, node, feature)"
        each = " UNION ALL ".join(
            f"SELECT tree, node, {i} AS feature, f{i} AS value, sum(w) AS pn, sum(w * y) AS ps FROM r{d} "
            f"WHERE f{i} IS NOT NULL GROUP BY tree, node, f{i}" for i in range(k)
        )
        ctes.append(f"""
        c{d} AS MATERIALIZED (
            SELECT tree, node, feature, value, sum(pn) OVER place AS ln, sum(ps) OVER place AS ls
            FROM ({each}){allowed}
            WINDOW place AS (PARTITION BY tree, node, feature ORDER BY ps::DOUBLE / pn, value
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        b{d} AS MATERIALIZED (
            SELECT tree, node, feature, ln AS cut
            FROM (SELECT *, ls::DOUBLE * ls / ln + (s - ls)::DOUBLE * (s - ls) / (n - ln) AS score
                  FROM c{d} JOIN t{d} USING (tree, node) WHERE n > ln)
            WHERE score > s::DOUBLE * s / n
            QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, feature, ln) = 1),
        l{d} AS MATERIALIZED (SELECT tree, node, value FROM c{d} JOIN b{d} USING (tree, node, feature) WHERE ln <= cut)""")

        def down(rows, carried):
            side = "CASE WHEN l.value IS NULL THEN 1 ELSE 0 END"
            return (
                f"SELECT {carried}, x.tree, 2 * x.node + {side} AS node, {names} "
                f"FROM (SELECT r.*, {text} AS value FROM {rows} r JOIN b{d} b ON r.tree = b.tree AND r.node = b.node) x "
                f"LEFT JOIN l{d} l ON l.tree = x.tree AND l.node = x.node AND l.value = x.value"
            )

        answers.append(
            f"SELECT row_key, tree, s::DOUBLE / n AS value FROM q{d} JOIN t{d} USING (tree, node) ANTI JOIN b{d} USING (tree, node)"
        )
        ctes.append(f"r{d + 1} AS MATERIALIZED ({down(f'r{d}', 'w, y')})")
        ctes.append(f"q{d + 1} AS MATERIALIZED ({down(f'q{d}', 'row_key')})")
    ctes.append(f"leaves AS ({' UNION ALL '.join(answers)})")
    summed = "list_reduce(list_prepend(0.0::DOUBLE, list(value ORDER BY tree)), lambda a, b: a + b)"
    mean = "any_value(value)" if rule.trees == 1 else f"{summed} / {rule.trees}"
    ctes.append(f"answers AS (SELECT row_key, {mean} AS predicted FROM leaves GROUP BY row_key)")
    return ",\n".join(ctes)
