"""DuckDB SQL of gain-ratio trees: grown level by level, pruned from the deepest level up."""

from collections.abc import Sequence
from statistics import NormalDist

from ratelab.operators.gain_subtrees import (
    ESTIMATE_DIGITS,
    EVEN_SHARE,
    GAIN_SLACK,
    HIGH,
    LEAST_SAVED,
    LOW,
    MOST_SIDE,
    SCORE_DIGITS,
    VALUE_MARK,
)
from ratelab.operators.gain_trees import MANY_VALUES, ROOT, GainRule

#: Levels written out; the trees of the test tables have fewer.
LEVELS = 24


def _h(n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN {n} * log2(CAST({n} AS DOUBLE)) ELSE 0 END"


def _alone(rule: GainRule) -> str:
    """Errors that a leaf of ``n`` rows and ``errors`` errors is expected to make."""
    z, n, e = f"{NormalDist().inv_cdf(1 - rule.confidence)!r}::DOUBLE", "n::DOUBLE", "errors::DOUBLE"
    f = f"(({e} + 0.5) / {n})"
    root = f"sqrt(greatest({f} / {n} - {f} * {f} / {n} + {z} * {z} / (4 * {n} * {n}), 0.0))"
    bound = f"({f} + {z} * {z} / (2 * {n}) + {z} * {root}) / (1 + {z} * {z} / {n})"
    return (
        f"{e} + CASE WHEN errors = 0 THEN {n} * (1 - pow({rule.confidence!r}::DOUBLE, 1 / {n})) "
        f"WHEN {e} + 0.5 >= {n} THEN greatest({n} - {e}, 0.0) ELSE {bound} * {n} - {e} END"
    )


def gain_tree_sql(
    nominal: Sequence[str], numeric: Sequence[str], rule: GainRule, train: str = "train", test: str = "test", levels: int = LEVELS
) -> str:
    """CTEs up to ``answers (row_key, predicted)``; ``train`` and ``test`` hold features and ``rating``."""
    k = len(nominal)
    columns = ", ".join(
        [f"CAST({c} AS VARCHAR) AS f{i}" for i, c in enumerate(nominal)]
        + [f"CAST({c} AS DOUBLE) AS f{k + i}" for i, c in enumerate(numeric)]
    )
    width = k + len(numeric)
    names = ", ".join(f"f{i}" for i in range(width))
    shares = " UNION ALL ".join(
        f"SELECT {i} AS feature FROM {train} HAVING count(DISTINCT {c}) >= {MANY_VALUES} * count(*)" for i, c in enumerate(nominal)
    )
    ctes = [
        f"many AS MATERIALIZED ({shares})",
        f"kinds AS MATERIALIZED (SELECT count(DISTINCT rating) AS kinds FROM {train})",
        f"r0 AS MATERIALIZED (SELECT '{ROOT}' AS node, CAST(NULL AS VARCHAR) AS parent, rating, {columns} FROM {train})",
        f"q0 AS MATERIALIZED (SELECT row_key, '{ROOT}' AS node, {columns} FROM {test})",
    ]
    ways = " ".join(
        f"WHEN {i} THEN " + (f"'{VALUE_MARK}' || f{i}" if i < k else f"CASE WHEN f{i} <= threshold THEN '{LOW}' WHEN f{i} IS NOT NULL THEN '{HIGH}' END")
        for i in range(width)
    )
    child = f"md5(node || '|' || coalesce(CASE feature {ways} END, most))"
    digits = SCORE_DIGITS
    for d in range(levels):
        cells = " UNION ALL ".join(
            f"SELECT node, {i} AS feature, {f'f{i}' if i < k else 'CAST(NULL AS VARCHAR)'} AS value, "
            f"{f'f{i}' if i >= k else 'CAST(NULL AS DOUBLE)'} AS number, rating, count(*) AS n "
            f"FROM r{d} SEMI JOIN (SELECT node FROM t{d} WHERE errors > 0 AND n >= {2 * rule.min_rows}) USING (node) "
            f"WHERE f{i} IS NOT NULL GROUP BY ALL"
            for i in range(width)
        )
        ctes.append(f"""
        t{d} AS MATERIALIZED (
            SELECT node, any_value(parent) AS parent, sum(n) AS n, sum(n) - max(n) AS errors,
                   CAST(first(rating ORDER BY n DESC, rating) AS DOUBLE) AS answer
            FROM (SELECT node, parent, rating, count(*) AS n FROM r{d} GROUP BY ALL) GROUP BY node),
        c{d} AS MATERIALIZED ({cells}),
        k{d} AS MATERIALIZED (SELECT node, feature, rating, sum(n) AS k FROM c{d} GROUP BY ALL),
        w{d} AS MATERIALIZED (SELECT node, feature, sum(k) AS known, {_h("sum(k)")} - sum({_h("k")}) AS disorder
                              FROM k{d} GROUP BY ALL),
        g{d} AS (SELECT v.node, v.feature, v.number, v.after, s.k, coalesce(sum(c.n) OVER place, 0) AS l
                 FROM (SELECT *, lead(number) OVER (PARTITION BY node, feature ORDER BY number) AS after
                       FROM (SELECT DISTINCT node, feature, number FROM c{d} WHERE number IS NOT NULL)) v
                 JOIN k{d} s USING (node, feature)
                 LEFT JOIN c{d} c ON c.node = v.node AND c.feature = v.feature AND c.number = v.number AND c.rating = s.rating
                 WINDOW place AS (PARTITION BY v.node, v.feature, s.rating ORDER BY v.number
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        x{d} AS (SELECT node, feature, number, after, sum(l) AS low, sum(k - l) AS high,
                        round({_h("sum(l)")} - sum({_h("l")}) + {_h("sum(k - l)")} - sum({_h("(k - l)")}), {digits}) AS inner_
                 FROM g{d} WHERE after IS NOT NULL GROUP BY ALL),
        y{d} AS (SELECT *, count(*) OVER (PARTITION BY node, feature) AS cuts FROM x{d}, kinds
                 WHERE least(low, high) >= greatest(least({EVEN_SHARE}::DOUBLE * (low + high) / kinds, {MOST_SIDE}), {rule.min_rows})
                 QUALIFY row_number() OVER (PARTITION BY node, feature ORDER BY inner_, number) = 1),
        u{d} AS (SELECT node, feature, sum({_h("n")} - hs) AS inner_, sum({_h("n")}) AS parts,
                        '{VALUE_MARK}' || first(value ORDER BY n DESC, value) AS most
                 FROM (SELECT node, feature, value, sum(n) AS n, sum({_h("n")}) AS hs FROM c{d} WHERE value IS NOT NULL GROUP BY ALL)
                 GROUP BY ALL HAVING count(*) FILTER (WHERE n >= {rule.min_rows}) > 1),
        o{d} AS (SELECT node, feature, inner_, parts, most, CAST(NULL AS DOUBLE) AS threshold, 0 AS price FROM u{d}
                 UNION ALL
                 SELECT node, feature, inner_, {_h("low")} + {_h("high")}, CASE WHEN low >= high THEN '{LOW}' ELSE '{HIGH}' END,
                        (number + after) / 2, log2(CAST(cuts AS DOUBLE)) FROM y{d}),
        s{d} AS MATERIALIZED (
            SELECT *, round(gain / nullif(told, 0), {digits}) AS ratio
            FROM (SELECT node, feature, threshold, most, round((disorder - inner_ - price) / n, {digits}) AS gain,
                         ({_h("n")} - parts - {_h("(n - known)")}) / n AS told
                  FROM o{d} JOIN w{d} USING (node, feature) JOIN t{d} USING (node))
            WHERE threshold IS NULL OR gain > 0),
        a{d} AS (SELECT node, round(sum(gain ORDER BY feature) / count(*) - {GAIN_SLACK}, {digits}) AS average
                 FROM s{d} ANTI JOIN many USING (feature) GROUP BY node),
        b{d} AS MATERIALIZED (
            SELECT node, feature, threshold, most FROM s{d} JOIN a{d} USING (node)
            WHERE gain >= average AND gain > 0 AND ratio > 0
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY ratio DESC, feature) = 1),
        r{d + 1} AS MATERIALIZED (SELECT {child} AS node, node AS parent, rating, {names} FROM r{d} JOIN b{d} USING (node))""")
    saves = "false" if rule.unpruned else f"round(alone - s.estimate, {ESTIMATE_DIGITS}) <= {LEAST_SAVED}"
    for d in reversed(range(levels)):
        below = f"SELECT parent AS node, sum(made) AS made, sum(estimate) AS estimate FROM p{d + 1} GROUP BY parent"
        if d == levels - 1:
            below = "SELECT NULL::VARCHAR AS node, 0 AS made, 0 AS estimate WHERE false"
        ctes.append(f"""
        p{d} AS MATERIALIZED (
            SELECT node, parent, answer, leaf, coalesce(s_made, errors) AS made, CASE WHEN leaf THEN alone ELSE s_estimate END AS estimate
            FROM (SELECT t.*, s.made AS s_made, s.estimate AS s_estimate,
                         s.node IS NULL OR s.made >= errors - {GAIN_SLACK} OR {saves} AS leaf
                  FROM (SELECT *, {_alone(rule)} AS alone FROM t{d}) t LEFT JOIN ({below}) s ON s.node = t.node))""")
    for d in range(levels - 1):
        ctes.append(
            f"q{d + 1} AS MATERIALIZED (SELECT row_key, {child} AS node, {names} FROM q{d} JOIN b{d} USING (node) "
            f"SEMI JOIN (SELECT node FROM p{d} WHERE NOT leaf) USING (node))"
        )
    met = " UNION ALL ".join(f"SELECT row_key, {d} AS level, answer FROM q{d} JOIN p{d} USING (node)" for d in range(levels))
    ctes.append(f"answers AS (SELECT row_key, arg_max(answer, level) AS predicted FROM ({met}) GROUP BY row_key)")
    return ",\n".join(ctes)
