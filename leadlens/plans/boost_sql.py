"""DuckDB SQL of a whole boosted fit of fixed parameters: two levels a tree, every level written out as CTEs.

States the learner's rules on the vocabulary of the training table: quantised gradients, cuts with the missing rows on
either side, one slot against the rest, L1/L2, least hessian, pruning from the bottom up.
"""
from __future__ import annotations

from .. import config

UNIT = 1 << 20
CHOICE = """row_number() OVER (PARTITION BY seg, node ORDER BY gain DESC, f, code, missing_left) AS nr"""


def encoded(features: dict[str, list[str]], numeric: set[str]) -> list[str]:
    """CTEs: rows (seg, rid, id, y, w), features in the learner's order and their codes by row."""
    order = {s: [c for c in fs if c in numeric] + [c for c in fs if c not in numeric] for s, fs in features.items()}
    long = " UNION ALL ".join(
        f"SELECT seg, rid, {i} AS f, '{c}' AS feature, {str(c in numeric).lower()} AS is_num, "
        + (f"CAST({c} AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS level" if c in numeric
           else f"CAST(NULL AS DOUBLE) AS num, COALESCE(CAST({c} AS VARCHAR), '{config.MISSING}') AS level")
        + f" FROM r WHERE seg = '{s}'" for s, fs in order.items() for i, c in enumerate(fs))
    return [
        "r AS MATERIALIZED (SELECT *, segmento AS seg, row_number() OVER () AS rid FROM loaded)",
        """w AS (SELECT seg, count_if(y = 0) / CAST(greatest(count_if(y = 1), 1) AS DOUBLE) AS pw FROM r GROUP BY seg)""",
        f"long AS MATERIALIZED ({long})",
        f"""levels AS (
  SELECT seg, f, level, count(*) AS n, count(*) >= {config.MIN_FREQUENCY} AS often FROM long WHERE NOT is_num GROUP BY seg, f, level)""",
        """slots AS (
  SELECT seg, f, level, CASE WHEN often THEN row_number() OVER (PARTITION BY seg, f, often ORDER BY level) - 1
                             ELSE count_if(often) OVER (PARTITION BY seg, f) END AS code FROM levels)""",
        """cuts AS (SELECT seg, f, num, row_number() OVER (PARTITION BY seg, f ORDER BY num) AS code
  FROM (SELECT DISTINCT seg, f, num FROM long WHERE is_num AND num IS NOT NULL))""",
        """enc AS MATERIALIZED (
  SELECT l.seg, l.rid, l.f, l.feature, l.is_num, CAST(CASE WHEN is_num THEN COALESCE(c.code, 0) ELSE s.code END AS INTEGER) AS code
  FROM long l LEFT JOIN slots s ON s.seg = l.seg AND s.f = l.f AND s.level = l.level
  LEFT JOIN cuts c ON c.seg = l.seg AND c.f = l.f AND c.num = l.num)""",
        "cells AS MATERIALIZED (SELECT DISTINCT seg, f, feature, is_num, code FROM enc WHERE NOT (is_num AND code = 0))",
        "m0 AS (SELECT r.seg, rid, ld_mcs_id, y, CASE WHEN y = 1 THEN pw ELSE 1.0 END AS w, CAST(0 AS DOUBLE) AS m FROM r JOIN w USING (seg) WHERE y IS NOT NULL)",
    ]


def level(name: str, rows: str, p: dict) -> list[str]:
    """CTEs: totals and the best split of each node of ``rows`` (seg, rid, node, g, h)."""
    t = lambda g: f"(sign({g}) * greatest(abs({g}) - {p['reg_alpha']}, 0))"
    score = lambda g, h: f"({t(g)} * {t(g)} / ({h} + {p['reg_lambda']}))"
    u = lambda x: f"(CAST({x} AS DOUBLE) / {UNIT})"
    return [
        f"{name}_t AS MATERIALIZED (SELECT seg, node, CAST(sum(g) AS BIGINT) AS gt, CAST(sum(h) AS BIGINT) AS ht FROM {rows} GROUP BY seg, node)",
        f"""{name}_h AS MATERIALIZED (
  SELECT e.seg, x.node, e.f, e.code, CAST(sum(g) AS BIGINT) AS g, CAST(sum(h) AS BIGINT) AS h
  FROM {rows} x JOIN enc e ON e.seg = x.seg AND e.rid = x.rid GROUP BY e.seg, x.node, e.f, e.code)""",
        f"""{name}_c AS (
  SELECT t.seg, t.node, c.f, c.feature, c.is_num, c.code, gt, ht,
    CAST(CASE WHEN c.is_num THEN sum(COALESCE(a.g, 0)) OVER k ELSE COALESCE(a.g, 0) END AS BIGINT) AS gl,
    CAST(CASE WHEN c.is_num THEN sum(COALESCE(a.h, 0)) OVER k ELSE COALESCE(a.h, 0) END AS BIGINT) AS hl,
    COALESCE(z.g, 0) AS gm, COALESCE(z.h, 0) AS hm
  FROM {name}_t t JOIN cells c ON c.seg = t.seg
  LEFT JOIN {name}_h a ON a.seg = t.seg AND a.node = t.node AND a.f = c.f AND a.code = c.code
  LEFT JOIN {name}_h z ON z.seg = t.seg AND z.node = t.node AND z.f = c.f AND z.code = 0 AND c.is_num
  WINDOW k AS (PARTITION BY t.seg, t.node, c.f ORDER BY c.code))""",
        f"""{name}_o AS (
  SELECT seg, node, f, feature, is_num, code, gt, ht, gl, hl, false AS missing_left FROM {name}_c
  UNION ALL SELECT seg, node, f, feature, is_num, code, gt, ht, gl + gm, hl + hm, true FROM {name}_c WHERE is_num)""",
        f"""{name}_s AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, {CHOICE} FROM (
      SELECT *, {score(u('gl'), u('hl'))} + {score(u('(gt - gl)'), u('(ht - hl)'))} - {score(u('gt'), u('ht'))} AS gain
      FROM {name}_o WHERE hl >= {p['min_child_weight']} * {UNIT} AND ht - hl >= {p['min_child_weight']} * {UNIT} AND hl > 0 AND ht - hl > 0))
  WHERE nr = 1 AND gain > 1e-6)""",
    ]


def fitted(p: dict, rounds: int) -> list[str]:
    """CTEs of all rounds; round i gives its nodes ``n{i}`` and the margins ``m{i+1}``."""
    out = []
    go_left = "CASE WHEN NOT s.is_num THEN e.code = s.code WHEN e.code = 0 THEN s.missing_left ELSE e.code <= s.code END"
    for i in range(rounds):
        out.append(f"""g{i} AS MATERIALIZED (
  SELECT seg, rid, 1 AS node, CAST(round_even((q - y) * w * {UNIT}, 0) AS BIGINT) AS g, CAST(round_even(greatest(q * (1 - q), 1e-16) * w * {UNIT}, 0) AS BIGINT) AS h
  FROM (SELECT *, 1 / (1 + exp(-m)) AS q FROM m{i}))""")
        out += level(f"a{i}", f"g{i}", p)
        out.append(f"""b{i} AS MATERIALIZED (
  SELECT x.seg, x.rid, CASE WHEN {go_left} THEN 2 ELSE 3 END AS node, x.g, x.h
  FROM g{i} x JOIN a{i}_s s ON s.seg = x.seg JOIN enc e ON e.seg = x.seg AND e.rid = x.rid AND e.f = s.f)""")
        out += level(f"c{i}", f"b{i}", p)
        out.append(f"""k{i} AS MATERIALIZED (SELECT * FROM c{i}_s WHERE gain >= {p['gamma']})""")
        out.append(f"""top{i} AS MATERIALIZED (
  SELECT * FROM a{i}_s s WHERE gain >= {p['gamma']} OR EXISTS (SELECT 1 FROM k{i} k WHERE k.seg = s.seg))""")
        out.append(f"""l{i} AS MATERIALIZED (
  SELECT x.seg, x.rid, CASE WHEN t.seg IS NULL THEN 1 WHEN s.seg IS NULL THEN b.node WHEN {go_left} THEN 2 * b.node ELSE 2 * b.node + 1 END AS node, x.g, x.h
  FROM g{i} x LEFT JOIN top{i} t ON t.seg = x.seg LEFT JOIN b{i} b ON b.seg = x.seg AND b.rid = x.rid
  LEFT JOIN k{i} s ON s.seg = x.seg AND s.node = b.node LEFT JOIN enc e ON e.seg = x.seg AND e.rid = x.rid AND e.f = s.f)""")
        total = "CAST(sum(g) AS DOUBLE) / {u}".format(u=UNIT)
        weight = "CAST(sum(h) AS DOUBLE) / {u}".format(u=UNIT)
        out.append(f"""v{i} AS MATERIALIZED (
  SELECT seg, node, {weight} AS cover,
         (0 - sign({total}) * greatest(abs({total}) - {p['reg_alpha']}, 0)) / ({weight} + {p['reg_lambda']}) * {p['learning_rate']} AS value
  FROM l{i} GROUP BY seg, node)""")
        out.append(f"""m{i + 1} AS MATERIALIZED (
  SELECT m.seg, m.rid, ld_mcs_id, y, w, m.m + v.value AS m FROM m{i} m JOIN l{i} l ON l.seg = m.seg AND l.rid = m.rid JOIN v{i} v ON v.seg = l.seg AND v.node = l.node)""")
    return out


def trees_select(rounds: int) -> str:
    parts = []
    for i in range(rounds):
        for s, t in ((f"top{i}", f"a{i}_t"), (f"k{i}", f"c{i}_t")):
            parts.append(f"""SELECT s.seg AS segment, {i} AS tree, s.node, s.feature, c.num AS cut, CASE WHEN s.is_num THEN NULL ELSE s.code END AS slot,
  CASE WHEN s.is_num THEN s.missing_left END AS missing_left, round(s.gain, 9) AS gain, round(CAST(s.ht AS DOUBLE) / {UNIT}, 9) AS cover, CAST(NULL AS DOUBLE) AS value
FROM {s} s LEFT JOIN cuts c ON s.is_num AND c.seg = s.seg AND c.f = s.f AND c.code = s.code""")
        parts.append(f"SELECT seg, {i}, node, NULL, NULL, NULL, NULL, NULL, round(cover, 9), round(value, 9) FROM v{i}")
    return "\nUNION ALL ".join(parts)


def scores_select(rounds: int) -> str:
    return f"SELECT ld_mcs_id, seg AS segmento, seg AS model_segment, round(1 / (1 + exp(-m)), 9) AS score FROM m{rounds}"
