"""DuckDB SQL of the queries that SQL can state whole."""
from __future__ import annotations

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, o.vec_id, CAST(list_inner_product(q.c, o.c) AS BIGINT) AS score
  FROM v q JOIN v o ON o.vec_id <> q.vec_id AND len(o.c) = len(q.c)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

_FEATURES = """
  SELECT {id} AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}"""

RESAMPLE = f"""
WITH tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
dw AS ({_FEATURES.format(id='doc_id', table='documents')}),
bw AS ({_FEATURES.format(id='item_id', table='benchmark')}),
runs AS (
  SELECT 'd' AS side, id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS r FROM dw
  UNION ALL
  SELECT 'b' AS side, id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS r FROM bw),
feats AS (SELECT side, id, unnest(r) AS f FROM runs),
known AS (
  SELECT f, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(CAST(len(hex(f)) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(hex(f), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM feats), tab),
hits AS (SELECT side, id, bucket FROM feats JOIN known USING (f)),
sums AS (SELECT bucket, count_if(side = 'd') AS s, count_if(side = 'b') AS t FROM hits GROUP BY bucket),
alls AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM sums),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM sums, alls),
worth AS (SELECT id, CAST(sum(g) AS BIGINT) AS g, count(*) AS n FROM hits JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, coalesce(n, 0) AS n_features, coalesce(len(w), 0) AS n_words,
         CASE WHEN n > 0 THEN (g - ((g % n) + n) % n) // n ELSE 0 END AS weight,
         CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) AS h
  FROM dw LEFT JOIN worth USING (id)),
summed AS (
  SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score FROM scored),
able AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM summed WHERE n_words >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r <= (25 * a.n) // 100 THEN r END AS rank, s.n_words
FROM summed s LEFT JOIN able a USING (doc_id)
"""


def _lloyd(rounds: int, k: int = 16, dim: int = 64) -> str:
    """Rounds written out one after the other; k * distance + number is least for the nearest centroid of the smallest number."""
    near = ("SELECT v.vec_id, v.r, v.c, min({k} * list_sum(list_transform(range(1, {dim} + 1), lambda i: (v.c[i] - m.c[i]) * (v.c[i] - m.c[i]))) + m.j) AS w "
            "FROM v, c{t} m GROUP BY v.vec_id, v.r, v.c")
    out = [f"""v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
           f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), vec_id, c) - 1 AS j, c FROM v QUALIFY j < {k})"""]
    for t in range(rounds + 1):
        out.append(f"a{t} AS MATERIALIZED (SELECT vec_id, c, w % {k} AS j, w // {k} AS d FROM ({near.format(k=k, dim=dim, t=t)}))")
        if t < rounds:
            out.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT m.j, coalesce(x.c, m.c) AS c FROM c{t} m LEFT JOIN (
    SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
    FROM (SELECT j, i, CAST(sum(c[i]) AS BIGINT) AS s, count(*) AS n FROM a{t}, range(1, {dim + 1}) g(i) GROUP BY j, i) GROUP BY j) x USING (j))""")
    return "WITH " + ",\n".join(out) + f"""
SELECT a.vec_id, CAST(a.j AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m ON m.j = a.j
"""


CLUSTERS = _lloyd(3)
