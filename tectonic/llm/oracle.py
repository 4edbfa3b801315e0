"""DuckDB SQL for the queries that SQL can express. Each computes its rows directly (all pairs,
all windows), independent of the operators' methods. The learned operators (op1, op8), packing
(op4) and byte-level BPE (op5) have none; nor has op9, whose byte windows are too many for SQL:
they are tested against brute force, round trips and held-out accuracy."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"

_COMPONENTS = """
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, r) AS (
  SELECT {id}, {id} FROM {table}
  UNION
  SELECT reach.id, edges.b FROM reach JOIN edges ON reach.r = edges.a),
component AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
"""



def _centroid_sql(k: int = 40, rounds: int = 5) -> str:
    """Every round spelled out: all distances, the nearest centroid, floored means."""
    parts = ["""ints AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", f"""
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v FROM ints
  QUALIFY cluster < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
  SELECT id, vec_id, p.v, cluster,
    list_sum(list_transform(range(1, 65), lambda i: (p.v[i] - c.v[i]) * (p.v[i] - c.v[i]))) AS distance
  FROM ints p CROSS JOIN c{r} c
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, cluster) = 1)""")
        if r < rounds:
            parts.append(f"""
m{r} AS MATERIALIZED (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
      SELECT cluster, unnest(v) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY cluster, i) GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (cluster))""")
    return "WITH " + ",".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (cluster)
"""


# CRC-32 of a number's decimal text: one step a byte, eight shifts a step.
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], list_transform(range(8), lambda i: CAST(0 AS BIGINT))),
    lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""


SQL = {
    "op2_similarity_sketch": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all({_LOWER}, {_WORD}) END AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, any_value(p.n) AS na, any_value(q.n) AS nb, count(*) AS c
  FROM shingles p JOIN shingles q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE c * 100 >= 80 * (na + nb - c)),
{_COMPONENTS.format(id="doc_id", table="documents")}
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN component c ON c.id = s.doc_id
""",
    "op3_difference_cover": f"""
WITH words AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, {_WORD}) END AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
earliest AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j
  FROM windows JOIN earliest USING (h) WHERE first_id < doc_id),
lost AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE
    list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(js, j)), lambda j: w[j]) END, ' '))
    AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id)
""",
    "op6_hyperplane_dedup": f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.label = q.label AND p.vec_id < q.vec_id
  WHERE list_dot_product(p.e, q.e) >= 0.93 * sqrt(list_dot_product(p.e, p.e)) * sqrt(list_dot_product(q.e, q.e))),
{_COMPONENTS.format(id="vec_id", table="embeddings")},
degree AS (SELECT a AS id, count(*) AS n FROM edges GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.id = e.vec_id LEFT JOIN degree d ON d.id = e.vec_id
""",
    "op7_norm_sorted_search": """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 5
""",
    "op10_chat_round_trip": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn), '')) AS loss_sha256,
  CAST(sum(12 + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 10 + 1) AS BIGINT)
    AS formatted_chars
FROM rows GROUP BY conv_id
""",
    "op11_laesa_centroids": _centroid_sql(),
    "op13_double_array_prefixes": f"""
WITH turns AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, s, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM turns),
built AS (
  SELECT a.conv_id, list_concat(coalesce(b.s[1:a.h], []), a.s[a.h + 1:]) AS s
  FROM heads a LEFT JOIN turns b ON b.conv_id = a.base),
places AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM built),
nodes AS (
  SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN d = 0 THEN 0 ELSE strlen(any_value(s[d].t)) END AS bytes,
    coalesce(string_agg(CASE WHEN len(s) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
  FROM places GROUP BY 1, 2),
children AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (p, d)),
above AS (SELECT p[1:u] AS p, u AS d, n_children, n_convs, bytes FROM (
  SELECT *, unnest(range(0, d + 1)) AS u FROM full_nodes)),
sums AS (
  SELECT p, d, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves,
    CAST(sum((n_convs - 1) * bytes) AS BIGINT) AS saved_tokens FROM above GROUP BY 1, 2)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
  sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN sums USING (p, d) LEFT JOIN nodes q ON q.d = f.d - 1 AND q.p = f.p[1:f.d - 1]
""",
}
