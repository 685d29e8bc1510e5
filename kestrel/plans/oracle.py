r"""DuckDB SQL for every query in ``kestrel.plans.queries`` (same names, same columns).

The SQL is written independently of the Spark plans: it follows the definitions in
shortcut in the Spark operators. Tables are the driver's views (``documents``, ...).
DuckDB notes: lists are 1-based, lambdas are written ``lambda x: ...``, regexp_replace needs 'g', ``\s`` lacks VT (write it out).
"""

from __future__ import annotations

# documents -> lines (one trailing empty piece dropped)
_LINES = r"""
doc_parts AS (
  SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS p FROM documents
),
doc_line_lists AS (
  SELECT doc_id, CASE WHEN p[-1] = '' THEN p[1:len(p) - 1] ELSE p END AS ls FROM doc_parts
),
lines AS (
  SELECT doc_id, unnest(ls) AS line FROM doc_line_lists
)"""

_BIGRAM_COUNTS = _LINES + r""",
segs AS (
  SELECT unnest(regexp_split_to_array(lower(line), '[.!?](?:[ \t\n\r\f]+|\z)')) AS seg FROM lines
),
seg_words AS (
  SELECT list_filter(
           list_transform(regexp_split_to_array(seg, '[ \t\n\r\f]+'),
                          lambda t: regexp_replace(t, '[^a-z0-9]', '', 'g')),
           lambda t: t <> '') AS w
  FROM segs
),
bigram_counts AS (
  SELECT bigram, CAST(count(*) AS BIGINT) AS n FROM (
    SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram
    FROM seg_words
  ) GROUP BY bigram
)"""

ORACLE: dict[str, str] = {}

ORACLE["text_lines"] = "WITH " + _LINES + r"""
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines FROM doc_line_lists"""

ORACLE["bigram_count"] = "WITH " + _BIGRAM_COUNTS + r"""
SELECT bigram, n FROM bigram_counts"""

ORACLE["bigram_top_k"] = "WITH " + _BIGRAM_COUNTS + r"""
SELECT n, bigram FROM bigram_counts
WHERE n IN (SELECT DISTINCT n FROM bigram_counts ORDER BY n DESC LIMIT 10)"""

_WORD_COUNT = "WITH " + _LINES + r""",
rt AS (
  SELECT line, regexp_replace(line, '[ \t\n\x0B\f\r]+\z', '') AS r FROM lines
),
wl AS (
  SELECT unnest(CASE WHEN line <> '' AND r = '' THEN []::VARCHAR[]
                     ELSE regexp_split_to_array(r, '[ \t\n\x0B\f\r]+') END) AS word
  FROM rt
)
SELECT word, CAST(count(*) AS BIGINT) AS n FROM wl GROUP BY word"""

ORACLE["word_count"] = _WORD_COUNT
ORACLE["write_pairs"] = _WORD_COUNT


# events -> ip_trace / raw_block lines, parsed back
_TRACE = r"""
trace_lines AS (
  SELECT replace(CAST(ts AS VARCHAR), ' ', 'T') || ' ' || CAST(event_id AS VARCHAR)
         || ' 10.0.' || CAST(user_id // 50 AS VARCHAR) || '.' || CAST(user_id % 50 AS VARCHAR)
         || '.' || CAST(1024 + event_id % 1000 AS VARCHAR)
         || ' > 192.168.' || CAST(event_id % 7 AS VARCHAR) || '.' || CAST(event_id % 50 AS VARCHAR)
         || '.80' AS value
  FROM events
),
trace_parts AS (SELECT string_split(value, ' ') AS f FROM trace_lines),
trace AS (
  SELECT f[1] AS tm, CAST(f[2] AS BIGINT) AS conn_id, f[3] AS src, f[5] AS dst FROM trace_parts
),
block_lines AS (
  SELECT CAST(event_id AS VARCHAR) || ' ' || CASE WHEN event_type = 'error' THEN 'Blocked' ELSE 'Allowed' END
         AS value
  FROM events
),
blocked AS (
  SELECT CAST(string_split(value, ' ')[1] AS BIGINT) AS conn_id, string_split(value, ' ')[2] AS action
  FROM block_lines WHERE contains(value, 'Blocked')
),
fw_log AS (
  SELECT t.tm, t.conn_id,
         regexp_replace(t.src, '[.][^.]*\z', '') AS src,
         regexp_replace(t.dst, '[.][^.]*\z', '') AS dst,
         b.action
  FROM trace t JOIN blocked b ON t.conn_id = b.conn_id
)"""

ORACLE["firewall_parse"] = "WITH " + _TRACE + r"""
SELECT tm, conn_id, src, dst FROM trace"""

ORACLE["strip_last_component"] = "WITH " + _TRACE + r"""
SELECT conn_id, regexp_replace(src, '[.][^.]*\z', '') AS src,
       regexp_replace(dst, '[.][^.]*\z', '') AS dst FROM trace"""

ORACLE["blocked_filter"] = "WITH " + _TRACE + r"""
SELECT conn_id, action FROM blocked"""

ORACLE["firewall_log"] = "WITH " + _TRACE + r"""
SELECT tm, conn_id, src, dst, action FROM fw_log"""

ORACLE["blocked_sources"] = "WITH " + _TRACE + r"""
SELECT src, CAST(count(*) AS BIGINT) AS n FROM fw_log GROUP BY src"""

# part -> 13-column comma lines -> repo rows
_REPOS = r"""
repo_lines AS (
  SELECT concat_ws(',', CAST(p_partkey AS VARCHAR), p_brand, p_name, p_type, CAST(p_size AS VARCHAR),
                   '', '', '', '', '', '', '', CAST(p_retailprice AS VARCHAR)) AS value
  FROM part
),
repos AS (
  SELECT string_split(value, ',')[1] AS name, string_split(value, ',')[2] AS grp,
         TRY_CAST(string_split(value, ',')[13] AS DOUBLE) AS score
  FROM repo_lines
)"""

ORACLE["csv_positional_project"] = "WITH " + _REPOS + r"""
SELECT name, grp, score FROM repos"""

ORACLE["group_total_join_back"] = r"""
SELECT p_partkey, p_brand, CAST(count(*) OVER (PARTITION BY p_brand) AS BIGINT) AS n FROM part"""

ORACLE["group_count_argmax"] = "WITH " + _REPOS + r"""
SELECT grp, CAST(count(*) AS BIGINT) AS n,
       first(name ORDER BY score DESC, name ASC) AS best_id,
       max(score) AS best_score
FROM repos GROUP BY grp"""

ORACLE["group_count_argmax_docs"] = r"""
SELECT lang AS grp, CAST(count(*) AS BIGINT) AS n,
       first(doc_id ORDER BY n_chars DESC, doc_id ASC) AS best_id,
       max(n_chars) AS best_score
FROM documents GROUP BY lang"""


# orders -> kv lines -> parsed pairs
_KV_SOURCE = r"""
kv_lines AS (
  SELECT md5(CAST(o_orderkey AS VARCHAR)) || chr(9) || CAST(o_orderkey AS VARCHAR) AS value FROM orders
),
kv AS (
  SELECT CASE WHEN strpos(value, chr(9)) > 0 THEN substr(value, 1, strpos(value, chr(9)) - 1) ELSE value END AS k,
         CASE WHEN strpos(value, chr(9)) > 0 THEN substr(value, strpos(value, chr(9)) + 1) ELSE '' END AS v
  FROM kv_lines
)"""

# documents -> every line as key, id and line number as value
_KV_SKEWED_SOURCE = _LINES + r""",
kv AS (
  SELECT line AS k, CAST(doc_id AS VARCHAR) || ':' || CAST(ln AS VARCHAR) AS v
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS ln FROM doc_line_lists)
)"""


def _hist(threshold: int) -> str:
    """First-char histogram over the md5 row sample (threshold out of 1,000,000)."""
    return r""",
hist AS (
  SELECT substr(k, 1, 1) AS ch, CAST(count(*) AS BIGINT) AS n FROM kv
  WHERE ('0x' || substr(md5(k || chr(9) || v), 1, 8))::BIGINT % 1000000 < """ + str(threshold) + r"""
  GROUP BY 1
)"""


# Equi-depth ranges as the literal running fold (recursive), independent of the closed form.
_FOLD = r""",
hrows AS (SELECT ch, n, row_number() OVER (ORDER BY ch) AS i FROM hist),
params AS (SELECT sum(n) // 10 AS step FROM hist),
fold AS (
  SELECT 0 AS i, CAST(0 AS BIGINT) AS cnt, 0 AS closed, 0 AS prev, CAST(NULL AS VARCHAR) AS ch,
         CAST(0 AS BIGINT) AS n
  UNION ALL
  SELECT h.i,
         CASE WHEN f.cnt + h.n >= (SELECT step FROM params) AND f.closed < 10
              THEN f.cnt + h.n - (SELECT step FROM params) ELSE f.cnt + h.n END,
         CASE WHEN f.cnt + h.n >= (SELECT step FROM params) AND f.closed < 10 THEN f.closed + 1 ELSE f.closed END,
         f.closed, h.ch, h.n
  FROM fold f JOIN hrows h ON h.i = f.i + 1
),
chars AS (
  SELECT ch, n, prev, prev < (SELECT max(closed) FROM fold) AS is_closed,
         CASE WHEN prev < (SELECT max(closed) FROM fold) THEN prev ELSE 9 END AS bucket
  FROM fold WHERE i > 0
),
bounds AS (
  SELECT CAST(bucket AS INTEGER) AS bucket, min(ch) AS lo, max(ch) AS hi, CAST(sum(n) AS BIGINT) AS n,
         bool_or(is_closed) AS closed
  FROM chars GROUP BY bucket
),
tagged AS (
  SELECT k, v, CAST(coalesce((SELECT min(b.bucket) FROM bounds b WHERE b.closed AND b.hi >= substr(kv.k, 1, 1)), 9)
                    AS INTEGER) AS bucket
  FROM kv
)"""

_KV = _KV_SOURCE + _hist(20000)
_BOUNDS = _KV + _FOLD

ORACLE["kv_tab_parse"] = "WITH " + _KV + r"""
SELECT k, v FROM kv"""

ORACLE["kv_ws_parse"] = r"""
WITH lines AS (SELECT md5(CAST(o_orderkey AS VARCHAR)) || ' ' || CAST(o_orderkey AS VARCHAR) AS value FROM orders)
SELECT regexp_split_to_array(value, '[ \t\n\x0B\f\r]+')[1] AS k,
       regexp_split_to_array(value, '[ \t\n\x0B\f\r]+')[2] AS v
FROM lines"""

ORACLE["total_order_sort"] = "WITH " + _KV + r"""
SELECT k, v, CAST(row_number() OVER (ORDER BY k, v) AS BIGINT) AS pos FROM kv"""

ORACLE["first_char_histogram"] = "WITH " + _KV + r"""
SELECT ch, n FROM hist"""

ORACLE["equi_depth_boundaries"] = "WITH RECURSIVE " + _BOUNDS + r"""
SELECT bucket, lo, hi, n, closed FROM bounds"""

ORACLE["range_bucket_assign"] = "WITH RECURSIVE " + _BOUNDS + r"""
SELECT bucket, CAST(count(*) AS BIGINT) AS n, min(k) AS min_k, max(k) AS max_k FROM tagged GROUP BY bucket"""

ORACLE["custom_range_sort"] = "WITH RECURSIVE " + _BOUNDS + r"""
SELECT k, v, bucket, CAST(row_number() OVER (PARTITION BY bucket ORDER BY k, v) AS BIGINT) AS pos_in_bucket
FROM tagged"""

ORACLE["skewed_range_sort"] = "WITH RECURSIVE " + _KV_SKEWED_SOURCE + _hist(250000) + _FOLD + r"""
SELECT k, v, bucket, CAST(row_number() OVER (PARTITION BY bucket ORDER BY k, v) AS BIGINT) AS pos_in_bucket
FROM tagged"""

# lineitem x orders -> "part customer" lines -> canonical edges
_EDGES = r"""
edge_lines AS (
  SELECT CAST(l.l_partkey AS VARCHAR) || ' ' || CAST(o.o_custkey AS VARCHAR) AS value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
edge_pairs AS (
  SELECT CAST(regexp_split_to_array(value, '[ \t\n\x0B\f\r]+')[1] AS BIGINT) AS s,
         CAST(regexp_split_to_array(value, '[ \t\n\x0B\f\r]+')[2] AS BIGINT) AS d
  FROM edge_lines WHERE regexp_replace(value, '[ \t\n\x0B\f\r]', '', 'g') <> ''
),
e AS (SELECT DISTINCT least(s, d) AS src, greatest(s, d) AS dst FROM edge_pairs WHERE s <> d),
sym AS (SELECT src AS v, dst AS u FROM e UNION ALL SELECT dst AS v, src AS u FROM e),
tri AS (
  SELECT e1.src AS a, e1.dst AS b, e2.dst AS c
  FROM e e1 JOIN e e2 ON e1.dst = e2.src JOIN e e3 ON e3.src = e1.src AND e3.dst = e2.dst
)"""

ORACLE["edge_list"] = "WITH " + _EDGES + r"""
SELECT src, dst FROM e"""

ORACLE["edge_symmetrize"] = "WITH " + _EDGES + r"""
SELECT v, u FROM sym"""

ORACLE["adjacency"] = "WITH " + _EDGES + r""",
ranked AS (
  SELECT v, u, row_number() OVER (PARTITION BY v ORDER BY u) AS rk, count(*) OVER (PARTITION BY v) AS degree
  FROM sym
)
SELECT v, CAST(degree AS BIGINT) AS degree, CAST((rk - 1) // 64 AS BIGINT) AS chunk,
       array_to_string(list(u ORDER BY u), ' ') AS neighbours
FROM ranked GROUP BY v, degree, (rk - 1) // 64"""

# Brute force, as the reference does it: every wedge, counted per sorted triple.
ORACLE["wedge_closure_histogram"] = "WITH " + _EDGES + r""",
wedges AS (SELECT x.u AS p, x.v AS m, y.u AS q FROM sym x JOIN sym y ON x.v = y.v AND x.u < y.u),
triples AS (SELECT list_sort([p, m, q]) AS t, count(*) AS c FROM wedges GROUP BY 1)
SELECT CAST(c AS BIGINT) AS wedges, CAST(count(*) AS BIGINT) AS n_triples FROM triples GROUP BY c"""

ORACLE["triangles"] = "WITH " + _EDGES + r"""
SELECT a, b, c FROM tri"""

ORACLE["triangle_count"] = "WITH " + _EDGES + r"""
SELECT 'Total Triangles: ' || CAST(count(*) AS VARCHAR) AS label, CAST(count(*) AS BIGINT) AS n FROM tri"""

ORACLE["range_xor_checksum"] = r"""
WITH b AS (
  SELECT doc_id, substr(hex(encode(text)), 21, 200) AS h FROM documents WHERE octet_length(encode(text)) > 10
)
SELECT doc_id,
       CAST(list_reduce(list_transform(range(0, length(h) // 2),
                                       lambda i: ('0x' || substr(h, 2 * i + 1, 2))::INTEGER),
                        lambda a, x: xor(a, x)) AS BIGINT) AS checksum
FROM b"""

# The jobs: what their output files hold.
ORACLE["job_word_count"] = _WORD_COUNT
ORACLE["job_bigrams"] = ORACLE["bigram_top_k"]
ORACLE["job_firewall_log"] = ORACLE["firewall_log"]
ORACLE["job_firewall_sources"] = ORACLE["blocked_sources"]
ORACLE["job_histogram_sort"] = ORACLE["kv_tab_parse"]
ORACLE["stage_parquet"] = _WORD_COUNT.replace("SELECT word, CAST(count(*) AS BIGINT) AS n FROM wl",
                                              "SELECT word, CAST(count(*) AS BIGINT) AS n, true AS few_files FROM wl")
ORACLE["job_sampled_sort"] = r"""
WITH kv AS (SELECT md5(CAST(o_orderkey AS VARCHAR)) AS k, CAST(o_orderkey AS VARCHAR) AS v FROM orders)
SELECT k, v FROM kv WHERE v NOT LIKE '%3'
UNION ALL SELECT NULL, CAST(count(*) AS VARCHAR) FROM kv WHERE v LIKE '%3'"""

_ODD_REPOS = r"""
repos AS (
  SELECT CAST(p_partkey AS VARCHAR) AS name, p_brand AS grp,
         CASE WHEN p_size <= 5 OR p_size > 45 THEN NULL ELSE CAST(p_retailprice AS DOUBLE) END AS score
  FROM part
)"""
ORACLE["csv_malformed_scores"] = "WITH " + _ODD_REPOS + r"""
SELECT grp, CAST(count(*) AS BIGINT) AS n, arg_min(name, name) FILTER (WHERE score = top) AS best_id, max(score) AS best_score
FROM (SELECT *, max(score) OVER (PARTITION BY grp) AS top FROM repos) GROUP BY grp"""
ORACLE["job_top_repo"] = ORACLE["csv_malformed_scores"]
ORACLE["group_total_null_group"] = r"""
SELECT p_partkey, grp, CAST(count(*) OVER (PARTITION BY grp) AS BIGINT) AS n
FROM (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_brand END AS grp FROM part)"""

# Files of 300 ids, joined line by line; everything in them is ASCII, so characters are bytes.
_SHARDS = r"""
files AS (
  SELECT doc_id // 300 AS shard,
         string_agg(CAST(doc_id AS VARCHAR) || chr(9) || coalesce(source, '-') || chr(9) || coalesce(lang, '-') || chr(9)
                    || coalesce(CAST(n_chars AS VARCHAR), '-') || chr(10), '' ORDER BY doc_id) AS body
  FROM documents WHERE doc_id IS NOT NULL GROUP BY 1
),
ranges AS (SELECT shard, substr(body, 1001, 3500) AS part FROM files WHERE length(body) > 1000)"""
ORACLE["byte_ranges"] = "WITH " + _SHARDS + r""",
pieces AS (SELECT shard, part, unnest(range(0, length(part), 1024)) AS pos FROM ranges)
SELECT shard, CAST(1000 + pos AS BIGINT) AS "offset", CAST(length(substr(part, pos + 1, 1024)) AS BIGINT) AS n_bytes,
       md5(substr(part, pos + 1, 1024)) AS md5
FROM pieces"""
ORACLE["job_xor_checksum"] = "WITH " + _SHARDS + r"""
SELECT shard, CAST(list_reduce(list_transform(string_split(part, ''), lambda c: ascii(c)), lambda a, x: xor(a, x)) AS BIGINT) AS checksum
FROM ranges"""
ORACLE["job_triangles"] = "WITH " + _EDGES + r"""
SELECT 'Total Triangles: ' || CAST(count(*) AS VARCHAR) AS label FROM tri"""
ORACLE["bounded_sample"] = "WITH " + _KV_SOURCE + r"""
SELECT k, v FROM kv WHERE ('0x' || substr(md5(k || chr(9) || v), 1, 8))::BIGINT % 1000000 < 100000
ORDER BY md5(k || chr(9) || v), k, v LIMIT 10000"""

# The fold over four-character prefixes of every line.
_LONG = _KV_SKEWED_SOURCE + r""",
hist AS (SELECT substr(k, 1, 4) AS ch, CAST(count(*) AS BIGINT) AS n FROM kv GROUP BY 1)""" + _FOLD.replace("substr(kv.k, 1, 1)", "substr(kv.k, 1, 4)")
ORACLE["long_prefix_boundaries"] = "WITH RECURSIVE " + _LONG + r"""
SELECT bucket, lo, hi, n, closed FROM bounds"""
ORACLE["long_prefix_buckets"] = "WITH RECURSIVE " + _LONG + r"""
SELECT bucket, CAST(count(*) AS BIGINT) AS n, min(k) AS min_k, max(k) AS max_k FROM tagged GROUP BY bucket"""
