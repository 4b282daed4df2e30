"""DuckDB SQL of the queries that SQL can express."""

OP3 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT rid, p, array_to_string(w[p:p+4], ' ') AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)),
twice AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, k) AS c FROM windows) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + 5)) AS q FROM twice) GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n, count(DISTINCT l) AS u
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
commonest AS (
  SELECT rid, max(c) AS n FROM (SELECT rid, x, count(*) AS c FROM (SELECT rid, unnest(w) AS x FROM d) GROUP BY rid, x) GROUP BY rid),
base AS (
  SELECT d.rid, doc_id, t, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n - lines.u, 0) AS BIGINT) AS n_dup_lines, coalesce(lines.n, 0) AS n_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, coalesce(commonest.n, 0) AS n_common
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN commonest USING (rid)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
         OR 10 * n_symbols > n_words
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words
         OR 10 * n_dup_lines > 3 * n_lines
         OR 10 * length(regexp_replace(t, '[^!]+', '', 'g')) > 3 * n_words
         OR 10 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 6 * word_chars
         OR 10 * length(regexp_replace(t, '[^0-9]+', '', 'g')) > 5 * word_chars
         OR 10 * n_common > 5 * n_words) AS kept
FROM judged
"""

OP9 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, coalesce('s' || source, 'null') AS site, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, site, p, ls[p] AS line FROM (SELECT rid, doc_id, site, ls, unnest(range(1, len(ls) + 1)) AS p FROM d)),
worded AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
least_sites AS (SELECT greatest(2, ceil(0.5 * count(DISTINCT site))) AS n FROM d),
wide AS (SELECT line FROM worded GROUP BY line HAVING count(DISTINCT site) >= (SELECT n FROM least_sites)),
placed AS (SELECT rid, p, rank() OVER (PARTITION BY line ORDER BY doc_id NULLS LAST, p) AS place FROM worded JOIN wide USING (line)),
gone AS (SELECT rid, p FROM placed WHERE place > 1),
kept AS (
  SELECT l.rid, string_agg(l.line, chr(10) ORDER BY l.p) AS t
  FROM l LEFT JOIN gone ON l.rid = gone.rid AND l.p = gone.p WHERE gone.p IS NULL GROUP BY l.rid)
SELECT d.doc_id, CAST((SELECT count(*) FROM worded w WHERE w.rid = d.rid) AS BIGINT) AS n_lines,
       CAST((SELECT count(*) FROM gone g WHERE g.rid = d.rid) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(kept.t, '')) END AS kept_sha256
FROM d LEFT JOIN kept ON d.rid = kept.rid
"""

#: The table of crc32 as SQL, and the sum of a list of bytes by it.
_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_concat([CAST(i AS UBIGINT)], CAST(range(8) AS UBIGINT[])), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, CAST(3988292384 AS UBIGINT)) ELSE a >> 1 END) AS v
    FROM range(256) r(i)))"""


def _crc32(codes: str) -> str:
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], {codes}), lambda a, b: xor(tab[CAST(xor(a, b) % 256 + 1 AS INTEGER)], a >> 8)), CAST(4294967295 AS UBIGINT))"


OP11 = f"""
WITH {_CRC_TABLE},
own AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS k, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, base, CAST({_crc32("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS UBIGINT))")} % 6 AS BIGINT) AS h
  FROM (SELECT DISTINCT conv_id, base FROM own), crc_table),
turns AS (
  SELECT c.conv_id, 0 AS part, o.pos, k, size FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, o.pos, k, size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
starts AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(k, '/') OVER w AS key, size FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
whole AS (SELECT conv_id, max(depth) AS last FROM starts GROUP BY conv_id),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last = depth), '') AS ends,
         CASE WHEN depth > 1 THEN left(key, length(key) - 129) WHEN depth = 1 THEN '' END AS parent
  FROM starts JOIN whole USING (conv_id) GROUP BY key, depth),
kids AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT top.key, count(*) FILTER (WHERE kids.n IS NULL) AS leaves, sum((low.n - 1) * low.size) AS saved
  FROM nodes top JOIN nodes low ON low.depth >= top.depth AND starts_with(low.key, top.key) LEFT JOIN kids ON kids.parent = low.key GROUP BY top.key)
SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(kids.n, 0) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v JOIN below USING (key) LEFT JOIN nodes up ON up.key = v.parent LEFT JOIN kids ON kids.parent = v.key
"""
OP12 = f"""
WITH {_CRC_TABLE},
texts AS (
  SELECT 0 AS kind, row_number() OVER () AS rid, doc_id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
worded AS (
  SELECT kind, rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
runs AS (SELECT kind, rid, array_to_string(w[p:p + n - 1], ' ') AS f FROM (SELECT kind, rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM worded, range(1, 4) r(n))),
counts AS (SELECT kind, rid, f, count(*) AS c FROM runs GROUP BY ALL),
hexed AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM counts)),
codes AS (
  SELECT f, list_transform(range(1, length(x), 2), lambda i: CAST(16 * strpos('123456789ABCDEF', x[i]) + strpos('123456789ABCDEF', x[i + 1]) AS UBIGINT)) AS b FROM hexed),
bucketed AS (SELECT f, CAST({_crc32("b")} % 10000 AS BIGINT) AS bucket FROM codes, crc_table),
hits AS (SELECT kind, rid, bucket, sum(c) AS c FROM counts JOIN bucketed USING (f) GROUP BY ALL),
each AS (SELECT bucket, coalesce(sum(c) FILTER (WHERE kind = 0), 0) AS s, coalesce(sum(c) FILTER (WHERE kind = 1), 0) AS t FROM hits GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * ((SELECT CAST(sum(s) AS DOUBLE) FROM each) + 10000) / ((CAST(s AS DOUBLE) + 1) * ((SELECT CAST(sum(t) AS DOUBLE) FROM each) + 10000)))) AS BIGINT) AS g FROM each),
weights AS (SELECT rid, sum(c) AS n, sum(c * g) AS weight FROM hits JOIN gains USING (bucket) WHERE kind = 0 GROUP BY rid),
scores AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST(CAST('0x' || left(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM worded LEFT JOIN weights USING (rid) WHERE kind = 0),
ranked AS (SELECT *, n_words >= 20 AS may, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS r, count(*) OVER (PARTITION BY n_words >= 20) AS m FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND r <= 5 * m // 100 THEN r END AS rank FROM ranked
"""

ORACLE_SQL = {"op3_quality_rules": OP3, "op9_line_dedup": OP9, "op11_prefix_trie": OP11, "op12_resampling": OP12}
