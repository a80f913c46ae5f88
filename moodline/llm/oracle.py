"""The queries of this package as DuckDB SQL, where SQL expresses them."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '{WORD}') AS ws FROM documents
), s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i : i + 2], ' ') FOR i IN range(1, len(ws) - 1)] END)) AS sh FROM w
), c AS (
  SELECT sh, min(doc_id) AS rep, count(*) AS n_class FROM s WHERE len(sh) > 0 GROUP BY sh
), g AS (
  SELECT rep, len(sh) AS n, unnest(sh) AS g FROM c
), l AS (
  SELECT a.rep AS x, b.rep AS y FROM g a JOIN g b ON a.g = b.g AND a.rep <> b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT rep AS node, rep AS here FROM c UNION SELECT reach.node, l.y FROM reach JOIN l ON reach.here = l.x
), m AS (
  SELECT node, min(here) AS component FROM reach GROUP BY node
)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(m.component, s.doc_id) AS component_id,
  coalesce(c.n_class, 1) AS n_class
FROM s LEFT JOIN c ON len(s.sh) > 0 AND s.sh = c.sh LEFT JOIN m ON m.node = c.rep
"""

# One row per document: the measurements and failure bits of the quality rules.
LEDGER = rf"""
w AS (
  SELECT *, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS k FROM w, unnest(range(1, len(ws) - 3)) AS r(i)
), dup AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM dup, unnest(range(i, i + 5)) AS u(p) GROUP BY doc_id
), measured AS (
  SELECT w.* EXCLUDE (ws, ls), CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_capitals
  FROM w LEFT JOIN cov USING (doc_id)
), ledger AS (
  SELECT *, CAST(
    CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 8 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END
    + CASE WHEN 10 * n_capitals > 6 * word_chars THEN 32 ELSE 0 END AS BIGINT) AS failed
  FROM measured
)
"""

OP3 = f"""
WITH {LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
  failed = 0 AS kept, failed
FROM ledger
"""


def chunk_sql(source: str) -> str:
    """Line chunks of ``source (doc_id, text)``: which rows of ``chunk`` are later copies."""
    return rf"""
ln AS (
  SELECT doc_id, text, i, x, CAST('0x' || md5(x)[1:8] AS BIGINT) AS h, len(regexp_extract_all(x, '{WORD}')) AS n
  FROM (SELECT doc_id, text, generate_subscripts(xs, 1) AS i, unnest(xs) AS x
        FROM (SELECT doc_id, text, string_split(text, chr(10)) AS xs FROM {source} WHERE text <> ''))
), cut AS (
  SELECT *, ((h * 31 + coalesce(lag(h) OVER d, 0)) % 3 = 0) OR n >= 50 OR coalesce(lead(n) OVER d, 50) >= 50 AS ends
  FROM ln WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM cut
), chunk AS (
  SELECT doc_id, c, string_agg(x, chr(10) ORDER BY i) AS body,
    count(*) FILTER (n > 0) >= 2 OR max(n) >= 50 AS counts
  FROM numbered GROUP BY doc_id, c
), marked AS (
  SELECT *, counts AND row_number() OVER (PARTITION BY counts, body ORDER BY doc_id, c) > 1 AS gone FROM chunk
), rebuilt AS (
  SELECT doc_id, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed,
    coalesce(string_agg(body, chr(10) ORDER BY c) FILTER (NOT gone), '') AS new_text
  FROM marked GROUP BY doc_id
)"""


# Runs of filled lines each neighbouring pair of which has been seen before, and the chunks.
OP8 = f"""
WITH {chunk_sql("documents")}, pair AS (
  SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY doc_id, i) > 1 AS later FROM (
    SELECT doc_id, i, x, n, row_number() OVER d AS j, lead(i) OVER d AS i_next, lead(x) OVER d AS y, lead(n) OVER d AS n_next
    FROM ln WHERE n > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY i)
  ) WHERE y IS NOT NULL
), run AS (
  SELECT doc_id, min(i) AS a, max(i_next) AS b, sum(n) + arg_max(n_next, j) AS n_words
  FROM (SELECT *, j - row_number() OVER (PARTITION BY doc_id ORDER BY j) AS island FROM pair WHERE later)
  GROUP BY doc_id, island
), dropped AS (
  SELECT doc_id, unnest(range(a, b + 1)) AS i FROM run WHERE n_words > 50
  UNION SELECT doc_id, i FROM numbered JOIN marked USING (doc_id, c) WHERE gone
), left_over AS (
  SELECT doc_id, bool_or(dropped.i IS NOT NULL) AS changed, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (dropped.i IS NULL), '') AS new_text
  FROM ln LEFT JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(r.n_removed, 0) AS n_removed, CASE WHEN l.changed THEN l.new_text ELSE d.text END AS text
FROM documents d LEFT JOIN rebuilt r USING (doc_id) LEFT JOIN left_over l USING (doc_id)
"""

OP11 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), g AS (
  SELECT *, count(*) OVER (PARTITION BY body) AS group_size,
    first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""

ORACLE_SQL = {"op1_ngram_join": OP1, "op3_quality_rules": OP3, "op8_line_dedup": OP8, "op11_block_naming": OP11}
