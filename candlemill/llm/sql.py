"""DuckDB SQL of the spelling and prefix-trie queries, over the same tables."""

from __future__ import annotations

CRC = """
crc_table AS (
  SELECT list(v ORDER BY b) AS crc FROM (
    SELECT b, list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda a, x: xor(a >> 1, (a & 1) * 3988292384)) AS v FROM range(256) t(b)))"""


def crc32_of(text):
    """CRC-32 of a text's UTF-8 bytes, with the table at hand as ``crc``."""
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(strlen({text})),
      lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))),
      lambda a, x: xor(a >> 8, crc[CAST(xor(a, x) & 255 AS INTEGER) + 1])), 4294967295)"""


TRIE = f"""WITH {CRC},
said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS turns FROM said GROUP BY conv_id),
heads AS (
  SELECT conv_id, turns, CAST({crc32_of('CAST(conv_id AS VARCHAR)')} % 4 AS INTEGER) AS h FROM own, crc_table),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS turns
  FROM heads o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
members AS (
  SELECT conv_id, len(turns) AS size, d AS depth, turns[1:d] AS path FROM rebuilt, range(1000000) t(d)
  WHERE d <= len(turns)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), ''))
      AS ends_sha256,
    CASE WHEN depth > 0 THEN len(regexp_extract_all(path[depth].text, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS words
  FROM members GROUP BY path, depth),
named AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1])
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, n.parent_conv_id, n.n_convs, n.n_children,
  count(*) FILTER (b.n_children = 0) AS n_leaves,
  CAST(sum((b.n_convs - 1) * b.words) AS BIGINT) AS saved_tokens, n.ends_sha256
FROM named n JOIN named b ON b.depth >= n.depth AND b.path[1:n.depth] = n.path
GROUP BY ALL
"""

SPELLING = f"""WITH RECURSIVE {CRC},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
lowered AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs
  WHERE length(run) >= 7),
hashed AS (
  SELECT run, {crc32_of("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM lowered, crc_table),
spoiled AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
    || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM hashed),
words AS (
  SELECT word, count(*) AS n FROM spoiled WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS (
  SELECT word, i, substr(word, 1, i - 1) AS front, substr(word, i + 1) AS back
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word AS one, b.word AS other FROM cut a JOIN cut b USING (i, front, back) WHERE a.word <> b.word
  UNION SELECT word, front || back FROM cut WHERE front || back IN (SELECT word FROM words)
  UNION SELECT front || back, word FROM cut WHERE front || back IN (SELECT word FROM words)),
near AS (
  SELECT one, count(*) AS n_near, first(other ORDER BY w.n DESC, other) AS best, max(w.n) AS best_n
  FROM pairs JOIN words w ON w.word = other GROUP BY one),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
    CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near ON one = word),
followed AS (
  SELECT word, word AS root FROM judged
  UNION SELECT f.word, j.form FROM followed f JOIN judged j ON j.word = f.root WHERE j.form IS NOT NULL)
SELECT j.word, j.form, f.root, j.n, j.n_near, j.form_n
FROM judged j JOIN followed f USING (word) JOIN judged e ON e.word = f.root WHERE e.form IS NULL
"""
