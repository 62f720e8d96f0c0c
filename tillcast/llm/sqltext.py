"""DuckDB SQL for the later operators: checksums by nibbles, shards, spelling variants, periodic runs."""

from __future__ import annotations

from tillcast.llm import periodic, sharding, spelling

#: The reversed polynomial of CRC-32 (fixed value).
POLYNOMIAL = 0xEDB88320


def _nibble_table() -> list[int]:
    table = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (POLYNOMIAL if c & 1 else 0)
        table.append(c)
    return table


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8, byte by byte, the lower four bits of each first."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST(concat('0x', x) AS BIGINT))"
    table = "[" + ", ".join(f"{c}::BIGINT" for c in _nibble_table()) + "]"
    low = f"xor(c >> 4, {table}[(xor(c, d) & 15) + 1])"
    both = f"xor({low} >> 4, {table}[(xor({low}, d >> 4) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, d: {both}), 4294967295::BIGINT)"


def shards(number: int) -> str:
    return f"""
WITH sized AS (
  SELECT doc_id, coalesce(strlen(text), 0) + {sharding.ROW_BYTES} AS size, {crc32("coalesce(text, '')")} AS text_crc32 FROM documents
), placed AS (
  SELECT *, least({number - 1}, ((2 * (sum(size) OVER (ORDER BY doc_id) - size) + size) * {number}) // greatest(1, 2 * sum(size) OVER ())) AS shard
  FROM sized
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_RUN = r"[a-z\x{C0}-\x{FF}]+"

SPELLING = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_RUN}')) AS run FROM documents
), hashed AS (
  SELECT run, c, {crc32("key")} AS h FROM (
    SELECT run, count(*) AS c, concat(doc_id, ':', run) AS key FROM found WHERE length(run) >= {spelling.LEAST_LETTERS} GROUP BY doc_id, run)
), kept AS (
  SELECT c, CASE WHEN h % {spelling.LOSS} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM kept WHERE length(word) >= {spelling.LEAST_LETTERS} GROUP BY word HAVING sum(c) >= {spelling.LEAST_COUNT}
), cut AS MATERIALIZED (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), links AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS most, arg_min(near, (-n, near)) AS near FROM links GROUP BY word
), formed AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {spelling.RATIO} * words.n THEN near END AS form,
         CASE WHEN most >= {spelling.RATIO} * words.n THEN most END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word
), path AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL
  SELECT path.word, formed.form, steps + 1 FROM path JOIN formed ON formed.word = path.root WHERE formed.form IS NOT NULL
)
SELECT formed.word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, arg_max(root, steps) AS root FROM path GROUP BY word) roots ON roots.word = formed.word
"""

PERIODIC = rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS given, {crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents
), dealt AS (
  SELECT doc_id, given, len(given) AS n, h, (h // 10) % greatest(len(given), 1) AS a, h // 10 AS g FROM texts
), words AS MATERIALIZED (
  SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN given[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] ELSE given[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM dealt)
), pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
), long AS MATERIALIZED (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS length FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest({periodic.LEAST_WORDS}, {periodic.LEAST_PERIODS} * q)
), runs AS MATERIALIZED (
  SELECT * FROM long WHERE NOT EXISTS (
    SELECT 1 FROM long o WHERE o.doc_id = long.doc_id AND o.q < long.q AND o.s <= long.s AND o.s + o.length >= long.s + long.length)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(s, ',', length, ',', q, chr(10)), '' ORDER BY s, q) AS listing,
         arg_min([s, length, q], (-CAST(length AS DOUBLE) / q, s, q)) AS best
  FROM runs GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period, 1000 * best[2] // best[3] AS exponent_milli,
       sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM dealt LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
