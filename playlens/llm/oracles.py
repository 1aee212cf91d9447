"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from playlens.llm.sharding import P1, P2, ROUNDS, round_keys

HAMMING_TOP_K = """
WITH e AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), d AS (
  SELECT q.vec_id AS query_id, e.vec_id,
    CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN (q.embedding[i] > 0) <> (e.embedding[i] > 0) THEN 1 ELSE 0 END)) AS INT) AS distance
  FROM e AS q, e WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INT) AS rank, vec_id, distance FROM d
)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""

_CRC = """
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(CAST(i AS BIGINT), [CAST(x AS BIGINT) FOR x IN range(8)]),
    lambda a, x: CASE WHEN a % 2 = 1 THEN xor(CAST(3988292384 AS BIGINT), a >> 1) ELSE a >> 1 END)) AS tab
), raw AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, string_split(hex(encode(coalesce(text, ''))), '') AS c FROM documents
), bytes AS (
  SELECT doc_id, CAST(n + 16 AS BIGINT) AS size, list_transform(range(n), lambda i: CAST(
    (instr('0123456789ABCDEF', c[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', c[2 * i + 2]) - 1 AS BIGINT)) AS b FROM raw
), keyed AS (
  SELECT doc_id, size, xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
    lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1]))) AS text_crc32 FROM bytes, crc
)"""


def feistel_shards(n_shards: int = 40, seed: int = 17) -> str:
    """The permutation step by step as a recursive query."""
    keys = ", ".join(f"({i}, CAST({a} AS BIGINT), CAST({b} AS BIGINT))" for i, (a, b) in enumerate(round_keys(seed)))
    mixed = "CASE WHEN w.i % 2 = 0 THEN w.r ELSE w.l END"
    t = f"(({mixed} * k.k1 + k.k2) % {P1})"
    return f"""
WITH RECURSIVE {_CRC}, numbered AS (
  SELECT *, row_number() OVER (ORDER BY substr(md5(concat_ws('|', doc_id, size, text_crc32)), 1, 3),
    doc_id NULLS FIRST, size, text_crc32) - 1 AS row_number FROM keyed
), dims AS (
  SELECT n, a, (n + a - 1) // a AS b FROM (SELECT n, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS a FROM (SELECT count(*) AS n FROM numbered))
), keys(i, k1, k2) AS (VALUES {keys}),
w AS (
  SELECT row_number, row_number // b AS l, row_number % b AS r, 0 AS i, n, a, b FROM numbered, dims
  UNION ALL
  SELECT w.row_number,
    CASE WHEN w.i % 2 = 0 AND w.i < {ROUNDS} THEN (w.l + {t} * {t} % {P2} % w.a) % w.a ELSE w.l END,
    CASE WHEN w.i % 2 = 1 AND w.i < {ROUNDS} THEN (w.r + {t} * {t} % {P2} % w.b) % w.b ELSE w.r END,
    CASE WHEN w.i < {ROUNDS} THEN w.i + 1 ELSE 0 END, w.n, w.a, w.b
  FROM w LEFT JOIN keys AS k ON k.i = w.i WHERE w.i < {ROUNDS} OR w.l * w.b + w.r >= w.n
), p AS (SELECT row_number, l * b + r AS p FROM w WHERE i = {ROUNDS} AND l * b + r < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {n_shards} AS INT) AS shard, p // {n_shards} AS slot,
  CAST(NULL AS INT) AS grown_shard, numbered.row_number
FROM numbered JOIN p USING (row_number)
"""


NEAR_DUPLICATES = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s
  FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items AS a JOIN items AS b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, least(doc_id, coalesce(m, doc_id)) = doc_id AS kept
FROM sets LEFT JOIN least ON least.a = sets.doc_id
"""


PHRASE_MINING = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents
), words AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m
), f AS (SELECT lang, phrase, m, count(*) AS f FROM grams GROUP BY lang, phrase, m HAVING count(*) >= 30),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
parts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS tail
  FROM c CROSS JOIN (SELECT unnest([1, 2, 3]) AS k) WHERE k < m
), cuts AS (
  SELECT p.lang, p.phrase, a, k, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * a) // (l.f::HUGEINT + r.f) AS BIGINT) AS score
  FROM parts AS p JOIN f AS l ON l.lang = p.lang AND l.phrase = head JOIN f AS r ON r.lang = p.lang AND r.phrase = tail
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, a, unnest(list_transform(range(1, m - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
  FROM c, (SELECT unnest([2, 3]) AS s) WHERE s < m
), longest AS (SELECT lang, phrase, max(a) AS b FROM inside GROUP BY lang, phrase),
kept AS (
  SELECT best.* FROM best LEFT JOIN longest USING (lang, phrase) WHERE b IS NULL OR 100::HUGEINT * b < 80::HUGEINT * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_hamming_top_k": HAMMING_TOP_K,
        "op2_feistel_shards": feistel_shards(),
        "op6_minhash_duplicates": NEAR_DUPLICATES,
        "op12_phrase_mining": PHRASE_MINING,
    }
