"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

# One pass per source without buckets, row by row, copies one after the other; the water level is
# found as in the text of the contract.
MIXING = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (length(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', '', 'g')) + 1) / (length(coalesce(text, '')) + 1) AS weight,
    coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS drawn,
    (('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
k AS (SELECT *, -ln(u) / weight AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS total FROM k GROUP BY source),
r AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM s),
c AS (SELECT *, total * 3 AS cap, (total * 3) / w AS ratio FROM r),
l AS (SELECT *, (sum(total) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / sum(w) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
f AS (SELECT arg_min(level, ratio) AS level FROM l WHERE ratio > level),
g AS (SELECT l.source, l.total, coalesce(least(l.cap::DOUBLE, f.level * l.w), l.cap::DOUBLE) AS target FROM l LEFT JOIN f ON true),
e AS (SELECT *, CASE WHEN total > 0 THEN floor(target / total)::BIGINT ELSE 0 END AS epochs FROM g),
p AS (SELECT k.*, e.total, e.target, e.epochs, e.target - e.epochs * e.total AS rest,
        sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.drawn, k.size ROWS UNBOUNDED PRECEDING) AS upto
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, total AS source_size, target,
  (size * (epochs + CASE WHEN upto - size / 2 <= rest AND upto - size < rest THEN 1 ELSE 0 END))::BIGINT AS taken,
  (epochs + CASE WHEN upto - size / 2 <= rest AND upto - size < rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM p"""

QUALITY_RULES = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS r
        FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again) GROUP BY doc_id),
x AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    list_filter(lines, lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS full_lines,
    coalesce(r, 0)::BIGINT AS n_repeat_words, length(text) AS n_chars,
    length(array_to_string(list_filter(lines, lambda y: NOT (
      (length(regexp_replace(y, '[^#*$%&<>!=_~^@{}\[\]\\]+', '', 'g')) >= 3
        AND length(regexp_replace(y, '[^#*$%&<>!=_~^@{}\[\]\\]+', '', 'g')) > length(y) * 0.08::DOUBLE)
      OR (length(regexp_replace(y, '[^|>»•·]+', '', 'g')) >= 3
        AND length(regexp_replace(y, '[^|>»•·]+', '', 'g')) * 5 >= length(y) - length(replace(y, ' ', '')) + 1)
      OR (length(y) <= 200 AND regexp_matches(lower(y), 'all rights reserved|licensed under|released under the|terms of use|terms of service|privacy policy|cookie policy|accept cookies|subscribe to our|sign up for|click here|read more|share this|skip to content|back to top|copyright ©|\(c\) copyright|powered by'))
    )), chr(10))) AS n_left
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
b AS (SELECT *, (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_chars - n_left <= n_chars * 0.5::DOUBLE AS kept, (n_chars - n_left)::BIGINT AS n_lost_chars
FROM b"""

# Brute force over all pairs; min-label propagation finds the components.
EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e,
    coalesce(vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0, false) AS usable
  FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.usable AND b.usable AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(c.low, v.vec_id)) AS component_id,
  coalesce(v.vec_id = least(v.vec_id, coalesce(c.low, v.vec_id)), false) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN c ON c.a = v.vec_id"""


# CRC-32 bit by bit for the table, byte by byte for every distinct word.
IMPORTANCE = r"""
WITH tab AS (
  SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
texts AS (SELECT 'd' AS part, row_number() OVER () AS r, doc_id, text FROM documents
          UNION ALL SELECT 'b', 0, NULL, text FROM benchmark),
w AS (SELECT part, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts WHERE text IS NOT NULL),
v AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM w)),
h AS (SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT],
          list_transform(range(len(x) // 2), lambda j: ('0x' || substr(x, 2 * j + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket FROM v, tab),
n AS (SELECT bucket, count(*) FILTER (part = 'd') AS s, count(*) FILTER (part = 'b') AS t FROM w JOIN h USING (word) GROUP BY bucket),
a AS (SELECT coalesce(sum(s), 0)::DOUBLE AS big_s, coalesce(sum(t), 0)::DOUBLE AS big_t FROM n),
g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (big_s + 10000) / ((s + 1)::DOUBLE * (big_t + 10000))))::BIGINT AS gain FROM n, a),
f AS (SELECT r, count(*) AS n_features, sum(gain) AS weight FROM w JOIN h USING (word) JOIN g USING (bucket) WHERE part = 'd' GROUP BY r),
d AS (SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
      FROM texts LEFT JOIN f ON f.r = texts.r WHERE part = 'd'),
e AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
        (SELECT count(*) FROM e WHERE n_features >= 20) * 10 // 100 AS drawn FROM e)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END::BIGINT AS rank FROM k"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": MIXING, "op2_quality_rules": QUALITY_RULES, "op7_embedding_dedup": EMBEDDING_DEDUP,
            "op13_importance_resampling": IMPORTANCE}
