"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from quayside.llm import decontaminate, secret_scan

_RUN = "[A-Za-z0-9+/_=-]{%d,}" % secret_scan.WINDOW
_ALLOW = " OR ".join(f"regexp_matches(hit, '{p}')" for p in secret_scan.ALLOW)


def _hits(name: str, pattern: str, after: str = "true") -> str:
    """CTE of (doc_id, start, hit): offsets from the pieces between the matches."""
    p = pattern.replace("'", "''")
    return f"""{name} AS (
        SELECT doc_id, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start, hits[i] AS hit
        FROM (SELECT doc_id, gaps, hits, unnest(range(1, len(hits) + 1)) AS i
              FROM (SELECT doc_id, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS hits FROM d))
        WHERE {after})"""


_GROUP = secret_scan.ASSIGN.replace("'", "''")
OP1 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_hits("assign_", secret_scan.ASSIGN, f"length(regexp_extract(hits[i], '{_GROUP}', 2)) >= 6")},
{_hits("access_", secret_scan.ACCESS)},
{_hits("hex_", secret_scan.HEX)},
{_hits("run_", _RUN)},
candidate AS (SELECT doc_id, start, hit FROM run_ WHERE regexp_matches(hit, '[0-9]') AND NOT ({_ALLOW})),
win AS (SELECT doc_id, start, i, substr(hit, i, {secret_scan.WINDOW}) AS w
        FROM (SELECT *, unnest(range(1, length(hit) - {secret_scan.WINDOW} + 2)) AS i FROM candidate)),
flagged AS (SELECT *, list_aggregate(string_split(w, ''), 'entropy') AS bits FROM win),
entropy_ AS (
    SELECT doc_id, start + min(i) - 1 AS s, start + max(i) - 1 + {secret_scan.WINDOW} AS e FROM flagged
    WHERE (regexp_full_match(w, '[0-9a-fA-F]+') AND regexp_matches(w, '[a-fA-F]') AND bits >= {secret_scan.HEX_BITS} - 1e-9)
       OR (regexp_matches(w, '[A-Z]') AND regexp_matches(w, '[a-z]') AND regexp_matches(w, '[0-9]')
           AND bits >= {secret_scan.BASE64_BITS} - 1e-9)
    GROUP BY doc_id, start),
span AS (
    SELECT doc_id, CAST(start AS BIGINT) AS s, 0 AS k, CAST(start + length(hit) AS BIGINT) AS e, 'assign' AS kind FROM assign_
    UNION ALL SELECT doc_id, start, 1, start + length(hit), 'access' FROM access_
    UNION ALL SELECT doc_id, start, 2, start + length(hit), 'hex' FROM hex_
    UNION ALL SELECT doc_id, s, 3, e, 'entropy' FROM entropy_),
joined AS (
    SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
    FROM span GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (doc_id)
"""

_ESCAPE = r"regexp_replace({}, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g')"
OP4 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<s>[INST]' || {_ESCAPE.format("role")} || '[/INST]' || {_ESCAPE.format("text")} || '</s>')) AS BIGINT)
           AS formatted_chars
FROM turns GROUP BY conv_id
"""


def _shingles(table: str, key: str) -> str:
    n = decontaminate.WORDS
    return f"""(SELECT DISTINCT {key}, shingle FROM (
        SELECT {key}, unnest(list_transform(range(1, greatest(len(w) - {n - 1}, 1) + 1), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS shingle
        FROM (SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda x: x <> '') AS w
              FROM {table}) WHERE len(w) > 0))"""


OP5 = f"""
WITH held AS {_shingles("documents", "doc_id")}, asked AS {_shingles("benchmark", "item_id")},
sized AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS n_shingles FROM asked)
SELECT doc_id, item_id, count(*) AS n_shared, n_shingles, count(*) / n_shingles AS containment
FROM held JOIN sized USING (shingle) GROUP BY doc_id, item_id, n_shingles
HAVING count(*) >= ceil({decontaminate.THRESHOLD} * n_shingles)
"""

OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (
    SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CAST(len(words) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INT)
           + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS INT)
           + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(w.doc_id > first AS INT) AS mask
    FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
cell AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
letter AS (SELECT unnest(range(5)) AS k),
steps AS (
    SELECT o, step, o[step] AS k, list_sum(list_transform(o[1:step - 1], lambda x: 1 << x)) AS before FROM (
        SELECT [a.k, b.k, c.k, d.k, e.k] AS o, unnest(range(1, 6)) AS step
        FROM letter a, letter b, letter c, letter d, letter e
        WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5)),
rows_ AS (
    SELECT part, o, step, k,
           sum(n) FILTER ((mask & (coalesce(before, 0) | (1 << k))) = 0) AS kept,
           sum(n) FILTER ((mask >> k) % 2 = 1 AND (mask & coalesce(before, 0)) = 0) AS removed,
           sum(n) FILTER ((mask >> k) % 2 = 1 AND (mask & coalesce(before, 0)) <> 0) AS redundant,
           sum(n) FILTER (mask = 1 << k) AS unique_fails,
           sum(good) FILTER ((mask >> k) % 2 = 1 AND (mask & coalesce(before, 0)) = 0) AS good_lost,
           sum(toxic) FILTER ((mask >> k) % 2 = 1 AND (mask & coalesce(before, 0)) = 0) AS toxic_lost
    FROM steps, cell GROUP BY part, o, step, k)
SELECT part, array_to_string(list_transform(o, lambda x: chr(CAST(65 + x AS INT))), '') AS filter_order, CAST(step AS INT) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, k), 0) AS BIGINT) AS shapley
FROM rows_
"""

# CRC-32 byte by byte over distinct words, from the polynomial's table of 256 remainders
OP13 = r"""
WITH RECURSIVE crc_step AS (
    SELECT b AS byte, b AS v, 0 AS i FROM range(256) AS r(b)
    UNION ALL SELECT byte, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i + 1 FROM crc_step WHERE i < 8),
crc_table AS (SELECT list(v ORDER BY byte) AS rem FROM crc_step WHERE i = 8),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM d) GROUP BY doc_id, word),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY word),
every_word AS (SELECT word, hex(encode(word)) AS code FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
bucketed AS (
    SELECT word, xor(list_reduce(list_transform(range(0, length(code) // 2), lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT)),
        lambda c, x: xor(c >> 8, rem[xor(c, x) % 256 + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
    FROM every_word, crc_table),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN bucketed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bw JOIN bucketed USING (word) GROUP BY bucket),
total AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS big_s, coalesce((SELECT sum(n) FROM t), 0) AS big_t),
gain AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST(big_s + 10000 AS DOUBLE)
                         / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST(big_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM s FULL JOIN t USING (bucket), total),
weight AS (SELECT doc_id, sum(n * gain) AS weight FROM dw JOIN bucketed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT d.doc_id, len(words) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS h
    FROM d LEFT JOIN weight ON d.doc_id = weight.doc_id),
drawn AS (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM drawn)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank FROM ranked
"""

OP12 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""

ORACLES = {
    "op1_secret_scan": OP1,
    "op4_chat_format": OP4,
    "op5_decontaminate": OP5,
    "op11_filter_audit": OP11,
    "op12_warc": OP12,
    "op13_importance_resampling": OP13,
}
