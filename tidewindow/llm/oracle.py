"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

WS = r"[\x20\x09-\x0D]+"

#: Documents with what the quality rules see; ``{docs}`` is the input relation.
QUALITY = rf"""
quality_words AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, *,
    list_filter(string_split_regex(coalesce(text, ''), '{WS}'), lambda x: x <> '') AS ws
  FROM {{docs}}),
quality_windows AS (
  SELECT rid, p, count(*) OVER (PARTITION BY rid, gram) AS times
  FROM (SELECT rid, p, array_to_string(ws[p : p + 7], ' ') AS gram
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS p FROM quality_words WHERE len(ws) >= 8))),
quality_repeats AS (
  SELECT rid, count(DISTINCT p + k) AS n
  FROM quality_windows, range(8) AS r(k) WHERE times > 1 GROUP BY rid),
quality_measures AS (
  SELECT q.*, len(ws)::BIGINT AS n_words,
    length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
     - len(list_distinct(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM quality_words q LEFT JOIN quality_repeats r USING (rid)),
quality_base AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM quality_measures),
quality_hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS failed FROM quality_base GROUP BY source),
quality_fit AS (
  SELECT avg(failed / n) AS m, var_pop(failed / n) AS v FROM quality_hosts),
quality_prior AS (
  SELECT m, CASE WHEN v > 0 AND m * (1 - m) / v - 1 > 0 THEN m * (1 - m) / v - 1 ELSE 1.0 END AS k FROM quality_fit),
quality_verdicts AS (
  SELECT source, (failed + m * k) / (n + k) > 0.5 AS rejected FROM quality_hosts, quality_prior),
quality_rows AS (
  SELECT b.*, NOT base_failed AND NOT rejected AS kept
  FROM quality_base b JOIN quality_verdicts v ON b.source IS NOT DISTINCT FROM v.source)"""

OP9 = f"""WITH {QUALITY.format(docs='documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM quality_rows"""

MIXING = rf"""
mix_docs AS MATERIALIZED (
  SELECT *, len(list_filter(string_split_regex(coalesce(text, ''), '{WS}'), lambda x: x <> ''))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':17') AS mix_key
  FROM {{docs}}),
mix_sources AS (
  SELECT source, source_size, 2 * source_size AS cap,
    [3, 1, 2][((row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM mix_docs GROUP BY source)),
mix_levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
     - coalesce(sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
     / sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM mix_sources),
mix_level AS (SELECT arg_min(level, cap / w) AS level FROM mix_levels WHERE cap / w > level),
mix_targets AS (
  SELECT source, source_size,
    least(cap::DOUBLE, coalesce(w * (SELECT level FROM mix_level), cap::DOUBLE))::DOUBLE AS target
  FROM mix_sources),
mix_plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM mix_targets),
mix_keys AS (
  SELECT source, mix_key, sum(size) AS key_size FROM mix_docs GROUP BY ALL),
mix_cuts AS (
  SELECT source, mix_key, sum(key_size) OVER (PARTITION BY source ORDER BY mix_key) - key_size / 2
    <= target - epochs * source_size AND target > epochs * source_size AS extra
  FROM mix_keys JOIN mix_plan USING (source)),
mix_rows AS (
  SELECT d.*, p.source_size, p.target, p.epochs + CASE WHEN c.extra THEN 1 ELSE 0 END AS copies
  FROM mix_docs d JOIN mix_plan p ON d.source IS NOT DISTINCT FROM p.source
  LEFT JOIN mix_cuts c ON c.source IS NOT DISTINCT FROM d.source AND c.mix_key = d.mix_key)"""

OP4 = f"""WITH {MIXING.format(docs='documents')}
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM mix_rows"""

OP10 = r"""WITH
doc_words AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM documents),
item_words AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS width, array_to_string(ws[p : p + least(13, len(ws)) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p FROM item_words WHERE len(ws) > 0)),
widths AS (SELECT DISTINCT width FROM windows),
places AS (
  SELECT doc_id, width, p, array_to_string(ws[p : p + width - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(ws) - width + 2)) AS p FROM doc_words, widths WHERE len(ws) >= width)),
found AS (SELECT doc_id, item_id, p, width FROM places JOIN windows USING (width, gram)),
hits AS (
  SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM found, range(13) AS r(k) WHERE k < width GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item COLLATE "C")) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)"""

def _centroid_round(n: int) -> str:
    """Assignment ``a{n}`` of all vectors to the centroids ``c{n}``."""
    return f"""
a{n} AS MATERIALIZED (
  SELECT r, min(d) AS d, arg_min(c, d * 1000 + c) AS c
  FROM (SELECT r, c, list_sum(list_transform(list_zip(v.q, k.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM vectors v, c{n} k) GROUP BY r)"""


def _next_centroids(n: int) -> str:
    """Centroids ``c{n + 1}``: floors of the means; ``//`` rounds towards zero."""
    return f""",
c{n + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.q, k.q) AS q FROM c{n} k LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY p) AS q FROM (
      SELECT c, p, sum(q[p])::BIGINT AS s, count(*) AS n
      FROM a{n} JOIN vectors USING (r), range(1, 65) AS t(p) GROUP BY c, p) GROUP BY c) m USING (c)),"""


OP11 = f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q
  FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, q FROM vectors ORDER BY h, q LIMIT 16)),
{_centroid_round(0)}{_next_centroids(0)}{_centroid_round(1)}{_next_centroids(1)}{_centroid_round(2)}{_next_centroids(2)}{_centroid_round(3)},
digests AS (SELECT c, sha256(array_to_string(q, ',')) AS centroid_sha256 FROM c3)
SELECT vec_id, c::INTEGER AS cluster, d AS distance,
  (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a3 JOIN vectors USING (r) JOIN digests USING (c)"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"regexp_extract_all(translate({text}, '{upper}', '{upper.lower()}'), '{_TERM}')"


OP12 = f"""
WITH docs AS (
  SELECT r, doc_id, t, len(t) AS n
  FROM (SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS t FROM documents) WHERE len(t) > 0),
size AS (SELECT count(*)::HUGEINT AS docs, sum(n)::HUGEINT AS terms FROM docs),
normed AS (SELECT r, doc_id, t, (10 + (90 * n * size.docs) // size.terms)::BIGINT AS m FROM docs, size),
postings AS (
  SELECT r, doc_id, m, term, count(*) AS tf FROM (SELECT r, doc_id, m, unnest(t) AS term FROM normed) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * size.docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, size GROUP BY term, size.docs),
asked AS (
  SELECT q, item_id, unnest(list_distinct({_terms('text')})) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark)),
scored AS (
  SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


ORACLE = {
    "op4_mix_sources": OP4,
    "op9_quality_rules": OP9,
    "op10_decontaminate": OP10,
    "op11_centroids": OP11,
    "op12_lexical_search": OP12,
}
