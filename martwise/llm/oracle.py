"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from martwise.llm import license_scan, mixing, quality_rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _mixing() -> str:
    weights = ", ".join(f"{float(w)}" for w in mixing.WEIGHTS)
    share, cap, n = mixing.SHARE, mixing.CAP, len(mixing.WEIGHTS)
    return rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         CAST('0x' || substr(md5('{mixing.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' ||
              md5(coalesce(text, ''))), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE) AS u
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(list_extract([{weights}], 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {n}) AS DOUBLE) AS weight
  FROM sized GROUP BY source),
run AS (
  SELECT *, sum(source_size) OVER () * CAST({share} AS DOUBLE) AS total, sum(weight) OVER () AS weights,
         CAST(coalesce(sum(source_size) OVER o, 0) AS DOUBLE) AS size_before, coalesce(sum(weight) OVER o, 0) AS weight_before
  FROM per
  WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stop AS (
  SELECT *, {cap} * CAST(source_size AS DOUBLE) <= (total - {cap} * size_before) / (weights - weight_before) * weight AS stopped
  FROM run),
level AS (
  SELECT *, (total - {cap} * CAST(sum(CASE WHEN stopped THEN source_size ELSE 0 END) OVER () AS DOUBLE))
            / nullif(weights - sum(CASE WHEN stopped THEN weight ELSE 0 END) OVER (), 0) AS level
  FROM stop),
rates AS (
  SELECT source, source_size, CASE WHEN stopped THEN {cap} * CAST(source_size AS DOUBLE) ELSE level * weight END AS target
  FROM level)
SELECT s.doc_id, s.size, r.source_size, r.target,
       CAST(CASE WHEN r.source_size = 0 THEN 0 ELSE s.size * (floor(r.target / r.source_size) +
         CASE WHEN s.u < r.target / r.source_size - floor(r.target / r.source_size) THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
"""


def _rules() -> str:
    q = quality_rules
    rules = ", ".join(f"sum(CAST({r} AS BIGINT)) AS {r}" for r in q.RULES)
    moments = ", ".join(f"sum({r}) OVER () / sum(n) OVER () AS {r}_p, "
                        f"coalesce(var_samp({r} / n) OVER (), 0) AS {r}_var" for r in q.RULES)
    between = ", ".join(f"{r}_var - {r}_p * (1 - {r}_p) * inverse_n / hosts AS {r}_b" for r in q.RULES)
    # a prior worth between one document and all of them; all where the hosts show no difference of their own
    strength = ", ".join(f"CASE WHEN {r}_b <= 0 THEN all_n ELSE greatest(1.0, least(all_n, {r}_p * (1 - {r}_p) / {r}_b - 1)) END AS {r}_k"
                         for r in q.RULES)
    shrunk = ", ".join(f"({r} + {r}_k * {r}_p) / (n + {r}_k) AS {r}_rate" for r in q.RULES)
    bad = " OR ".join(f"({r}_rate - {q.DOUBT} * sqrt({r}_rate * (1 - {r}_rate) / (n + {r}_k + 1)) > {q.MAX_RATE})" for r in q.RULES)
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
listed AS (SELECT *, {_WORDS} AS words, string_split(text, chr(10)) AS all_lines FROM docs),
spots AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM listed),
windows AS (
  SELECT r, i, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c FROM spots WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows WHERE c IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS t(k) GROUP BY r),
lines AS (
  SELECT r, list_filter(all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM listed),
base AS (
  SELECT d.r, d.doc_id, d.source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM listed d JOIN lines USING (r) LEFT JOIN covered c USING (r)),
flags AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.REPEAT_SHARE} * n_words AS base_failed,
         100 * n_symbols > {q.SYMBOL_SHARE} * n_words AS symbols_failed, n_dup_lines > {q.DUP_LINES} AS lines_failed
  FROM base),
per AS (SELECT source, count(*) AS n, {rules} FROM flags GROUP BY source),
moments AS (SELECT *, {moments}, CAST(sum(n) OVER () AS DOUBLE) AS all_n, count(*) OVER () AS hosts, sum(1.0 / n) OVER () AS inverse_n FROM per),
between_hosts AS (SELECT *, {between} FROM moments),
priors AS (SELECT *, {strength} FROM between_hosts),
rates AS (SELECT *, {shrunk} FROM priors),
verdicts AS (SELECT source, {bad} AS rejected FROM rates)
SELECT f.doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed,
       NOT f.base_failed AND NOT v.rejected AS kept
FROM flags f JOIN verdicts v ON f.source IS NOT DISTINCT FROM v.source
"""


def _vectors() -> str:
    return """
WITH RECURSIVE usable AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v,
         embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
links AS (
  SELECT a.r AS a, b.r AS b FROM (SELECT * FROM usable WHERE ok) a JOIN (SELECT * FROM usable WHERE ok) b
  ON a.r <> b.r AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT r AS a, r AS b FROM usable
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT reach.a AS r, min(u.vec_id) AS component_id FROM reach JOIN usable u ON reach.b = u.r GROUP BY reach.a),
counts AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT u.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.component_id,
       u.vec_id IS NOT DISTINCT FROM l.component_id AS kept
FROM usable u JOIN low l USING (r) LEFT JOIN counts c USING (r)
"""


def _archives() -> str:
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
coded AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, CAST(5 * i + 1 AS INT), 5) AS INT)) AS parts FROM rows),
firsts AS (SELECT hex, min(page_id) AS response_id, count(*) AS n FROM rows GROUP BY hex)
SELECT c.page_id, CAST(strlen(c.html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(parts, lambda p: substr('{digits}', 1 + (p // 32768) % 32, 1) || substr('{digits}', 1 + (p // 1024) % 32, 1)
         || substr('{digits}', 1 + (p // 32) % 32, 1) || substr('{digits}', 1 + p % 32, 1)), '') AS payload_digest,
       CASE WHEN f.n > 1 AND c.page_id IS DISTINCT FROM f.response_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.n > 1 AND c.page_id IS DISTINCT FROM f.response_id THEN f.response_id END AS refers_to
FROM coded c JOIN firsts f USING (hex)
"""


def _licenses() -> str:
    s = license_scan
    phrases = " UNION ALL ".join(
        f"SELECT '{p}' AS phrase, '{label}' AS label, {p.split()!r} AS pw" for p, label in s.PHRASES.items())
    notices = " UNION ALL ".join(f"SELECT '{label}' AS label, '{t}' AS said" for label, ts in s.NOTICES.items() for t in ts)
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
listed AS (SELECT *, regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM docs),
phrases AS ({phrases}),
places AS (
  SELECT l.r, p.label, i AS spot
  FROM listed l JOIN phrases p ON true, LATERAL (SELECT unnest(range(1, CAST(len(l.words) AS BIGINT) + 1)) AS i) t
  WHERE l.words[i] = p.pw[1] AND l.words[i : i + len(p.pw) - 1] = p.pw),
based AS (
  SELECT r, count(*) AS n_base, min(spot) - 1 AS first_word, max(spot) - 1 AS last_word, list_sort(list_distinct(list(label))) AS labels
  FROM places GROUP BY r),
said AS ({notices}),
notices AS (
  SELECT row_number() OVER () AS k, label, list_distinct(string_split(said, ' ')) AS nw,
         ceil({s.THRESHOLD} * len(list_distinct(string_split(said, ' '))) - 1e-9) AS need,
         CAST(ceil(len(string_split(said, ' ')) / {s.THRESHOLD} - 1e-9) AS BIGINT) + {s.INSERTED} AS run
  FROM said),
telling AS (
  SELECT n.k, list(DISTINCT w) AS tw
  FROM notices n JOIN notices o ON o.label <> n.label AND len(list_intersect(n.nw, o.nw)) >= n.need,
       LATERAL (SELECT unnest(n.nw) AS w) t
  WHERE NOT list_contains(o.nw, w) GROUP BY n.k),
likely AS (
  SELECT l.r, l.words, n.*, coalesce(t.tw, []) AS tw
  FROM listed l JOIN notices n ON len(list_intersect(n.nw, l.words)) >= n.need LEFT JOIN telling t ON t.k = n.k),
held AS (
  SELECT r, label, need, len(nw) AS size, tw, nw, words[i : i + run - 1] AS run_words
  FROM likely, LATERAL (SELECT unnest(range(1, CAST(len(words) AS BIGINT) + 1)) AS i) t
  WHERE list_contains(nw, words[i])),
found AS (
  SELECT r, list(DISTINCT label) AS labels, max(len(list_intersect(nw, run_words)) / size) AS best
  FROM held WHERE len(list_intersect(nw, run_words)) >= need AND list_has_all(run_words, tw) GROUP BY r)
SELECT l.doc_id, CAST(len(l.words) AS BIGINT) AS n_words, CAST(coalesce(b.n_base, 0) AS BIGINT) AS n_base,
       CAST(b.first_word AS BIGINT) AS first_word, CAST(b.last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
       CAST(greatest(coalesce(f.best, 0), CASE WHEN coalesce(b.n_base, 0) > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS score
FROM listed l LEFT JOIN based b USING (r) LEFT JOIN found f USING (r)
"""


SQL = {
    "op1_mixing": _mixing(),
    "op2_quality_rules": _rules(),
    "op8_embedding_dedup": _vectors(),
    "op9_warc": _archives(),
    "op10_license_scan": _licenses(),
}
