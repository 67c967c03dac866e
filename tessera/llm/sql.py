"""DuckDB SQL for the queries that SQL can express."""

MIXING = r"""
WITH q AS (
  SELECT doc_id, CASE WHEN min(quality) = 1 THEN 2.0 ELSE 0.5 END AS w
  FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id
), d AS (
  SELECT documents.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(documents.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)
      / coalesce(w, 1.0)::DOUBLE AS key
  FROM documents LEFT JOIN q ON documents.doc_id = q.doc_id
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, 3 * source_size / weight AS ratio, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights FROM s
), p AS (
  SELECT *, row_number() OVER o AS place,
    coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weighed
  FROM r WINDOW o AS (ORDER BY ratio, source NULLS LAST)
), l AS (
  SELECT *, (total - capped)::DOUBLE / (weights - weighed)::DOUBLE AS level FROM p
), t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * (SELECT arg_min(level, place) FROM l WHERE ratio >= level)) AS target FROM l
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(round(target) / source_size)::BIGINT ELSE 0 END AS epochs FROM t
), a AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, round(e.target)::BIGINT - e.epochs * e.source_size AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id NULLS FIRST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - ahead)))::BIGINT AS taken FROM a
"""

_ESCAPED = r"replace(replace(replace(replace(replace(replace(replace(replace({}, '\', '\\'), '<|', '<\|'), '<s>', '<\s>'), '</s>', '<\/s>'), '<SYS>>', '<\SYS>>'), '</SYS>>', '<\/SYS>>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')"

CHAT = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), o AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w AS was
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), p AS (
  SELECT *, length({_ESCAPED.format("text")}) + CASE WHEN was IS NULL OR was <> role
    THEN length('<|start|>' || {_ESCAPED.format("role")} || '<|message|>' || '<|end|>' || chr(10)) ELSE length('<|turn|>') END AS chars
  FROM o
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""

_NAMES = "(?i:password|passwd|secret|token|api_?key)"
_BEFORE = _NAMES + r"""["'']?\x20*[:=]\x20*["'']?"""

SECRETS = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents
), m AS (
  SELECT row, doc_id, source, kind, least, f, list_transform(f, lambda x: length(x)) AS lf, list_transform(g, lambda x: length(x)) AS lg
  FROM (
    SELECT d.*, 0 AS kind, 12 AS least, regexp_extract_all(t, '{_BEFORE}[A-Za-z0-9+/_.=-]+') AS f, regexp_split_to_array(t, '{_BEFORE}[A-Za-z0-9+/_.=-]+') AS g FROM d
    UNION ALL SELECT d.*, 1, 18, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_split_to_array(t, 'AKIA[A-Z0-9]+') FROM d
    UNION ALL SELECT d.*, 2, 16, regexp_extract_all(t, '[0-9a-f]{{16,}}'), regexp_split_to_array(t, '[0-9a-f]{{16,}}') FROM d
    UNION ALL SELECT d.*, 3, 20, regexp_extract_all(t, '[A-Za-z0-9+/_=-]{{20,}}'), regexp_split_to_array(t, '[A-Za-z0-9+/_=-]{{20,}}') FROM d
  ) WHERE len(f) > 0
), u AS (
  SELECT row, doc_id, source, kind, least, unnest(f) AS match, unnest(lf) AS long,
    unnest(list_transform(range(1, len(f) + 1), lambda i: coalesce(list_sum(lg[1:i]), 0) + coalesce(list_sum(lf[1:(i - 1)]), 0))) AS start
  FROM m
), v AS (
  SELECT row, doc_id, source, kind, start::BIGINT AS start, (start + long)::BIGINT AS stop,
    CASE WHEN kind = 0 THEN regexp_replace(match, '^{_BEFORE}', '') ELSE match END AS value, least
  FROM u
), k AS (
  SELECT * FROM v WHERE length(value) >= least AND (kind < 3 OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')))
), c AS (
  SELECT * FROM k WHERE kind < 3 OR NOT EXISTS (
    SELECT 1 FROM k AS b WHERE b.row = k.row AND b.kind < 3 AND b.start < k.stop AND k.start < b.stop)
), f AS (
  SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT (coalesce(source, chr(0)), coalesce(doc_id::VARCHAR, chr(0)))) AS places FROM c GROUP BY value
), s AS (
  SELECT c.*, owners, owners >= 5 OR places >= 50 AS wide, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop AS span FROM c JOIN f USING (value)
), g AS (
  SELECT row,
    count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3 OR (owners = 1 AND NOT wide)) AS spans,
    count(*) FILTER (kind = 3 AND owners = 1 AND NOT wide) AS n_owned,
    count(*) FILTER (kind < 3 AND NOT wide) AS n_live, count(*) FILTER (kind < 3 AND wide) AS n_copied
  FROM s GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_owned, 0) AS n_owned, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN g USING (row)
"""
