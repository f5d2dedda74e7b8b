"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from assaymill.llm import mixing, secrets

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = f"""
WITH bench AS (
  SELECT item_id, w, least(len(w), 10) AS size
  FROM (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM bench, range(1, 100000) AS r(i) WHERE i <= len(w) - size + 1
), sizes AS (SELECT DISTINCT size FROM windows),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)
), hits AS (
  SELECT p.doc_id, p.i, p.size, item_id FROM places p JOIN windows USING (win, size)
), covered AS (
  SELECT doc_id, count(DISTINCT i + o) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, size FROM hits), range(0, 10) AS r(o)
  WHERE o < size GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _matches(pattern: str, kind: int, where: str = "true") -> str:
    """Matches with positions: gaps and matches in turn give the starts."""
    p = pattern.replace("'", "''")
    return rf"""
  SELECT doc_id, {kind} AS kind, b AS begin, b + length(m) AS "end", m, right(g, {secrets.BEFORE}) AS before
  FROM (
    SELECT doc_id, m, g,
           sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS b
    FROM (
      SELECT doc_id, unnest(ms) AS m, unnest(gs[1 : len(ms)]) AS g, generate_subscripts(ms, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS ms, regexp_split_to_array(t, '{p}') AS gs FROM texts)
    )
  ) WHERE {where}"""


def _op9() -> str:
    group = secrets.ASSIGN.replace("'", "''")
    limits = {k: secrets.most_repetition(v) for k, v in secrets.BITS.items()}
    w = secrets.WINDOW
    terms = ", ".join(map(str, secrets.terms()))
    allowed = secrets.ALLOWED.replace("'", "''")
    before = secrets.ALLOWED_BEFORE.replace("'", "''")
    kinds = ", ".join(f"'{k}'" for k in secrets.KINDS)
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (
{_matches(secrets.ASSIGN, 0, f"length(regexp_extract(m, '{group}', 2)) >= {secrets.ASSIGN_LEAST}")}
UNION ALL {_matches(secrets.ACCESS, 1)}
UNION ALL {_matches(secrets.HEX, 2)}
), candidates AS (
{_matches(secrets.CANDIDATE, 3, f"NOT regexp_matches(m, '{allowed}') AND NOT regexp_matches(before, '{before}')")}
), windows AS (
  SELECT doc_id, begin, m, i, list_distinct(string_split(substr(m, i, {w}), '')) AS symbols, substr(m, i, {w}) AS win
  FROM (SELECT doc_id, begin, m, unnest(range(1, length(m) - {w} + 2)) AS i FROM candidates)
), hot AS (
  SELECT doc_id, begin, min(i) AS first, max(i) AS last FROM windows
  WHERE list_sum(list_transform(symbols, lambda s: ([{terms}])[length(win) - length(replace(win, s, '')) + 1]))
        <= CASE WHEN regexp_full_match(m, '[0-9a-fA-F]+') THEN {limits["hex"]}
                WHEN regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') THEN {limits["mixed"]}
                ELSE {limits["single_case"]} END
  GROUP BY doc_id, begin
), entropy AS (
  SELECT doc_id, 3 AS kind, begin + first - 1 AS begin, begin + last - 1 + {w} AS "end" FROM hot
), spans AS (
  SELECT doc_id, kind, begin, "end" FROM base
  UNION ALL
  SELECT doc_id, kind, begin, "end" FROM entropy e WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = e.doc_id AND b.begin < e."end" AND e.begin < b."end")
), lines AS (
  SELECT *, concat_ws(':', ([{kinds}])[kind + 1], CAST(begin AS BIGINT), CAST("end" AS BIGINT)) AS line FROM spans
)
SELECT t.doc_id, count(line) FILTER (kind = 0) AS n_assign, count(line) FILTER (kind = 1) AS n_access,
       count(line) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(line, ',' ORDER BY begin, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(line, ',' ORDER BY begin, kind), '') AS spans
FROM texts t LEFT JOIN lines l ON l.doc_id = t.doc_id GROUP BY t.doc_id
"""


OP2 = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations
), placed AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
         string_agg(sha256(role || chr(31) || text), '') OVER w AS prefix
  FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), whole AS (SELECT prefix, min(conv_id) AS conv_id FROM placed WHERE k = n GROUP BY prefix),
kept AS (SELECT conv_id FROM whole WHERE prefix NOT IN (SELECT prefix FROM placed WHERE k < n)),
lines AS (
  SELECT conv_id, k, n, CAST((k - 1) // 256 AS BIGINT) AS part,
         replace(replace(role, '<|im_start|>', '< | im_start | >'), '<|im_end|>', '< | im_end | >') AS r,
         replace(replace(text, '<|im_start|>', '< | im_start | >'), '<|im_end|>', '< | im_end | >') AS t
  FROM placed JOIN kept USING (conv_id)
)
SELECT conv_id, part, n AS n_turns,
       string_agg('<|im_start|>' || r || chr(10) || t || '<|im_end|>' || chr(10), '' ORDER BY k) AS rendered
FROM lines GROUP BY conv_id, part, n
"""

OP4 = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS head FROM payloads WHERE payload_bytes >= 100 GROUP BY ALL
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""


def _op11() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return rf"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}')) AS size,
         md5(concat('{mixing.SEED}:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size) AS source_size, {mixing.MOST_REPEATS} * sum(size) AS most,
         ([{weights}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
  FROM docs GROUP BY source
), levels AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS width
  FROM sources WINDOW w AS (ORDER BY most / weight, source NULLS LAST)
), open AS (SELECT * FROM levels WHERE most * width >= words * weight ORDER BY words, width DESC),
level AS (SELECT max(words) AS words, max(width) AS width FROM open),
targets AS (
  SELECT source, source_size,
         CASE WHEN most * level.width < level.words * weight THEN CAST(most AS DOUBLE)
              ELSE CAST(level.words * weight AS DOUBLE) / level.width END AS target
  FROM sources, level
), placed AS (
  SELECT doc_id, size, source_size, target, CAST(round(target) AS HUGEINT) AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(budget // greatest(source_size, 1) * size
            + greatest(0, least(size, budget - budget // greatest(source_size, 1) * source_size - before)) AS BIGINT) AS taken
FROM placed
"""


def statements() -> dict[str, str]:
    return {"op2_chat": OP2, "op4_warc": OP4, "op7_decontaminate": OP7, "op9_secrets": _op9(), "op11_mix": _op11()}
