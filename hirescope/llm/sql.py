"""DuckDB SQL for the operators that SQL can express."""

from hirescope.llm.substring_dedup import MIN_WORDS

OP1_SUBSTRING_DEDUP = rf"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS number FROM split
), units AS (
  SELECT doc_id, line, number,
         trim(regexp_replace(lower(line), '[ \t\r\f\v]+', ' ', 'g'), ' ') AS norm,
         coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY number
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM lines
), ranked AS (
  SELECT *, length(norm) - length(replace(norm, ' ', '')) >= {MIN_WORDS - 1}
            AND row_number() OVER (PARTITION BY norm ORDER BY doc_id, number) > 1 AS gone
  FROM units
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
       coalesce(sum(length(line)) FILTER (WHERE gone), 0)::BIGINT AS removed_chars,
       coalesce(string_agg(start || '-' || (start + length(line)), ',' ORDER BY number) FILTER (WHERE gone), '') AS spans,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM ranked GROUP BY doc_id
"""

OP13_CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL
  SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length('### : </turn>') + 1 + length(replace(replace(role, '\', '\\'), ':', '\:'))
            + length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')) AS size
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
