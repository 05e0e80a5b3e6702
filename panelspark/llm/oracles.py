"""DuckDB SQL that must give the rows of the operators whose contract fixes every value, over whole tables."""

from __future__ import annotations

_WORDS = r"[^\x20\x09-\x0D]+"
_LOW = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# Rows are numbered, since a doc_id may repeat.
DECONTAMINATION = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_folded('text')}, '{_LOW}') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_folded('text')}, '{_LOW}') AS w FROM benchmark),
cut AS (SELECT item, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS win FROM b WHERE len(w) > 0),
win AS MATERIALIZED (SELECT array_to_string(win, ' ') AS win, len(win) AS n, list(DISTINCT item) AS items FROM cut GROUP BY ALL),
sizes AS (SELECT DISTINCT n FROM win),
spans AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
found AS MATERIALIZED (SELECT sp.r, sp.s, sp.n, win.items FROM spans sp JOIN d USING (r) JOIN win ON win.n = sp.n AND win.win = array_to_string(d.w[sp.s:sp.s + sp.n - 1], ' ')),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r),
named AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM (SELECT r, unnest(items) AS item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items, sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""

SUBSTRING = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
s AS (SELECT r, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20),
h AS MATERIALIZED (SELECT s.r, s.s, md5(array_to_string(d.w[s.s:s.s + 19], ' ')) AS h FROM s JOIN d USING (r)),
again AS (SELECT r, s FROM h QUALIFY row_number() OVER (PARTITION BY h ORDER BY r, s) > 1),
gone AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(s, s + 20)) AS p FROM again) GROUP BY r),
left_over AS (SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, CASE WHEN gone IS NULL THEN w
  ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END AS kept FROM d LEFT JOIN gone USING (r))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM left_over"""

# A turn is formatted as <s>[role], a line feed, the text, </s> and a line feed; a backslash follows each of < [ ] \\ inside.
CHAT = r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(11 + length(role) + length(text) + length(regexp_replace(role, '[^<\[\]\\]', '', 'g')) + length(regexp_replace(text, '[^<\[\]\\]', '', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""

ORACLES = {"op4_chat_formatting": CHAT, "op7_benchmark_decontamination": DECONTAMINATION, "op9_substring_dedup": SUBSTRING}
