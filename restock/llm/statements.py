"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from restock.llm.spot_signatures import ANCHORS

# Value patterns without look-behind: the sign before a credential is a group of its own.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"[0-9a-f]+"
_CREDENTIAL = (
    r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----|://[^\s/:@]{1,64}:[^\s/:@]{4,128}@"
    r"|(^|[^A-Za-z0-9_+/=-])(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|[A-Za-z0-9+/_=-]{24,})"
)
_KINDS = [("assign", _ASSIGN, 1, 8), ("access", _ACCESS, 0, 16), ("hex", _HEX, 0, 32), ("credential", _CREDENTIAL, 0, 16)]


def _matches(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    lead = f"regexp_extract_all(text, '{pattern}', 1)" if kind == "credential" else "CAST([] AS VARCHAR[])"
    value = "substr(whole, length(lead) + 1)" if group == 0 else "value"
    return f"""
SELECT r, doc_id, owner, {rank} AS rank, '{kind}' AS kind, ends - size + length(lead) AS s, ends AS e, {value} AS value
FROM (SELECT *, length(whole) AS size, CAST(SUM(length(gap) + length(whole)) OVER (PARTITION BY r ORDER BY i) AS BIGINT) AS ends
      FROM (SELECT r, doc_id, owner, i, gaps[i] AS gap, wholes[i] AS whole, vals[i] AS value, COALESCE(leads[i], '') AS lead
            FROM (SELECT *, UNNEST(range(1, len(wholes) + 1)) AS i
                  FROM (SELECT r, doc_id, owner, regexp_extract_all(text, '{pattern}') AS wholes, {lead} AS leads,
                               regexp_extract_all(text, '{pattern}', {group}) AS vals, string_split_regex(text, '{pattern}') AS gaps
                        FROM texts WHERE regexp_matches(text, '{pattern}')))))
WHERE length({value}) >= {least}"""


SECRET_SCAN = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, COALESCE('=' || source, '-') AS owner, COALESCE(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_matches(rank, *kind) for rank, kind in enumerate(_KINDS))}),
held AS (
  SELECT value, COUNT(DISTINCT owner) AS owners, COUNT(DISTINCT (owner, doc_id)) AS repos FROM found GROUP BY value),
known AS (SELECT found.*, owners, repos, owners < 3 AS live FROM found JOIN held USING (value)),
shown AS (
  SELECT * FROM known k WHERE rank < 3 OR (
    live AND NOT EXISTS (SELECT 1 FROM known b WHERE b.r = k.r AND b.rank < 3 AND b.s < k.e AND k.s < b.e)
    AND (regexp_matches(value, '^(-----BEGIN|://)')
         OR (length(regexp_replace(value, '[^0-9]', '', 'g')) >= 3 AND length(regexp_replace(value, '[^A-Za-z]', '', 'g')) >= 3
             AND len(list_distinct(string_split(value, ''))) >= 10)))),
per_row AS (
  SELECT r, COUNT(*) FILTER (kind = 'assign') AS n_assign, COUNT(*) FILTER (kind = 'access') AS n_access,
         COUNT(*) FILTER (kind = 'hex') AS n_hex, COUNT(*) FILTER (kind = 'credential') AS n_credential,
         COUNT(*) FILTER (live) AS n_live, COUNT(*) FILTER (NOT live) AS n_example, MAX(owners) AS most_owners, MAX(repos) AS most_repos,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM shown GROUP BY r)
SELECT doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
       sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans, COALESCE(n_credential, 0) AS n_credential,
       COALESCE(n_live, 0) AS n_live, COALESCE(n_example, 0) AS n_example, COALESCE(most_owners, 0) AS most_owners,
       COALESCE(most_repos, 0) AS most_repos
FROM texts LEFT JOIN per_row USING (r)
"""

CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(text, '') AS text, COALESCE(role, '') AS role
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, UNNEST([0, 1]), UNNEST(['user', 'assistant']), '\### Assistant: </turn> ok')),
sized AS (
  SELECT *, length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g'))
            + CASE WHEN regexp_matches(role, '^[a-z]') THEN 0 ELSE 1 END + length('### ' || ': ' || ' </turn>') + 1 AS chars
  FROM turns)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_WORDLESS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ANCHORS = "[" + ", ".join(f"'{word}'" for word in ANCHORS) + "]"
_SIXTY_BITS = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"

SPOT_SIGNATURES = f"""
WITH given AS (SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS text FROM documents),
paired AS (
  SELECT r, doc_id, text, length(text) AS n,
         COALESCE(LEAD(r) OVER o, FIRST_VALUE(r) OVER o) AS next_r, COALESCE(LEAD(text) OVER o, FIRST_VALUE(text) OVER o) AS next_text
  FROM given WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, text)),
texts AS (
  SELECT r, 'own' AS kind, text FROM paired
  UNION ALL SELECT r, 'edited', substr(text, 1, n - n // 2) || substr(next_text, 1, n // 2) FROM paired),
words AS (
  SELECT r, kind, text, list_filter(string_split_regex(lower(text), '{_WORDLESS}'), lambda w: w <> '') AS words FROM texts),
marked AS (
  SELECT *, list_filter(words, lambda w: NOT list_contains({_ANCHORS}, w)) AS content,
         list_filter(range(1, len(words) + 1), lambda i: list_contains({_ANCHORS}, words[i])) AS spots
  FROM words),
chained AS (
  SELECT *, list_sort(list_distinct(list_transform(
           list_filter(range(1, len(spots) + 1), lambda j: spots[j] - j + 3 <= len(content)),
           lambda j: {_SIXTY_BITS.format("concat_ws(' ', words[spots[j]], content[spots[j] - j + 1], content[spots[j] - j + 2], content[spots[j] - j + 3])")}))) AS chains
  FROM marked),
signed AS (
  SELECT r, kind, text, CASE WHEN len(chains) > 0 THEN chains
                             WHEN len(words) > 0 THEN [{_SIXTY_BITS.format("array_to_string(words, ' ')")}] ELSE [] END AS sigs
  FROM chained),
pairs AS (
  SELECT p.doc_id, p.n, e.text AS edited, a.sigs AS own, e.sigs AS changed, b.sigs AS following
  FROM paired p JOIN signed a ON a.r = p.r AND a.kind = 'own' JOIN signed e ON e.r = p.r AND e.kind = 'edited'
  JOIN signed b ON b.r = p.next_r AND b.kind = 'own'),
likened AS (
  SELECT *, len(list_intersect(own, changed)) AS with_changed, len(list_intersect(own, following)) AS with_following FROM pairs)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256,
       md5(array_to_string(own, ',')) AS fingerprint, md5(array_to_string(changed, ',')) AS edited_fingerprint,
       CASE WHEN own = changed THEN 1.0 ELSE with_changed / (len(own) + len(changed) - with_changed) END AS near_edited,
       CASE WHEN own = following THEN 1.0 ELSE with_following / (len(own) + len(following) - with_following) END AS near_next,
       len(own) AS n_signatures,
       CASE WHEN len(own) = 0 THEN -1 ELSE CAST(floor(ln(len(own)) / ln(1 / 0.8) + 1e-9) AS INTEGER) END AS length_partition,
       CASE WHEN own = following THEN TRUE ELSE with_following >= 0.8 * (len(own) + len(following) - with_following) - 1e-9 END AS alike_next
FROM likened
"""

_SMALL = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

FP_TREE_SEARCH = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex({_SMALL}, '{_WORDLESS}'), lambda w: w <> '') AS terms FROM documents),
items AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(list_filter(string_split_regex({_SMALL}, '{_WORDLESS}'), lambda w: w <> '')) AS terms
  FROM benchmark),
total AS (SELECT COUNT(*) AS n_docs, CAST(SUM(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
held AS (SELECT r, doc_id, len(terms) AS n, UNNEST(terms) AS term FROM docs),
tfs AS (SELECT r, doc_id, n, term, COUNT(*) AS tf FROM held GROUP BY ALL),
dfs AS (SELECT term, COUNT(*) AS df FROM tfs GROUP BY term),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM dfs, total),
asked AS (SELECT i, item_id, UNNEST(terms) AS term FROM items),
gained AS (
  SELECT i, item_id, r, doc_id, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS gain
  FROM asked JOIN tfs USING (term) JOIN weighed USING (term), total),
scored AS (SELECT i, item_id, r, doc_id, CAST(SUM(gain) AS BIGINT) AS score FROM gained GROUP BY i, item_id, r, doc_id),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM numbered WHERE rank <= 50
"""

# CRC-32 of a number's decimal form, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

PREFIX_TRIE = f"""
WITH given AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations),
keyed AS (SELECT conv_id, turn, role, md5(length(role) || ':' || role || text) || printf('%08X', length(text)) AS key FROM given),
own AS (SELECT conv_id, list(key ORDER BY turn NULLS FIRST, role, key) AS turns FROM keyed GROUP BY conv_id),
asked AS (
  SELECT own.*, COALESCE({_CRC32} % 6, 0) AS h, conv_id - conv_id % 100 AS head_id FROM own),
rebuilt AS (
  SELECT a.conv_id, list_concat(COALESCE(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS path
  FROM asked a LEFT JOIN own b ON b.conv_id = a.head_id),
opened AS (SELECT conv_id, path, UNNEST(range(0, len(path) + 1)) AS depth FROM rebuilt),
placed AS (
  SELECT conv_id, depth, path[1:depth] AS prefix, CASE WHEN depth > 0 THEN path[1:depth - 1] END AS parent,
         CASE WHEN depth > 0 THEN CAST('0x' || substr(path[depth], 33) AS BIGINT) ELSE 0 END AS chars
  FROM opened),
counted AS (
  SELECT prefix, parent, depth, chars, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs FROM placed GROUP BY prefix, parent, depth, chars),
nodes AS (SELECT *, (n_convs - 1) * chars AS saved FROM counted),
children AS (SELECT parent AS prefix, COUNT(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
marked AS (SELECT nodes.*, COALESCE(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)),
above AS (SELECT *, UNNEST(range(0, depth + 1)) AS up FROM marked),
covered AS (SELECT prefix[1:up] AS prefix, n_children, saved FROM above),
subtrees AS (
  SELECT prefix, COUNT(*) FILTER (n_children = 0) AS n_leaves, SUM(saved) AS saved_tokens FROM covered GROUP BY prefix),
ends AS (SELECT path AS prefix, sha256(string_agg(conv_id, ',' ORDER BY conv_id)) AS ends_sha256 FROM rebuilt GROUP BY path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       COALESCE(ends_sha256, sha256('')) AS ends_sha256
FROM marked n JOIN subtrees s USING (prefix) LEFT JOIN ends USING (prefix)
LEFT JOIN marked p ON p.prefix = n.parent AND n.depth > 0
"""

STATEMENTS = {
    "op1_secret_scan": SECRET_SCAN,
    "op9_chat_format": CHAT_FORMAT,
    "op11_fp_tree_search": FP_TREE_SEARCH,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_spot_signatures": SPOT_SIGNATURES,
}
