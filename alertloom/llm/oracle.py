"""SQL for the queries that SQL can express."""

from __future__ import annotations

from alertloom.llm import chat, secret_scan
from alertloom.llm.queries import TRICKY

OP1 = r"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT l.v, r.c FROM r JOIN l ON r.doc_id = l.u)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, min(c) AS component_id, s.doc_id = min(c) AS kept
FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s
"""

OP13 = r"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s
  FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT l.v, r.c FROM r JOIN l ON r.doc_id = l.u)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, min(c) AS component_id FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s
"""

OP5 = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(s) AS text_sha256
FROM t WINDOW w AS (PARTITION BY s)
"""


def re2(pattern: str) -> str:
    """The rule's pattern in the other dialect, with ASCII letters in either case where it asks for any case."""
    if pattern.startswith("(?i)"):
        head, tail = pattern.removeprefix("(?i)").split(")", 1)
        pattern = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in head) + ")" + tail
    return pattern.replace("'", "''")


def op7() -> str:
    kinds = []
    for i, r in enumerate(secret_scan.RULES):
        p = re2(r.pattern)
        value = f"regexp_extract(hits[i], '{p}', {r.group})" if r.group else "hits[i]"
        kinds.append(f"""
  SELECT doc_id, {i} AS r, '{r.kind}' AS kind, n - length(hits[i]) AS s, n AS e FROM (
    SELECT doc_id, i, hits, sum(length(gaps[i]) + length(hits[i])) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM (
      SELECT doc_id, regexp_split_to_array(text, '{p}') AS gaps, regexp_extract_all(text, '{p}') AS hits,
             unnest(generate_series(1, len(regexp_extract_all(text, '{p}')))) AS i
      FROM documents WHERE regexp_matches(text, '{p}')))
  WHERE length({value}) >= {r.least}""")
    base = ", ".join(f"'{k}'" for k in secret_scan.BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secret_scan.BASE)
    return f"""
WITH f AS ({" UNION ALL ".join(kinds)}),
g AS (
  SELECT doc_id, {counts},
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r) FILTER (kind IN ({base})) AS b,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r) AS a
  FROM f GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secret_scan.BASE)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""


OP9 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{TRICKY}'), (-7, 1, 'assistant', '{TRICKY}')),
r AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS NOT DISTINCT FROM role AS goes_on,
         length(replace(replace(text, '\', '\b'), '<', '\l')) AS n,
         length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g')) AS m FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{chat.LEARNED}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{chat.LEARNED}'), '')) AS loss_sha256,
       sum(CASE WHEN goes_on THEN n + {len(chat.CUT)} ELSE n + m + {len(chat.HEAD + chat.HEAD_END + chat.END)} END)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""

#: The unsigned CRC-32 of an ASCII string {0}: 8 steps for each byte.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda k: 0::BIGINT)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP11 = rf"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         [coalesce(role, ''), coalesce(text, '')] AS x
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, {CRC32.format("c::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT ids.c, pos, x FROM ids JOIN t ON t.c = ids.c AND pos > h
  UNION ALL SELECT ids.c, pos, x FROM ids JOIN t ON t.c = ids.c - ids.c % 20 AND pos <= h),
p AS (SELECT ids.c, coalesce(list(x ORDER BY pos) FILTER (pos IS NOT NULL), []) AS p FROM ids LEFT JOIN r ON r.c = ids.c GROUP BY ids.c),
m AS (SELECT c, p[1:d] AS p, d, d = len(p) AS ends FROM (SELECT c, p, unnest(range(len(p) + 1)) AS d FROM p)),
n AS (
  SELECT p, d, min(c) AS c, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ends,
         (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d][2], '[^\x20\x09-\x0D]+')) END AS saved
  FROM m GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
s AS (
  SELECT u.p[1:a] AS p, sum(u.saved) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM n) u LEFT JOIN k ON k.p = u.p GROUP BY 1)
SELECT n.c AS conv_id, n.d AS depth, up.c AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children, s.leaves AS n_leaves,
       s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s ON s.p = n.p LEFT JOIN k ON k.p = n.p LEFT JOIN n up ON n.d > 0 AND up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
"""


def op12() -> str:
    """The programme as a recursion over the rows. A way is [cost, audit, repaired]; ways compare in this order."""
    way = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR)"

    def step(of: str, cost: str, letter: str, line: str = "NULL") -> str:
        """A way with one more edit; ``line`` is the turn it leaves."""
        more = f"{of}.r" if line == "NULL" else f"CASE WHEN {of}.r = '' THEN {line} ELSE {of}.r || chr(10) || {line} END"
        return f"CASE WHEN {of}.c IS NOT NULL THEN {{'c': {of}.c + {cost}, 'a': {of}.a || '{letter}', 'r': {more}}} END"

    def best(*ways: str) -> str:
        return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w.c IS NOT NULL))[1]::{way}"

    user = best("q.u", *(step(f"q.{s}", "3", "I", "'user:'") for s in "nsa"))
    keep, role = "3 * cut", "role || ':' || text"
    none = "NULL"
    allowed = lambda when, *ways: [f"CASE WHEN go = 0{when} THEN {w} END" for w in ways]
    return rf"""
WITH RECURSIVE
t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC32.format("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS k
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM t),
o AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last, substr(role, 1, 1) AS x, lag(substr(role, 1, 1)) OVER w AS before
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (
  SELECT *, (last = '')::INT AS blank, (last <> '' AND seen > 1)::INT AS dup, (last = '' OR seen > 1)::INT AS go,
         (last <> '' AND seen = 1 AND last NOT IN ('.', '!', '?'))::INT AS cut FROM o),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank) AS blank, sum(dup) AS duplicate, sum(cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || x NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM f GROUP BY conv_id),
z AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'r': ''}}::{way} AS n, {none}::{way} AS s, {none}::{way} AS u, {none}::{way} AS a
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i,
         {best(step("q.n", "4", "D"))},
         {best(step("q.s", "4", "D"), *allowed(" AND x = 's'", step("q.n", keep, "K", role)))},
         {best(step("q.u", "4", "D"), *allowed(" AND x = 'u'", *(step(f"q.{b}", keep, "K", role) for b in "nsa")),
               *allowed("", *(step(f"q.{b}", f"3 + {keep}", "R", "'user:' || text") for b in "nsa")))},
         {best(step("q.a", "4", "D"), *allowed(" AND x = 'a'", step("q.u", keep, "K", role)), *allowed("", step("q.u", f"3 + {keep}", "R", "'assistant:' || text")))}
  FROM (
    SELECT f.conv_id, f.i, x, go, cut, role, text, {{'n': v.n, 's': v.s, 'u': v.u, 'a': {best("v.a", step("v.u", "3", "I", "'assistant:'"))}}} AS q
    FROM (SELECT q.conv_id, q.i, q.n, q.s, {user} AS u, q.a FROM z q) v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i + 1)),
e AS (
  SELECT conv_id, i, {best("v.n", "v.a", step("v.u", "3", "I", "'assistant:'"))} AS w FROM (SELECT q.conv_id, q.i, q.n, {user} AS u, q.a FROM z q) v)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0) AS illegal, w.c AS cost, w.a AS audit, sha256(w.r) AS repaired_sha256
FROM e LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM e.conv_id WHERE e.i = coalesce(g.n, 0)
"""


ORACLE = {
    "op1_minhash_near_dedup": OP1,
    "op5_exact_dedup": OP5,
    "op7_secret_scan": op7(),
    "op9_chat_format": OP9,
    "op11_prefix_trie": OP11,
    "op12_conversation_repair": op12(),
    "op13_ngram_join": OP13,
}
