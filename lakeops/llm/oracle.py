"""The operators that SQL can express, in SQL, written apart from the DataFrame code.

Without SQL are sharding (random draws), BPE, page text, suffixes and components, which tests
hold against plain versions, and language, which they hold against held-out labels.
"""

from lakeops.llm.licenses import PHRASES, TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_VISIBLE = r"'[^\x20\x09-\x0D]+'"


def _values(*rows: tuple[str, ...]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)


_PHRASES = _values(*((phrase, label) for phrase, label in PHRASES.items()))
_TEMPLATES = _values(*((label, t.text, t.needs, t.bars) for label, t in TEMPLATES.items()))

_LICENSES = f"""
WITH d AS (
  SELECT doc_id, t, regexp_extract_all(t, {_WORDS}) AS ws
  FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
), phrases AS (
  SELECT label, string_split(phrase, ' ') AS pw
  FROM (VALUES {_PHRASES}) AS v(phrase, label)
), places AS (
  SELECT doc_id, label, unnest(list_filter(range(1, len(ws) + 1), lambda i: ws[i:i + len(pw) - 1] = pw)) - 1 AS place
  FROM d, phrases
), base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY doc_id
), templates AS (
  SELECT label, list_distinct(tws) AS tw, (len(tws) + len(tws) // 4)::BIGINT AS size,
         regexp_extract_all(needs, {_WORDS}) AS needs, regexp_extract_all(bars, {_WORDS}) AS bars
  FROM (SELECT *, regexp_extract_all(lower(text), {_WORDS}) AS tws
        FROM (VALUES {_TEMPLATES}) AS v(label, text, needs, bars))
), found AS (
  SELECT doc_id, ws, label, tw, size, needs, bars,
         unnest(list_filter(range(1, len(ws) + 1), lambda i: list_contains(tw, ws[i]))) AS i
  FROM d, templates WHERE len(list_intersect(ws, tw)) * 100 >= 80 * len(tw)
), blocks AS (
  SELECT doc_id, label, tw, needs, bars, ws[i:i + size - 1] AS bw FROM found
), contained AS (
  SELECT doc_id, label, max(len(list_intersect(bw, tw))::DOUBLE / len(tw)) AS part
  FROM blocks
  WHERE len(list_intersect(bw, tw)) * 100 >= 80 * len(tw) AND len(list_intersect(bw, bars)) = 0
    AND list_has_all(bw, needs)
  GROUP BY doc_id, label
), every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM contained) GROUP BY doc_id
), best AS (SELECT doc_id, max(part) AS part FROM contained GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id)"""

_QUALITY = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_VISIBLE}) AS ws
  FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)
), again AS (
  SELECT doc_id, i FROM grams
  WHERE (doc_id, gram) IN (SELECT (doc_id, gram) FROM grams GROUP BY doc_id, gram HAVING count(*) > 1)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, {_VISIBLE}) GROUP BY doc_id
), counts AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols > 0.3 * n_words OR word_chars < 2.0 * n_words OR word_chars > 20.0 * n_words AS odd
  FROM counts
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed OR odd) AS failed
  FROM judged GROUP BY source
), prior AS (
  SELECT avg(failed / n) AS m, var_pop(failed / n) AS v FROM hosts
), shares AS (
  SELECT source, CASE WHEN v > 0 THEN (failed + m * greatest(1, m * (1 - m) / v - 1))
                                      / (n + greatest(1, m * (1 - m) / v - 1)) ELSE m END AS share
  FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       share > 0.5 AS host_rejected, NOT base_failed AND NOT share > 0.5 AS kept
FROM judged JOIN shares ON judged.source IS NOT DISTINCT FROM shares.source"""

_CONTROL = r"""'([<\[])(\\*)(\|(?:turn|text|end|image|audio|document)\|>|/?s>|/?INST\])'"""


def _escaped(column: str) -> str:
    return rf"length(regexp_replace({column}, {_CONTROL}, '\1\\\2\3', 'g'))"


_CHAT = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), told AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS every,
         coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('<|turn|><|text|><|end|>') + {_escaped("role")} + {_escaped("text")})::BIGINT AS formatted_chars
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(every) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars, 0::BIGINT AS n_attachments, 0::BIGINT AS expanded_tokens
FROM told"""

_DECONTAMINATION = f"""
WITH items AS (
  SELECT item_id, ws, least(len(ws), 10) AS size
  FROM (SELECT item_id, regexp_extract_all({_LOWER}, {_WORDS}) AS ws FROM benchmark) WHERE len(ws) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS w
  FROM (SELECT item_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM items)
), docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS ws FROM documents
), spans AS (
  SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS w
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows))
), hits AS (SELECT doc_id, i, size, item_id FROM spans JOIN windows USING (size, w)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits)
  GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)"""

_INTERACTION = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), {_VISIBLE}) AS ws
  FROM documents
), marks AS (
  SELECT doc_id, part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
         100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM d
), marked AS (
  SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END,
                      CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END,
                      CASE WHEN e THEN 'E' ELSE '' END) AS fails,
         coalesce(good, false) AS good, coalesce(bad, false) AS bad
  FROM marks LEFT JOIN (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good,
                               bool_or(coalesce(toxic = 1, false)) AS bad
                        FROM labels GROUP BY doc_id) USING (doc_id)
), counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad
  FROM marked GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), told AS (
  SELECT *, contains(fails, letter) AS failing,
         len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND before <> '' AND fails <> '' AS gone
  FROM counted, steps
), totals AS (
  SELECT part, filter_order, step::INT AS step, letter,
         coalesce(sum(n) FILTER (WHERE NOT failing AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE failing AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE failing AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = letter), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE failing AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(bad) FILTER (WHERE failing AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM told GROUP BY part, filter_order, step, letter
)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM totals"""

_JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_VISIBLE}) AS ws FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS s
  FROM d
), tokens AS (SELECT doc_id, unnest(s) AS t FROM sets
), shared AS (SELECT t, row_number() OVER () AS k FROM tokens GROUP BY t HAVING count(*) > 1
), places AS MATERIALIZED (SELECT doc_id, k FROM tokens JOIN shared USING (t)
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM places x JOIN places y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL
), near AS (
  SELECT a, b FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 90 * (len(x.s) + len(y.s) - n)
), links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN least ON a = doc_id"""

# The checksum is taken bit by bit; its polynomial is a fixed value.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT,
  list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
  lambda c, x: list_reduce(list_prepend(xor(c, x), list_transform(range(8), lambda i: i::UBIGINT)),
    lambda y, i: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))), 4294967295::UBIGINT)"""

_TRIE = f"""
WITH rows AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, ({_CRC32} % 6)::BIGINT AS h
  FROM (SELECT DISTINCT conv_id FROM rows)
), turns AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN rows r ON r.conv_id = base AND pos <= h
  UNION ALL
  SELECT conv_id, 1, pos, role, text FROM convs JOIN rows USING (conv_id) WHERE pos > h
), lists AS (
  SELECT conv_id, list(role || chr(31) || text ORDER BY part, pos) FILTER (WHERE role IS NOT NULL) AS seq
  FROM convs LEFT JOIN turns USING (conv_id) GROUP BY conv_id
), whole AS (SELECT conv_id, coalesce(seq, []) AS seq FROM lists
), prefixes AS (
  SELECT conv_id, d AS depth, seq[1:d] AS prefix, d = len(seq) AS is_end
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM whole)
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256,
         CASE WHEN depth = 0 THEN 0
              ELSE (count(*) - 1) * (length(prefix[-1]) - strpos(prefix[-1], chr(31))) END AS saved
  FROM prefixes GROUP BY prefix, depth
), kids AS (
  SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), full_nodes AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (prefix)
), below AS (
  SELECT prefix[1:k] AS prefix, sum(saved)::BIGINT AS saved_tokens,
         count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT prefix, saved, n_children, unnest(range(0, depth + 1)) AS k FROM full_nodes) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
       n.ends_sha256
FROM full_nodes n JOIN below USING (prefix)
LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]"""

ORACLE: dict[str, str] = {
    "op1_licenses": _LICENSES,
    "op2_quality": _QUALITY,
    "op4_chat": _CHAT,
    "op5_decontamination": _DECONTAMINATION,
    "op11_interaction": _INTERACTION,
    "op12_jaccard": _JACCARD,
    "op13_trie": _TRIE,
}
