"""DuckDB SQL for the queries that SQL can express; each takes the plain way, pair by pair."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from edgeloom.llm.license_scan import NOTICES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _shingles(words: str) -> str:
    """Distinct runs of five words of a list; none for fewer words."""
    return (f"list_distinct([array_to_string({words}[i:i + 4], ' ') "
            f"for i in range(1, len({words}) - 3)])")


_LOWER = f"translate(COALESCE(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"

_CONTAINED = """
d AS (SELECT doc_id, unnest({shingles}) AS s FROM (SELECT doc_id, {doc_words} AS w FROM documents)),
q AS (SELECT {item}, len(s) AS n, unnest(s) AS s
      FROM (SELECT {item}, {shingles} AS s FROM (SELECT {item}, {item_words} AS w FROM {items})))
SELECT doc_id, {item}, CAST(n AS BIGINT) AS n_shingles, COUNT(*) AS n_found,
       CAST(COUNT(*) AS DOUBLE) / n AS containment
FROM d JOIN q USING (s) GROUP BY doc_id, {item}, n HAVING COUNT(*) >= 0.8 * n
"""

_LETTERS = r"regexp_extract_all(lower(COALESCE(text, '')), '[\p{L}\p{N}]+')"
_NOT_SPACE = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

_NOTICE_ROWS = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in NOTICES.items())

_SAID = _text("\\### Assistant: </turn> ok")
_MORE = r"len(regexp_extract_all({}, '<\\*\|'))"

#: The 256 remainders of CRC-32, each from its own eight shifts.
_CRC_TABLE = """
crc_table AS (SELECT list(c ORDER BY i) AS remainders FROM (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i)))"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; needs ``crc_table`` in the same FROM."""
    byte = f"CAST('0x' || hex(encode({text}))[2 * i - 1:2 * i] AS BIGINT)"
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: {byte})"
    step = "xor(c >> 8, remainders[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: {step}), 4294967295)"


_WORDS = r"regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op2_license_scan": f"WITH notices(license, text) AS (VALUES {_NOTICE_ROWS}),"
    + _CONTAINED.format(shingles=_shingles("w"), doc_words=_LETTERS, item_words=_LETTERS,
                        item="license", items="notices"),
    "op8_chat_format": f"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', {_SAID}), (-7, 1, 'assistant', {_SAID})
)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(SUM(length('<|turn|><|text|><|end|>') + length(role) + length(text)
                + {_MORE.format('role')} + {_MORE.format('text')}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
""",
    "op10_decontamination": "WITH " + _CONTAINED.format(
        shingles=_shingles("w"), doc_words=_NOT_SPACE, item_words=_NOT_SPACE,
        item="item_id", items="benchmark") + f"""
UNION SELECT doc_id, item_id, 1, 1, 1.0
FROM (SELECT doc_id, ' ' || array_to_string({_NOT_SPACE}, ' ') || ' ' AS said FROM documents)
JOIN (SELECT item_id, {_NOT_SPACE} AS w FROM benchmark WHERE len({_NOT_SPACE}) BETWEEN 1 AND 4)
  ON contains(said, ' ' || array_to_string(w, ' ') || ' ')""",
    "op11_substring_dedup": f"""
WITH texts AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM texts)),
earliest AS (SELECT s, min(doc_id) AS first_doc FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM windows JOIN earliest USING (s) WHERE first_doc < doc_id),
kept AS (
  SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS left_over, count(*) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts)
  ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - COALESCE(n, 0) AS n_removed,
       sha256(COALESCE(left_over, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
""",
    "op12_prefix_trie": f"""
WITH {_CRC_TABLE.strip()},
own AS (
  SELECT conv_id, list({{'role': COALESCE(role, ''), 'text': COALESCE(text, '')}}
                       ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
parts AS (
  SELECT conv_id, turns, conv_id - conv_id % 5 AS family,
         {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own, crc_table),
rebuilt AS (
  SELECT parts.conv_id, list_concat(COALESCE(base.turns, [])[1:h], parts.turns[h + 1:]) AS turns
  FROM parts LEFT JOIN own AS base ON base.conv_id = family),
members AS (
  SELECT conv_id, len(turns) = d AS here, turns[1:d] AS node, d
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE here), '') AS ends,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * octet_length(encode(node[d].text)) END AS saved
  FROM members GROUP BY node, d),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT nodes.*, COALESCE(n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
subtrees AS (
  SELECT node[1:d] AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1)
SELECT c.conv_id, c.depth, up.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted AS c JOIN subtrees AS s USING (node)
LEFT JOIN nodes AS up ON c.depth > 0 AND up.node = c.node[1:c.depth - 1]
""",
    "op13_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE.strip()},
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(COALESCE(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[a-z\u00C0-\u00FF]+')) AS run
        FROM documents) GROUP BY doc_id, run),
marked AS (SELECT run, n, {_crc32("doc_id || ':' || run")} AS h FROM runs, crc_table),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM marked GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
gaps AS (
  SELECT word, n, left(word, i) || '*' || substr(word, i + 2) AS gap, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps AS a JOIN gaps AS b USING (gap) WHERE a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps AS g JOIN words AS w ON g.rest = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps AS g JOIN words AS w ON g.rest = w.word),
ranked AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place FROM near),
forms AS (
  SELECT word, CASE WHEN other_n >= 2 * n THEN other END AS form, n, COALESCE(n_near, 0) AS n_near,
         CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN (SELECT * FROM ranked WHERE place = 1) USING (word)),
chains AS (
  SELECT word, word AS reached FROM forms
  UNION ALL SELECT chains.word, form FROM chains JOIN forms ON forms.word = reached WHERE form IS NOT NULL)
SELECT forms.word, forms.form, reached AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN chains USING (word) JOIN forms AS last ON last.word = reached WHERE last.form IS NULL
""",
}
