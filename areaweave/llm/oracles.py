"""The same results as SQL, where SQL can express them."""

ORACLES = {}

ORACLES["op2_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(role || text) + length(regexp_replace(role || text, '[^\\#<:]', '', 'g'))) AS BIGINT)
    AS formatted_chars
FROM t GROUP BY conv_id
"""

ORACLES["op4_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, text, list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM d),
g AS (SELECT k, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
h AS (SELECT k, i, count(*) OVER (PARTITION BY k, words[i], words[i + 1], words[i + 2]) AS n FROM g),
r AS (SELECT k, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM h WHERE n > 1) GROUP BY k),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(list_filter(words, lambda x: x IN (STOPS))) AS n_stop,
             len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t\n\x0B\f\r]*[-*•‣]'))) AS n_bullets,
             len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\n\x0B\f\r]*$'))) AS n_dots
      FROM w LEFT JOIN r USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND word_chars >= 2 * n_words AND word_chars <= 20 * n_words
    AND n_symbols / n_words <= 0.1 AND n_stop / n_words >= 0.06
    AND n_dup_lines / n_lines <= 0.5 AND n_bullets / n_lines <= 0.9 AND n_dots / n_lines <= 0.3 AS kept
FROM m
"""

ORACLES["op9_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id,
                  sha1(coalesce(html, '')) AS digest, url,
                  regexp_replace(regexp_replace(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), '#.*$', '') AS rest
           FROM pages)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(digest, CAST(i // 4 AS INT) * 5 + 1, 5) AS INT) >> CAST(5 * (3 - i % 4) AS INT)) & 31 AS INT) + 1, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
  array_to_string(list_reverse(string_split(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www\.|:\d+$', '', 'g'),
    '.')), ',') || ')' || regexp_extract(rest, '^[^/?]*(.*)$', 1) AS url_key,
  strftime(make_timestamp((1700000000 + coalesce(page_id, 0) % 100000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM p
"""

ORACLES["op5_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
             lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
        lambda x: x <> '') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 12], ' ') AS win, len(w[s:s + 12]) AS n
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
x AS (SELECT k, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
      FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM i))),
h AS (SELECT k, s, n, item_id FROM x JOIN i USING (n, win)),
p AS (SELECT k, count(DISTINCT pos) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS pos FROM h) GROUP BY k),
m AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY k)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (k) LEFT JOIN m USING (k)
"""

ORACLES["op12_conversation_repair"] = r"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') AS k,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
c AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(place, ''),
        lambda x: list_concat([CAST(ord(x) AS BIGINT)], list_transform(range(8), lambda y: CAST(256 AS BIGINT)))))),
        lambda r, x: CASE WHEN x < 256 THEN xor(r, x) WHEN r & 1 = 1 THEN xor(r >> 1, CAST(3988292384 AS BIGINT)) ELSE r >> 1 END),
        CAST(4294967295 AS BIGINT)) % 20 AS fault FROM o),
m AS (SELECT k, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM (SELECT *, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) FROM c WHERE fault <> 0)),
p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
        left(role, 1) AS a FROM m),
f AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS again,
        NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, lag(a) OVER (PARTITION BY k ORDER BY i) AS before FROM p),
r AS (SELECT k, i, role, text, a, blank OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS t FROM f),
d AS (
  SELECT DISTINCT k, CAST(0 AS BIGINT) AS i, {'c': 0, 'a': '', 'o': ''} AS s0, {'c': 1000000000, 'a': '', 'o': ''} AS s1,
    {'c': 3, 'a': 'I', 'o': chr(10) || 'user:'} AS s2, {'c': 6, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s3 FROM r
  UNION ALL
  SELECT k, i2, n0, n1,
    list_min([n2, {'c': n3.c + 3, 'a': n3.a || 'I', 'o': n3.o || chr(10) || 'user:'},
      {'c': n0.c + 3, 'a': n0.a || 'I', 'o': n0.o || chr(10) || 'user:'}, {'c': n1.c + 3, 'a': n1.a || 'I', 'o': n1.o || chr(10) || 'user:'}]),
    list_min([n3, {'c': n2.c + 3, 'a': n2.a || 'I', 'o': n2.o || chr(10) || 'assistant:'},
      {'c': n0.c + 6, 'a': n0.a || 'II', 'o': n0.o || chr(10) || 'user:' || chr(10) || 'assistant:'},
      {'c': n1.c + 6, 'a': n1.a || 'II', 'o': n1.o || chr(10) || 'user:' || chr(10) || 'assistant:'}])
  FROM (SELECT k, i2, n0,
      list_min([n1, {'c': kept0 + CASE WHEN a = 's' THEN 0 ELSE 1000000000 END, 'a': s0.a || 'K', 'o': s0.o || own}]) AS n1,
      list_min([n2, {'c': kept0 + ku, 'a': s0.a || eu, 'o': s0.o || ou}, {'c': kept1 + ku, 'a': s1.a || eu, 'o': s1.o || ou},
        {'c': kept3 + ku, 'a': s3.a || eu, 'o': s3.o || ou}]) AS n2,
      list_min([n3, {'c': kept2 + ka, 'a': s2.a || ea, 'o': s2.o || oa}]) AS n3
    FROM (SELECT d.*, r.i AS i2, r.a, chr(10) || r.role || ':' || r.text AS own,
        {'c': s0.c + 4, 'a': s0.a || 'D', 'o': s0.o} AS n0, {'c': s1.c + 4, 'a': s1.a || 'D', 'o': s1.o} AS n1,
        {'c': s2.c + 4, 'a': s2.a || 'D', 'o': s2.o} AS n2, {'c': s3.c + 4, 'a': s3.a || 'D', 'o': s3.o} AS n3,
        CASE WHEN r.gone THEN 1000000000 ELSE r.t END AS keep, s0.c + keep AS kept0, s1.c + keep AS kept1, s2.c + keep AS kept2, s3.c + keep AS kept3,
        CASE WHEN r.a = 'u' THEN 0 ELSE 3 END AS ku, CASE WHEN r.a = 'u' THEN 'K' ELSE 'R' END AS eu,
        CASE WHEN r.a = 'a' THEN 0 ELSE 3 END AS ka, CASE WHEN r.a = 'a' THEN 'K' ELSE 'R' END AS ea,
        chr(10) || CASE WHEN r.a = 'u' THEN r.role ELSE 'user' END || ':' || r.text AS ou,
        chr(10) || CASE WHEN r.a = 'a' THEN r.role ELSE 'assistant' END || ':' || r.text AS oa
      FROM d JOIN r ON r.k = d.k AND r.i = d.i + 1) x) z),
e AS (SELECT k, list_min([s0, s3]) AS best FROM d QUALIFY i = max(i) OVER (PARTITION BY k)),
g AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || a NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY k)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, k FROM o) LEFT JOIN g USING (k) LEFT JOIN e USING (k)
"""


def _license_sql() -> str:
    """Base phrases by place, templates as regular expressions over words with a space after each."""
    from areaweave.llm.license_scan import PHRASES, TEMPLATES, as_regex, compile_template, read_template

    def same(words: list[str]) -> str:
        return " AND ".join(f"w[i + {n + 1}] = '{word}'" for n, word in enumerate(words))

    places = ", ".join(f"list_filter(range(len(w)), lambda i: {same(text.split())}) AS {label}_at" for text, label in PHRASES)
    found = ", ".join(f"regexp_matches(joined, ' {as_regex(read_template(text))}')" for text in TEMPLATES.values())
    names = list(TEMPLATES)
    sizes = [len(compile_template(label, text).mandatory) for label, text in TEMPLATES.items()]
    base = ", ".join(f"CASE WHEN len({label}_at) > 0 THEN '{label}' END" for _, label in sorted(PHRASES, key=lambda p: p[1]))
    base_size = ", ".join(f"CASE WHEN len({label}_at) > 0 THEN {len(text.split())} ELSE 0 END" for text, label in PHRASES)
    every = " || ".join(f"{label}_at" for _, label in PHRASES)
    return f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
             lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n_words, {places}, ' ' || array_to_string(w, ' ') || ' ' AS joined FROM d),
m AS (SELECT *, {every} AS places, list_filter([{base}], lambda x: x IS NOT NULL) AS base, [{found}] AS found FROM p)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_concat(base, list_filter({names}, lambda x, i: found[i]))), ',') AS labels,
  list_max(list_concat([{base_size}], list_transform({sizes}, lambda x, i: CASE WHEN found[i] THEN x ELSE 0 END))) AS longest,
  longest / (longest + 1) AS score
FROM m
"""


ORACLES["op11_license_scan"] = f"SELECT * EXCLUDE longest FROM ({_license_sql()})"


def _stops() -> str:
    from areaweave.llm.quality_rules import STOP_FORMS

    return ", ".join(f"'{x}'" for x in dict.fromkeys(STOP_FORMS))


ORACLES["op4_quality_rules"] = ORACLES["op4_quality_rules"].replace("STOPS", _stops())
