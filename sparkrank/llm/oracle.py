"""SQL statements of the queries that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, replace(replace(text, '<', '<\'), '[', '[\') AS body,
         replace(replace(role, '<', '<\'), '[', '[\') AS name
  FROM turns
), written AS (
  SELECT *, CASE role WHEN 'user' THEN '<s>[INST] ' || body || ' [/INST]'
                      WHEN 'assistant' THEN '[OUT]' || body || '</s>'
                      ELSE '[ROLE]' || name || '[/ROLE]' || body || '[END]' END AS formatted
  FROM escaped
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
"""

OP9 = r"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i : i + 9], ' ') AS w
  FROM items, unnest(range(1, greatest(len(words) - 8, 2))) AS r(i) WHERE len(words) > 0
), docs AS (
  SELECT doc_id, row_number() OVER () AS line,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), lengths AS (SELECT DISTINCT n FROM windows
), starts AS (
  SELECT line, i, l.n, array_to_string(words[i : i + l.n - 1], ' ') AS w
  FROM docs, lengths AS l, unnest(range(1, len(words) - l.n + 2)) AS r(i)
), found AS (
  SELECT line, i, n, item_id FROM starts JOIN windows USING (n, w)
), hit AS (
  SELECT line, count(DISTINCT j) AS n_hit
  FROM (SELECT DISTINCT line, i, n FROM found), unnest(range(i, i + n)) AS r(j) GROUP BY line
), named AS (
  SELECT line, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT line, item_id FROM found) GROUP BY line
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (line) LEFT JOIN named USING (line)
"""

OP7 = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS line, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT line, doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS w
  FROM docs, unnest(range(1, len(words) - 48)) AS r(i)
), least AS (
  SELECT w, min(doc_id) AS lo FROM starts GROUP BY w HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT line, j FROM starts JOIN least USING (w), unnest(range(i, i + 50)) AS r(j) WHERE doc_id > lo
), spread AS (
  SELECT line, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM docs
), kept AS (
  SELECT line, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS line_text FROM spread ANTI JOIN gone USING (line, j) GROUP BY line
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(line_text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (line)
"""

OP6 = r"""
WITH known AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), marked AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM known
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM marked
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), grams AS (
  SELECT lang, s.k AS size, words[i : i + s.k - 1] AS phrase
  FROM split, (SELECT unnest([1, 2, 3, 4]) AS k) AS s, unnest(range(1, len(words) - s.k + 2)) AS r(i)
), counted AS (
  SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY lang, size, phrase
), totals AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM counted WHERE size > 1 AND a >= 30
), cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, k, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
  FROM candidates AS c, unnest(range(1, c.size)) AS t(k)
  JOIN counted AS l ON l.lang = c.lang AND l.phrase = c.phrase[1 : k]
  JOIN counted AS r ON r.lang = c.lang AND r.phrase = c.phrase[k + 1 :]
), scored AS (
  SELECT lang, size, phrase, a, arg_min({'score': score, 'l': l, 'r': r}, (score, k)) AS cut FROM cuts GROUP BY lang, size, phrase, a
), inner_phrases AS (
  SELECT lang, phrase[i : i + s.k - 1] AS phrase, max(a) AS longer
  FROM candidates, (SELECT unnest([2, 3]) AS k) AS s, unnest(range(1, size - s.k + 2)) AS r(i) WHERE s.k < size GROUP BY ALL
), kept AS (
  SELECT s.lang, array_to_string(s.phrase, ' ') AS phrase, s.a, s.cut.l AS l, s.cut.r AS r, CAST(s.cut.score AS BIGINT) AS score
  FROM scored AS s LEFT JOIN inner_phrases AS i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE NOT coalesce(100 * i.longer::HUGEINT >= 80 * s.a::HUGEINT, false)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

OP12 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id, list_sort(CASE WHEN len(words) >= 4 THEN list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' ')))
                                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS s
  FROM docs
), named AS (
  SELECT doc_id, s, len(s) AS n, md5(array_to_string(s, chr(10))) AS c FROM sets
), classes AS (
  SELECT c, n, any_value(s) AS s, min(doc_id) AS lo FROM named WHERE n > 0 GROUP BY c, n
), elements AS (
  SELECT c, n, unnest(s) AS e FROM classes
), common AS (
  SELECT a.c AS a, b.c AS b, a.n AS na, b.n AS nb, count(*) AS k
  FROM elements AS a JOIN elements AS b ON a.e = b.e AND a.c < b.c AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n
), near AS (
  SELECT a, b FROM common WHERE 100 * k >= 85 * (na + nb - k)
), links AS (
  SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reached AS (
  SELECT c, c AS r FROM classes UNION SELECT reached.c, b FROM reached JOIN links ON a = r
), labels AS (
  SELECT reached.c, min(lo) AS component_id FROM reached JOIN classes ON classes.c = r GROUP BY reached.c
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, CASE WHEN n > 0 THEN component_id ELSE doc_id END AS component_id
FROM named LEFT JOIN labels ON labels.c = named.c AND n > 0
"""

OP13 = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS line, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), summed AS (
  SELECT *, CAST(len(words) AS BIGINT) AS n,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
             lambda x: list_concat([CAST(ascii(x) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS h
  FROM split
), placed AS (
  SELECT *, h % 10 = 0 AND n > 0 AS planted, (h // 10) % greatest(n, 1) AS a FROM summed
), docs AS (
  SELECT doc_id, line, n, CASE WHEN planted
    THEN list_transform(range(n), lambda i: words[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END + 1])
    ELSE words END AS words
  FROM placed
), spread AS (
  SELECT line, n, unnest(words) AS word, unnest(range(n)) AS i FROM docs
), equal AS (
  SELECT l.line, l.i, r.i - l.i AS q, l.i - row_number() OVER (PARTITION BY l.line, r.i - l.i ORDER BY l.i) AS island
  FROM spread AS l JOIN spread AS r ON l.line = r.line AND l.word = r.word AND r.i > l.i AND 3 * (r.i - l.i) <= l.n
), stretches AS (
  SELECT line, q, min(i) AS start, count(*) + q AS length FROM equal GROUP BY line, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (
  SELECT line, start, length, min(q) AS period FROM stretches GROUP BY line, start, length
), best AS (
  SELECT line, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         max(CAST(length AS HUGEINT) * 1000000000000000000 // period) AS most
  FROM runs GROUP BY line
), chosen AS (
  SELECT line, arg_min(r, (start, period)) AS r
  FROM (SELECT line, start, period, {'start': start, 'length': length, 'period': period} AS r FROM runs JOIN best USING (line)
        WHERE CAST(length AS HUGEINT) * 1000000000000000000 // period = most) GROUP BY line
), gone AS (
  SELECT DISTINCT line, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT line, string_agg(word, ' ' ORDER BY i) AS collapsed FROM spread ANTI JOIN gone USING (line, i) GROUP BY line
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, r.start AS start, r.length AS length, r.period AS period,
       CAST(1000 * r.length // r.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (line) LEFT JOIN chosen USING (line) LEFT JOIN kept USING (line)
"""

STATEMENTS: dict[str, str] = {"op3_chat": OP3, "op6_warc": OP6, "op7_substrings": OP7, "op9_decontamination": OP9, "op11_collocations": OP11, "op12_jaccard": OP12, "op13_periodic": OP13}
