"""The registered queries stated in SQL for DuckDB, over the same tables.

Named common table expressions are put together per query; each lists the ones
it reads. They follow the definitions step by step and not the Spark plans: one
replacement after the other, windows over exploded rows, recursion for packing.
"""

from __future__ import annotations

import re

DIM = 64


def _letters(source: str) -> str:
    return f"translate(substr({source}, 4), '0123456789', 'abcdefghij')"


def _raw_id(source: str, doc_id: str) -> str:
    return f"'SRC.' || upper({_letters(source)}) || '2023' || {doc_id}"


def _normal_id(c: str) -> str:
    return f"lower(regexp_replace({c}, '[^a-zA-Z0-9]', '', 'g'))"


def _clean(c: str) -> str:
    """The corpus cleaning contract, one step per line."""
    steps = [
        "regexp_replace({}, '[+*]', ' ', 'g')",
        "replace({}, '—', '')",
        "regexp_replace({}, '#+', ' ', 'g')",
        "replace({}, ',', '')",
        "replace({}, '•', '')",
        "replace({}, '`s', '')",
        "replace({}, '''s', '')",
        "lower({})",
        "replace({}, '%', ' percent ')",
        "replace({}, '$', ' dollar ')",
        "regexp_replace({}, '[^a-z0-9(). ]', '', 'g')",
        "regexp_replace({}, '\\s+', ' ', 'g')",
        "regexp_replace({}, '\\((\\d+(?:\\.\\d+)?)\\)', '-\\1', 'g')",
        "regexp_replace({}, '\\(([^)0-9]+)\\)', '\\1', 'g')",
        "trim({})",
    ]
    for step in steps:
        c = step.format(c)
    return c


def _clean_query(c: str) -> str:
    for step in (
        "lower({})",
        "replace({}, '`s', '')",
        "replace({}, '''s', '')",
        "replace({}, '%', ' percent ')",
        "replace({}, '#', ' number ')",
        "replace({}, '$', ' dollar ')",
        "regexp_replace({}, '[^0-9a-z ]', '', 'g')",
        "trim({})",
    ):
        c = step.format(c)
    return c


def _words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '\\s+'), lambda w: w <> '')"


def _sentences(c: str) -> str:
    marked = f"regexp_replace(trim({c}), '([.!?])\\s+', '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"


def _embedded(source: str, key: str, text: str) -> str:
    """Rows ``key, embedding`` of a table's texts."""
    return f"""
    SELECT {key}, list_transform(counts, lambda n:
             CASE WHEN len(words) > 0 THEN n / sqrt(list_sum(list_transform(counts, lambda m: m * m))::DOUBLE)
                  ELSE 0 END::FLOAT) AS embedding
    FROM (SELECT {key}, words,
                 list_transform(range({DIM}), lambda d: len(list_filter(buckets, lambda b: b = d))) AS counts
          FROM (SELECT {key}, words,
                       list_transform(words, lambda w: ('0x' || substr(md5(w), 1, 4))::INT % {DIM}) AS buckets
                FROM (SELECT {key}, {_words(text)} AS words FROM {source})))"""


def _squared(a: str, b: str) -> str:
    return (
        f"list_sum(list_transform(list_zip({a}::DOUBLE[], {b}::DOUBLE[]), "
        "lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    )


# name -> (what it reads, body)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_corpus": (
        (),
        f"""SELECT {_raw_id('source', 'doc_id')} AS _id,
                   'src' || {_letters('source')} || ' ' || split_part(text, chr(10), 1) AS title,
                   text, doc_id AS pos
            FROM documents""",
    ),
    "dictionary": (
        (),
        f"""SELECT stem || {_letters('source')} AS company, 'src' || {_letters('source')} AS ticker,
                   2 * substr(source, 4)::BIGINT + n AS pos
            FROM (SELECT DISTINCT source FROM documents)
            CROSS JOIN (VALUES ('corp', 0), ('firm', 1)) AS stems(stem, n)""",
    ),
    "inverted": (("dictionary",), "SELECT ticker, arg_max(company, pos) AS company FROM dictionary GROUP BY ticker"),
    "titles": (
        ("raw_corpus", "inverted"),
        """SELECT r.pos, lower(r.title) AS title, i.ticker, i.company
           FROM raw_corpus r
           LEFT JOIN (SELECT pos, arg_min(word, place) AS word
                      FROM (SELECT pos, unnest(string_split(lower(title), ' ')) AS word,
                                   generate_subscripts(string_split(lower(title), ' '), 1) AS place
                            FROM raw_corpus)
                      WHERE word IN (SELECT ticker FROM inverted) GROUP BY pos) f ON r.pos = f.pos
           LEFT JOIN inverted i ON i.ticker = f.word""",
    ),
    "clean_titles": (
        ("titles",),
        """SELECT pos, CASE WHEN ticker IS NULL THEN title ELSE
             (SELECT string_agg(word, ' ' ORDER BY place) FROM
               (SELECT word, min(place) AS place FROM
                 (SELECT unnest(named) AS word, generate_subscripts(named, 1) AS place)
                WHERE word <> '' GROUP BY word)) END AS title
           FROM (SELECT pos, title, ticker, regexp_split_to_array(array_to_string(
                   list_transform(string_split(title, ' '),
                     lambda w: CASE WHEN w = ticker THEN company ELSE w END), ' '), '\\s+') AS named
                 FROM titles)""",
    ),
    "corpus": (
        ("raw_corpus", "clean_titles"),
        f"""SELECT {_normal_id('_id')} AS _id, t.title,
                   {_clean("(t.title || ' ' || r.text)")} AS text, r.pos
            FROM raw_corpus r JOIN clean_titles t ON r.pos = t.pos""",
    ),
    "marked": (
        ("corpus",),
        f"""SELECT *, n_tokens > 300 AS is_long
            FROM (SELECT *, len({_words('text')})::INT AS n_tokens FROM corpus)""",
    ),
    "sentence": (
        ("corpus",),
        f"""SELECT _id, generate_subscripts(s, 1)::INT - 1 AS sentence_no, unnest(s) AS sentence
            FROM (SELECT _id, {_sentences('text')} AS s FROM corpus)""",
    ),
    "long_sentence": (
        ("sentence", "marked"),
        "SELECT s.* FROM sentence s JOIN marked m ON s._id = m._id WHERE m.is_long",
    ),
    "sentence_vector": (
        ("long_sentence",),
        _embedded("long_sentence", "_id, sentence_no, sentence", "sentence"),
    ),
    "segment": (
        ("sentence_vector",),
        """SELECT _id, segment_no, string_agg(sentence, ' ' ORDER BY sentence_no) AS segment
           FROM (SELECT *, (sum(opens) OVER (PARTITION BY _id ORDER BY sentence_no))::INT AS segment_no
                 FROM (SELECT _id, sentence_no, sentence,
                              CASE WHEN round(list_cosine_similarity(embedding::DOUBLE[],
                                     (lag(embedding) OVER (PARTITION BY _id ORDER BY sentence_no))::DOUBLE[]), 9)
                                   < 0.55 THEN 1 ELSE 0 END AS opens
                       FROM sentence_vector))
           GROUP BY _id, segment_no""",
    ),
    "piece_words": (
        ("segment",),
        """SELECT _id, segment_no, flatten(list_transform(string_split(segment, ' '), lambda w:
                   CASE WHEN length(w) > 300
                        THEN list_transform(range(0, length(w), 300), lambda i: substr(w, i + 1, 300))
                        ELSE [w] END)) AS words
           FROM segment WHERE length(segment) > 300""",
    ),
    "packing": (
        ("piece_words",),
        """SELECT _id, segment_no, words, 1 AS i, words[1] AS cur, 0 AS piece_no, NULL::VARCHAR AS done
           FROM piece_words
           UNION ALL
           SELECT _id, segment_no, words, i + 1,
                  CASE WHEN fits THEN cur || ' ' || word
                       ELSE coalesce((list_filter(
                              list_transform(range(2, len(string_split(cur, ' ')) + 1),
                                lambda j: array_to_string(string_split(cur, ' ')[j:], ' ')),
                              lambda tail: length(tail) <= least(30, 299 - length(word))))[1] || ' ', '') || word END,
                  piece_no + CASE WHEN fits THEN 0 ELSE 1 END,
                  CASE WHEN NOT fits THEN cur END
           FROM (SELECT *, words[i + 1] AS word, length(cur) + 1 + length(words[i + 1]) <= 300 AS fits
                 FROM packing WHERE i < len(words))""",
    ),
    "piece": (
        ("segment", "packing"),
        """SELECT _id, segment_no, piece_no - 1 AS piece_no, done AS text FROM packing WHERE done IS NOT NULL
           UNION ALL SELECT _id, segment_no, piece_no, cur FROM packing WHERE i = len(words)
           UNION ALL SELECT _id, segment_no, NULL, segment FROM segment WHERE length(segment) <= 300""",
    ),
    "chunk": (
        ("piece", "marked"),
        """SELECT concat_ws('_', _id, segment_no, piece_no) AS _id, _id AS parent_id, text FROM piece
           UNION ALL SELECT _id, _id, text FROM marked WHERE NOT is_long""",
    ),
    "tagged": (
        ("chunk",),
        "SELECT *, regexp_extract(parent_id, '^([^0-9]*)', 1) AS ticker FROM chunk",
    ),
    "collection": (("tagged",), _embedded("tagged", "_id, parent_id, ticker, text", "text")),
    "item_document": (
        (),
        f"""SELECT DISTINCT item_id, doc_id, source FROM
              (SELECT item_id, unnest({_sentences('text')}) AS sentence FROM benchmark) b
              JOIN (SELECT doc_id, source, unnest({_sentences('text')}) AS sentence FROM documents) d
              USING (sentence)
            WHERE len({_words('sentence')}) >= 5""",
    ),
    "judgment": (
        ("item_document",),
        f"""SELECT 'q' || item_id AS query_id, {_normal_id(_raw_id('source', 'doc_id'))} AS corpus_id,
                   1::INT AS score FROM item_document""",
    ),
    "raw_query": (
        ("item_document",),
        f"""SELECT 'q' || b.item_id AS _id, b.item_id AS pos,
                   coalesce(CASE WHEN b.item_id % 2 = 0 THEN 'corp' ELSE 'src' END
                            || {_letters('source')} || ' ', '') || b.text AS text
            FROM benchmark b LEFT JOIN
              (SELECT item_id, arg_min(source, doc_id) AS source FROM item_document GROUP BY item_id) f
              ON b.item_id = f.item_id""",
    ),
    "query": (
        ("raw_query",),
        f"SELECT _id AS query_id, pos, {_clean_query('text')} AS query_text FROM raw_query",
    ),
    "query_word": (
        ("query",),
        """SELECT query_id, unnest(string_split(query_text, ' ')) AS word,
                  generate_subscripts(string_split(query_text, ' '), 1) AS place FROM query""",
    ),
    "routed": (
        ("query", "query_word", "dictionary", "inverted"),
        """SELECT query_id, pos, query_text,
                  CASE WHEN own_ticker IS NOT NULL AND by_name IS NULL
                       THEN array_to_string(list_transform(string_split(query_text, ' '),
                              lambda w: CASE WHEN w = own_ticker THEN own_company ELSE w END), ' ')
                       ELSE query_text END AS embed_text,
                  last_value(own_ticker IGNORE NULLS) OVER
                    (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ticker,
                  CASE WHEN by_name IS NOT NULL THEN 'company' WHEN own_ticker IS NOT NULL THEN 'ticker'
                       WHEN last_value(own_ticker IGNORE NULLS) OVER
                         (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) IS NULL THEN 'all'
                       ELSE 'carry' END AS route
           FROM (SELECT q.*, n.ticker AS by_name, coalesce(n.ticker, t.ticker) AS own_ticker, t.company AS own_company
                 FROM query q
                 LEFT JOIN (SELECT query_id, arg_min(ticker, place) AS ticker FROM query_word
                            JOIN dictionary ON word = company GROUP BY query_id) n ON q.query_id = n.query_id
                 LEFT JOIN (SELECT query_id, arg_min(ticker, place) AS ticker, arg_min(company, place) AS company
                            FROM query_word JOIN inverted ON word = ticker GROUP BY query_id) t
                   ON q.query_id = t.query_id)""",
    ),
    "asked": (
        ("routed", "judgment"),
        "SELECT * FROM routed WHERE query_id IN (SELECT query_id FROM judgment)",
    ),
    "asked_vector": (("asked",), _embedded("asked", "query_id, ticker", "embed_text")),
    "candidate": (
        ("asked_vector", "collection"),
        f"""SELECT * FROM (
              SELECT query_id, _id AS corpus_id, parent_id, text,
                     row_number() OVER (PARTITION BY query_id ORDER BY distance, _id) AS rank
              FROM (SELECT q.query_id, c._id, c.parent_id, c.text,
                           round({_squared('q.embedding', 'c.embedding')}, 9) AS distance
                    FROM asked_vector q JOIN collection c ON q.ticker = c.ticker OR q.ticker IS NULL))
            WHERE rank <= 100""",
    ),
    "weight": (
        ("tagged",),
        f"""SELECT word, ln(1 + (SELECT count(*) FROM tagged) / count(*)::DOUBLE) AS weight
            FROM (SELECT DISTINCT _id, unnest({_words('text')}) AS word FROM tagged) GROUP BY word""",
    ),
    "score": (
        ("candidate", "asked", "weight"),
        f"""SELECT c.query_id, c.parent_id, c.corpus_id, round(coalesce(s.score, 0), 6) AS score
            FROM candidate c LEFT JOIN
              (SELECT query_id, corpus_id, sum(weight) AS score
               FROM (SELECT DISTINCT query_id, unnest({_words('query_text')}) AS word FROM asked)
               JOIN (SELECT DISTINCT query_id, corpus_id, unnest({_words('text')}) AS word FROM candidate)
                 USING (query_id, word)
               JOIN weight USING (word) GROUP BY query_id, corpus_id) s
              ON c.query_id = s.query_id AND c.corpus_id = s.corpus_id""",
    ),
    "reranked": (
        ("score",),
        """SELECT * FROM (
             SELECT query_id, parent_id AS corpus_id, max(score) AS rerank_score,
                    row_number() OVER (PARTITION BY query_id ORDER BY max(score) DESC, parent_id)::INT AS rank
             FROM score GROUP BY query_id, parent_id)
           WHERE rank <= 10""",
    ),
    "vector": ((), "SELECT 'v' || vec_id AS _id, 'label' || label AS ticker, embedding, vec_id FROM embeddings"),
    "vector_judgment": (
        ("vector",),
        """SELECT a._id AS query_id, b._id AS corpus_id FROM vector a JOIN vector b
           ON a.ticker = b.ticker AND b.vec_id > a.vec_id AND b.vec_id <= a.vec_id + 20""",
    ),
    "turn": (
        (),
        f"SELECT conv_id, turn, role, {_clean('text')} AS text FROM conversations",
    ),
    "user_turn": (
        ("turn",),
        "SELECT 'u' || conv_id || 'x' || turn AS query_id, conv_id, turn, text FROM turn WHERE role = 'user'",
    ),
    "answer_turn": (
        ("turn",),
        "SELECT 'a' || conv_id || 'x' || turn AS corpus_id, conv_id, turn, text FROM turn WHERE role = 'assistant'",
    ),
    "answer": (
        ("user_turn", "answer_turn"),
        """SELECT u.query_id, a.corpus_id, u.text AS query_text, a.text FROM user_turn u
           JOIN answer_turn a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1""",
    ),
    "user_vector": (("user_turn",), _embedded("user_turn", "query_id", "text")),
    "answer_vector": (("answer_turn",), _embedded("answer_turn", "corpus_id", "text")),
    "run": (
        (),
        """SELECT branch || '_run_' || strftime(ts, '%Y%m%d_%H%M%S') AS run_name, branch, ts, value
           FROM (SELECT CASE WHEN lang = 'en' THEN 'main' ELSE lang END AS branch, avg(quality) AS value,
                        TIMESTAMP '2025-01-02 03:04:05' + to_minutes(substr(source, 4)::INT) AS ts
                 FROM documents JOIN labels USING (doc_id) GROUP BY source, lang)""",
    ),
    "decision": (
        ("run",),
        """SELECT run_name, CASE WHEN value > main_score THEN 'approved' ELSE 'skipped' END AS promotion_status,
                  branch, 'recall' AS metric, round(main_score, 6) AS main_score, round(value, 6) AS new_score
           FROM run CROSS JOIN
             (SELECT coalesce(max(value), 0)::DOUBLE AS main_score FROM run WHERE branch = 'main')
           WHERE branch NOT IN ('main', 'prod')""",
    ),
    "doc_diff": (
        (),
        """SELECT coalesce(m.name, c.name) AS name, m.md5 AS main_md5, c.md5 AS current_md5,
                  CASE WHEN c.name IS NULL THEN 'missing' WHEN m.md5 IS NULL THEN 'new'
                       WHEN m.md5 IS DISTINCT FROM c.md5 THEN 'changed' ELSE 'unchanged' END AS status
           FROM (SELECT 'doc-' || doc_id AS name, md5(text) AS md5 FROM documents) m
           FULL OUTER JOIN
             (SELECT 'doc-' || doc_id AS name,
                     md5(text || CASE WHEN toxic = 1 THEN ' [redacted]' ELSE '' END) AS md5
              FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 1) <> 0
              UNION ALL SELECT 'item-' || item_id, md5(text) FROM benchmark) c
           ON m.name = c.name""",
    ),
    "shard_diff": (
        (),
        """SELECT coalesce(m.name, c.name) AS name, m.md5 AS main_md5,
                  CASE WHEN c.name IS NULL THEN 'missing' WHEN m.md5 IS NULL THEN 'new'
                       WHEN m.md5 <> c.md5 THEN 'changed' ELSE 'unchanged' END AS status
           FROM (SELECT source || '/' || lang AS name, md5(count(*) || '/' || sum(h)) AS md5
                 FROM (SELECT source, lang, ('0x' || substr(md5(text), 1, 8))::BIGINT AS h FROM documents)
                 GROUP BY source, lang) m
           FULL OUTER JOIN
             (SELECT source || '/' || lang AS name, md5(count(*) || '/' || sum(h)) AS md5
              FROM (SELECT source, lang, ('0x' || substr(md5(text), 1, 8))::BIGINT AS h
                    FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
              GROUP BY source, lang) c
           ON m.name = c.name""",
    ),
    "setting": (
        (),
        """SELECT snapshot, source AS run_name, unnest(['corpus.documents', 'corpus.lang',
                    'splitter.max_chars', 'splitter.min_chars']) AS key,
                  unnest([count(*)::VARCHAR, max(lang), max(n_chars)::VARCHAR, min(n_chars)::VARCHAR]) AS value
           FROM (SELECT 'main' AS snapshot, * FROM documents
                 UNION ALL SELECT 'current', * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
           GROUP BY snapshot, source""",
    ),
}


def _top(distance: str, join: str, digits: int = 9, source: str = "vector") -> str:
    return f"""SELECT query_id, corpus_id, distance, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, corpus_id)::INT AS rank
        FROM (SELECT q._id AS query_id, c._id AS corpus_id, round({distance}, {digits}) AS distance
              FROM {source} q JOIN vector c ON {join}))
      WHERE rank <= 10"""


def _metrics(retrieved: str, judged: str, order: str = "", zero: bool = False) -> str:
    """Metrics of ``retrieved (query_id, corpus_id, rank)`` by its definition."""
    keep = "LEFT JOIN" if zero else "JOIN"
    return f"""
    SELECT j.query_id, round(coalesce(n_hits / n_retrieved, 0), 6) AS precision,
           round(coalesce(n_hits / n_relevant, 0), 6) AS recall,
           round(coalesce(gain / n_relevant, 0), 6) AS map
    FROM (SELECT query_id, count(DISTINCT corpus_id)::DOUBLE AS n_relevant FROM {judged} GROUP BY query_id) j
    {keep} (SELECT query_id, count(*)::DOUBLE AS n_retrieved, sum(hit)::DOUBLE AS n_hits,
                 sum(hit * so_far / place::DOUBLE) AS gain
          FROM (SELECT *, sum(hit) OVER w AS so_far, count(*) OVER w AS place
                FROM (SELECT r.query_id, r.corpus_id, min(r.rank) AS rank,
                             CASE WHEN count(j.corpus_id) > 0 THEN 1 ELSE 0 END AS hit
                      FROM {retrieved} r LEFT JOIN {judged} j
                        ON r.query_id = j.query_id AND r.corpus_id = j.corpus_id
                      GROUP BY r.query_id, r.corpus_id)
                WINDOW w AS (PARTITION BY query_id ORDER BY rank))
          GROUP BY query_id) m ON j.query_id = m.query_id {order}"""


_FILTERED = _top(_squared("q.embedding", "c.embedding"), "q.ticker = c.ticker")

# name -> (what it reads, statement)
STATEMENTS: dict[str, tuple[tuple[str, ...], str]] = {
    "clean_corpus": (("corpus",), "SELECT _id, title, text FROM corpus"),
    "clean_corpus_joined": (("corpus",), "SELECT _id, title, text FROM corpus"),
    "scan_quarantine": (
        (),
        f"""SELECT {_raw_id('source', 'doc_id')} AS _id, CASE WHEN lang = 'es' THEN 'aside' ELSE 'kept' END AS status,
                   CASE WHEN lang <> 'es' THEN md5(text) END AS md5 FROM documents""",
    ),
    "clean_corpus_as_coded": (
        ("raw_corpus", "titles"),
        f"""SELECT _id, title, {_clean("regexp_replace(title || ' ' || text, '\\s', ' ', 'g')")} AS text
            FROM (SELECT lower(r._id) AS _id, r.text, CASE WHEN t.ticker IS NULL THEN t.title ELSE
                    (SELECT string_agg(word, ' ' ORDER BY place) FROM
                      (SELECT word, min(place) AS place FROM
                        (SELECT unnest(t.named) AS word, generate_subscripts(t.named, 1) AS place)
                       WHERE word <> '' GROUP BY word)) END AS title
                  FROM raw_corpus r JOIN
                    (SELECT *, regexp_split_to_array(replace(title, ticker, company), '\\s+') AS named FROM titles) t
                    ON r.pos = t.pos)""",
    ),
    "clean_queries": (("raw_query",), f"SELECT _id, {_clean_query('text')} AS text FROM raw_query"),
    "normalize_judgments": (("judgment",), "SELECT query_id, corpus_id, score FROM judgment"),
    "derive_tag": (
        ("raw_corpus",),
        f"""SELECT _id, regexp_extract(lower(_id), '^([^0-9]*)', 1) AS ticker, split_part(_id, '_', 1) AS parent_id
            FROM (SELECT {_normal_id('_id')} || '_' || pos AS _id FROM raw_corpus)""",
    ),
    "scan_json_lines": (
        ("raw_corpus",),
        "SELECT _id, title, md5(text) AS md5, length(text)::INT AS n_chars FROM raw_corpus",
    ),
    "scan_judgments": (
        ("item_document",),
        f"""SELECT 'q' || item_id AS query_id, {_raw_id('source', 'doc_id')} AS corpus_id, 1::INT AS score
            FROM item_document""",
    ),
    "metrics_file": (
        ("vector", "vector_judgment"),
        _metrics(f"({_FILTERED})", "vector_judgment"),
    ),
    "run_log": (
        ("run",),
        "SELECT run_name, branch, 'recall' AS metric, round(value, 6) AS value FROM run",
    ),
    "invert_dictionary": (("inverted",), "SELECT ticker, company FROM inverted"),
    "route_entities": (
        ("routed",),
        "SELECT query_id, query_text, embed_text, ticker, route FROM routed",
    ),
    "route_entities_all": (
        ("routed",),
        """SELECT query_id, query_text, embed_text, CASE WHEN route IN ('company', 'ticker') THEN ticker END AS ticker,
                  CASE WHEN route IN ('company', 'ticker') THEN route ELSE 'all' END AS route FROM routed""",
    ),
    "route_entities_drop": (
        ("routed",),
        """SELECT query_id, query_text, embed_text, ticker, route FROM routed
           WHERE route IN ('company', 'ticker')""",
    ),
    "route_long_docs": (("marked",), "SELECT _id, n_tokens, is_long FROM marked"),
    "route_long_docs_skip": (
        ("marked",),
        """SELECT _id, n_tokens, is_long AND (row_number() OVER (PARTITION BY is_long, run ORDER BY pos)) % 2 = 1 AS is_long
           FROM (SELECT *, row_number() OVER (ORDER BY pos)
                        - row_number() OVER (PARTITION BY is_long ORDER BY pos) AS run FROM marked)""",
    ),
    "split_sentences": (("sentence",), "SELECT _id, sentence_no, sentence FROM sentence"),
    "semantic_segments": (("segment",), "SELECT _id, segment_no, segment FROM segment"),
    "pack_chunks": (("piece",), "SELECT _id, segment_no, coalesce(piece_no, -1)::INT AS piece_no, text FROM piece"),
    "assign_chunk_ids": (
        ("piece",),
        """SELECT concat_ws('_', _id, segment_no, piece_no) AS _id, _id AS parent_id,
                  length(text)::INT AS n_chars FROM piece""",
    ),
    "assign_chunk_ids_counter": (
        ("piece", "segment", "marked"),
        """SELECT p._id || '_' || (first + p.segment_no)::BIGINT || doc_no || p.segment_no
                    || coalesce(p.piece_no::VARCHAR, '') AS _id,
                  p._id AS parent_id, length(p.text)::INT AS n_chars
           FROM piece p JOIN
             (SELECT _id, row_number() OVER (ORDER BY pos) - 1 AS doc_no,
                     coalesce(sum(n) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
              FROM (SELECT m._id, m.pos, count(*) AS n FROM segment s JOIN marked m ON s._id = m._id
                    GROUP BY m._id, m.pos)) d ON p._id = d._id""",
    ),
    "dedupe_ids_union": (
        ("raw_corpus",),
        f"""SELECT CASE WHEN is_long THEN parent_id || '_long_' || pos WHEN n > 0 THEN parent_id || '_' || n
                        ELSE parent_id END AS _id,
                   parent_id, regexp_extract(parent_id, '^([^0-9]*)', 1) AS ticker, n_chars
            FROM (SELECT *, row_number() OVER (PARTITION BY parent_id, is_long ORDER BY pos) - 1 AS n
                  FROM (SELECT regexp_extract({_normal_id('_id')}, '^([^0-9]*)', 1) || '2023' AS parent_id, pos,
                               len({_words('text')}) > 300 AS is_long, length(text)::INT AS n_chars
                        FROM raw_corpus))""",
    ),
    "embed_hashed": (
        ("corpus",),
        f"""SELECT _id, bucket,
                   round((count(*) / sqrt(sum(count(*) * count(*)) OVER (PARTITION BY _id)))::FLOAT::DOUBLE, 6) AS weight
            FROM (SELECT _id, ('0x' || substr(md5(word), 1, 4))::INT % {DIM} AS bucket
                  FROM (SELECT _id, unnest({_words('text')}) AS word FROM corpus))
            GROUP BY _id, bucket""",
    ),
    "build_index": (
        ("tagged",),
        """SELECT ticker, count(*) AS n_chunks, count(DISTINCT parent_id) AS n_documents,
                  sum(length(text))::BIGINT AS n_chars FROM tagged GROUP BY ticker""",
    ),
    "collection_chunks": (("tagged",), "SELECT _id, parent_id, ticker, md5(text) AS md5 FROM tagged"),
    "collection_vectors": (
        ("collection",),
        """SELECT _id, bucket, round(weight::DOUBLE, 6) AS weight FROM
             (SELECT _id, generate_subscripts(embedding, 1)::INT - 1 AS bucket, unnest(embedding) AS weight FROM collection)
           WHERE weight > 0""",
    ),
    "collection_audit": (
        ("tagged",),
        f"""SELECT count(*) AS n_rows, 0::BIGINT AS n_null_key, 0::BIGINT AS n_null_parent_id, 0::BIGINT AS n_null_text,
                   0::BIGINT AS n_null_embedding, 0::BIGINT AS n_null_ticker, {DIM} AS least_size, {DIM} AS most_size,
                   count(*) - count(DISTINCT _id) AS n_repeated FROM tagged""",
    ),
    "repeated_ids": (
        (),
        "SELECT source || '-' || lang AS _id, count(*) AS n FROM documents GROUP BY source, lang HAVING count(*) > 1",
    ),
    "knn_filtered_topk": (("vector",), _FILTERED),
    "knn_blocks_topk": (("vector",), _FILTERED),
    "knn_pruned_topk": (("vector",), _FILTERED),
    "knn_unfiltered_topk": (("vector",), _top(_squared("q.embedding", "c.embedding"), "true")),
    "knn_cosine_topk": (
        ("vector",),
        _top("1 - list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[])", "q.ticker = c.ticker"),
    ),
    "knn_eval_metrics": (
        ("vector", "vector_judgment"),
        _metrics(f"({_FILTERED})", "vector_judgment"),
    ),
    "judged_queries": (("asked",), "SELECT DISTINCT query_text FROM asked"),
    "rerank_topk": (
        ("reranked",),
        "SELECT query_id, corpus_id, rerank_score, rank FROM reranked",
    ),
    "rerank_by_text": (
        ("score", "asked"),
        """SELECT query_id, corpus_id, rerank_score, rank FROM (
             SELECT first(s.query_id ORDER BY s.score DESC, s.query_id) AS query_id, s.parent_id AS corpus_id,
                    max(s.score) AS rerank_score,
                    row_number() OVER (PARTITION BY a.query_text ORDER BY max(s.score) DESC, s.parent_id)::INT AS rank
             FROM score s JOIN asked a ON s.query_id = a.query_id GROUP BY a.query_text, s.parent_id)
           WHERE rank <= 10""",
    ),
    "evaluate_retrieval": (
        ("reranked", "judgment"),
        _metrics("reranked", "judgment", "ORDER BY j.query_id"),
    ),
    "mean_retrieval_metrics": (
        ("reranked", "judgment"),
        f"""SELECT count(*) AS n_queries, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
                   round(avg(map), 6) AS map FROM ({_metrics("reranked", "judgment").replace(", 6)", ", 15)")})""",
    ),
    "both_mean_metrics": (
        ("reranked", "judgment"),
        f"""SELECT count(m.query_id) AS n_queries, count(*) AS n_judged,
                   {", ".join(f"round(avg(m.{c}), 6) AS {c}, round(avg(coalesce(m.{c}, 0)), 6) AS {c}_zero_filled" for c in ("precision", "recall", "map"))}
            FROM (SELECT DISTINCT query_id FROM judgment) j
            LEFT JOIN ({_metrics("reranked", "judgment").replace(", 6)", ", 15)")}) m USING (query_id)""",
    ),
    "conversation_retrieval": (
        ("user_vector", "answer_vector", "answer"),
        "WITH found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id "
        "ORDER BY distance, corpus_id) AS rank FROM (SELECT q.query_id, c.corpus_id, "
        f"round({_squared('q.embedding', 'c.embedding')}, 9) AS distance "
        "FROM user_vector q CROSS JOIN answer_vector c)) WHERE rank <= 10) "
        + _metrics("found", "answer", zero=True),
    ),
    "best_run_per_branch": (
        ("run",),
        """SELECT branch, run_name, round(value, 6) AS value FROM
             (SELECT *, row_number() OVER (PARTITION BY branch ORDER BY value DESC, run_name) AS n FROM run)
           WHERE n = 1""",
    ),
    "best_main_run": (
        ("run",),
        """SELECT run_name, branch, round(value, 6) AS value FROM run WHERE branch = 'main'
           ORDER BY value DESC, run_name LIMIT 1""",
    ),
    "promotion_decision": (("decision",), "SELECT * FROM decision"),
    "manifest_diff": (
        ("doc_diff",),
        """SELECT *, CASE status WHEN 'changed' THEN 'v1.1' WHEN 'new' THEN 'v1.0' END AS new_version
           FROM doc_diff""",
    ),
    "manifest_diff_buckets": (("doc_diff",), "SELECT * FROM doc_diff"),
    "file_manifest": (
        (),
        """SELECT 'doc-' || doc_id AS name, md5(coalesce(text, '')) AS md5 FROM documents
           UNION ALL SELECT 'item-' || item_id, NULL FROM benchmark""",
    ),
    "run_params": (
        ("setting", "shard_diff"),
        """SELECT run_name, key, value FROM setting WHERE snapshot = 'main'
           UNION ALL SELECT split_part(name, '/', 1), 'data.' || name, main_md5 FROM shard_diff WHERE status <> 'new'""",
    ),
    "decision_file": (("decision",), "SELECT * FROM decision"),
    "track_logs": (
        ("shard_diff",),
        """SELECT branch || '_run_' || ts AS run_name, ts AS timestamp, branch, sha1(branch || '_run_' || ts) AS commit,
                  'v1.0' AS base_main_version, changed_files, missing_files
           FROM (SELECT DISTINCT source, lang AS branch,
                        strftime(TIMESTAMP '2025-01-02 03:04:05' + to_minutes(substr(source, 4)::INT), '%Y%m%d_%H%M%S') AS ts
                 FROM documents JOIN labels USING (doc_id) WHERE lang NOT IN ('en', 'main', 'prod')) r
           JOIN (SELECT split_part(name, '/', 1) AS source,
                        coalesce(string_agg(name, ',' ORDER BY name) FILTER (status = 'changed'), '') AS changed_files,
                        coalesce(string_agg(name, ',' ORDER BY name) FILTER (status = 'missing'), '') AS missing_files
                 FROM shard_diff GROUP BY 1) d USING (source)""",
    ),
    "model_log": (
        ("setting",),
        """WITH every AS (
             SELECT run_name, key, max(value) FILTER (snapshot = 'main') AS main, max(value) FILTER (snapshot = 'current') AS current
             FROM (SELECT * FROM setting UNION ALL SELECT DISTINCT 'current', run_name, 'corpus.type', run_name FROM setting WHERE snapshot = 'current')
             GROUP BY run_name, key)
           SELECT run_name, split_part(key, '.', 1) AS section,
                  coalesce(string_agg(split_part(key, '.', 2) || '=' || current, ',' ORDER BY key) FILTER (current IS NOT NULL), '') AS current,
                  coalesce(string_agg(split_part(key, '.', 2) || '=' || main, ',' ORDER BY key) FILTER (main IS NOT NULL), '') AS main,
                  bool_or(main IS DISTINCT FROM current) AS differs,
                  max(current) FILTER (key = 'corpus.type') AS type, NULL::VARCHAR AS storage
           FROM every GROUP BY run_name, section""",
    ),
    "manifest_integrity": (
        ("doc_diff",),
        """SELECT bool_and(status = 'unchanged') AS data_integrity_passed,
                  count(*) FILTER (status = 'unchanged') AS n_unchanged,
                  count(*) FILTER (status = 'changed') AS n_changed,
                  count(*) FILTER (status = 'new') AS n_new,
                  count(*) FILTER (status = 'missing') AS n_missing FROM doc_diff""",
    ),
    "version_log": (
        ("shard_diff",),
        """SELECT split_part(name, '/', 1) AS source, 'v1.0' AS base_main_version,
                  coalesce(string_agg(name, ',' ORDER BY name) FILTER (status = 'changed'), '') AS changed_files,
                  coalesce(string_agg(name, ',' ORDER BY name) FILTER (status = 'new'), '') AS new_files,
                  coalesce(string_agg(name, ',' ORDER BY name) FILTER (status = 'missing'), '') AS missing_files,
                  coalesce(string_agg('v1.1', ',') FILTER (status = 'changed'), '') AS changed_versions,
                  bool_and(status = 'unchanged') AS data_integrity_passed,
                  NOT bool_and(status = 'unchanged') AS intentional_data_update,
                  CASE WHEN bool_and(status = 'unchanged') THEN 'v1.0'
                       ELSE 'Base version changed check data diff' END AS data_version
           FROM shard_diff GROUP BY split_part(name, '/', 1)""",
    ),
    "config_compare": (
        ("setting",),
        """SELECT run_name, key, m.value AS main, c.value AS current, m.value IS DISTINCT FROM c.value AS differs
           FROM (SELECT * FROM setting WHERE snapshot = 'main') m
           FULL OUTER JOIN (SELECT * FROM setting WHERE snapshot = 'current') c USING (run_name, key)""",
    ),
    "track_and_promote": (
        ("decision", "shard_diff"),
        """SELECT d.*, ok AS data_integrity_passed, NOT ok AS intentional_data_update,
                  CASE WHEN ok THEN 'v1.0' ELSE 'Base version changed check data diff' END AS data_version
           FROM decision d CROSS JOIN (SELECT bool_and(status = 'unchanged') AS ok FROM shard_diff)""",
    ),
    "udf_embed": (
        ("corpus",),
        """SELECT _id, length(text) AS n_chars, length(text) - length(replace(text, 'e', '')) AS n_e,
                  length(text) - length(replace(text, ' ', '')) AS n_spaces FROM corpus""",
    ),
    "udf_embed_batched": (
        ("corpus",),
        """SELECT _id, length(text) AS n_chars, length(text) - length(replace(text, 'e', '')) AS n_e,
                  length(text) - length(replace(text, ' ', '')) AS n_spaces FROM corpus""",
    ),
    "udf_score": (
        ("answer",),
        """SELECT query_id, corpus_id, round(length(query_text) / (length(text) + 1)::DOUBLE, 6) AS rerank_score
           FROM answer""",
    ),
    "udf_split": (
        ("raw_corpus",),
        """SELECT _id, generate_subscripts(s, 1)::INT - 1 AS sentence_no, unnest(s) AS sentence
           FROM (SELECT _id, list_filter(string_split(text, chr(10)), lambda s: s <> '') AS s FROM raw_corpus)""",
    ),
    "udf_size_split": (
        ("segment",),
        """SELECT _id, segment_no, CASE WHEN length(segment) > 300 THEN i ELSE -1 END::INT AS piece_no,
                  substr(segment, 300 * i + 1, 300) AS text
           FROM (SELECT *, unnest(range((length(segment) + 299) // 300)) AS i FROM segment)""",
    ),
    "udf_count": (
        ("corpus",),
        """SELECT _id, n_tokens, n_tokens > 300 AS is_long
           FROM (SELECT _id, ceil(length(text) / 4.0)::INT AS n_tokens FROM corpus)""",
    ),
}


def _closure(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _closure(PARTS[name][0], seen)
            seen.append(name)
    return seen


def statement(name: str) -> str:
    reads, body = STATEMENTS[name]
    parts = _closure(reads, [])
    if not parts:
        return body
    # a part that several others read is kept; recursion needs the keyword
    ctes = ",\n".join(f"{p} AS ({PARTS[p][1]})" for p in parts)
    if body.lstrip().startswith("WITH "):
        return f"WITH RECURSIVE {ctes},\n{body.lstrip()[5:]}"
    return f"WITH RECURSIVE {ctes}\n{body}"


EDITED = """SELECT d.* REPLACE (CASE WHEN toxic = 1 THEN text || ' [redacted]' ELSE text END AS text)
              FROM documents d LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 1) <> 0"""


def _on_edited(sql: str) -> str:
    """A statement over the edited documents; titles are their first lines, which redaction may end."""
    reads = re.sub(r"\bdocuments\b", "edited_documents", sql)
    return reads.replace("WITH RECURSIVE ", f"WITH RECURSIVE edited_documents AS ({EDITED}),\n", 1)


def statements() -> dict[str, str]:
    return {name: statement(name) for name in STATEMENTS} | {"collection_increment": _on_edited(statement("collection_chunks"))}
