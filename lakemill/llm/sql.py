"""DuckDB SQL for the queries whose whole result SQL can express."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ESCAPED = r"regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g')"
_ROLE = _ESCAPED.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")

OP3_CHAT = f"""
WITH t AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, k, ['user', 'assistant'][k + 1], '<|im_end|><|im_start|>assistant ok' FROM range(2) AS x(k)),
f AS (SELECT *, '<|im_start|>' || {_ROLE} || chr(10) || {_ESCAPED.format('text')} || '<|im_end|>' || chr(10) AS formatted FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, formatted)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars, 0::BIGINT AS expanded_tokens
FROM f GROUP BY conv_id"""

_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7_DECONTAMINATE = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
p AS MATERIALIZED (
  SELECT DISTINCT item, size, array_to_string(w[k:k + size - 1], ' ') AS words
  FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM (SELECT *, least(10, len(w)) AS size FROM i WHERE len(w) > 0))),
s AS MATERIALIZED (
  SELECT doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM p) WHERE len(w) >= size)),
h AS MATERIALIZED (SELECT doc_id, k, size, item FROM s JOIN p USING (size, words)),
n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS pos FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""

# strings of 100 bytes are compared by their MD5
OP8_SUBSTRINGS = """
WITH b AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS h, octet_length(h) AS n FROM documents),
s AS (SELECT doc_id, pos, md5_number(h[pos + 1:pos + 100]) AS string FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS pos FROM b WHERE n >= 100)),
r AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY string ORDER BY doc_id, pos) AS k FROM s) WHERE k > 1),
g AS (SELECT doc_id, pos, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run
  FROM (SELECT doc_id, pos, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100, true)::INT AS fresh FROM r)),
runs AS MATERIALIZED (SELECT doc_id, min(pos) AS a, max(pos) + 100 AS z FROM g GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS x, a AS y FROM runs
  UNION ALL SELECT doc_id, coalesce(max(z), 0), any_value(n) FROM b LEFT JOIN runs USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(CASE WHEN y > x THEN hex(h[x + 1:y]) ELSE '' END, '' ORDER BY x) AS h FROM gaps JOIN b USING (doc_id) GROUP BY doc_id),
c AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT b.doc_id, b.n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM b JOIN kept USING (doc_id) LEFT JOIN c USING (doc_id)"""

OP11_DEBRUIJN = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, k, md5_number(array_to_string(w[k:k + 12], ' ')) AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13)),
r AS (SELECT doc_id, k FROM (SELECT doc_id, k, min(doc_id) OVER (PARTITION BY words) AS first FROM s) WHERE first < doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS pos FROM r),
l AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
a AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t FROM a ANTI JOIN g USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN l USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP13_PHRASES = rf"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f AS MATERIALIZED (
  SELECT lang, size, w[k:k + size - 1] AS words, count(*) AS f
  FROM (SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS k FROM p, range(1, 5) AS s(size) WHERE len(w) >= size)
  GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE size > 1 AND f >= 30),
cut AS (SELECT lang, size, words, f AS a, unnest(range(1, size)) AS k FROM c),
s AS (
  SELECT c.lang, c.words, c.size, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM cut AS c JOIN f AS x ON x.lang = c.lang AND x.words = c.words[:c.k] JOIN f AS y ON y.lang = c.lang AND y.words = c.words[c.k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inside AS (
  SELECT lang, part, max(f) AS longer
  FROM (SELECT lang, f, words[k:k + m - 1] AS part FROM (SELECT lang, f, words, m, unnest(range(1, size - m + 2)) AS k FROM c, range(2, 4) AS x(m) WHERE m < size))
  GROUP BY lang, part),
t AS (
  SELECT b.lang, array_to_string(b.words, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM b LEFT JOIN inside AS i ON i.lang = b.lang AND i.part = b.words
  WHERE coalesce(100::HUGEINT * longer < 80::HUGEINT * a, true))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM t JOIN n USING (lang) QUALIFY rank <= 2000"""

ORACLE_SQL = {"op3_chat": OP3_CHAT, "op7_decontaminate": OP7_DECONTAMINATE, "op8_substrings": OP8_SUBSTRINGS, "op11_debruijn": OP11_DEBRUIJN, "op13_phrases": OP13_PHRASES}
