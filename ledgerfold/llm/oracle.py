"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from ledgerfold.llm.queries import QUERY_STEP, URL_RULES

_BLANKS = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

TOP_K = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
WHERE place <= 5
"""

MIX = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS turn
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, [3, 1, 2][(turn - 1) % 3 + 1] AS weight, source_size * 2 AS cap FROM sources
), waiting AS (
  SELECT *,
    CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
      - coalesce(sum(cap) OVER before, 0) AS left_total,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS left_weight
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, cap * left_weight <= left_total * weight AS is_capped FROM waiting
), level AS (
  SELECT arg_min(left_total, (cap / weight, turn)) AS level_total, arg_min(left_weight, (cap / weight, turn)) AS level_weight
  FROM capped WHERE NOT is_capped
), targets AS (
  SELECT source, source_size,
    CASE WHEN is_capped THEN CAST(cap AS DOUBLE) ELSE CAST(level_total AS DOUBLE) * weight / CAST(level_weight AS DOUBLE) END AS target,
    CAST(CAST('0x' || substr(md5('42:' || coalesce(source, '')), 1, 4) AS INTEGER) AS DOUBLE) / 65536 AS shift
  FROM capped LEFT JOIN level ON true
), ranked AS (
  SELECT sized.doc_id, sized.size, t.source_size, t.target, t.shift,
    CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 2.0::DOUBLE) ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY sized.source ORDER BY sized.size DESC, doc_id) AS place
  FROM sized JOIN targets t ON sized.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(least(floor(shift + place * rate) - floor(shift + (place - 1) * rate), 2) AS BIGINT) * size AS taken
FROM ranked
"""

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
URLS = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}), parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
    row_number() OVER () AS n
  FROM pages
), judged AS (
  SELECT n, page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM parts LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM judged WHERE place = 1
"""

EXACT = f"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_BLANKS}', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id,
  min(doc_id) OVER same AS keep_id,
  count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept,
  text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""

REPEATS = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
), starts AS (
  SELECT d, doc_id, words, unnest(range(1, len(words) - 48)) AS first FROM docs WHERE len(words) >= 50
), hashed AS (
  SELECT d, doc_id, first, md5(array_to_string(words[first:first + 49], ' ')) AS sequence FROM starts
), judged AS (
  SELECT d, first, doc_id > min(doc_id) OVER (PARTITION BY sequence) AS gone FROM hashed
), removed AS (
  SELECT d, list_distinct(flatten(list(range(first, first + 50)))) AS places FROM judged WHERE gone GROUP BY d
), places AS (
  SELECT d, unnest(places) AS place FROM removed
), word_rows AS (
  SELECT d, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs
), left_over AS (
  SELECT w.d, string_agg(word, ' ' ORDER BY w.place) AS kept, count(*) AS n_kept
  FROM word_rows w LEFT JOIN places p ON w.d = p.d AND w.place = p.place WHERE p.place IS NULL GROUP BY w.d
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN left_over USING (d)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKED = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS d, regexp_extract_all({_LOWERED}, '{_TERM}') AS terms FROM documents
), sized AS (
  SELECT d, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0
), corpus AS (
  SELECT CAST(count(*) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS length FROM sized
), counted AS (
  SELECT d, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, unnest(terms) AS term FROM sized) GROUP BY d, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * total + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM counted GROUP BY term), corpus
), asked AS (
  SELECT i, item_id, unnest(list_distinct(regexp_extract_all({_LOWERED}, '{_TERM}'))) AS term
  FROM (SELECT *, row_number() OVER () AS i FROM benchmark)
), scored AS (
  SELECT i, item_id, d,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * total) // length)))) AS BIGINT) AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN sized USING (d), corpus
  GROUP BY i, item_id, d
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM (
  SELECT i, item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS place
  FROM scored JOIN sized USING (d) WHERE score > 0
) WHERE place <= 10
"""

PHRASES = f"""
WITH cut AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM cut
), starts AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS first FROM pieces
), phrases AS (
  SELECT lang, size, array_to_string(words[first:first + size - 1], ' ') AS phrase
  FROM starts, range(1, 6) AS sizes(size) WHERE first + size - 1 <= len(words)
), counted AS (
  SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM counted WHERE f >= 100 AND size >= 2
), cuts AS (
  SELECT c.lang, c.size, c.phrase, a, k, p.f AS l, q.f AS r, n,
    (1000 * a::HUGEINT * n::HUGEINT) // (p.f::HUGEINT * q.f::HUGEINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN counted p ON p.lang = c.lang AND p.phrase = array_to_string(c.words[1:k], ' ')
  JOIN counted q ON q.lang = c.lang AND q.phrase = array_to_string(c.words[k + 1:c.size], ' ')
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS turn FROM cuts) WHERE turn = 1
), kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates b WHERE b.lang = s.lang AND b.size > s.size AND 100 * b.a >= 100 * s.a
      AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
) WHERE rank <= 2000
"""


def llm_sql() -> dict[str, str]:
    return {
        "op1_exact_topk": TOP_K,
        "op2_source_mix": MIX,
        "op4_url_filter": URLS,
        "op10_exact_dedup": EXACT,
        "op11_substring_dedup": REPEATS,
        "op12_lexical_search": RANKED,
        "op13_collocations": PHRASES,
    }
