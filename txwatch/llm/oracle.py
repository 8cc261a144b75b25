"""DuckDB twins of the corpus queries that SQL can express.

Substring removal, model scores, tokenizers, fingerprints by XXH64 and packing are tested
against brute force instead (tests/llm).
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ITEM_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS size,
         array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS key
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS key
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)
),
hits AS (SELECT doc_id, places.size, p, item FROM places JOIN windows USING (size, key)),
hit_words AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS spot FROM (SELECT DISTINCT doc_id, p, size FROM hits)) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _share_distance(rows: str) -> str:
    """Jensen-Shannon distance per document from rows (doc_id, lang, rank, c)."""
    return f"""
  SELECT doc_id, sqrt(greatest(sum(
           (CASE WHEN p > 0 THEN p * log2(p / ((p + r) / 2)) ELSE 0 END
            + CASE WHEN r > 0 THEN r * log2(r / ((p + r) / 2)) ELSE 0 END) / 2), 0)) AS far
  FROM (
    SELECT doc_id, CASE WHEN own > 0 THEN c / own ELSE 0 END AS p, CASE WHEN whole > 0 THEN ref / whole ELSE 0 END AS r
    FROM (SELECT doc_id, lang, rank, c, sum(c) OVER (PARTITION BY doc_id) AS own,
                 sum(c) OVER (PARTITION BY lang, rank) AS ref, sum(c) OVER (PARTITION BY lang) AS whole
          FROM {rows}))
  GROUP BY doc_id"""


def quality(k: int, min_words: int, min_chars: int, word_limit: float, class_limit: float) -> str:
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
grams AS (
  SELECT doc_id, p, array_to_string(w[p : p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) > 4)
),
often AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS spot FROM often) GROUP BY doc_id),
words AS (SELECT doc_id, lang, unnest(w) AS word FROM d),
common AS (
  SELECT lang, word, rank FROM (
    SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rank
    FROM words GROUP BY lang, word) WHERE rank <= {k}
),
counted AS (SELECT doc_id, rank, count(*) AS c FROM words JOIN common USING (lang, word) GROUP BY doc_id, rank),
hist AS (
  SELECT d.doc_id, d.lang, r.rank, coalesce(c, 0) AS c FROM d CROSS JOIN (SELECT unnest(range(1, {k} + 1)) AS rank) r
  LEFT JOIN counted ON counted.doc_id = d.doc_id AND counted.rank = r.rank
  UNION ALL
  SELECT d.doc_id, d.lang, {k} + 1, len(w) - coalesce((SELECT sum(c) FROM counted WHERE counted.doc_id = d.doc_id), 0) FROM d
),
r0 AS (SELECT doc_id, lang, text AS t0, regexp_replace(text, '[a-z]+', '', 'g') AS t1 FROM d),
r2 AS (SELECT *, regexp_replace(t1, '[ \x09-\x0D]+', '', 'g') AS t2 FROM r0),
r3 AS (SELECT *, regexp_replace(t2, '[A-Z]+', '', 'g') AS t3 FROM r2),
r4 AS (SELECT *, regexp_replace(t3, '[0-9]+', '', 'g') AS t4 FROM r3),
r5 AS (SELECT *, regexp_replace(t4, '[.,;:!?''"()-]+', '', 'g') AS t5 FROM r4),
r6 AS (SELECT *, regexp_replace(t5, '\pL+', '', 'g') AS t6 FROM r5),
classes AS (
  SELECT doc_id, lang, unnest(range(7)) AS rank, unnest([
    length(t0) - length(t1), length(t1) - length(t2), length(t2) - length(t3), length(t3) - length(t4),
    length(t4) - length(t5), length(t5) - length(t6), length(t6)]) AS c FROM r6
),
word_far AS ({_share_distance("hist")}),
class_far AS ({_share_distance("classes")}),
base AS (
  SELECT d.doc_id, d.text, len(w) AS n_words, coalesce(repeats.n, 0) AS n_repeat_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         list_filter(string_split(d.text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND NOT (n_words >= {min_words} AND word_far.far > {word_limit})
       AND NOT (length(text) >= {min_chars} AND class_far.far > {class_limit}) AS kept
FROM base JOIN word_far USING (doc_id) JOIN class_far USING (doc_id)"""


NEAREST = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def collocations(min_count: int, absorbed: int, top: int) -> str:
    return f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, p FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\n\x0B\x0C\r]')) AS p
    FROM documents WHERE text IS NOT NULL)
),
split AS (
  SELECT lang, piece, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces
),
words AS (
  SELECT lang, piece, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split
),
along AS (
  SELECT lang, w, lead(w) OVER reading AS w2, lead(w, 2) OVER reading AS w3 FROM words
  WINDOW reading AS (PARTITION BY piece ORDER BY i)
),
f1 AS (SELECT lang, w, count(*) AS f FROM along GROUP BY ALL),
f2 AS (SELECT lang, w, w2, count(*) AS f FROM along WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w, w2, w3, count(*) AS f FROM along WHERE w3 IS NOT NULL GROUP BY ALL),
longer AS (SELECT * FROM f3 WHERE f >= {min_count}),
cuts AS (
  SELECT p.lang, p.w || ' ' || p.w2 AS phrase, 1 AS k, p.f AS a, x.f AS l, y.f AS r
  FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.w = p.w JOIN f1 y ON y.lang = p.lang AND y.w = p.w2
  WHERE p.f >= {min_count}
    AND NOT EXISTS (SELECT 1 FROM longer t WHERE t.lang = p.lang AND t.w = p.w AND t.w2 = p.w2 AND 100 * t.f >= {absorbed} * p.f)
    AND NOT EXISTS (SELECT 1 FROM longer t WHERE t.lang = p.lang AND t.w2 = p.w AND t.w3 = p.w2 AND 100 * t.f >= {absorbed} * p.f)
  UNION ALL
  SELECT t.lang, t.w || ' ' || t.w2 || ' ' || t.w3, 1, t.f, x.f, y.f
  FROM longer t JOIN f1 x ON x.lang = t.lang AND x.w = t.w JOIN f2 y ON y.lang = t.lang AND y.w = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w || ' ' || t.w2 || ' ' || t.w3, 2, t.f, x.f, y.f
  FROM longer t JOIN f2 x ON x.lang = t.lang AND x.w = t.w AND x.w2 = t.w2 JOIN f1 y ON y.lang = t.lang AND y.w = t.w3
),
scored AS (
  SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang) t ON t.lang = r.lang
WHERE r.rank <= {top}
"""
