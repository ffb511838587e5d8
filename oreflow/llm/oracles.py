"""SQL for the queries that SQL can express on whole tables."""

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

PREFERENCES = """
WITH rows AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    '<|' || replace(role, '<|', '< |') || '|>' || chr(10) AS head, replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM rows
), last AS (
  SELECT conv_id, max(pos) AS pos, arg_max(text, pos) AS answer, arg_max(head || body, pos) AS written, arg_max(body, pos) AS body
  FROM numbered WHERE role = 'assistant' GROUP BY conv_id
), pairs AS (
  SELECT a.conv_id, a.pos, a.answer = b.answer AS same, a.written AS chosen, b.written AS rejected, a.body AS a_body, b.body AS b_body
  FROM last a JOIN last b ON b.conv_id = xor(a.conv_id, 1)
), before AS (
  SELECT p.conv_id, string_agg(n.head || n.body, '' ORDER BY n.pos) AS prompt
  FROM pairs p JOIN numbered n ON n.conv_id = p.conv_id AND (n.pos < p.pos OR (p.same AND n.pos = p.pos))
  GROUP BY p.conv_id
)
SELECT p.conv_id AS pair_id, CAST(CASE WHEN same THEN pos ELSE pos - 1 END AS BIGINT) AS n_prompt_turns, coalesce(prompt, '') AS prompt,
  CASE WHEN same THEN '' ELSE chosen END AS chosen, CASE WHEN same THEN '' ELSE rejected END AS rejected,
  CASE WHEN same THEN '' ELSE '14:' || length(chosen) END AS chosen_mask,
  CASE WHEN same THEN '' ELSE '14:' || length(rejected) END AS rejected_mask, same AS identical
FROM pairs p LEFT JOIN before USING (conv_id)
"""

SUBSTRINGS = f"""
WITH texts AS (SELECT doc_id, {WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, pos, array_to_string(words[pos : pos + 49], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM texts WHERE len(words) >= 50)
), firsts AS (SELECT win, min(doc_id) AS least FROM windows GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS place
  FROM windows JOIN firsts USING (win) WHERE doc_id > least
), placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.place) AS kept, count(*) AS n
  FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.place = p.place WHERE g.place IS NULL GROUP BY p.doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""

ALIKE_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

PASSAGES = f"""
WITH texts AS (SELECT doc_id, {ALIKE_WORDS} AS words FROM documents),
listed AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {ALIKE_WORDS} AS words FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(words[pos : pos + 9], ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos FROM listed WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM wanted),
windows AS (
  SELECT doc_id, pos, size, array_to_string(words[pos : pos + size - 1], ' ') AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM texts, sizes WHERE len(words) >= size)
), hits AS (SELECT doc_id, pos, w.size, item_id FROM windows w JOIN wanted USING (size, win)),
places AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(p.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, p.n IS NOT NULL AS contaminated
FROM texts t LEFT JOIN places p USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

PARITY_JOIN = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos : pos + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS pos FROM texts WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), parts AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, t.doc_id) AS component_id
FROM texts t LEFT JOIN sizes USING (doc_id) LEFT JOIN parts USING (doc_id)
"""

SUFFIX_ORDER = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (
  SELECT doc_id, since, substr(h, 2 * since + 1, 2798) AS h
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399, 1000)) AS since FROM texts WHERE length(h) >= 800)
), strings AS (
  SELECT doc_id, since + pos AS pos, md5(substr(h, 2 * pos - 1, 800)) AS own
  FROM (SELECT doc_id, since, h, unnest(range(1, length(h) // 2 - 398)) AS pos FROM chunks)
), twice AS (SELECT own FROM strings GROUP BY own HAVING count(*) > 1),
hits AS (
  SELECT doc_id, pos, pos > coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 400, 0) AS first
  FROM strings SEMI JOIN twice USING (own)
), spans AS (
  SELECT doc_id, min(pos) AS a, max(pos) + 400 AS b
  FROM (SELECT *, sum(CAST(first AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM hits)
  GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS since FROM spans
), kept AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(h, 2 * since - 1, 2 * (a - since)), '' ORDER BY a) AS before
  FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last, 1) - 1))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


def _assigned(books: str) -> str:
    """The nearest entry of every part, the lowest at ties, and its distance."""
    distance = "list_sum(list_transform(list_zip(x.part, y.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""
  SELECT vec_id, p, any_value(part) AS part, min(far)[2] AS entry, min(far)[1] AS far FROM (
    SELECT x.vec_id, x.p, x.part, [CAST({distance} AS BIGINT), y.entry] AS far FROM parts x JOIN {books} y ON x.p = y.p
  ) GROUP BY vec_id, p"""


def _moved(coded: str, books: str) -> str:
    """Floor of the mean of each entry's parts; an entry without a part stays."""
    return f"""
  SELECT p, entry, coalesce(new, part) AS part FROM {books} LEFT JOIN (
    SELECT p, entry, list(mean ORDER BY k) AS new FROM (
      SELECT p, entry, k, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS mean
      FROM (SELECT p, entry, unnest(part) AS v, unnest(range(len(part))) AS k FROM {coded}) GROUP BY p, entry, k
    ) GROUP BY p, entry
  ) USING (p, entry)"""


VECTOR_CODES = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS part FROM (SELECT vec_id, v, unnest(range(16)) AS p FROM kept)
), books0 AS MATERIALIZED (
  SELECT p, part, entry FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept) USING (vec_id) WHERE entry < 64
), coded0 AS MATERIALIZED ({_assigned("books0")}
), books1 AS MATERIALIZED ({_moved("coded0", "books0")}
), coded1 AS MATERIALIZED ({_assigned("books1")}
), books2 AS MATERIALIZED ({_moved("coded1", "books1")}
), coded2 AS MATERIALIZED ({_assigned("books2")}
), codes AS (
  SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM coded2 GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, entry)) AS digest FROM books2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM codes JOIN kept USING (vec_id), books
"""
