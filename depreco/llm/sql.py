"""DuckDB SQL that states what the operators' queries return, independently of how Spark gets there."""

#: Lower-case A-Z only.
_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

NEAR_DEDUP = f"""
WITH RECURSIVE listed AS (
    SELECT doc_id, {_WORDS.format(_FOLD.format("coalesce(text, '')"))} AS ws FROM documents
), grams AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS gram
    FROM listed
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
    WHERE 100 * s.both >= 75 * (x.n + y.n - s.both)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN least m ON m.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

_BLANK = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH pages AS (
    SELECT row_number() OVER () AS page, doc_id, source, text FROM documents
), cut AS (
    SELECT page, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM pages
), lines AS (
    SELECT *, trim(line, {_BLANK}) AS body FROM cut
), held AS (
    SELECT source, body, count(DISTINCT page) AS on_pages FROM lines WHERE body <> '' GROUP BY 1, 2
), hosts AS (
    SELECT source, count(*) AS total FROM pages GROUP BY 1
), common AS (
    SELECT h.source, h.body FROM held h JOIN hosts t ON t.source IS NOT DISTINCT FROM h.source
    WHERE h.on_pages >= 2 AND h.on_pages * 100 > t.total * 1
), judged AS (
    SELECT l.*, c.body IS NOT NULL AS gone FROM lines l LEFT JOIN common c ON c.source IS NOT DISTINCT FROM l.source AND c.body = l.body
), merged AS (
    SELECT page, count(*) AS n_lines, count(*) FILTER (gone) AS n_gone, bool_or(body <> '' AND NOT gone) AS content,
           string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS rest
    FROM judged GROUP BY page
)
SELECT p.doc_id, coalesce(m.n_lines, 0)::BIGINT AS n_lines,
       CASE WHEN m.content THEN m.n_gone ELSE 0 END::BIGINT AS n_dropped,
       coalesce(NOT m.content AND m.n_gone > 0, false) AS left_whole,
       CASE WHEN m.content AND m.n_gone > 0 THEN m.rest ELSE p.text END AS text
FROM pages p LEFT JOIN merged m ON m.page = p.page
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           0.1::DOUBLE + 0.9::DOUBLE * length(translate(coalesce(text, ''), '#*$%&|<>', '')) / greatest(length(coalesce(text, '')), 1) AS quality,
           (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':' || number::VARCHAR), 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656::DOUBLE AS draw
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) - 1 AS number FROM documents)
), placed AS (
    SELECT doc_id, source, size, floor((1 - pow(draw, 1 / quality)) * 281474976710656::DOUBLE)::BIGINT AS place FROM sized
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM placed GROUP BY source
), weighted AS (
    SELECT source, source_size, (CASE turn WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS weight, (2 * source_size)::DOUBLE AS most FROM totals
), stepped AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
               - coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
    FROM weighted
), level AS (
    SELECT rate FROM stepped WHERE weight * rate < most ORDER BY most / weight, source LIMIT 1
), goals AS (
    SELECT source, source_size, least(most, weight * coalesce((SELECT rate FROM level), 0)) AS target FROM weighted
), budgets AS (
    SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS whole, target - floor(target / greatest(source_size, 1)) * source_size AS rest FROM goals
), summed AS (
    SELECT p.*, b.source_size, b.target, b.whole, b.rest,
           sum(size) OVER (PARTITION BY p.source ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto,
           sum(size) OVER (PARTITION BY p.source, place) AS held
    FROM placed p JOIN budgets b ON b.source IS NOT DISTINCT FROM p.source
), ends AS (
    SELECT source, min(place) AS place FROM summed WHERE rest > 0 AND upto >= rest GROUP BY source
), cut AS (
    SELECT DISTINCT s.source, CASE WHEN s.upto - s.rest <= s.rest - (s.upto - s.held) THEN e.place ELSE e.place - 1 END AS place
    FROM summed s JOIN ends e ON e.source IS NOT DISTINCT FROM s.source AND e.place = s.place
)
SELECT s.doc_id, s.source, s.size, s.source_size, s.target,
       s.whole + CASE WHEN s.place <= c.place THEN 1 ELSE 0 END AS epochs,
       (s.size * (s.whole + CASE WHEN s.place <= c.place THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed s LEFT JOIN cut c ON c.source IS NOT DISTINCT FROM s.source
"""


def licenses(templates: tuple, percent: int) -> str:
    values = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(templates))
    listed = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return f"""
WITH given(tid, license, text) AS (VALUES {values}
), known AS (
    SELECT tid, license, {listed} AS ws FROM given
), sized AS (
    SELECT *, len(ws) AS n, least(len(ws), 5) AS k, greatest(1, len(ws) // 2) AS step FROM known WHERE len(ws) > 0
), want AS (
    SELECT DISTINCT tid, k, unnest(list_transform(range(1, n - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS gram FROM sized
), totals AS (
    SELECT tid, count(*) AS n_shingles FROM want GROUP BY tid
), texts AS (
    SELECT DISTINCT doc_id, text FROM documents
), docs AS (
    SELECT row_number() OVER () AS page, doc_id, {listed} AS ws FROM texts
), grams AS (
    SELECT page, s.k, unnest(range(0, len(ws) - s.k + 1)) AS pos,
           unnest(list_transform(range(1, len(ws) - s.k + 2), lambda i: array_to_string(ws[i:i + s.k - 1], ' '))) AS gram
    FROM docs, (SELECT DISTINCT k FROM sized) s WHERE len(ws) >= s.k
), hits AS (
    SELECT g.page, w.tid, g.pos, g.gram FROM grams g JOIN want w ON w.gram = g.gram AND w.k = g.k
), inside AS (
    SELECT h.page, h.tid, h.gram, unnest(range(greatest(0, ceil((h.pos + s.k - s.n - s.step)::DOUBLE / s.step)::BIGINT), h.pos // s.step + 1)) * s.step AS at_word
    FROM hits h JOIN sized s ON s.tid = h.tid
), found AS (
    SELECT page, tid, at_word, count(DISTINCT gram) AS n_found FROM inside GROUP BY 1, 2, 3
), good AS (
    SELECT f.*, t.n_shingles, s.license FROM found f JOIN totals t ON t.tid = f.tid JOIN sized s ON s.tid = f.tid WHERE f.n_found * 100 >= t.n_shingles * {percent}
), best AS (
    SELECT *, row_number() OVER (PARTITION BY page, license ORDER BY n_found / n_shingles DESC, at_word, n_shingles DESC) AS place FROM good
)
SELECT d.doc_id, b.license, b.n_shingles::INTEGER AS n_shingles, b.n_found::INTEGER AS n_found, b.at_word::INTEGER AS at_word
FROM best b JOIN docs d ON d.page = b.page WHERE b.place = 1
"""


def vector_codes(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Each round is a pair of tables: assignments by plain squared distances, and the codebook of their floored means."""
    square = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
    SELECT c.r, c.p, min({{'d': {square.format("c.x", "b.x")}::BIGINT, 'e': b.e}}) AS best FROM cut c JOIN book{i} b ON b.p = c.p GROUP BY 1, 2
)""")
        if i < rounds:
            steps.append(f"""sums{i} AS (
    SELECT c.p, n.best.e AS e, unnest(c.x) AS v, generate_subscripts(c.x, 1) AS k FROM cut c JOIN near{i} n ON n.r = c.r AND n.p = c.p
), means{i} AS (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x FROM (SELECT p, e, k, sum(v)::BIGINT AS s, count(*) AS n FROM sums{i} GROUP BY 1, 2, 3) GROUP BY 1, 2
), book{i + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN means{i} m ON m.p = b.p AND m.e = b.e
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
    SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, (SELECT unnest(range({parts})) AS p)
), book0 AS MATERIALIZED (
    SELECT p, r - 1 AS e, x FROM cut WHERE r <= {entries}
), {", ".join(steps)}, digest AS (
    SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, k)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS k FROM book{rounds})
), coded AS (
    SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY r
)
SELECT k.vec_id, k.label, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, d.codebooks_sha256
FROM kept k JOIN coded c ON c.r = k.r, digest d
"""


def spelling(least_length: int, least_count: int, drop_every: int, times: int) -> str:
    """Near words by leaving out each letter in turn; crc32 by its table, byte by byte."""
    letters = "[a-z" + chr(0xC0) + "-" + chr(0xFF) + "]+"
    return f"""
WITH RECURSIVE crc AS MATERIALIZED (
    SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all({_FOLD.format("text")}, '{letters}')) AS run FROM documents
), counted AS (
    SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS own, count(*) AS n FROM runs WHERE length(run) >= {least_length} GROUP BY 1, 2
), spelled AS (
    SELECT run, n, hex(encode(own)) AS code FROM counted
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(code)::BIGINT, 2), lambda i: ('0x' || code[i:i + 1])::BIGINT)),
                                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
    FROM spelled, crc
), kept AS (
    SELECT CASE WHEN h % {drop_every} = 0 THEN CASE WHEN h % length(run) = 0 THEN '' ELSE run[:h % length(run)] END || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed
), words AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= {least_length} GROUP BY 1 HAVING sum(n) >= {least_count}
), places AS (
    SELECT word, n, unnest(range(length(word))) AS i FROM words
), without AS MATERIALIZED (
    SELECT word, n, i, CASE WHEN i = 0 THEN '' ELSE word[:i] END || word[i + 2:] AS rest FROM places
), near AS (
    SELECT a.word, b.word AS other, b.n FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min({{'n': -n, 'w': other}}) AS first FROM near GROUP BY 1
), linked AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.first.n >= {times} * w.n THEN b.first.w END AS form, CASE WHEN -b.first.n >= {times} * w.n THEN -b.first.n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word
), walk AS (
    SELECT word, word AS at FROM linked
    UNION ALL
    SELECT k.word, l.form FROM walk k JOIN linked l ON l.word = k.at WHERE l.form IS NOT NULL
), ends AS (
    SELECT k.word, k.at AS root FROM walk k JOIN linked l ON l.word = k.at WHERE l.form IS NULL
)
SELECT l.word, l.n, l.n_near::BIGINT AS n_near, l.form, l.form_n::BIGINT AS form_n, e.root FROM linked l JOIN ends e ON e.word = l.word
"""
