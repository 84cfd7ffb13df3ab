"""DuckDB counterparts of the queries that SQL can express."""

# Components as labels that sink to the smallest id over links; a link needs
# 100 * common >= 80 * (all of both).
NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS s
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * c >= 80 * (p.n + q.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT a AS doc_id, a AS low FROM ways
    UNION
    SELECT w.b, r.low FROM reach r JOIN ways w ON w.a = r.doc_id WHERE r.low < w.b),
lowest AS (SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.low, d.doc_id) AS component_id,
    d.doc_id = coalesce(l.low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lowest l USING (doc_id)
"""

# A word is hit if one of the windows that hold it is a window of an item.
DECONTAMINATE = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
item_words AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS k, unnest(list_transform(
        range(1, len(w) - least(len(w), 13) + 2),
        lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS s
    FROM item_words WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM item_windows),
doc_windows AS (
    SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i,
        unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
    FROM doc_words, sizes),
hits AS (SELECT doc_id, item_id, i, k FROM doc_windows JOIN item_windows USING (k, s)),
hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
    sha256(coalesce(t.listed, '')) AS items_sha256,
    coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
"""

NEIGHBOURS = """
WITH vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
        vec_id, score
    FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# Every line against every earlier line of a similar length, without an index.
LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
sets AS (
    SELECT doc_id, line_no, line, list_sort(list_distinct(list_filter(
        regexp_split_to_array(lower(line), '[ \t\x0B\f\r]'), lambda x: x <> ''))) AS w
    FROM lines),
firsts AS (SELECT w, len(w) AS n, min((doc_id, line_no)) AS at FROM sets WHERE len(w) > 0 GROUP BY w),
repeated AS (
    SELECT DISTINCT y.w
    FROM firsts x JOIN firsts y ON x.at < y.at AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n
    WHERE 100 * len(list_intersect(x.w, y.w)) >= 80 * (x.n + y.n - len(list_intersect(x.w, y.w)))),
marked AS (
    SELECT s.doc_id, s.line_no, s.line, len(s.w) > 0 AND ((s.doc_id, s.line_no) <> f.at OR r.w IS NOT NULL) AS gone
    FROM sets s LEFT JOIN firsts f ON f.w = s.w LEFT JOIN repeated r ON r.w = s.w)
SELECT doc_id, count(line)::INTEGER AS n_lines, (count(*) FILTER (WHERE gone))::INTEGER AS n_removed,
    CASE WHEN any_value(d.text) IS NOT NULL
        THEN coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') END AS text
FROM documents d LEFT JOIN marked m USING (doc_id) GROUP BY doc_id
"""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
found AS (SELECT lang, source, unnest(w) AS term FROM docs),
kept AS (
    SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM docs) GROUP BY ALL HAVING count(*) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
    SELECT g.lang, g.source, k.term, count(f.term)::HUGEINT AS n
    FROM groups g JOIN kept k ON k.lang = g.lang
        LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
    GROUP BY ALL),
prices AS (
    SELECT *, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p
    FROM counts WINDOW w AS (PARTITION BY lang, source)),
lang_counts AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL),
lang_prices AS (
    SELECT *, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS q
    FROM lang_counts WINDOW w AS (PARTITION BY lang)),
distances AS (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM prices x JOIN prices y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(d.value, 0) AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
        LEFT JOIN distances d ON d.lang = g.lang AND d.source = g.source AND d.item = h.source),
above AS (
    SELECT lang, source, 'term' AS part, term AS item, p - q AS value
    FROM prices p JOIN lang_prices l USING (lang, term) WHERE p.n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (FROM pairs UNION ALL FROM above))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""

FILTER_AUDIT = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
flags AS (
    SELECT doc_id, part, {
        'A': len(w) < 200,
        'B': 100 * len(list_distinct(w)) < 50 * len(w),
        'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
        'D': regexp_matches(t, '[#$%&*|]'),
        'E': coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)} AS f
    FROM words),
failed AS (
    SELECT doc_id, part, concat(CASE WHEN f.A THEN 'A' END, CASE WHEN f.B THEN 'B' END, CASE WHEN f.C THEN 'C' END,
        CASE WHEN f.D THEN 'D' END, CASE WHEN f.E THEN 'E' END) AS failed
    FROM flags),
marked AS (
    SELECT part, failed, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
    FROM failed LEFT JOIN labels USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM orders),
each AS (
    SELECT m.*, filter_order, step, contains(failed, filter_order[step]) AS fails, filter_order[step] AS letter,
        len(list_filter(range(1, step), lambda i: contains(failed, filter_order[i]))) > 0 AS gone
    FROM marked m, steps),
counted AS (
    SELECT part, filter_order, step, letter, count(*) FILTER (WHERE NOT fails AND NOT gone) AS kept,
        count(*) FILTER (WHERE fails AND NOT gone) AS removed, count(*) FILTER (WHERE fails AND gone) AS redundant,
        count(*) FILTER (WHERE failed = letter) AS unique_fails,
        count(*) FILTER (WHERE fails AND NOT gone AND good) AS good_lost,
        count(*) FILTER (WHERE fails AND NOT gone AND toxic) AS toxic_lost
    FROM each GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

# Two hexadecimal digits are a byte; a place is that of a string's first byte.
REPEATED_STRINGS = r"""
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
places AS (SELECT doc_id, unnest(range(0, n - 199)) AS p FROM docs WHERE n >= 200),
strings AS (SELECT doc_id, p, md5_number(substring(h, 2 * p + 1, 400)) AS s FROM places JOIN docs USING (doc_id)),
repeated AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY s) AS c FROM strings) WHERE c > 1),
opened AS (
    SELECT *, p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200, -1) AS opens FROM repeated),
numbered AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM opened),
spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 200 AS b FROM numbered GROUP BY ALL),
gaps AS (
    SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
    UNION ALL
    SELECT doc_id, coalesce(max(b), 0), any_value(n) FROM docs LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h
    FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS c, sum(b - a) AS r FROM spans GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(c, 0)::BIGINT AS n_spans,
    sha256(unhex(kept.h)) AS kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_near_dedup": NEAR_DEDUP,
    "op3_projected_neighbours": NEIGHBOURS,
    "op7_decontaminate": DECONTAMINATE,
    "op10_line_dedup": LINE_DEDUP,
    "op11_source_divergence": SOURCE_DIVERGENCE,
    "op12_repeated_strings": REPEATED_STRINGS,
    "op13_filter_audit": FILTER_AUDIT,
}
