"""SQL with the same results as the queries that SQL can express."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCHMARK_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANK_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

ORACLE_SQL = {
    "op3_decontamination": f"""
WITH items AS (SELECT item_id, {_BENCHMARK_WORDS} AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + 12], ' ') AS passage
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM items WHERE len(w) > 0)
),
docs AS (SELECT doc_id, {_BENCHMARK_WORDS} AS w FROM documents),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS passage
    FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM item_windows) AS lengths WHERE len(w) >= n
    )
),
hits AS (SELECT doc_id, item_id, places.n, i FROM places JOIN item_windows USING (passage)),
words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op4_minhash_forest": f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_BLANK_WORDS.format(text=_LOWERED)} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op5_line_dedup": """
WITH lines AS (
    SELECT doc_id, i, lines[i] AS line,
        translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
),
frequent AS (
    SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN frequent USING (k) GROUP BY doc_id
""",
    "op6_source_mixing": rf"""
WITH docs AS (
    SELECT doc_id, source, CAST(len({_BLANK_WORDS.format(text="coalesce(text, '')")}) AS BIGINT) AS size,
        -ln((CAST('0x' || substr(md5('mix' || chr(31) || CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
            / (1 + 4 * length(regexp_replace(coalesce(text, ''), '[^\p{{L}}\s]+', '', 'g')) // greatest(length(coalesce(text, '')), 1)) AS k
    FROM documents
),
sources AS (
    SELECT source, source_size, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source)
),
ranked AS (SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / w, source) AS r FROM sources),
-- With the r smallest ratios at their bound: what the others get by unit of weight.
levels AS (
    SELECT c.r, (1.5 * (SELECT sum(source_size) FROM sources) - coalesce(sum(2 * x.source_size) FILTER (x.r <= c.r), 0))
        / sum(x.w) FILTER (x.r > c.r) AS level, min(2.0 * x.source_size / x.w) FILTER (x.r > c.r) AS lowest
    FROM (SELECT 0 AS r UNION ALL SELECT r FROM ranked) c, ranked x GROUP BY c.r
),
cut AS (SELECT r, level FROM levels WHERE level <= lowest ORDER BY r LIMIT 1),
targets AS (
    SELECT source, source_size,
        CAST(CASE WHEN ranked.r <= cut.r THEN 2.0 * source_size ELSE w * level END AS DOUBLE) AS target
    FROM ranked, cut
),
placed AS (
    SELECT doc_id, size, source_size, target,
        CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs,
        sum(size) OVER (PARTITION BY docs.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
    FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
    CAST(epochs * size + greatest(least(CAST(round(target) AS BIGINT) - epochs * source_size - before, size), 0) AS BIGINT) AS taken
FROM placed
""",
    "op9_substring_dedup": f"""
WITH docs AS (SELECT doc_id, {_BLANK_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)
),
twice AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN twice USING (s)),
words AS (SELECT doc_id, w[p] AS word, p FROM (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM docs)),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
""",
}
