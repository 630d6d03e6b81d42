"""DuckDB SQL for the operators that SQL expresses."""

WORD_CHARS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = f"""
WITH item_words AS (
    SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
        regexp_extract_all({LOWER}, '{WORD_CHARS}') AS w
    FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS window_text
    FROM item_words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i)
    WHERE len(w) > 0
), lengths AS (
    SELECT DISTINCT n FROM item_windows
), doc_words AS (
    SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '{WORD_CHARS}'), []) AS w FROM documents
), hits AS (
    SELECT DISTINCT d.doc_id, d.i, d.n, x.item_id
    FROM (
        SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS window_text
        FROM doc_words, lengths, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)
        WHERE len(w) >= n
    ) d JOIN item_windows x ON d.n = x.n AND d.window_text = x.window_text
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(x.n_items, 0) AS n_items,
    sha256(coalesce(x.items, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items x USING (doc_id)
"""

LINE_DEDUP = """
WITH docs AS (
    SELECT doc_id, string_split(text, chr(10)) AS all_lines FROM documents
), placed AS (
    SELECT doc_id, line, min(p) AS p
    FROM (SELECT doc_id, unnest(all_lines) AS line, unnest(range(len(all_lines))) AS p FROM docs) GROUP BY doc_id, line
), numbered AS (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS pos FROM placed
), sized AS (
    SELECT doc_id, count(*) AS n_lines FROM numbered GROUP BY doc_id
), classes AS (
    SELECT line, min(doc_id) AS doc_id, arg_min(pos, doc_id) AS pos,
        list_filter(list_distinct(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+')), lambda x: x <> '') AS words
    FROM numbered WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY line
), tokens AS (
    SELECT doc_id, pos, len(words) AS n, unnest(words) AS word FROM classes
), frequency AS (
    SELECT word, count(*) AS f FROM tokens GROUP BY word
), ranked AS (
    SELECT doc_id, pos, n, word, row_number() OVER (PARTITION BY doc_id, pos ORDER BY f, word) AS r FROM tokens JOIN frequency USING (word)
), prefix AS (
    SELECT doc_id, pos, n, word FROM ranked WHERE r <= n - CAST(ceil(n * 0.8 - 1e-9) AS BIGINT) + 1
), pairs AS (
    SELECT DISTINCT x.doc_id, x.pos, y.doc_id AS doc_y, y.pos AS pos_y
    FROM prefix x JOIN prefix y ON x.word = y.word AND (y.doc_id < x.doc_id OR y.doc_id = x.doc_id AND y.pos < x.pos)
        AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
), removed AS (
    SELECT DISTINCT p.doc_id, p.pos
    FROM pairs p JOIN classes x ON x.doc_id = p.doc_id AND x.pos = p.pos JOIN classes y ON y.doc_id = p.doc_y AND y.pos = p.pos_y
    WHERE 100 * len(list_intersect(x.words, y.words)) >= 80 * (len(x.words) + len(y.words) - len(list_intersect(x.words, y.words)))
), kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS kept_lines
    FROM classes c WHERE NOT EXISTS (SELECT 1 FROM removed r WHERE r.doc_id = c.doc_id AND r.pos = c.pos) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n_lines, 0) AS n_lines, coalesce(k.n_kept, 0) AS n_kept, coalesce(k.kept_lines, '') AS kept_lines
FROM documents d LEFT JOIN sized s ON s.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

SOURCE_DIVERGENCE = """
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents
), occurring AS (
    SELECT d, lang, source, term, count(*) AS n FROM (SELECT d, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n) AS n FROM occurring GROUP BY lang, term HAVING count(*) >= 3
), lang_sums AS (
    SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), dense AS (
    SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n
    FROM groups g JOIN kept k USING (lang)
    LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM occurring GROUP BY ALL) o
        ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
), group_sums AS (
    SELECT lang, source, sum(n) AS total FROM dense GROUP BY ALL
), chances AS (
    SELECT d.lang, d.source, d.term, d.n, 1 + 1000000000::HUGEINT * (d.n + 1)::HUGEINT // (s.total + l.v)::HUGEINT AS p,
        1 + 1000000000::HUGEINT * (k.n + 1)::HUGEINT // (l.total + l.v)::HUGEINT AS q
    FROM dense d JOIN group_sums s USING (lang, source) JOIN lang_sums l USING (lang) JOIN kept k USING (lang, term)
), pairs AS (
    SELECT g.lang, g.source, h.source AS item, coalesce(x.value, 0) AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM chances a JOIN chances b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ) x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS r FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q,
        row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, encode(term))
    FROM chances WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 200
"""

ORACLE_SQL = {
    "op6_decontamination": DECONTAMINATION,
    "op9_line_dedup": LINE_DEDUP,
    "op12_source_divergence": SOURCE_DIVERGENCE,
}
