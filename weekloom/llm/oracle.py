"""The results of the package's queries in SQL, where SQL can express them."""

from __future__ import annotations

MIXING = r"""
WITH sizes AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS source_no
    FROM sizes GROUP BY source
), weighted AS (
    SELECT *, CASE source_no % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM totals
), filling AS (
    SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS everything,
        coalesce(CAST(sum(cap) OVER (ORDER BY cap / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS filled,
        CAST(sum(weight) OVER (ORDER BY cap / weight, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open
    FROM weighted
), levels AS (
    SELECT *, (everything - filled) / open AS level FROM filling
), goals AS (
    SELECT source, source_no, source_size, CASE WHEN cap <= level * weight THEN CAST(cap AS DOUBLE)
        ELSE coalesce(max(CASE WHEN cap > level * weight THEN level END) OVER (), 0) * weight END AS target
    FROM levels
), blocks AS (
    SELECT *, CAST(ceil(source_size / 1024.0) AS BIGINT) AS n, CAST(round(target) AS BIGINT) AS words FROM goals WHERE source_size > 0
), fit AS (
    SELECT *, [p for p in [104729, 224737, 350377, 479909, 611953, 746773, 882377, 1020379] if n % p <> 0] AS primes FROM blocks
), plans AS (
    SELECT *, primes[CAST(source_no % len(primes) AS INTEGER) + 1] AS a, (source_no + 1) * 20240229 % n AS b,
        source_size - (n - 1) * 1024 AS short FROM fit
), short_blocks AS (
    SELECT *, (a * (n - 1) + b) % n AS short_at FROM plans
), placed AS (
    SELECT doc_id, source, size, row_number() OVER w AS row_no, CAST(sum(size) OVER w AS BIGINT) - size AS start
    FROM (SELECT *, coalesce((doc_id % 1024 + 1024) % 1024, 1024) AS chunk FROM sizes)
    WINDOW w AS (PARTITION BY source ORDER BY chunk, doc_id, size ROWS UNBOUNDED PRECEDING)
), parts AS (
    SELECT d.source, d.row_no, d.start, d.size, p.*, unnest(range(d.start // 1024, (d.start + d.size - 1) // 1024 + 1)) AS block
    FROM placed d JOIN short_blocks p ON d.source IS NOT DISTINCT FROM p.source WHERE d.size > 0
), rounds AS (
    SELECT *, (a * block + b) % n AS place, unnest([0, 1]) AS round FROM parts
), cuts AS (
    SELECT source, row_no, greatest(0, least(
            least(1024, words - round * source_size - place * 1024 + CASE WHEN place > short_at THEN 1024 - short ELSE 0 END)
                - greatest(start - block * 1024, 0),
            least(1024 - greatest(start - block * 1024, 0), size - greatest(block * 1024 - start, 0)))) AS cut
    FROM rounds
), sums AS (
    SELECT source, row_no, CAST(sum(cut) AS BIGINT) AS taken FROM cuts GROUP BY ALL
)
SELECT d.doc_id, d.size, g.source_size, g.target, coalesce(s.taken, 0) AS taken
FROM placed d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
LEFT JOIN sums s ON d.source IS NOT DISTINCT FROM s.source AND d.row_no = s.row_no
"""

NEAR_TEXT = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END)) AS grams
    FROM words WHERE len(w) > 0
), classes AS (
    SELECT min(doc_id) AS class_id, count(*) AS weight, grams FROM sets GROUP BY grams
), grams AS (
    SELECT class_id, len(grams) AS n, unnest(grams) AS g FROM classes
), common AS (
    SELECT a.class_id AS a, b.class_id AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS c
    FROM grams a JOIN grams b ON a.g = b.g AND a.class_id <> b.class_id GROUP BY a.class_id, b.class_id
), links AS (
    SELECT a, b FROM common WHERE 5 * c >= 4 * (an + bn - c)
), reach(a, r) AS (
    SELECT class_id, class_id FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.r
), component AS (
    SELECT a, min(r) AS component_id FROM reach GROUP BY a
), counts AS (
    SELECT l.a, sum(k.weight) AS n FROM links l JOIN classes k ON k.class_id = l.b GROUP BY l.a
)
SELECT d.doc_id, coalesce(k.class_id, d.doc_id) AS class_id,
    CAST(coalesce(n.n, 0) + coalesce(k.weight - 1, 0) AS BIGINT) AS n_links,
    coalesce(c.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sets s ON s.doc_id = d.doc_id LEFT JOIN classes k ON k.grams = s.grams
LEFT JOIN component c ON c.a = k.class_id LEFT JOIN counts n ON n.a = k.class_id
"""

NEAR_VECTORS = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS norm
    FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL)
    WHERE len(v) > 0 AND len([x for x in v if x IS NULL OR NOT isfinite(x)]) = 0 AND list_inner_product(v, v) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
), reach(a, r) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.r
), component AS (
    SELECT a, min(r) AS component_id FROM reach GROUP BY a
), counts AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.a = e.vec_id LEFT JOIN counts n ON n.a = e.vec_id
"""


HARD_NEGATIVES = """
WITH vectors AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""

PREFIX_TRIE = """
WITH turns AS (
    SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST,
        sha256(concat(len(coalesce(role, '')), ':', role, text))) AS own
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), counted AS (
    SELECT *, xor(list_reduce([ord(x) for x in string_split(CAST(conv_id AS VARCHAR), '')], lambda c, b: list_reduce(range(8),
        lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END, xor(c, CAST(b AS BIGINT))), 4294967295), 4294967295) % 6 AS h
    FROM turns
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS s
    FROM counted c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
    SELECT conv_id, unnest(range(len(s) + 1)) AS depth, s FROM rebuilt
), nodes AS (
    SELECT s[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = depth) AS ends
    FROM prefixes GROUP BY ALL
), children AS (
    SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), valued AS (
    SELECT nodes.*, coalesce(c.n, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * len(nodes.p[-1].t) ELSE 0 END AS own
    FROM nodes LEFT JOIN children c ON c.p = nodes.p
), upward AS (
    SELECT p[1:a] AS p, CAST(sum(own) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(depth + 1)) AS a FROM valued) GROUP BY ALL
)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, w.n_leaves, w.saved_tokens,
    sha256(coalesce(v.ends, '')) AS ends_sha256
FROM valued v JOIN upward w ON w.p = v.p LEFT JOIN nodes u ON u.p = v.p[1:v.depth - 1] AND v.depth = u.depth + 1
"""

LINE_RULES = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT row_no, doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, text FROM texts
), grams AS (
    SELECT row_no, unnest(range(1, len(w) - 1)) AS i, unnest([w[i:i + 2] for i in range(1, len(w) - 1)]) AS g FROM words WHERE len(w) > 3
), twice AS (
    SELECT row_no, i FROM grams QUALIFY count(*) OVER (PARTITION BY row_no, g) > 1
), repeats AS (
    SELECT row_no, count(DISTINCT i + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY row_no
), split AS (
    SELECT row_no, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM texts
), lines AS (
    SELECT row_no, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
        len(regexp_extract_all(line, '[|»·•>]')) AS separators, len(regexp_extract_all(line, '[!?#*$%&<>|~^_=+\\]')) AS marks,
        row_number() OVER (PARTITION BY row_no, line ORDER BY line_no) > 1 AS earlier
    FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), losses AS (
    SELECT row_no, CAST(count(*) FILTER (earlier) AS BIGINT) AS n_dup_lines, coalesce(CAST(sum(chars) FILTER (
            separators >= 3 AND 4 * separators >= n OR marks >= 4 AND marks >= n
            OR n < 4 AND NOT regexp_matches(line, '[.!?…:;"''”’»)\]。！？][\x20\x09-\x0D]*$') OR earlier
            OR regexp_matches(line, '(?i)all rights reserved|copyright|terms of (use|service)|privacy policy|cookie|javascript|subscribe|sign (in|up)'
                || '|log ?in\b|click here|powered by|lorem ipsum|licensed under|released under the|©')) AS BIGINT), 0) AS lost_chars
    FROM lines GROUP BY row_no
), measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost_chars, 0) AS lost_chars
    FROM words LEFT JOIN repeats r USING (row_no) LEFT JOIN losses USING (row_no)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_chars <= 0.5 * word_chars AS kept
FROM measured
"""


def all_sql() -> dict[str, str]:
    return {"op2_near_vectors": NEAR_VECTORS, "op4_ngram_join": NEAR_TEXT, "op9_source_mixing": MIXING, "op11_prefix_trie": PREFIX_TRIE, "op12_hard_negatives": HARD_NEGATIVES, "op13_line_rules": LINE_RULES}
