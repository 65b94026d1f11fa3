"""The queries in DuckDB SQL, where SQL can express them."""

#: Table of the crc32, for `crc32` below.
CRC = """bits AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i::UBIGINT, list_transform(range(8), lambda k: k::UBIGINT)),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
        FROM range(256) r(i))
)"""


def crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes, by the table `bits`."""
    return f"""xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(range(octet_length(encode({text}))),
            lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::UBIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])))"""


ORACLE = {
    "op3_line_dedup": """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM (SELECT *, key IN (SELECT key FROM common) AS dropped FROM keyed)
GROUP BY doc_id
""",
    "op9_minhash_near_dedup": """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
    FROM words, range(1, greatest(len(w) - 1, 2)) r(i) WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, m.n, n.n
    HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) ON x = d.doc_id
""",
    "op10_decontamination": """
WITH dw AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), iw AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), iwin AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS l, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
    FROM iw, range(1, len(w) - least(13, len(w)) + 2) r(i) WHERE len(w) > 0
), dwin AS (
    SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS win
    FROM dw, (SELECT DISTINCT l FROM iwin) k, range(1, len(w) - l + 2) r(i)
), hits AS (
    SELECT DISTINCT doc_id, i, l, item_id FROM dwin JOIN iwin USING (l, win)
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, i, l FROM hits), range(i, i + l) r(p) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n > 0 AND 20 * h.n >= len(w), false) AS contaminated
FROM dw LEFT JOIN hit_words h USING (doc_id) LEFT JOIN items i USING (doc_id)
""",
    "op8_substring_dedup": """
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS win FROM words, range(1, len(w) - 33) r(i)
), repeated AS (
    SELECT doc_id, i FROM windows WHERE win IN (SELECT win FROM windows GROUP BY win HAVING count(*) > 1)
), gone AS (
    SELECT DISTINCT doc_id, p FROM repeated, range(i, i + 35) r(p)
), each AS (
    SELECT doc_id, p, w[p] AS word FROM words, range(1, len(w) + 1) r(p)
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
    FROM each LEFT JOIN (SELECT doc_id, p, true AS lost FROM gone) USING (doc_id, p) WHERE lost IS NULL GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""",
    "op5_suffix_array_dedup": """
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), strings AS (
    SELECT doc_id, unnest(range(1, len(x) // 2 - 48)) AS i,
        unnest(list_transform(range(1, len(x) // 2 - 48), lambda i: md5_number(substr(x, 2 * i - 1, 100)))) AS s
    FROM bytes
), firsts AS (
    SELECT s, min(doc_id) AS m FROM strings GROUP BY s
), hits AS (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
    FROM strings JOIN firsts USING (s) WHERE m < doc_id
), runs AS (
    SELECT doc_id, i, count(*) FILTER (WHERE before IS NULL OR i - before > 50) OVER (PARTITION BY doc_id ORDER BY i) AS g
    FROM hits
), spans AS (
    SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, g
), sums AS (
    SELECT doc_id, sum(b - a)::BIGINT AS n, count(*) AS spans FROM spans GROUP BY doc_id
), pieces AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS f, a AS t FROM spans
    UNION ALL
    SELECT doc_id, coalesce(max(b), 1), any_value(len(x)) // 2 + 1 FROM bytes LEFT JOIN spans USING (doc_id) GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(substr(x, 2 * f - 1, 2 * (t - f)), '' ORDER BY f, t) AS x
    FROM pieces JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, len(b.x) // 2 AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
    sha256(unhex(coalesce(k.x, ''))) AS kept_sha256
FROM bytes b LEFT JOIN sums USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
    "op11_pivotal_grams": f"""
WITH RECURSIVE {CRC}, runs AS (
    SELECT doc_id, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, bits
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
        FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM words, range(1, length(word) + 1) r(i)
), near AS (
    SELECT word AS a, cut AS b FROM cuts WHERE cut IN (SELECT word FROM words)
    UNION SELECT cut, word FROM cuts WHERE cut IN (SELECT word FROM words)
    UNION SELECT x.word, y.word FROM cuts x JOIN cuts y USING (cut, i) WHERE x.word <> y.word
), best AS (
    SELECT a, count(*) AS n_near, arg_min(b, (-n, b)) AS b, max(n) AS n FROM near JOIN words ON word = b GROUP BY a
), formed AS (
    SELECT word, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN best.n >= 5 * w.n THEN b END AS form, CASE WHEN best.n >= 5 * w.n THEN best.n END AS form_n
    FROM words w LEFT JOIN best ON a = word
), steps AS (
    SELECT word, word AS root FROM formed
    UNION ALL
    SELECT steps.word, form FROM steps JOIN formed ON formed.word = steps.root WHERE form IS NOT NULL
)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
FROM formed f JOIN steps s USING (word) JOIN formed e ON e.word = s.root WHERE e.form IS NULL
""",
    "op12_jaccard_join": """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
    FROM words, range(1, greatest(len(w) - 2, 2)) r(i) WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, m.n, n.n
    HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) ON x = d.doc_id
""",
    "op13_prefix_trie": f"""
WITH RECURSIVE {CRC}, turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS lender, ({crc32("conv_id::VARCHAR")} % 4)::BIGINT AS h FROM (SELECT DISTINCT conv_id FROM turns), bits
), parts AS (
    SELECT c.conv_id, 0 AS own, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.lender WHERE pos <= h
    UNION ALL
    SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE pos > h
), rebuilt AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS d, sha256(length(role) || ':' || role || text) AS mark,
        len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM parts
), grown AS (
    SELECT conv_id, 0::BIGINT AS d, '' AS path, '' AS above, 0::BIGINT AS words FROM convs
    UNION ALL
    SELECT g.conv_id, r.d, sha256(g.path || r.mark), g.path, r.words FROM grown g JOIN rebuilt r ON r.conv_id = g.conv_id AND r.d = g.d + 1
), ends AS (
    SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, arg_max(path, d) AS path FROM grown GROUP BY conv_id) GROUP BY path
), nodes AS (
    SELECT path, any_value(above) AS above, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(words) AS saved
    FROM grown GROUP BY path
), children AS (
    SELECT above, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above
), lines AS (
    SELECT path AS top, path, above, depth FROM nodes
    UNION ALL
    SELECT l.above AS top, l.path, n.above, n.depth FROM lines l JOIN nodes n ON n.path = l.above WHERE l.depth > 0
), sums AS (
    SELECT top, count(*) FILTER (WHERE c.n IS NULL) AS leaves, sum(n.saved)::BIGINT AS saved
    FROM lines l JOIN nodes n ON n.path = l.path LEFT JOIN children c ON c.above = l.path GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
    s.saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums s ON s.top = n.path LEFT JOIN nodes p ON p.path = n.above AND n.depth > 0
    LEFT JOIN children c ON c.above = n.path LEFT JOIN ends e ON e.path = n.path
""",
}
