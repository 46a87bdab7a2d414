"""DuckDB statements of the queries that SQL can express, for checking only."""

from __future__ import annotations

# Words, windows of ten words or of a whole shorter item, and every place where one occurs.
_CONTAMINATED = r"""
        WITH dw AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        bw AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
            FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM (SELECT item_id, w, least(len(w), 10) AS n FROM bw WHERE len(w) > 0))),
        places AS (
            SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM dw, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
        hits AS (SELECT DISTINCT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x USING (n, win)),
        covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit
                    FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
        SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

# The pages' one layout: blocks of the article between its paragraph and heading tags.
_MAIN_TEXT = r"""
        WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS body FROM pages),
        b AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(body, '</?(?:p|h1)>'), lambda x: trim(regexp_replace(
                  replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '&amp', '&'),
                  '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM a)
        SELECT page_id, url, array_to_string(blocks, chr(10)) AS text, CAST(length(array_to_string(blocks, chr(10))) AS BIGINT) AS n_chars,
               CAST(len(blocks) AS BIGINT) AS n_blocks
        FROM b"""

_WARC = """
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, url, strlen(html) AS n, sha1(html) AS digest FROM p),
        w AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last, count(*) OVER (PARTITION BY digest) AS copies FROM d)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 1000 AND copies > 1 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND copies > 1 AND page_id <> last THEN last END AS refers_to,
               url AS target_uri
        FROM w"""

# Pairs of documents by the shingles they share, then what can be reached.
_NEAR = r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
                   FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
        least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(b, w.doc_id)) AS component_id,
               w.doc_id <= coalesce(b, w.doc_id) AS kept
        FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON a = w.doc_id"""

# Every start of a hundred bytes (two hexadecimal digits each), ranked among the equal ones.
_REPEATS = """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
        starts AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
        later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM starts) WHERE r > 1),
        numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM (
            SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM later)),
        spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, span),
        gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
        kept AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
                        string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
                 FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)"""

# CRC-32 of a word's bytes by a table made from the polynomial; a gain for each bucket of the corpus.
_IMPORTANCE = r"""
        WITH codes AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS code),
        dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents),
        bw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
        d AS (SELECT w, r, count(*) AS n FROM (SELECT unnest(w) AS w, r FROM dw) GROUP BY w, r),
        b AS (SELECT w, count(*) AS n FROM bw GROUP BY w),
        words AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM d UNION SELECT w FROM b)),
        hashed AS (SELECT w, xor(list_reduce(list_concat([4294967295], list_transform(range(0, length(h), 2),
                       lambda i: (strpos('0123456789ABCDEF', h[i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 2]) - 1)),
                       lambda c, k: xor(c >> 8, code[(xor(c, k) & 255) + 1])), 4294967295) % 10000 AS bucket FROM words, codes),
        s AS (SELECT bucket, sum(n) AS n FROM d JOIN hashed USING (w) GROUP BY bucket),
        t AS (SELECT bucket, sum(n) AS n FROM b JOIN hashed USING (w) GROUP BY bucket),
        sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
        gains AS (SELECT s.bucket, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (s_all + 10000) AS DOUBLE)
                                                        / CAST((s.n + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
                  FROM s LEFT JOIN t USING (bucket), sums),
        weights AS (SELECT r, sum(n * gain) AS weight FROM d JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY r),
        scored AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                          CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT)
                                                                                     + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
                   FROM dw LEFT JOIN weights USING (r)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
                          10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS drawn FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM ranked"""

_COPIES = r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents)
        SELECT doc_id, first(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size, row_number() OVER w = 1 AS kept,
               sha256(body) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY body ORDER BY length(text) DESC, doc_id NULLS LAST)"""

# Counts of every kept term in every group of its language, none included.
_DIVERGENCE = r"""
        WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 30),
        groups AS (SELECT DISTINCT lang, source FROM d),
        found AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) JOIN kept USING (lang, term) GROUP BY ALL),
        counts AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM groups JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)),
        shares AS (SELECT *, 1 + (1000000000 * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS p FROM counts WINDOW g AS (PARTITION BY lang, source)),
        langs AS (SELECT lang, term, sum(n) AS lang_n FROM found GROUP BY lang, term),
        lang_shares AS (SELECT lang, term, 1 + (1000000000 * (lang_n + 5)) // (sum(lang_n) OVER g + 5 * count(*) OVER g) AS q FROM langs WINDOW g AS (PARTITION BY lang)),
        far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
                  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
                   FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50"""

STATEMENTS: dict[str, str] = {"op2_decontamination": _CONTAMINATED, "op5_html_paths": _MAIN_TEXT, "op7_warc": _WARC,
                              "op8_near_duplicates": _NEAR, "op10_repeats": _REPEATS, "op11_importance": _IMPORTANCE,
                              "op12_exact_copies": _COPIES, "op13_divergence": _DIVERGENCE}
