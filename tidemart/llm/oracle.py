"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_statements = {
    "op2_ngram_jaccard": rf"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i : i + 3], ' ') FOR i IN range(1, len(w) - 2)]
                                                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
            FROM texts
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id != b.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * k >= 85 * (p.n + q.n - k)
        ), reached AS (
            SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
        ), least AS (
            SELECT x, min(y) AS y FROM reached GROUP BY x
        )
        SELECT t.doc_id, coalesce(z.n, 0) AS n_shingles, least(t.doc_id, coalesce(l.y, t.doc_id)) AS component_id
        FROM texts t LEFT JOIN sizes z USING (doc_id) LEFT JOIN least l ON l.x = t.doc_id
    """,
    "op4_quality_rules": rf"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
        ), lines AS (
            SELECT r, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM texts
        ), windows AS (
            SELECT r, unnest([{{'i': i, 's': array_to_string(w[i : i + 2], ' ')}} FOR i IN range(1, len(w) - 1)]) AS x
            FROM texts WHERE len(w) >= 3
        ), counted AS (
            SELECT r, x.i AS i, count(*) OVER (PARTITION BY r, x.s) AS n FROM windows
        ), places AS (
            SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE n > 1
        ), repeated AS (
            SELECT r, count(*) AS n FROM places GROUP BY r
        ), measured AS (
            SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines,
                   len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
                   len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '\p{{L}}')) AS n_letters
            FROM texts JOIN lines USING (r) LEFT JOIN repeated USING (r)
        ), judged AS (
            SELECT *, n_words < 50 AS f0, 100 * n_repeat_words > 50 * n_words AS f1, 100 * n_symbols > 20 * n_words AS f2,
                   100 * n_dup_lines > 50 * n_lines AS f3, word_chars < 2 * n_words OR word_chars > 15 * n_words AS f4,
                   100 * n_upper > 60 * n_letters AS f5
            FROM measured
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f0 OR f1 AS base_failed,
               NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5) AS kept,
               f0::BIGINT + 2 * f1::BIGINT + 4 * f2::BIGINT + 8 * f3::BIGINT + 16 * f4::BIGINT + 32 * f5::BIGINT AS failed
        FROM judged
    """,
    "op5_url_filters": r"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), rules(rule, verdict, rule_host, rule_path) AS (
            VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
                   ('www.example.com/en/', 'allow', 'www.example.com', '/en/'),
                   ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')
        ), fits AS (
            SELECT page_id, host, path, rule, verdict,
                   row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule) DESC) AS nth
            FROM parts JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        )
        SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM parts p LEFT JOIN fits f
          ON f.page_id = p.page_id AND f.host = p.host AND f.path = p.path AND f.nth = 1
    """,
    "op11_periodic_runs": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   flatten([[(ascii(c) >> j) & 1 FOR j IN range(8)] FOR c IN string_split(doc_id::VARCHAR, '')]) AS bits
            FROM documents
        ), hashed AS (
            -- crc32 of the id, bit by bit
            SELECT r, doc_id, w, len(w) AS n,
                   xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bits::BIGINT[]),
                       lambda acc, b: xor(acc >> 1, 3988292384 * (xor(acc, b) & 1)))) AS h
            FROM texts
        ), places AS (
            SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a,
                   CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p
            FROM hashed
        ), edited AS (
            SELECT r, doc_id, n,
                   CASE WHEN a IS NULL THEN w
                        ELSE [w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] FOR i IN range(n)] END AS w
            FROM places
        ), words AS (
            SELECT r, n, unnest(range(n)) AS i, unnest(w) AS word FROM edited
        ), matches AS (
            SELECT x.r, x.i, x.i - y.i AS q FROM words x JOIN words y
              ON x.r = y.r AND x.word = y.word AND y.i < x.i AND 4 * (x.i - y.i) <= x.n
        ), pieces AS (
            SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS piece FROM matches
        ), stretches AS (
            SELECT r, q, min(i) - q AS s, count(*) + q AS l FROM pieces GROUP BY r, q, piece
            HAVING count(*) + q >= greatest(6, 4 * q)
        ), runs AS (
            SELECT r, s, l, min(q) AS q FROM stretches GROUP BY r, s, l
        ), told AS (
            SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
                   arg_min({'s': s, 'l': l, 'q': q}, {'l': -l, 's': s, 'q': q}) AS most
            FROM runs GROUP BY r
        ), dropped AS (
            SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs
        ), collapsed AS (
            SELECT r, string_agg(word, ' ' ORDER BY i) AS t
            FROM words w WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.r = w.r AND d.i = w.i) GROUP BY r
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, most.s AS start, most.l AS length, most.q AS period,
               1000 * most.l // most.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
               sha256(coalesce(t, '')) AS collapsed_sha256
        FROM edited LEFT JOIN told USING (r) LEFT JOIN collapsed USING (r)
    """,
}


def statements() -> dict[str, str]:
    return dict(_statements)
