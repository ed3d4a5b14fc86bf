"""DuckDB SQL for the corpus queries that SQL can express."""

from .url_reputation import SUFFIXES

_STRENGTH = """CASE WHEN coalesce(sum(n * (n - 1) * mean * (1 - mean)), 0) = 0 THEN 50.0 ELSE 1 / least(greatest(round((sum((bad - n * mean) ** 2)
      - sum(n * mean * (1 - mean))) / sum(n * (n - 1) * mean * (1 - mean)), 6), 1 / 51.0), 1 / 3.0) - 1 END"""
_LISTED = ", ".join(f"('{s}', {s.count('.') + 1})" for s in SUFFIXES)

OP4_URL_FILTER = f"""
    WITH j AS (
      SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    o AS (SELECT host, CASE WHEN quality IS NULL AND toxic IS NULL THEN NULL WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad FROM j LEFT JOIN labels ON page_id = doc_id WHERE host <> ''),
    listed(name, k) AS (VALUES {_LISTED}),
    h AS (SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad, string_split(host, '.') AS parts,
                 (SELECT coalesce(max(k), 1) FROM listed WHERE o.host = name OR ends_with(o.host, '.' || name)) AS k FROM o GROUP BY host),
    d AS (SELECT host, n, bad, array_to_string(parts[-least(k + 1, len(parts)):], '.') AS domain, array_to_string(parts[-least(k, len(parts)):], '.') AS suffix FROM h),
    base AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS share FROM d),
    s1 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT share FROM base) AS mean FROM d GROUP BY 1),
    m1 AS (SELECT {_STRENGTH} AS m FROM s1), p1 AS (SELECT suffix, (bad + m * mean) / (n + m) AS mean FROM s1, m1),
    s2 AS (SELECT d.suffix, domain, sum(n) AS n, sum(bad) AS bad, max(mean) AS mean FROM d JOIN p1 USING (suffix) GROUP BY 1, 2),
    m2 AS (SELECT {_STRENGTH} AS m FROM s2), p2 AS (SELECT domain, (bad + m * mean) / (n + m) AS mean FROM s2, m2),
    s3 AS (SELECT host, n, bad, mean FROM d JOIN p2 USING (domain)), m3 AS (SELECT {_STRENGTH} AS m FROM s3),
    ab AS (SELECT host, bad + m * mean AS a, n - bad + m * (1 - mean) AS b FROM s3, m3),
    c AS (SELECT host, a, b, 1 / (9 * a) AS sa, 1 / (9 * b) AS sb, 1 - 1 / (9 * a) AS ca, 1 - 1 / (9 * b) AS cb, -0.8416 AS z FROM ab),
    r AS (SELECT host, greatest((ca * cb + z * sqrt(greatest(ca * ca * sb + cb * cb * sa - z * z * sa * sb, 0))) / (cb * cb - z * z * sb), 0) ** 3 * a / b AS odds FROM c),
    bound AS (SELECT host, round(odds / (1 + odds), 6) AS bad_bound FROM r),
    rules(rhost, rpath, rverdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
    fit AS (SELECT DISTINCT host, path, arg_max(rhost || rpath, length(rhost || rpath)) OVER w AS rule, arg_max(rverdict, length(rhost || rpath)) OVER w AS rverdict
            FROM (SELECT DISTINCT host, path FROM j), rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) WINDOW w AS (PARTITION BY host, path))
    SELECT page_id, host, path, rule, coalesce(rverdict, CASE WHEN bad_bound > (SELECT share FROM base) THEN 'block' ELSE 'allow' END) AS verdict, bad_bound
    FROM j LEFT JOIN bound USING (host) LEFT JOIN fit USING (host, path)"""

OP1_QUALITY_RULES = """
    WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM w),
    g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
    c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM g),
    r AS (SELECT doc_id, count(DISTINCT i + k2) AS n_repeat_words FROM c, (VALUES (0), (1), (2)) t(k2) WHERE k > 1 GROUP BY 1),
    m AS (SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
          FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
    v AS (SELECT doc_id, lang, source, metric, CAST(floor(1000 * x / n_words) AS BIGINT) AS v FROM b,
            LATERAL (VALUES ('word_length', word_chars), ('symbols', n_symbols), ('dup_lines', n_dup_lines), ('repeats', n_repeat_words)) t(metric, x) WHERE NOT base_failed),
    s AS (SELECT lang, source, metric, greatest(0, length(bin(v)) - 6) * 32 + (v >> greatest(0, length(bin(v)) - 6)) AS bucket, count(*) AS n FROM v GROUP BY ALL),
    a2 AS (SELECT metric, bucket, sum(n) / sum(sum(n)) OVER (PARTITION BY metric) AS share FROM s GROUP BY 1, 2),
    o1 AS (SELECT lang, metric, bucket, sum(n) AS n FROM s GROUP BY 1, 2, 3), t1 AS (SELECT lang, metric, sum(n) AS total FROM s GROUP BY 1, 2),
    a1 AS (SELECT t1.lang, t1.metric, a2.bucket, (coalesce(o1.n, 0) + 30.0 * share) / (total + 30.0) AS share FROM t1 JOIN a2 USING (metric)
           LEFT JOIN o1 ON o1.lang IS NOT DISTINCT FROM t1.lang AND o1.metric = t1.metric AND o1.bucket = a2.bucket),
    t0 AS (SELECT lang, source, metric FROM s GROUP BY 1, 2, 3),
    lv AS (SELECT t0.lang, t0.source, t0.metric, a1.bucket, coalesce(s.n, 0) + 30.0 * share AS n FROM t0 JOIN a1 ON a1.lang IS NOT DISTINCT FROM t0.lang AND a1.metric = t0.metric
           LEFT JOIN s ON s.lang IS NOT DISTINCT FROM t0.lang AND s.source IS NOT DISTINCT FROM t0.source AND s.metric = t0.metric AND s.bucket = a1.bucket),
    u AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, metric ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER (PARTITION BY lang, source, metric) AS total,
            (bucket - greatest(0, bucket // 32 - 1) * 32) << greatest(0, bucket // 32 - 1) AS value FROM lv),
    q AS (SELECT lang, source, metric, min(value) FILTER (round(upto, 6) * 1000 >= round(total, 6) * 250) AS q1, min(value) FILTER (round(upto, 6) * 1000 >= round(total, 6) * 750) AS q3 FROM u GROUP BY ALL),
    slack(metric, two, size) AS (VALUES ('word_length', true, 1000), ('symbols', false, 100), ('dup_lines', false, 50), ('repeats', false, 250)),
    t AS (SELECT lang, source, metric, CASE WHEN two THEN q1 - 6 * (q3 - q1) - size END AS low, q3 + 6 * (q3 - q1) + size AS high FROM q JOIN slack USING (metric)),
    x AS (SELECT v.doc_id, coalesce(v.v < t.low, false) OR v.v > t.high AS odd FROM v JOIN t ON t.metric = v.metric AND t.lang IS NOT DISTINCT FROM v.lang AND t.source IS NOT DISTINCT FROM v.source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce((SELECT bool_or(odd) FROM x WHERE x.doc_id = b.doc_id), false) AS kept, lang, source FROM b"""

OP11_CONVERSATION_REPAIR = """
    WITH RECURSIVE tab AS (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) r(n))),
    j AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id FROM conversations),
    h AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(id) + 1), lambda i: CAST(ascii(id[i]) AS BIGINT))),
                 lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) % 20 AS d FROM j, tab),
    d AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(CASE d WHEN 0 THEN CAST([] AS INTEGER[]) WHEN 3 THEN [1, 2] ELSE [1] END) AS k FROM h),
    o AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink FROM o),
    f AS (SELECT *, CASE WHEN ink = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(ink, 1) IN ('.', '!', '?') THEN '' ELSE 'truncated' END AS fault,
                 coalesce(lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] NOT IN ('su', 'ua', 'au'), false) AS illegal FROM r),
    n AS (SELECT conv_id, count(f.i) AS n, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                 count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
          FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN f USING (conv_id) GROUP BY 1),
    e AS (SELECT s, edit, initial, s2, c, role AS new_role FROM (VALUES (0, 'D', NULL, 0, 4, NULL), (1, 'D', NULL, 1, 4, NULL), (2, 'D', NULL, 2, 4, NULL), (3, 'D', NULL, 3, 4, NULL),
            (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL),
            (0, 'R', NULL, 2, 3, 'user'), (1, 'R', NULL, 2, 3, 'user'), (3, 'R', NULL, 2, 3, 'user'), (2, 'R', NULL, 3, 3, 'assistant')) t(s, edit, initial, s2, c, role)),
    ins(s, s2, c, a, o) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 3, 'I', 'user:'), (1, 2, 3, 'I', 'user:'), (3, 2, 3, 'I', 'user:'),
            (2, 3, 3, 'I', 'assistant:'), (0, 3, 6, 'II', 'user:' || chr(10) || 'assistant:'), (1, 3, 6, 'II', 'user:' || chr(10) || 'assistant:')),
    v AS (
      SELECT conv_id, CAST(0 AS BIGINT) AS i, s2 AS s, CAST(c AS BIGINT) AS c, a, o FROM (SELECT DISTINCT conv_id FROM conversations), ins WHERE ins.s = 0
      UNION ALL
      SELECT conv_id, i, s, b.c, b.a, b.o FROM (
        SELECT w.conv_id, w.i, ins.s2 AS s, arg_min({'c': w.c + ins.c, 'a': w.a || ins.a, 'o': w.o || CASE WHEN w.o = '' OR ins.o = '' THEN '' ELSE chr(10) END || ins.o},
                                                    lpad(CAST(w.c + ins.c AS VARCHAR), 12, '0') || w.a || ins.a) AS b
        FROM (SELECT v.conv_id, f.i, e.s2 AS s, v.c + e.c + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 3 ELSE 0 END AS c, v.a || edit AS a,
                     CASE WHEN edit = 'D' THEN v.o ELSE v.o || CASE WHEN v.o = '' THEN '' ELSE chr(10) END || coalesce(new_role, f.role) || ':' || f.text END AS o
              FROM v JOIN f ON v.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = v.i + 1
              JOIN e ON e.s = v.s AND (edit = 'D' OR fault IN ('', 'truncated')) AND (edit <> 'K' OR initial = f.role[1:1])) w JOIN ins ON w.s = ins.s
        GROUP BY 1, 2, 3))
    SELECT n.conv_id, gaps, blank, duplicate, truncated, illegal, min(v.c) AS cost, arg_min(v.a, lpad(CAST(v.c AS VARCHAR), 12, '0') || v.a) AS audit,
           sha256(arg_min(v.o, lpad(CAST(v.c AS VARCHAR), 12, '0') || v.a)) AS repaired_sha256
    FROM n JOIN v ON n.conv_id IS NOT DISTINCT FROM v.conv_id AND v.i = n.n AND v.s IN (0, 3) GROUP BY 1, 2, 3, 4, 5, 6"""

OP13_COLLOCATIONS = r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
    g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase FROM w, (VALUES (1), (2), (3)) t(m)),
    f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY 1, 2, 3),
    n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY 1),
    c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND a >= 10),
    cut AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.a AS HUGEINT) * y.a) AS score
            FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c JOIN f x ON x.lang = c.lang AND x.m = k AND x.phrase = array_to_string(ws[1:k], ' ')
            JOIN f y ON y.lang = c.lang AND y.m = c.m - k AND y.phrase = array_to_string(ws[k + 1:], ' ')),
    low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    part AS (SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, a FROM c WHERE m = 3),
    longer AS (SELECT lang, phrase, max(a) AS most FROM part GROUP BY 1, 2),
    ranked AS (SELECT low.lang, low.phrase, a, l, r, CAST(score AS BIGINT) AS score, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, low.phrase) AS rank
               FROM low LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
