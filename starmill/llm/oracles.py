"""The operators that SQL can express, as plain SQL for a second engine.

Not here: operators that learn weights (2, 6, 9) or sum logarithms (10), and the templates
of 7, whose patterns look behind. Those are tested against brute force or held-out labels.
"""

from __future__ import annotations

from starmill.llm.conversation_sql import REPAIR, TRIE

_WORDS = r"""list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"""

# Runs of removed starts of a fixed size, merged where they touch, and what is left between.
_RUNS = """
    runs AS (SELECT doc_id, min(p) AS a, max(p) + {size} AS b FROM (
        SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
            SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {size}
                              THEN 1 ELSE 0 END AS new FROM gone))
        GROUP BY doc_id, run),
    parts AS (
        SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e
        FROM runs
        UNION ALL SELECT doc_id, max(b), NULL FROM runs GROUP BY doc_id)"""

SUFFIX = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
          FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM d)),
    gone AS (SELECT w.doc_id, w.p FROM w JOIN (SELECT s, min(doc_id) AS m FROM w GROUP BY s) f
             ON w.s = f.s AND w.doc_id > f.m),
    {_RUNS.format(size=50)},
    kept AS (
        SELECT doc_id, string_agg(CASE WHEN e IS NULL THEN substr(h, 2 * s + 1)
                                       ELSE substr(h, 2 * s + 1, 2 * (e - s)) END, '' ORDER BY s) AS h
        FROM parts JOIN d USING (doc_id) GROUP BY doc_id),
    sums AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)"""

SUBSTRING = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
    w AS (SELECT doc_id, p, array_to_string(words[p + 1 : p + 20], ' ') AS s
          FROM (SELECT doc_id, words, unnest(range(0, len(words) - 19)) AS p FROM d)),
    gone AS (SELECT doc_id, p FROM w
             QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
    {_RUNS.format(size=20)},
    kept AS (
        SELECT doc_id, string_agg(array_to_string(words[s + 1 : coalesce(e, len(words))], ' '), ' '
                                  ORDER BY s) AS t
        FROM parts JOIN d USING (doc_id) WHERE s < coalesce(e, len(words)) GROUP BY doc_id),
    sums AS (SELECT doc_id, sum(b - a) AS n FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(words, ' ') ELSE coalesce(t, '') END)
           AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)"""

NEAR = f"""
WITH RECURSIVE
    d AS (SELECT doc_id, {_WORDS.format(
        text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )} AS words FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(words[p + 1 : p + 5], ' ') AS shingle
          FROM (SELECT doc_id, words, unnest(range(0, greatest(len(words) - 4, least(len(words), 1))))
                       AS p FROM d)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    links AS (
        SELECT a, b FROM (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
            FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2)
        JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
        WHERE 100 * n_both >= 85 * (na.n + nb.n - n_both)),
    reach AS (
        SELECT a, b FROM links
        UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least_ AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(b, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_ ON a = d.doc_id"""

# Shares by largest remainder (the sources of these tables all get a slot or more), then one
# period of the schedule step by step, then blocks of 32 documents in the order of a hash.
MIXING = """
WITH RECURSIVE
    x AS (SELECT source, n, 1000 * sqrt(n) / sum(sqrt(n)) OVER () AS x
          FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)),
    f AS (SELECT *, greatest(floor(x), 1) AS f,
                 row_number() OVER (ORDER BY x - floor(x) DESC, '=' || source) AS turn FROM x),
    shares AS (SELECT source, n, CAST(f AS BIGINT)
                      + CASE WHEN turn <= 1000 - sum(f) OVER () THEN 1 ELSE 0 END AS a FROM f),
    everyone AS (SELECT list(source ORDER BY '=' || source) AS sources,
                        list(a ORDER BY '=' || source) AS a FROM shares),
    steps AS (
        SELECT -1 AS t, list_transform(a, lambda s: 0) AS done, 0 AS pick FROM everyone
        UNION ALL
        SELECT t + 1, list_transform(done, lambda n, i: n + CASE WHEN i = next THEN 1 ELSE 0 END),
               next
        FROM (SELECT t, done, CAST(list_min(list_transform(range(1, len(a) + 1), lambda i:
                  1000 * CASE WHEN done[i] * 1000 // a[i] <= t + 1 AND done[i] < a[i]
                              THEN ((done[i] + 1) * 1000 + a[i] - 1) // a[i] ELSE 4000 END + i))
                  % 1000 AS BIGINT) AS next
              FROM steps, everyone WHERE t < 999)),
    slots AS (SELECT sources[pick] AS source, t,
                     row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k
              FROM steps, everyone WHERE t >= 0),
    ranked AS (SELECT doc_id, source, row_number() OVER (
                          PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1 AS r
               FROM documents),
    blocks AS (SELECT *, r // 32 AS j FROM ranked JOIN shares USING (source))
SELECT b.doc_id, b.source, CAST(j AS BIGINT) AS block,
       CAST(j * 1000 // a AS BIGINT) AS release,
       CAST(((j + 1) * 1000 + a - 1) // a AS BIGINT) AS deadline,
       CAST(j // a * 1000 + t AS BIGINT) AS slot,
       CAST((j // a * 1000 + t) * 32 + r % 32 AS BIGINT) AS position
FROM blocks b JOIN slots s ON b.source = s.source AND j % a = k"""


def _spans(kind: int, pattern: str, group: int, least: int) -> str:
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
        SELECT doc_id, source, lang, {kind} AS kind, m.a AS a, m.a + length(m.whole) AS b, m.v AS v FROM (
            SELECT doc_id, source, lang, unnest(list_transform(range(1, len(whole) + 1), lambda i: {{
                'a': list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                     + coalesce(list_sum(list_transform(whole[1:i - 1], lambda g: length(g))), 0),
                'whole': whole[i], 'v': part[i]}})) AS m
            FROM (SELECT doc_id, source, lang, string_split_regex(t, {quoted}) AS gaps,
                         regexp_extract_all(t, {quoted}) AS whole,
                         regexp_extract_all(t, {quoted}, {group}) AS part FROM d))
        WHERE length(m.v) >= {least}"""


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

SECRETS = f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
    base AS ({_spans(0, _ASSIGN, 1, 6)} UNION ALL {_spans(1, "AKIA[A-Z0-9]+", 0, 20)}
             UNION ALL {_spans(2, "[0-9a-f]{24,}", 0, 24)}),
    bare AS ({_spans(3, "[A-Za-z0-9+/_.=-]{16,}", 0, 16)} AND regexp_matches(m.v, '[0-9]')),
    valued AS (SELECT *, regexp_replace(v, '[.=]+$', '') AS s FROM base),
    owned AS (
        SELECT s, count(DISTINCT source) AS owners,
               length(s) >= 16 AND regexp_matches(s, '[0-9]') AND regexp_matches(s, '[A-Za-z]')
               AND NOT regexp_matches(s, '(?i)example|sample|dummy|placeholder|change.?me|your|xxxx|test|1234567|abcdef')
               AND len(list_distinct(string_split(s, ''))) >= 8 AS live
        FROM valued GROUP BY s),
    classed AS (SELECT s, CASE WHEN owners > 2 THEN 'copied' WHEN live THEN 'live' END AS class FROM owned),
    places AS (
        SELECT x.doc_id, x.a, x.v, c.s, unnest(range(0, length(x.v) - length(c.s) + 1)) AS p
        FROM bare x JOIN classed c ON c.class = 'live' AND contains(x.v, c.s)),
    outside AS (
        SELECT DISTINCT doc_id, 3 AS kind, a, b FROM (
            SELECT doc_id, a + p AS a, a + p + length(s) AS b FROM places
            WHERE substr(v, p + 1, length(s)) = s AND NOT regexp_matches(substr(v, p + length(s) + 1, 1), '[A-Za-z0-9]')
              AND (p = 0 OR NOT regexp_matches(substr(v, p, 1) || left(s, 1), '^[A-Za-z0-9]{{2}}$'))) x
        WHERE NOT EXISTS (
            SELECT 1 FROM base y WHERE y.doc_id = x.doc_id AND y.a < x.b AND x.a < y.b)),
    named AS (SELECT doc_id, kind, a, b FROM base UNION ALL SELECT * FROM outside),
    listed AS (
        SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex,
               string_agg(['assign', 'access', 'hex', 'live'][kind + 1] || ':' || a || ':' || b, ','
                          ORDER BY a, kind, b) AS spans,
               string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || a || ':' || b, ','
                          ORDER BY a, kind) FILTER (kind < 3) AS base
        FROM named GROUP BY doc_id),
    judged AS (
        SELECT doc_id, count(*) FILTER (class = 'live') AS n_live,
               count(*) FILTER (class = 'copied') AS n_copied
        FROM valued JOIN classed USING (s) GROUP BY doc_id),
    extra AS (SELECT doc_id, count(*) AS n FROM outside GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) + coalesce(extra.n, 0) AS n_live,
       coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN judged USING (doc_id) LEFT JOIN extra USING (doc_id)"""

PAGES = """
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN size >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND page_id < top THEN top END AS refers_to
FROM (SELECT page_id, html, strlen(html) AS size, max(page_id) OVER (PARTITION BY html) AS top
      FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))"""

SQL = {
    "op1_suffix_array_dedup": SUFFIX,
    "op3_secret_scan": SECRETS,
    "op4_substring_dedup": SUBSTRING,
    "op5_mixing": MIXING,
    "op8_minhash_dedup": NEAR,
    "op11_conversation_trie": TRIE,
    "op12_conversation_repair": REPAIR,
    "op13_warc": PAGES,
}
