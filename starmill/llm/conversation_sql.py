"""The conversation operators as plain SQL for a second engine, which has no CRC-32 of its own."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit; 999 stands for a shift."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::UBIGINT] || repeat([999::UBIGINT], 8)))"
    step = "CASE WHEN x < 999 THEN xor(a, x) ELSE xor(a >> 1, 3988292384::UBIGINT * (a & 1)) END"
    return f"xor(list_reduce({bits}, lambda a, x: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


# --- repair -----------------------------------------------------------------------------
# A way is its cost in nine digits, its edits, and after chr(1) the repaired lines.


def _add(way: str, cost: str, edit: str, line: str | None = None) -> str:
    head = f"lpad(CAST(CAST(left({way}, 9) AS INT) + {cost} AS VARCHAR), 9, '0')"
    cut = f"strpos({way}, chr(1))"
    out = f"{head} || substr({way}, 10, {cut} - 10) || '{edit}' || chr(1) || substr({way}, {cut} + 1)"
    if line is None:
        return out
    return f"{out} || CASE WHEN right({way}, 1) = chr(1) THEN '' ELSE chr(10) END || {line}"


def _inserted(v: list[str]) -> list[str]:
    user, assistant = "'user:'", "'assistant:'"
    twice = "'user:' || chr(10) || 'assistant:'"
    return [
        v[0],
        v[1],
        f"least({v[2]}, {', '.join(_add(v[k], '3', 'I', user) for k in (0, 1, 3))})",
        f"least({v[3]}, {_add(v[2], '3', 'I', assistant)}, {', '.join(_add(v[k], '6', 'II', twice) for k in (0, 1))})",
    ]


_V, _W = [f"v{k}" for k in range(4)], [f"w{k}" for k in range(4)]
_EXTRA = "CASE fault WHEN 't' THEN 3 ELSE 0 END"


def _to(state: int, initial: str, role: str, sources: tuple[int, ...]) -> str:
    best = f"least({', '.join(_W[k] for k in sources)}, NULL)"
    kept = _add("best", _EXTRA, "K", "role || ':' || text")
    changed = _add("best", f"3 + {_EXTRA}", "R", f"'{role}:' || text")
    moved = f"CASE WHEN must_go THEN NULL WHEN initial = '{initial}' THEN {kept} ELSE {changed} END"
    return f"least({_add(f'w{state}', '4', 'D')}, (SELECT {moved} FROM (SELECT {best} AS best)))"


_FIRST = f"CASE WHEN must_go OR initial <> 's' THEN NULL ELSE {_add('w0', _EXTRA, 'K', 'role || chr(58) || text')} END"

REPAIR = rf"""
WITH RECURSIVE
    coded AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS code
        FROM conversations),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
               CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM coded),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                   sha256(strlen(role) || ':' || role || text), copy) AS pos,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
        FROM damaged),
    judged AS (
        SELECT *, left(role, 1) AS initial, fault IN ('b', 'd') AS must_go FROM (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen > 1 THEN 'd'
                      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault
            FROM placed)),
    ways AS (
        SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, '000000000' || chr(1) AS v0, CAST(NULL AS VARCHAR) AS v1,
               CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3
        FROM conversations
        UNION ALL
        SELECT conv_id, pos, {_add("w0", "4", "D")} AS v0, least({_add("w1", "4", "D")}, {_FIRST}) AS v1,
               {_to(2, "u", "user", (0, 1, 3))} AS v2, {_to(3, "a", "assistant", (2,))} AS v3
        FROM (SELECT j.*, {", ".join(f"{w} AS w{k}" for k, w in enumerate(_inserted(_V)))}
              FROM ways JOIN judged j ON j.conv_id IS NOT DISTINCT FROM ways.conv_id AND j.pos = ways.pos + 1) x),
    last AS (
        SELECT conv_id, least({_inserted(_V)[0]}, {_inserted(_V)[3]}) AS best FROM ways
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
    counted AS (
        SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
               count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
               count(*) FILTER (fault = 't') AS truncated,
               count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('s>u', 'u>a', 'a>u')) AS illegal
        FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || '>' || initial AS pair FROM judged)
        GROUP BY conv_id)
SELECT l.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10, strpos(best, chr(1)) - 10) AS audit,
       sha256(substr(best, strpos(best, chr(1)) + 1)) AS repaired_sha256
FROM last l LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM l.conv_id"""


# --- trie -------------------------------------------------------------------------------

TRIE = f"""
WITH turns AS (
        SELECT conv_id, list(sha256(strlen(r) || ':' || r || x) || '/' || strlen(x)
                             ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)) AS ids
        FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations)
        GROUP BY conv_id),
    own AS (SELECT *, CAST({crc32("CAST(conv_id AS VARCHAR)")} % 9 AS BIGINT) AS h FROM turns),
    built AS (
        SELECT own.conv_id, list_concat(coalesce(base.ids, [])[1:h], own.ids[h + 1:]) AS ids
        FROM own LEFT JOIN turns base ON base.conv_id = own.conv_id - own.conv_id % 5),
    prefixes AS (
        SELECT conv_id, d, len(ids) = d AS ends, array_to_string(ids[1:d], ' ') AS prefix,
               CASE WHEN d > 0 THEN array_to_string(ids[1:d - 1], ' ') END AS up,
               CASE WHEN d > 0 THEN CAST(split_part(ids[d], '/', 2) AS BIGINT) ELSE 0 END AS size
        FROM (SELECT conv_id, ids, unnest(range(0, len(ids) + 1)) AS d FROM built)),
    nodes AS (
        SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(up) AS up, min(size) AS size,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), ''))
                   AS ends_sha256
        FROM prefixes GROUP BY prefix, d),
    children AS (SELECT up AS prefix, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
    full_nodes AS (
        SELECT v.*, coalesce(c.n, 0) AS n_children, u.conv_id AS parent_conv_id
        FROM nodes v LEFT JOIN children c ON c.prefix = v.prefix AND c.d = v.d
        LEFT JOIN nodes u ON u.prefix = v.up AND u.d = v.d - 1),
    sums AS (
        SELECT a.prefix, a.d, count(*) FILTER (u.n_children = 0) AS n_leaves,
               CAST(sum((u.n_convs - 1) * u.size) AS BIGINT) AS saved_tokens
        FROM full_nodes u JOIN prefixes a ON a.conv_id = u.conv_id AND a.d <= u.d GROUP BY a.prefix, a.d)
SELECT conv_id, v.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM full_nodes v JOIN sums s ON s.prefix = v.prefix AND s.d = v.d"""
