"""SQL twins of those queries that SQL can express on the whole tables, for DuckDB."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _reach(edges: str) -> str:
    """CTE component(node, component) of the nodes of ``edges`` (a, b)."""
    return (
        f"both_ways AS (SELECT a, b FROM {edges} UNION SELECT b, a FROM {edges}), "
        "reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a), "
        "component AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)"
    )


def jaccard(size: int, percent: int) -> str:
    words = _WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")
    return (
        f"WITH RECURSIVE w AS (SELECT doc_id, {words} AS ws FROM documents), "
        "s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] "
        f"WHEN len(ws) < {size} THEN [array_to_string(ws, ' ')] "
        f"ELSE list_distinct([array_to_string(ws[i:i + {size - 1}], ' ') for i in range(1, len(ws) - {size - 2})]) END AS sh FROM w), "
        "e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s), "
        "links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id "
        f"GROUP BY 1, 2 HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))), "
        + _reach("links")
        + " SELECT doc_id, len(sh) AS n_shingles, coalesce(component, doc_id) AS component_id "
        "FROM s LEFT JOIN component ON node = doc_id"
    )


def substrings(size: int) -> str:
    words = _WORDS.format("coalesce(text, '')")
    return (
        f"WITH w AS (SELECT doc_id, {words} AS ws FROM documents), "
        f"spots AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {size - 2})) AS p FROM w WHERE len(ws) >= {size}), "
        f"again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(ws[p:p + {size - 1}], ' ') "
        "ORDER BY doc_id, p) AS k FROM spots) WHERE k > 1), "
        f"gone AS (SELECT DISTINCT doc_id, p + g AS p FROM again, range({size}) t(g)), "
        "every AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w), "
        "kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS rest FROM every ANTI JOIN gone USING (doc_id, p) GROUP BY 1) "
        "SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 "
        "FROM w LEFT JOIN kept USING (doc_id)"
    )


_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def _part(url: str, group: int) -> str:
    return f"regexp_extract(coalesce({url}, ''), '{_PARTS}', {group})"


def _host(url: str) -> str:
    return f"translate({_part(url, 2)}, '{_UPPER}', '{_LOWER}')"


def _node(url: str) -> str:
    tracking = r"(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?"
    fields = f"list_filter(string_split(substr({_part(url, 4)}, 2), '&'), lambda x: NOT regexp_full_match(x, '{tracking}') AND x <> '')"
    query = f"array_to_string({fields}, '&')"
    return (
        f"CASE WHEN {_host(url)} <> '' THEN regexp_replace({_host(url)}, '^www\\.', '') || regexp_replace({_part(url, 3)}, '/$', '') "
        f"|| CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END"
    )


def url_rules(rules: list[tuple[str, str, str]], default: str) -> str:
    """Rules and url forms, with canonical links and redirects to absolute addresses."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    canonical = r"""(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>"""
    refresh = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>"""
    href, target = r"""(?is)\bhref\s*=\s*["'']?([^"''\s>]+)""", r"""(?is)\burl\s*=\s*["'']?([^"''\s>]+)"""
    found = (
        f"list_concat(list_transform(regexp_extract_all(html, '{canonical}'), lambda t: regexp_extract(t, '{href}', 1)), "
        f"list_transform(regexp_extract_all(html, '{refresh}'), lambda t: regexp_extract(t, '{target}', 1)))"
    )

    def ruled(source: str, key: str) -> str:
        return (
            f"SELECT {key}, arg_max(verdict, (length(rh || rp), verdict)) AS said, arg_max(rh || rp, (length(rh || rp), verdict)) AS rule "
            f"FROM {source}, rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND host <> '' AND starts_with(path, rp) GROUP BY {key}"
        )

    return (
        f"WITH RECURSIVE rules(rh, rp, verdict) AS (VALUES {values}), "
        f"p AS (SELECT row_number() OVER () AS k, page_id, {_host('url')} AS host, {_part('url', 3)} AS path, {_node('url')} AS node, "
        f"{found} AS links FROM pages), "
        "t AS (SELECT DISTINCT node, link FROM (SELECT node, unnest(links) AS link FROM p WHERE node IS NOT NULL) WHERE contains(link, '://')), "
        f"targets AS (SELECT DISTINCT {_host('link')} AS host, {_part('link', 3)} AS path, {_node('link')} AS node FROM t), "
        f"page_said AS ({ruled('p', 'k')}), target_said AS ({ruled('targets', 'node')}), "
        f"edges AS (SELECT node AS a, {_node('link')} AS b FROM t WHERE {_node('link')} IS NOT NULL), "
        + _reach("edges")
        + ", told AS (SELECT node, said FROM p JOIN page_said USING (k) UNION ALL SELECT node, said FROM target_said), "
        "grouped AS (SELECT coalesce(component, told.node) AS g, min(said) AS alias_said FROM told LEFT JOIN component USING (node) GROUP BY 1) "
        f"SELECT page_id, host, path, rule, coalesce(said, alias_said, '{default}') AS verdict, "
        "said IS NULL AND alias_said IS NOT NULL AS reached "
        "FROM p LEFT JOIN page_said USING (k) LEFT JOIN component ON component.node = p.node "
        "LEFT JOIN grouped ON g = coalesce(component, p.node)"
    )


def secret_spans(max_owners: int, max_repos: int) -> str:
    names = ["password", "passwd", "secret", "token", "api_?key"]
    either = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name) for name in names)
    assign = rf"({either})[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
    kinds = [("assign", 0, assign, 2), ("access", 1, "AKIA[A-Z0-9]+", 0), ("hex", 2, "[0-9a-f]{24,}", 0), ("mixed", 3, "[A-Za-z0-9+/_=-]{20,}", 0)]

    def one(name: str, number: int, pattern: str, group: int) -> str:
        return (
            f"SELECT k, {number} AS kind, '{name}' AS name, unnest(string_split_regex(text, '{pattern}')) AS gap, "
            f"unnest(regexp_extract_all(text, '{pattern}')) AS hit, unnest(regexp_extract_all(text, '{pattern}', {group})) AS value, "
            f"unnest(range(len(regexp_extract_all(text, '{pattern}')) + 1)) AS i FROM d"
        )

    spans = " UNION ALL ".join(one(*kind) for kind in kinds)
    listed = "coalesce(string_agg(name || ':' || a || ':' || b, ',' ORDER BY a, kind){}, '')"
    return (
        "WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, source, "
        "concat_ws('/', source, lang) AS repo FROM documents), "
        f"m AS ({spans}), "
        "placed AS (SELECT k, kind, name, hit, value, sum(length(gap)) OVER w + sum(length(hit)) OVER w - length(hit) AS a "
        "FROM m WINDOW w AS (PARTITION BY k, kind ORDER BY i)), "
        "good AS (SELECT k, kind, name, value, CAST(a AS INTEGER) AS a, CAST(a AS INTEGER) + length(hit) AS b FROM placed WHERE hit IS NOT NULL AND CASE kind "
        "WHEN 0 THEN length(value) >= 6 WHEN 1 THEN length(hit) >= 20 WHEN 2 THEN true ELSE regexp_matches(hit, '[a-z]') "
        "AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[0-9]') END), "
        "owned AS (SELECT value, count(DISTINCT source) AS owners, count(DISTINCT (source, repo)) AS repos FROM good JOIN d USING (k) GROUP BY 1), "
        f"told AS (SELECT good.*, owners <= {max_owners} AND repos <= {max_repos} AS live FROM good JOIN owned USING (value)), "
        "base AS (SELECT k, a, b FROM told WHERE kind < 3), "
        "shown AS (SELECT *, kind < 3 OR (live AND NOT EXISTS (SELECT 1 FROM base x WHERE x.k = t.k AND x.a < t.b AND t.a < x.b)) AS shown FROM told t), "
        f"s AS (SELECT k, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, "
        f"count(*) FILTER (WHERE kind = 2) AS n_hex, {listed.format(' FILTER (WHERE kind < 3)')} AS base, {listed.format(' FILTER (WHERE shown)')} AS spans, "
        "count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_copied FROM shown GROUP BY k) "
        "SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, "
        "sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied "
        "FROM d LEFT JOIN s USING (k)"
    )


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def structure_repair() -> str:
    """Faults and cheapest edits of conversations: a walk over the rows of each, which keeps, for each of four
    states, the cheapest edits so far (``c`` the cost, ``a`` the letters, ``t`` the kept rows)."""

    def moved(state: str, cost: str, letter: str, kept: str = "") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t{kept and f' || {kept}'}}}"

    def stays(state: str, role: str, initial: str) -> str:
        same = moved(state, "stay", "K", "chr(10) || role || ':' || text")
        other = moved(state, "stay + 1", "R", f"chr(10) || '{role}:' || text")
        return f"CASE WHEN initial = '{initial}' THEN {same} ELSE {other} END"

    far = "{'c': 1000000000, 'a': '', 't': ''}"
    inserted_user = _least("u", *(moved(q, "5", "I", "chr(10) || 'user:'") for q in ("n", "s", "a")))
    inserted_assistant = _least("a", moved("u1", "5", "I", "chr(10) || 'assistant:'"))
    return f"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS codes FROM bits WHERE k = 8),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS mark FROM conversations
), dealt AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(mark, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: xor(a >> 8, codes[xor(a & 255, b) + 1]))) % 20 AS fate FROM given, crc
), damaged AS (
  SELECT coalesce('v' || conv_id::VARCHAR, 'n') AS conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy FROM dealt WHERE fate <> 0
), placed AS (
  SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM damaged
), told AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY place) AS before, CASE
    WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY place) > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), priced AS (
  SELECT *, CASE fault WHEN 'blank' THEN 100000000 WHEN 'duplicate' THEN 100000000 WHEN 'truncated' THEN 5 ELSE 0 END AS stay FROM told
), walk(conv, place, n, s, u, a) AS (
  SELECT DISTINCT conv, 0::BIGINT, {{'c': 0, 'a': '', 't': ''}}, {far}, {far}, {far} FROM priced
  UNION ALL
  SELECT conv, place, {moved('n', '2', 'D')},
    {_least(moved('s', '2', 'D'), f"CASE WHEN initial = 's' THEN {moved('n', 'stay', 'K', "chr(10) || role || ':' || text")} ELSE {far} END")},
    {_least(moved('u1', '2', 'D'), *(stays(q, 'user', 'u') for q in ('n', 's', 'a1')))},
    {_least(moved('a1', '2', 'D'), stays('u1', 'assistant', 'a'))}
  FROM (SELECT *, {inserted_assistant} AS a1 FROM (
    SELECT p.conv, p.place, p.role, p.text, p.initial, p.stay, n, s, u, a, {inserted_user} AS u1
    FROM walk w JOIN priced p ON p.conv = w.conv AND p.place = w.place + 1))
), ended AS (
  SELECT conv, {_least('n', 'a1')} AS x FROM (SELECT *, {inserted_assistant} AS a1 FROM (
    SELECT w.conv, n, s, u, a, {inserted_user} AS u1 FROM walk w
    JOIN (SELECT conv, max(place) AS place FROM priced GROUP BY conv) l ON l.conv = w.conv AND l.place = w.place))
), counted AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY conv
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(x.c, 0)::BIGINT AS cost, coalesce(x.a, '') AS audit,
  sha256(coalesce(substr(x.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counted c ON c.conv = coalesce('v' || e.conv_id::VARCHAR, 'n') LEFT JOIN ended d ON d.conv = c.conv
"""
