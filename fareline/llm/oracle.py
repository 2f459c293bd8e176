"""SQL twins of the text queries, for DuckDB over the same tables."""

from __future__ import annotations

from fareline.llm.queries import URL_RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: str) -> str:
    return f"CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END"


def _host(url: str) -> str:
    return f"translate(regexp_extract({_after_scheme(url)}, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"


def _path(url: str) -> str:
    return f"regexp_extract({_after_scheme(url)}, '^[^/?#]*([^?#]*)', 1)"


def _node(url: str) -> str:
    """Host, path without dot segments, and query; the path is written again segment by segment, as a text."""
    query = f"regexp_extract({_after_scheme(url)}, '^[^?#]*(\\?[^#]*)', 1)"
    steps = f"list_concat([''], string_split({_path(url)}, '/')[2:])"
    walked = (f"list_reduce({steps}, lambda done, s: CASE s WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') WHEN '.' THEN done "
              "ELSE done || '/' || s END)")
    folder = f"CASE WHEN regexp_matches({_path(url)}, '/\\.\\.?$') OR {walked} = '' THEN '/' ELSE '' END"
    return f"CASE WHEN {_host(url)} <> '' THEN {_host(url)} || {walked} || {folder} || {query} END"


def _resolved(target: str, base: str) -> str:
    """A target against the url it stands in."""
    rooted = f"CASE WHEN {_path(base)} = '' THEN '/' ELSE {_path(base)} END"
    origin = f"regexp_extract({base}, '^(.*?://[^/?#]*)', 1)"
    return f"""CASE WHEN regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {target}
    WHEN starts_with({target}, '//') THEN regexp_extract({base}, '^(.*?:)//', 1) || {target}
    WHEN starts_with({target}, '/') THEN {origin} || {target}
    WHEN starts_with({target}, '?') THEN {origin} || {rooted} || {target}
    WHEN starts_with({target}, '#') THEN {base}
    ELSE {origin} || regexp_extract({rooted}, '^(.*/)', 1) || {target} END"""


_HREF = """(?i)\\bhref\\s*=\\s*["'']?\\s*([^"''\\s>]+)"""


def _ruled(host: str, path: str, what: str) -> str:
    """``what`` of the longest rule that fits."""
    ordered = sorted(URL_RULES, key=lambda r: (-len(r.text), r.verdict != "allow", r.text))
    cases = " ".join(
        f"WHEN ({host} = '{r.host}' OR {host} LIKE '%.{r.host}') AND starts_with({path}, '{r.path}') "
        f"THEN '{getattr(r, what)}'" for r in ordered)
    return f"CASE {cases} END"


_URLS = f"""WITH RECURSIVE parsed AS (
  SELECT page_id, url, html, {_host("url")} AS host, {_path("url")} AS path, {_node("url")} AS node,
         replace(coalesce(list_filter(list_transform(regexp_extract_all(html, '(?i)<base\\b[^>]*>'),
           lambda tag: regexp_extract(tag, '{_HREF}', 1)), lambda h: h <> '')[1], ''), '&amp;', '&') AS told
  FROM pages
), tags AS (
  SELECT *, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) AS tag FROM parsed
), links AS (
  SELECT *, replace(CASE
    WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, '(?i)\\brel\\s*=\\s*["'']?\\s*canonical\\b')
      THEN regexp_extract(tag, '{_HREF}', 1)
    WHEN regexp_matches(tag, '(?i)^<meta') AND regexp_matches(tag, '(?i)\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh\\b')
      THEN regexp_extract(tag, '(?i);\\s*url\\s*=\\s*[''"]?\\s*([^"''\\s>]+)', 1)
    ELSE '' END, '&amp;', '&') AS target
  FROM tags
), based AS (
  SELECT node, target, CASE WHEN told = '' THEN url ELSE {_resolved("told", "url")} END AS base FROM links WHERE target <> ''
), goals AS (
  SELECT node, {_resolved("target", "base")} AS goal FROM based
), edges AS (
  SELECT node AS a, {_node("goal")} AS b FROM goals
), both_ways AS (
  SELECT a, b FROM edges WHERE a IS NOT NULL AND b IS NOT NULL
  UNION SELECT b, a FROM edges WHERE a IS NOT NULL AND b IS NOT NULL
), reached AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON r.b = e.a
), blocked AS (
  SELECT DISTINCT a AS node FROM reached
  WHERE {_ruled("regexp_extract(b, '^([^/?#]*)', 1)", "regexp_extract(b, '^[^/?#]*([^?]*)', 1)", "verdict")} = 'block'
)
SELECT page_id, host, path, {_ruled("host", "path", "text")} AS rule,
       coalesce({_ruled("host", "path", "verdict")}, CASE WHEN blocked.node IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM parsed LEFT JOIN blocked USING (node)"""

_NEAREST = """WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_inner_product(q.v, c.v) AS BIGINT)) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

_EQUAL_TEXTS = """WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY t)"""

_SPACES = r"[\x20\x09-\x0D]"


def _edit(state: str, edit: str, cost: str, role: str, text: str) -> str:
    """The state reached by an edit that leaves a row, as a struct of cost, edits and repaired lines."""
    return f"{{'c': {state}.c + {cost}, 'e': {state}.e || '{edit}', 'l': list_append({state}.l, {role} || ':' || {text})}}"


def _deleted(state: str) -> str:
    return f"{{'c': {state}.c + 3, 'e': {state}.e || 'D', 'l': {state}.l}}"


def _kept(state: str, initial: str) -> str:
    """Keeping the row, out of reach where it must go or has another initial."""
    dear = f"CASE WHEN must_go OR left(role, 1) <> '{initial}' THEN 1000000000000 ELSE open END"
    return _edit(state, "K", dear, "role", "text")


def _reroled(state: str, role: str) -> str:
    return _edit(state, "R", "CASE WHEN must_go THEN 1000000000000 ELSE 2 + open END", f"'{role}'", "text")


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _inserted(state: str, role: str) -> str:
    return _edit(state, "I", "2", f"'{role}'", "''")


# Forwards: the least (cost, edits) with which the rows so far lead to each state; s0 start, s1 after s, s2 after u, s3 after a.
_REPAIRED = f"""WITH RECURSIVE bytes AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
    ORDER BY i) AS remainders FROM (SELECT unnest(range(256)) AS i)
), filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ')
    || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations
), faulty AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(place, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda x, b: xor(x // 256, remainders[xor(x, b) % 256 + 1])), 4294967295) % 20 AS fault FROM filled, bytes
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM faulty
), placed AS (
  SELECT *, row_number() OVER conv AS i, lag(left(role, 1)) OVER conv || left(role, 1) AS pair, regexp_extract(text, '([^\x20\x09-\x0D]){_SPACES}*$', 1) AS final
  FROM damaged WINDOW conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))
), marked AS (
  SELECT *, final = '' AS blank, final <> '' AND nth > 1 AS duplicate, final NOT IN ('', '.', '!', '?') AND nth = 1 AS truncated
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed)
), rows_of AS (
  SELECT *, blank OR duplicate AS must_go, CAST(truncated AS BIGINT) AS open FROM marked
), paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'e': '', 'l': CAST([] AS VARCHAR[])}} AS s0,
    {{'c': CAST(1000000000000 AS BIGINT), 'e': '', 'l': CAST([] AS VARCHAR[])}} AS s1,
    {{'c': CAST(1000000000000 AS BIGINT), 'e': '', 'l': CAST([] AS VARCHAR[])}} AS s2,
    {{'c': CAST(1000000000000 AS BIGINT), 'e': '', 'l': CAST([] AS VARCHAR[])}} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {_deleted("s0")}, {_least(_deleted("s1"), _kept("s0", "s"))},
    {_least(_deleted("t2"), *(f(x, v) for x in ("s0", "s1", "t3") for f, v in ((_kept, "u"), (_reroled, "user"))))},
    {_least(_deleted("t3"), _kept("t2", "a"), _reroled("t2", "assistant"))}
  FROM (
    SELECT *, {_least("s3", _inserted("t2", "assistant"))} AS t3 FROM (
      SELECT p.conv_id, p.s0, p.s1, p.s3, r.i, r.role, r.text, r.must_go, r.open,
        {_least("p.s2", *(_inserted(f"p.{x}", "user") for x in ("s0", "s1", "s3")))} AS t2
      FROM paths p JOIN rows_of r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1))
), ends AS (
  SELECT conv_id, {_least("s0", "s3", _inserted("s2", "assistant"), _inserted(_inserted("s1", "user"), "assistant"))} AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM paths) WHERE back = 1
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.e AS audit,
  sha256(array_to_string(best.l, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""



def _nearest(name: str, books: str) -> str:
    """Each part's nearest entry, by comparing it with all."""
    apart = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""{name} AS (
  SELECT rid, part, v, min({{'far': far, 'entry': entry}}) AS best FROM (
    SELECT p.rid, p.part, p.v, b.entry, CAST({apart} AS BIGINT) AS far FROM parts p JOIN {books} b USING (part))
  GROUP BY rid, part, v
)"""


def _means(name: str, near: str, books: str) -> str:
    """Entries as the floor of the mean of their parts."""
    return f"""{name}_sums AS (
  SELECT part, best.entry AS entry, i, sum(v[i])::BIGINT AS total, count(*) AS n
  FROM {near}, (SELECT unnest(range(1, 5)) AS i) GROUP BY part, best.entry, i
), {name}_moved AS (
  SELECT part, entry, list(CASE WHEN total >= 0 OR total % n = 0 THEN total // n ELSE total // n - 1 END ORDER BY i) AS v
  FROM {name}_sums GROUP BY part, entry
), {name} AS (
  SELECT part, entry, coalesce(m.v, b.v) AS v FROM {books} b LEFT JOIN {name}_moved m USING (part, entry)
)"""


_CODES = f"""WITH whole AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS (
  SELECT rid, part, v[4 * part + 1 : 4 * part + 4] AS v FROM whole, (SELECT unnest(range(16)) AS part)
), books0 AS (
  SELECT part, rid - 1 AS entry, v FROM parts WHERE rid <= 64
), {_nearest("near0", "books0")}, {_means("books1", "near0", "books0")}, {_nearest("near1", "books1")},
{_means("books2", "near1", "books1")}, {_nearest("near2", "books2")}, coded AS (
  SELECT rid, string_agg(lpad(lower(to_hex(best.entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best.far) AS BIGINT) AS error
  FROM near2 GROUP BY rid
), told AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM whole JOIN coded USING (rid), told"""

LLM_ORACLE_SQL: dict[str, str] = {
    "op4_topk": _NEAREST,
    "op5_exact_dedup": _EQUAL_TEXTS,
    "op9_url_filter": _URLS,
    "op12_vector_codes": _CODES,
    "op13_conversation_repair": _REPAIRED,
}
