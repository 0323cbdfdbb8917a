"""DuckDB SQL that gives the rows of those queries that SQL can express."""

_PREFERENCES = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), chosen AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM turns
), replies AS (
    SELECT conv_id, max(place) AS place, arg_max(text, place) AS text FROM chosen WHERE role = 'assistant' GROUP BY conv_id
), swaps AS (
    SELECT conv_id, place, coalesce(lead(text) OVER (ORDER BY conv_id), first_value(text) OVER (ORDER BY conv_id)) AS other FROM replies
), rejected AS (
    SELECT conv_id, place, role, coalesce(other, text) AS text FROM chosen LEFT JOIN swaps USING (conv_id, place)
), apart AS (
    SELECT conv_id, coalesce(min(place) FILTER (c.text <> r.text), max(place) + 1) AS prefix_turns
    FROM chosen c JOIN rejected r USING (conv_id, place) GROUP BY conv_id
), pieces AS (
    SELECT s.*, s.place < prefix_turns AS common, prefix_turns, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece
    FROM (SELECT 'c' AS side, * FROM chosen UNION ALL BY NAME SELECT 'r' AS side, * FROM rejected) s JOIN apart USING (conv_id)
), spans AS (
    SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id, side, common ORDER BY place)::BIGINT AS stop FROM pieces
), marked AS (
    SELECT *, CASE WHEN role = 'assistant' THEN (stop - length(text) - 8) || ':' || stop END AS span FROM spans
)
SELECT conv_id AS pair_id, prefix_turns,
    coalesce(string_agg(piece, '' ORDER BY place) FILTER (common AND side = 'c'), '') AS prompt,
    coalesce(string_agg(piece, '' ORDER BY place) FILTER (NOT common AND side = 'c'), '') AS chosen,
    coalesce(string_agg(piece, '' ORDER BY place) FILTER (NOT common AND side = 'r'), '') AS rejected,
    coalesce(string_agg(span, ',' ORDER BY place) FILTER (NOT common AND side = 'c'), '') AS chosen_mask,
    coalesce(string_agg(span, ',' ORDER BY place) FILTER (NOT common AND side = 'r'), '') AS rejected_mask
FROM marked GROUP BY conv_id, prefix_turns
"""

_HARD_NEGATIVES = """
WITH sound AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS own, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
    FROM sound a JOIN sound r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 3
"""

_CRC = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),"
    " lambda c, x: list_reduce(list_concat([xor(c, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda d, y: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295)"
)

_PERIODIC_RUNS = f"""
WITH split AS (
    SELECT doc_id, {_CRC} AS h, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), edits AS (
    SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a FROM split
), places AS (
    SELECT doc_id, n, i, w[CASE WHEN h % 10 = 0 AND i > a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END + 1] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM edits)
), pairs AS (
    SELECT x.doc_id, x.i, x.i - y.i AS lag FROM places x JOIN places y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i < x.i AND 4 * (x.i - y.i) <= x.n
), diagonals AS (
    SELECT doc_id, lag, min(i) - lag AS start, count(*) + lag AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM pairs)
    GROUP BY doc_id, lag, island HAVING count(*) + lag >= greatest(6, 4 * lag)
), runs AS (
    SELECT doc_id, start, length, min(lag) AS period FROM diagonals GROUP BY doc_id, start, length
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing FROM runs GROUP BY doc_id
), best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM places ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
    sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""

_URL_RULES = """
WITH parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)\\A.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)\\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND prefix(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/') THEN 'com/' END AS rule,
        regexp_full_match(host || path, '(?s)[^/]*(casino|bets|betting|poker|cheap-|pills|pharm[^/]cy)[^/]*(/.*)?|([^/]*\\.)?ads-[^/]*(/.*)?|([^/]*\\.)?track[^/]?\\.[^/]*(/.*)?'
            || '|[^/]*/(.*/)?wp-login\\.[^/]*|[^/]*/.*/cart/.*|[^/]*/login(/.*)?|.*\\.exe|.*\\.apk|[^/]*/tag/.*|[^/]*/.*/page/[^/]*') AS blocked,
        regexp_full_match(host || path, '(?s)help\\.[^/]*(/.*)?|[^/]*/help/.*') AS let_through
    FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN blocked AND NOT let_through THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

def _divided(name: str, nodes: str, parent: str, child: str) -> str:
    """CTEs that end in ``name``: the nodes (parent columns, child, supply, weight, budget) with what each of them gets."""
    family = f"PARTITION BY {parent}" if parent else ""
    order = f"{family} ORDER BY supply / weight, {child}"
    return f"""
{name}_open AS (
    SELECT *, supply * sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        <= (budget - coalesce(sum(supply) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS satisfied
    FROM ({nodes})
), {name}_share AS (
    SELECT *, CASE WHEN satisfied THEN supply ELSE
        (budget - coalesce(sum(supply) FILTER (satisfied) OVER ({family}), 0)) * weight // sum(weight) FILTER (NOT satisfied) OVER ({family}) END AS share
    FROM {name}_open
), {name} AS (
    SELECT *, share + CASE WHEN share < supply
        AND count(*) FILTER (share < supply) OVER ({order} ROWS UNBOUNDED PRECEDING) <= budget - sum(share) OVER ({family}) THEN 1 ELSE 0 END AS got
    FROM {name}_share
)"""


_MIXING = f"""
WITH docs AS (
    SELECT doc_id, CASE WHEN number = '' THEN 'other' ELSE 'd' || number::INTEGER // 5 END AS domain, language, source, n_tokens
    FROM (SELECT doc_id, coalesce(lang, '') AS language, coalesce(source, '') AS source, regexp_extract(coalesce(source, ''), '^src([0-9]{{1,9}})$', 1) AS number,
        len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n_tokens FROM documents)
), leaves AS (
    SELECT domain, language, source, sum(n_tokens)::BIGINT AS tokens, 2 * sum(n_tokens)::BIGINT AS supply,
        CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 WHEN 'd3' THEN 2 ELSE 1 END AS w_domain,
        CASE language WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w_language
    FROM docs GROUP BY ALL
),{_divided("domains", "SELECT domain, sum(supply)::BIGINT AS supply, max(w_domain) AS weight, (SELECT sum(n_tokens) * 90 // 100 FROM docs) AS budget FROM leaves GROUP BY domain", "", "domain")},
{_divided("languages", "SELECT l.domain, language, sum(l.supply)::BIGINT AS supply, max(w_language) AS weight, got AS budget FROM leaves l JOIN domains d ON l.domain = d.domain GROUP BY l.domain, language, got", "domain", "language")},
{_divided("sources", "SELECT l.domain, l.language, source, l.supply, 1 AS weight, got AS budget FROM leaves l JOIN languages d ON l.domain = d.domain AND l.language = d.language", "domain, language", "source")},
given AS (
    SELECT domain, language, source, got, CASE WHEN tokens > 0 THEN got // tokens ELSE 0 END::BIGINT AS whole FROM sources JOIN leaves USING (domain, language, source)
), placed AS (
    SELECT d.*, got, whole, coalesce(sum(n_tokens) OVER (PARTITION BY domain, language, source
        ORDER BY md5('11:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
        sum(n_tokens) OVER (PARTITION BY domain, language, source) AS tokens
    FROM docs d JOIN given USING (domain, language, source)
)
SELECT doc_id, domain, language, source, n_tokens, unnest(range(whole + CASE WHEN start < got - whole * tokens THEN 1 ELSE 0 END))::BIGINT AS epoch, got::BIGINT AS budget
FROM placed
"""

# All pairs that share an n-gram are compared; a band that misses a pair of 0.8 (one in a thousand) would show as a difference.
_NGRAM_JOIN = """
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL
), sets AS (
    SELECT doc_id, list_sort(list_distinct(list_transform(range(greatest(len(w) - 4, least(len(w), 1))), lambda i: array_to_string(w[i + 1:i + 5], ' ')))) AS grams FROM split
), classes AS (
    SELECT grams, len(grams) AS size, min(doc_id) AS rep, count(DISTINCT doc_id) AS copies FROM sets GROUP BY grams
), grams AS (
    SELECT rep, size, copies, unnest(grams) AS gram FROM classes
), links AS (
    SELECT a.rep AS a, b.rep AS b, b.copies AS copies FROM grams a JOIN grams b ON a.gram = b.gram AND a.rep <> b.rep
    GROUP BY a.rep, b.rep, a.size, b.size, b.copies HAVING 10 * count(*) >= 8 * (a.size + b.size - count(*))
), reached AS (
    SELECT a AS rep, a AS other FROM links UNION SELECT r.rep, l.b FROM reached r JOIN links l ON l.a = r.other
), joined AS (
    SELECT rep, min(other) AS class_id FROM reached GROUP BY rep
), linked AS (
    SELECT a AS rep, sum(copies) AS linked FROM links GROUP BY a
)
SELECT doc_id, min(coalesce(class_id, rep)) AS class_id, min(rep) AS copy_of, max(copies - 1 + coalesce(linked, 0))::BIGINT AS n_links
FROM sets JOIN classes USING (grams) LEFT JOIN joined USING (rep) LEFT JOIN linked USING (rep) GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, NULL, NULL FROM documents WHERE doc_id IS NULL
"""

SQL = {"op4_preferences": _PREFERENCES, "op6_mixing": _MIXING, "op10_ngram_join": _NGRAM_JOIN, "op11_hard_negatives": _HARD_NEGATIVES, "op12_periodic_runs": _PERIODIC_RUNS, "op13_url_rules": _URL_RULES}
