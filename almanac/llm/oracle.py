"""DuckDB SQL for the queries that SQL can express; constants are stated here again."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_REPUTATION = rf"""
WITH page AS (
    SELECT page_id, row_number() OVER () AS uid,
        coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), outcome AS (
    SELECT host, quality = 1 AND toxic = 0 AS good FROM page LEFT JOIN labels ON doc_id = page_id
), hosts AS (
    SELECT host, coalesce(sum(good::BIGINT), 0)::BIGINT AS k, count(good) AS n,
        array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix
    FROM outcome GROUP BY host
), domains AS (
    SELECT domain, suffix, sum(k)::BIGINT AS k, sum(n)::BIGINT AS n FROM hosts GROUP BY ALL
), suffixes AS (
    SELECT suffix, sum(k)::BIGINT AS k, sum(n)::BIGINT AS n FROM domains GROUP BY ALL
), levels AS (
    SELECT 'host' AS level, k, n FROM hosts UNION ALL SELECT 'domain', k, n FROM domains UNION ALL SELECT 'suffix', k, n FROM suffixes
), sums AS (
    SELECT level, sum(k)::DOUBLE AS k, sum(n)::DOUBLE AS n, count(*) AS g, sum(n * n)::DOUBLE AS sq, sum(k * k / n) AS b
    FROM levels WHERE n > 0 GROUP BY level
), fitted AS (
    SELECT level, k / n AS m, (b - n * (k / n) * (k / n) - (g - 1) * (k / n) * (1 - k / n)) / nullif(n - sq / n, 0) AS v FROM sums
), prior AS (
    SELECT level, m, greatest(1.0, least(10000.0, CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 10000.0 END)) AS weight FROM fitted
), suffix_mean AS (
    SELECT suffix, (k + m * weight) / (n + weight) AS mean FROM suffixes, prior WHERE level = 'suffix'
), domain_mean AS (
    SELECT domain, (k + mean * weight) / (n + weight) AS mean
    FROM domains JOIN suffix_mean USING (suffix), prior WHERE level = 'domain'
), host_mean AS (
    SELECT host, n, weight, (k + mean * weight) / (n + weight) AS mean
    FROM hosts JOIN domain_mean USING (domain), prior WHERE level = 'host'
), bounds AS (
    SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (n + weight + 1)) AS bound FROM host_mean
), rules(rule, domain, below, says) AS (
    VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
        ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), longest AS (
    SELECT uid, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says
    FROM page JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, below)
    GROUP BY uid
)
SELECT page_id, page.host, path, rule,
    coalesce(says, CASE WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict, round(bound, 6) AS host_bound
FROM page JOIN bounds USING (host) LEFT JOIN longest USING (uid)
"""

MIX_SOURCES = r"""
WITH doc AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        md5(concat_ws(':', '6', coalesce(doc_id::VARCHAR, 'null'), coalesce(text, ''))) AS key
    FROM documents
), of_source AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM doc GROUP BY source
), weighted AS (
    SELECT source, source_size, 3.0 * source_size AS most,
        ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
    FROM of_source
), filled AS (
    SELECT most / weight AS ratio,
        sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM weighted
), level AS (
    SELECT coalesce(arg_min(rest / open, ratio) FILTER (rest / open < ratio), 0) AS level FROM filled
), shared AS (
    SELECT source, source_size, least(most, weight * level)::DOUBLE AS target, round(least(most, weight * level))::BIGINT AS budget
    FROM weighted, level
), ordered AS (
    SELECT doc.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM doc
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
    CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
        + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken
FROM ordered JOIN shared ON ordered.source IS NOT DISTINCT FROM shared.source
"""

TOP_K = """
WITH v AS (
    SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor(64.0 * x::DOUBLE)) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
), scored AS (
    SELECT q.uid, q.vec_id AS query_id, v.vec_id, list_dot_product(q.w, v.w)::BIGINT AS score,
        row_number() OVER (PARTITION BY q.uid ORDER BY list_dot_product(q.w, v.w) DESC, v.vec_id, v.uid)::INTEGER AS rank
    FROM v AS q JOIN v ON q.uid <> v.uid WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, score FROM scored WHERE rank <= 20
"""

BENCHMARK_LEAKS = rf"""
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS uid, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
    FROM documents
), item AS (
    SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark WHERE text IS NOT NULL
), pattern AS (
    SELECT DISTINCT item, least(10, len(words)) AS length, array_to_string(list_slice(words, pos, pos + 9), ' ') AS pattern
    FROM item, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS places(pos) WHERE len(words) > 0
), place AS (
    SELECT uid, words, length, unnest(range(1, len(words) - length + 2)) AS pos
    FROM doc, (SELECT DISTINCT length FROM pattern)
), found AS (
    SELECT uid, pos, place.length, item
    FROM place JOIN pattern ON place.length = pattern.length AND array_to_string(list_slice(words, pos, pos + place.length - 1), ' ') = pattern
), hit AS (
    SELECT uid, count(DISTINCT word) AS n_hit FROM (SELECT uid, unnest(range(pos, pos + length)) AS word FROM found) GROUP BY uid
), items AS (
    SELECT uid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY uid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (uid) LEFT JOIN items USING (uid)
"""

# Matches of each kind and their places: matches and the pieces between them alternate.
def _places(kinds: str) -> str:
    return rf"""doc AS (
    SELECT doc_id, row_number() OVER () AS uid, coalesce(text, '') AS text FROM documents
), kinds(kind, name, pattern) AS (
    VALUES {kinds}
), searched AS (
    SELECT uid, kind, regexp_extract_all(text, pattern) AS found, string_split_regex(text, pattern) AS gaps FROM doc, kinds
), alternating AS (
    SELECT uid, kind, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS value, unnest(gaps[1:len(found)]) AS gap
    FROM searched WHERE len(found) > 0
), place AS (
    SELECT uid, kind, value, start, start + length(value) AS stop
    FROM (
        SELECT uid, kind, value, (length(gap) + coalesce(sum(length(gap) + length(value)) OVER (
            PARTITION BY uid, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start
        FROM alternating)
)"""


def _digest(base: str, every: str) -> str:
    """Counts are added by the caller; checksum of the base spans, and all spans as text."""
    one = "name || ':' || start || ':' || stop"
    return f"""checksum AS (
    SELECT uid, sha256(string_agg({one}, ',' ORDER BY start, kind)) AS base_sha256 FROM {base} JOIN kinds USING (kind) GROUP BY uid
), listed AS (
    SELECT uid, string_agg({one}, ',' ORDER BY start, kind) AS spans FROM {every} JOIN kinds USING (kind) GROUP BY uid
)"""


_VALUE = "[A-Za-z0-9+/_.=-]"
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?(""" + _VALUE + "+)"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

# Equal to the query as long as all documents are in its training sample of 20,000.
SECRET_SCAN = rf"""
WITH {_places(f"(0, 'assign', '{_ASSIGN}'), (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'), (3, 'random', '[A-Za-z0-9+/_=-]+')")},
base AS (
    SELECT *, CASE kind WHEN 0 THEN regexp_extract(value, '{_ASSIGN}', 1) ELSE value END AS secret FROM place
    WHERE kind = 0 AND length(regexp_extract(value, '{_ASSIGN}', 1)) >= 6
        OR kind = 1 AND length(value) >= 20 OR kind = 2 AND length(value) >= 24
), token AS (
    SELECT * FROM place t WHERE kind = 3 AND length(value) >= 16
        AND NOT EXISTS (SELECT 1 FROM base b WHERE b.uid = t.uid AND b.start < t.stop AND t.start < b.stop)
), other_token AS (
    SELECT DISTINCT text, unnest(regexp_extract_all(
        regexp_replace(text, '{_ASSIGN}|AKIA[A-Z0-9]{{16,}}|[0-9a-f]{{24,}}', ' ', 'g'), '[A-Za-z0-9+/_=-]{{4,}}')) AS token
    FROM doc
), sample_token AS (
    SELECT DISTINCT true AS random, regexp_replace(secret, '[^A-Za-z0-9+/_=-]', '', 'g') AS token FROM base
    UNION ALL SELECT false, token FROM other_token GROUP BY token HAVING count(*) > 1
), sample AS (
    SELECT random, token, row_number() OVER () AS n FROM sample_token
), sample_char AS (
    SELECT random, n, unnest(range(1, length(token) + 1)) AS i, strpos('{_ALPHABET}', unnest(string_split(token, ''))) AS c
    FROM sample WHERE token <> ''
), pair AS (
    SELECT DISTINCT random, n, coalesce(lag(c) OVER (PARTITION BY random, n ORDER BY i), 0) AS a, c AS b FROM sample_char
), counted AS (
    SELECT a, b, count(*) FILTER (random) AS r, count(*) FILTER (NOT random) AS o FROM pair GROUP BY a, b
), grid AS (
    SELECT g.a, h.b, coalesce(r, 0)::DOUBLE AS r, coalesce(o, 0)::DOUBLE AS o
    FROM range(68) g(a) CROSS JOIN range(68) h(b) LEFT JOIN counted USING (a, b)
), ratio AS (
    SELECT a, b, round(1000 * ln(
        (0.5::DOUBLE * CASE WHEN sum(r) OVER of_a > 0 THEN r / sum(r) OVER of_a ELSE 1 / 67::DOUBLE END + 0.5::DOUBLE / 67)
        / (0.9::DOUBLE * (o + 10 * CASE WHEN sum(o) OVER () > 0 THEN sum(o) OVER (PARTITION BY b) / sum(o) OVER () ELSE 1 / 67::DOUBLE END)
            / (sum(o) OVER of_a + 10) + 0.1::DOUBLE / 67)))::INTEGER AS ratio
    FROM grid WINDOW of_a AS (PARTITION BY a)
), spelling AS (
    SELECT uid, start, 0 AS folded, value FROM token UNION ALL SELECT uid, start, 1, lower(value) FROM token
), token_char AS (
    SELECT uid, start, folded, unnest(range(1, length(value) + 1)) AS i, strpos('{_ALPHABET}', unnest(string_split(value, ''))) AS b
    FROM spelling
), token_pair AS (
    SELECT uid, start, folded, coalesce(lag(b) OVER (PARTITION BY uid, start, folded ORDER BY i), 0) AS a, b FROM token_char
), judged AS (
    SELECT uid, start, folded FROM token_pair JOIN ratio USING (a, b) GROUP BY ALL HAVING sum(ratio) > 700 * count(*)
), random AS (
    SELECT uid, start FROM judged GROUP BY ALL HAVING count(*) = 2
), every AS (
    SELECT uid, kind, start, stop FROM base UNION ALL SELECT uid, kind, start, stop FROM token JOIN random USING (uid, start)
), {_digest("base", "every")},
counts AS (
    SELECT uid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h FROM base GROUP BY uid
)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
    coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN counts USING (uid) LEFT JOIN checksum USING (uid) LEFT JOIN listed USING (uid)
"""

# A context ends after 80 code points or at the neighbouring entity of its kind.
PRIVATE_DATA = rf"""
WITH {_places(r"(0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'), (2, 'card', '[0-9]+(?:[\x20-][0-9]+)*'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]'), (4, 'term', '\p{L}{2,}')")},
numbered AS (
    SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM place
), passed AS (
    SELECT uid, kind, start, stop, kind || ':' || CASE WHEN kind < 2 THEN lower(value) ELSE digits END AS entity
    FROM numbered
    WHERE CASE kind WHEN 0 THEN true
        WHEN 1 THEN list_bool_and(list_transform(string_split(value, '.'),
            lambda x: length(ltrim(x, '0')) <= 3 AND ('0' || right(ltrim(x, '0'), 3))::INTEGER <= 255))
        WHEN 2 THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1),
            lambda j: CASE WHEN j % 2 = 0 THEN ([0, 2, 4, 6, 8, 1, 3, 5, 7, 9])[substr(reverse(digits), j, 1)::INTEGER + 1]
                ELSE substr(reverse(digits), j, 1)::INTEGER END)) % 10 = 0
        WHEN 3 THEN length(digits) BETWEEN 9 AND 15 ELSE false END
), bounded AS (
    SELECT *, greatest(start - 80, 0, coalesce(lag(stop) OVER of_kind, 0)) AS least,
        least(stop + 80, coalesce(lead(start) OVER of_kind, stop + 80)) AS most
    FROM passed WINDOW of_kind AS (PARTITION BY uid, kind ORDER BY start)
), base AS (
    SELECT uid, kind, start, stop, entity, substr(text, least + 1, start - least) AS before, substr(text, stop + 1, most - stop) AS after
    FROM bounded JOIN doc USING (uid)
), context AS (
    SELECT uid, entity, start, row_number() OVER () AS c, before AS text, start - length(before) AS edge, true AS is_left FROM base
    UNION ALL SELECT uid, entity, start, -row_number() OVER (), after, stop, false FROM base
), context_words AS (
    SELECT uid, entity, c, edge, is_left, text, regexp_extract_all(text, '\p{{L}}{{2,}}') AS found, string_split_regex(text, '\p{{L}}{{2,}}') AS gaps FROM context
), context_alternating AS (
    SELECT uid, entity, c, edge, is_left, length(text) AS size, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS value, unnest(gaps[1:len(found)]) AS gap
    FROM context_words WHERE len(found) > 0
), near AS (
    SELECT uid, entity, lower(value) AS term, (edge + own)::BIGINT AS start, (edge + own + length(value))::BIGINT AS stop
    FROM (
        SELECT *, length(gap) + coalesce(sum(length(gap) + length(value)) OVER (
            PARTITION BY c ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS own
        FROM context_alternating)
    WHERE CASE WHEN is_left THEN own > 0 OR size < 80 ELSE own + length(value) < size OR size < 80 END
), outside AS (
    SELECT * FROM near n WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.uid = n.uid AND b.start < n.stop AND n.start < b.stop)
), together AS (
    SELECT entity, term, count(*) AS n_tc FROM outside GROUP BY ALL
), around AS (
    SELECT entity, sum(n_tc) AS n_c FROM together GROUP BY entity
), corpus AS (
    SELECT term, count(*) AS n_t, sum(count(*)) OVER () AS n
    FROM (SELECT lower(value) AS term FROM place w WHERE kind = 4 AND NOT EXISTS (
        SELECT 1 FROM base b WHERE b.uid = w.uid AND b.start < w.stop AND w.start < b.stop)) GROUP BY term
), given AS (
    SELECT entity, term, n_c::DOUBLE / n AS without, (least(n_tc, n_t) + n_c::DOUBLE / n) / (n_t + 1) AS given
    FROM together JOIN corpus USING (term) JOIN around USING (entity)
), told AS (
    SELECT entity, term FROM given WHERE given >= 0.5 AND given >= 2 * without
), near_told AS (
    SELECT DISTINCT uid, start, stop FROM outside JOIN told USING (entity, term)
), placed AS (
    SELECT uid, start, stop FROM base UNION ALL SELECT uid, start, stop FROM near_told
), further AS (
    SELECT DISTINCT w.uid, w.start, w.stop
    FROM place w JOIN base h ON h.uid = w.uid JOIN told ON told.entity = h.entity AND told.term = lower(w.value)
    WHERE w.kind = 4 AND NOT EXISTS (SELECT 1 FROM placed p WHERE p.uid = w.uid AND p.start < w.stop AND w.start < p.stop)
), every AS (
    SELECT uid, kind, start, stop FROM base
    UNION ALL SELECT uid, 4, start, stop FROM near_told UNION ALL SELECT uid, 4, start, stop FROM further
), {_digest("base", "every")},
counts AS (
    SELECT uid, count(*) FILTER (kind = 0) AS e, count(*) FILTER (kind = 1) AS i, count(*) FILTER (kind = 2) AS c,
        count(*) FILTER (kind = 3) AS p FROM base GROUP BY uid
)
SELECT doc_id, coalesce(e, 0)::BIGINT AS n_email, coalesce(i, 0)::BIGINT AS n_ip, coalesce(c, 0)::BIGINT AS n_card,
    coalesce(p, 0)::BIGINT AS n_phone, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN counts USING (uid) LEFT JOIN checksum USING (uid) LEFT JOIN listed USING (uid)
"""

COLLOCATIONS = rf"""
WITH piece AS (
    SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), phrase_at AS (
    SELECT lang, size, list_slice(words, pos, pos + size - 1) AS words
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM piece, range(1, 6) AS sizes(size) WHERE len(words) >= size)
), counted AS (
    SELECT lang, size, words, count(*)::HUGEINT AS f FROM phrase_at GROUP BY ALL
), total AS (
    SELECT lang, sum(f)::HUGEINT AS n FROM counted WHERE size = 1 GROUP BY lang
), candidate AS (
    SELECT * FROM counted WHERE size > 1 AND f >= 100
), inside AS (
    SELECT lang, f, words[i:i + s - 1] AS words
    FROM candidate, range(1, 5) AS starts(i), range(2, 5) AS sizes(s) WHERE s < size AND i + s - 1 <= size
), kept AS (
    SELECT * FROM candidate c WHERE NOT EXISTS (
        SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.words = c.words AND 100 * i.f >= 100 * c.f)
), cut AS (
    SELECT c.lang, c.words, c.f AS a, k, x.f AS l, y.f AS r, n, (1000 * c.f * n) // (x.f * y.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM kept) c
    JOIN counted x ON x.lang = c.lang AND x.words = c.words[1:k]
    JOIN counted y ON y.lang = c.lang AND y.words = c.words[k + 1:c.size]
    JOIN total ON total.lang = c.lang
), lowest AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), ranked AS (
    SELECT *, array_to_string(words, ' ') AS phrase,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank FROM lowest
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_url_reputation": URL_REPUTATION,
    "op4_private_data": PRIVATE_DATA,
    "op6_mix_sources": MIX_SOURCES,
    "op7_top_k": TOP_K,
    "op8_benchmark_leaks": BENCHMARK_LEAKS,
    "op10_secret_scan": SECRET_SCAN,
    "op13_collocations": COLLOCATIONS,
}
