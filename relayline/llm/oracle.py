"""DuckDB SQL of the operators' queries, where SQL can express them."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_COMPONENTS = """
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(a, b) AS (
        SELECT a, b FROM both_ways
        UNION
        SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)"""

OP1 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS s
    FROM words),
grams AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM sets),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id
    GROUP BY x.doc_id, y.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
{_COMPONENTS}
SELECT doc_id, len(s)::BIGINT AS n_shingles,
       least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS component_id
FROM sets
"""

_VALID = """embedding IS NOT NULL AND len(embedding) > 0
        AND len([1 for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0"""

OP4 = f"""
WITH whole AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings WHERE {_VALID}),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
"""

_FIXED = r"\### Assistant: </turn> ok"

OP5 = rf"""
WITH every AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{_FIXED}'
    UNION ALL SELECT -7, 1, 'assistant', '{_FIXED}'),
placed AS (
    SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before FROM every
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
    SELECT *, 2 * length(text) - length(regexp_replace(text, '[\\<#:]', '', 'g')) AS text_chars,
           2 * length(role) - length(regexp_replace(role, '[\\<#:]', '', 'g')) AS role_chars
    FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(text_chars + CASE WHEN before IS DISTINCT FROM role
                             THEN length('### ') + role_chars + length(': ') + length('</turn>')
                             ELSE length('<next>') END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP10 = f"""
WITH RECURSIVE valid AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE {_VALID} AND len([1 for x in embedding if x <> 0]) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM valid x JOIN valid y
    ON x.vec_id < y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.95),
{_COMPONENTS}
SELECT vec_id, (SELECT count(*) FROM both_ways WHERE a = vec_id) AS n_links,
       least(vec_id, (SELECT min(b) FROM reach WHERE a = vec_id)) AS component_id,
       vec_id <= coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id) AS kept
FROM embeddings
"""

OP11 = rf"""
WITH pieces AS (
    SELECT lang, unnest(string_split_regex(body, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS body
          FROM documents)),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
phrases AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, len(p) AS k, count(*) AS f FROM (
        SELECT lang, unnest([w[i:i + 0] for i in range(1, len(w) + 1)] || [w[i:i + 1] for i in range(1, len(w))]
                            || [w[i:i + 2] for i in range(1, len(w) - 1)]) AS p FROM words)
    GROUP BY ALL HAVING k = 1 OR f >= 10),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, string_split(phrase, ' ') AS p, f AS a FROM phrases WHERE k >= 2),
halves AS (
    SELECT *, array_to_string(p[1:cut], ' ') AS first, array_to_string(p[cut + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, len(p))) AS cut FROM candidates)),
cuts AS (
    SELECT h.lang, h.phrase, h.p, a, x.f AS l, y.f AS r, cut,
           (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM halves h JOIN phrases x ON x.lang = h.lang AND x.phrase = h.first
    JOIN phrases y ON y.lang = h.lang AND y.phrase = h.rest),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
    SELECT lang, part, max(a) AS longer FROM (
        SELECT lang, a, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS part FROM candidates WHERE len(p) = 3)
    GROUP BY lang, part)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM weakest w JOIN totals t ON t.lang = w.lang LEFT JOIN around o ON o.lang = w.lang AND o.part = w.phrase
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""

OP12 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
terms AS (SELECT doc, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS whole FROM terms GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS size, sum(whole) AS words FROM kept GROUP BY lang),
groups AS (
    SELECT g.lang, g.source, coalesce(sum(n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts USING (lang, source) GROUP BY g.lang, g.source),
dense AS (
    SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
           (1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (total + size))::BIGINT AS p,
           (1 + 1000000000::HUGEINT * (whole + 1) // (words + size))::BIGINT AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (
    SELECT x.lang, x.source, y.source AS item, coalesce(v.value, 0)::BIGINT AS value
    FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
               FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL) v
    ON v.lang = x.lang AND v.source = x.source AND v.item = y.source),
parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM dense WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200
"""

# Every document is queued twice by its key; a target is the level at which
# the sources that stop are a prefix in the order of size / weight.
OP8 = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           sha256('17|' || coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(length(source)::VARCHAR, '-') || '|'
                  || coalesce(source, '') || CASE WHEN text IS NULL THEN '|-' ELSE '|+' || text END) AS key,
           row_number() OVER () AS nth
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
           sum(size)::DOUBLE * 2 AS cap
    FROM sized GROUP BY source),
levels AS (
    SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(cap) OVER before, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM sources
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
    SELECT source, source_size, least(cap, coalesce(final * weight, cap)) AS target
    FROM levels, (SELECT arg_min(level, cap / weight) AS final FROM levels WHERE level * weight <= cap)),
queued AS (
    SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY key, nth) AS through
    FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
runs AS (
    SELECT *, (epoch * source_size + through)::DOUBLE / target AS finish
    FROM queued, (SELECT unnest([0, 1]) AS epoch) WHERE size > 0),
spent AS (
    SELECT nth, sum(size) OVER (ORDER BY finish, source NULLS FIRST, key, nth, epoch) AS spent FROM runs),
taken AS (
    SELECT nth, count(*) AS copies FROM spent
    WHERE spent <= (SELECT floor(sum(size) * 1.5) FROM sized) GROUP BY nth)
SELECT doc_id, size, source_size, target, (coalesce(copies, 0) * size)::BIGINT AS taken,
       coalesce(copies, 0)::BIGINT AS copies
FROM queued LEFT JOIN taken USING (nth)
"""

ORACLE_SQL = {
    "op1_ngram_jaccard_join": OP1,
    "op4_exact_top_k": OP4,
    "op5_chat_formatting": OP5,
    "op8_mixing": OP8,
    "op10_embedding_near_dedup": OP10,
    "op11_phrase_collocations": OP11,
    "op12_source_divergence": OP12,
}
