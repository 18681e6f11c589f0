"""DuckDB SQL for the text queries that SQL can express."""

DECONTAMINATION = r"""
WITH lowered AS (
    SELECT doc_id, NULL AS item_id, text FROM documents
    UNION ALL SELECT NULL, item_id, text FROM benchmark WHERE item_id IS NOT NULL),
words AS (
    SELECT doc_id, item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM lowered),
phrases AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS phrase
    FROM words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i)
    WHERE item_id IS NOT NULL AND len(w) > 0),
sizes AS (SELECT DISTINCT size FROM phrases),
docs AS (SELECT doc_id, w FROM words WHERE item_id IS NULL),
runs AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS r(i)),
found AS (SELECT doc_id, i, size, item_id FROM runs JOIN phrases USING (size, phrase)),
hit AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM found, unnest(range(i, i + size)) AS r(pos) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit ON docs.doc_id = hit.doc_id LEFT JOIN items ON docs.doc_id = items.doc_id
"""

LEXICAL_SEARCH = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS w, n
    FROM (SELECT doc_id, len(found) AS n, array_to_string(found, ' ') AS w FROM (
        SELECT doc_id, regexp_extract_all(
            coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS found
        FROM documents))),
items AS (
    SELECT row_number() OVER () AS query, item_id, string_split(translate(array_to_string(
        regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ') AS w
    FROM benchmark),
asked AS (
    SELECT query, item_id, term, count(*) AS times
    FROM (SELECT query, item_id, unnest(w) AS term FROM items) WHERE term <> '' GROUP BY ALL),
total AS (
    SELECT CAST(count(*) FILTER (n > 0) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length
    FROM docs),
held AS (
    SELECT row, term, count(*) AS tf FROM (
        SELECT row, unnest(string_split(w, ' ')) AS term FROM docs WHERE n > 0)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))
        AS BIGINT) AS weight
    FROM held, total GROUP BY term, docs),
scores AS (
    SELECT query, item_id, doc_id, CAST(sum(times * weight
        * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT)
        AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN docs USING (row), total
    GROUP BY query, item_id, row, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank
    FROM scores WHERE score > 0)
WHERE rank <= 20
"""

COLLOCATIONS = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM texts),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
counts AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase,
        CAST(count(*) AS HUGEINT) AS f
    FROM pieces, (VALUES (1), (2), (3)) AS s(size), unnest(range(1, len(w) - size + 2)) AS r(i)
    GROUP BY ALL HAVING count(*) >= 10),
split AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts),
around AS (
    SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS phrase
        FROM split, (VALUES (1), (2)) AS r(i) WHERE size = 3) GROUP BY lang, phrase),
kept AS (
    SELECT split.* FROM split LEFT JOIN around
        ON around.lang = split.lang AND around.phrase = split.phrase
    WHERE size > 1 AND (most IS NULL OR 100 * most < 50 * a)),
cuts AS (
    SELECT kept.lang, kept.phrase, a, k, x.f AS l, y.f AS r,
        (1000000::HUGEINT * a * a) // (x.f * y.f) AS score
    FROM kept JOIN (VALUES (1), (2)) AS c(k) ON k < kept.size
    JOIN counts x ON x.lang = kept.lang AND x.phrase = array_to_string(w[1:k], ' ')
    JOIN counts y ON y.lang = kept.lang AND y.phrase = array_to_string(w[k + 1:kept.size], ' ')),
lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts),
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
    n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _located(pattern: str, group: int, least: int, source: str = "texts") -> str:
    """Matches of a pattern in DuckDB: number, start, stop and whole match."""
    return f"""
    SELECT doc_id, start, start + length(whole) AS stop, whole FROM (
        SELECT doc_id, whole[i] AS whole, grp[i] AS val,
            list_sum(list_transform(cut[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS start
        FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS cut,
                  regexp_extract_all(text, '{pattern}', 0) AS whole,
                  regexp_extract_all(text, '{pattern}', {group}) AS grp FROM {source}),
            unnest(range(1, len(whole) + 1)) AS r(i))
    WHERE length(val) >= {least}"""


# Written out here on their own, so that a slip in the operator's patterns shows.
_ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
           r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\x20*[:=]\x20*[\"'']?"
           r"([A-Za-z0-9+/_.=-]+)")
_SAMPLES = "example|sample|placeholder|changeme|your|dummy|xxxx|0123456789"

SECRET_SCANS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS (
    SELECT 0 AS kind, * FROM ({_located(_ASSIGN, 2, 8)})
    UNION ALL SELECT 1, * FROM ({_located("AKIA[A-Z0-9]+", 0, 16)})
    UNION ALL SELECT 2, * FROM ({_located("[0-9a-f]+", 0, 32)})),
runs AS ({_located("[A-Za-z0-9+/_=-]{20,}", 0, 20)}),
segments AS (
    SELECT doc_id, piece[i] AS word, start
        + coalesce(list_sum(list_transform(piece[1:i - 1], lambda x: length(x))), 0)
        + coalesce(list_sum(list_transform(held[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT doc_id, start,
              string_split_regex(whole, '[^/=_-]*(?i:{_SAMPLES})[^/=_-]*') AS piece,
              regexp_extract_all(whole, '[^/=_-]*(?i:{_SAMPLES})[^/=_-]*', 0) AS held FROM runs),
        unnest(range(1, len(piece) + 1)) AS r(i)),
classed AS (
    SELECT doc_id, start, regexp_full_match(word, '[0-9a-fA-F]+') AS hexa,
        CASE WHEN regexp_full_match(word, '[0-9a-fA-F]+') THEN lower(word) ELSE word END AS word
    FROM segments
    WHERE length(word) >= 20 AND regexp_matches(word, '[0-9]')
        AND regexp_matches(word, '[A-Za-z]') AND NOT regexp_full_match(
            word, '[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}')),
symbols AS (
    SELECT doc_id, start, hexa, i, symbol, count(*) AS c FROM (
        SELECT doc_id, start, hexa, i,
            unnest(string_split(substr(word, CAST(i AS INT), 20), '')) AS symbol
        FROM classed, unnest(range(1, length(word) - 18)) AS r(i))
    GROUP BY ALL),
high AS (
    SELECT doc_id, start, i, hexa FROM symbols GROUP BY ALL
    HAVING sum(CAST(round(1000000 * c * log2(c)) AS BIGINT))
        <= floor(1000000 * 20 * (log2(20) - CASE WHEN hexa THEN 3.0 ELSE 3.8 END))),
islands AS (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id, start ORDER BY i) AS island FROM (
        SELECT doc_id, start, i, CASE WHEN i - lag(i) OVER (
            PARTITION BY doc_id, start ORDER BY i) <= 20 THEN 0 ELSE 1 END AS fresh FROM high)),
added AS (
    SELECT doc_id, 3 AS kind, start + min(i) - 1 AS start, start + max(i) + 19 AS stop
    FROM islands GROUP BY doc_id, start, island),
spans AS (
    SELECT doc_id, kind, start, stop FROM base
    UNION ALL SELECT * FROM added a WHERE NOT EXISTS (
        SELECT 1 FROM base b WHERE b.doc_id = a.doc_id AND b.start <= a.start AND b.stop >= a.stop)),
named AS (
    SELECT doc_id, kind, start, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':'
        || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM spans),
written AS (
    SELECT doc_id, CAST(count(*) FILTER (kind = 0) AS BIGINT) AS n_assign,
        CAST(count(*) FILTER (kind = 1) AS BIGINT) AS n_access,
        CAST(count(*) FILTER (kind = 2) AS BIGINT) AS n_hex,
        string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
        string_agg(span, ',' ORDER BY start, kind) AS spans
    FROM named GROUP BY doc_id)
SELECT texts.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM texts LEFT JOIN written ON texts.doc_id = written.doc_id
"""
