"""SQL for the queries that SQL can express, over the whole tables."""

from sluice.llm import licenses

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

QUALITY_RULES = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, t,
    list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT r, i FROM windows JOIN (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1) USING (r, g)
), repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
  FROM d LEFT JOIN repeats USING (r)
), f AS (
  SELECT *, (
    CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 25 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 50 * word_chars THEN 64 ELSE 0 END)::BIGINT AS failures
  FROM m
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, failures = 0 AS kept FROM f
"""

DECONTAMINATION = f"""
WITH i AS (
  SELECT item_id, regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), iw AS (
  SELECT DISTINCT item_id, s, array_to_string(w[p:p + s - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS s, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)
), dw AS (
  SELECT r, s, p, array_to_string(w[p:p + s - 1], ' ') AS g
  FROM (SELECT r, w, s, unnest(range(1, len(w) - s + 2)) AS p FROM d, (SELECT DISTINCT s FROM iw) WHERE len(w) >= s)
), hits AS (
  SELECT r, item_id, s, p FROM dw JOIN iw USING (s, g)
), words AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(p, p + s)) AS p FROM hits) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

WARC = """
WITH p AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

_quoted = lambda text: "'" + text.replace("'", "''") + "'"
_spelled = ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in licenses.SPELLINGS.items())


_BEGIN = "(?i)^[^\\p{L}\\p{N}©]*(?:(?:some )?(?:portions|parts|modifications)[ \\t:,-]+)?"
_YEAR = ".*\\b(?:19|20)\\d\\d\\b"
_NAME = "(?-i:\\p{Lu})[^ \\t\\r]*"


def _statement(line: str) -> str:
    """SQL of whether a line is a statement of copyright, one way of being one after the other."""
    has = lambda pattern: f"regexp_matches({line}, {_quoted(_BEGIN + pattern)})"
    word, after = "copyrights?", "(?:[ \\t:,.-]*)"
    sign = "(?:\\(c\\)|©|&copy;|[\\[{<])"
    ways = [
        has("©"),
        has(f"{word}{after}{sign}"),
        has(f"{word}[ \\t:,.-]+(?:\\p{{N}}|by\\b)"),
        f"(NOT {has(f'{word}[ \\t:,.-]+(?:{licenses.GOES_ON})\\b')} AND ({has(f'{word}[ \\t:,.-]+(?-i:\\p{{Lu}})')} OR {has(f'{word}[^\\p{{L}}\\p{{N}}]{_YEAR}')}))",
        has(f"\\(c\\)[ \\t]*(?:copyright\\b|{sign}|\\p{{N}}|{_YEAR}|[^\\s.]+[ \\t\\r]*$)"),
        has(f"\\(c\\)[ \\t]*{_NAME}(?:[ \\t]+(?:{_NAME}|<[^ \\t\\r]+>|&|and|of|the|de|von))*[ \\t\\r]*$"),
    ]
    return " OR ".join(ways)


def _canonical(text: str) -> str:
    """SQL of the canonical form, line by line and without the shortcuts that the query takes."""
    lines = f"list_filter(string_split({text}, chr(10)), lambda l: NOT ({_statement('l')}))"
    words = f"string_split(trim(regexp_replace(lower(array_to_string({lines}, chr(10))), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    out = f"array_to_string(list_transform({words}, lambda w: coalesce(MAP {{{_spelled}}}[w], w)), ' ')"
    for named, general in licenses.PARTIES:
        out = f"regexp_replace({out}, {_quoted(named)}, {_quoted(general)}, 'g')"
    return out


def _whole(text: str) -> str:
    """SQL of a text without the lines that only reserve all rights."""
    reserved = f"(?i)^[^\\p{{L}}\\p{{N}}]*{licenses.RESERVED}[^\\p{{L}}\\p{{N}}]*$"
    return f"array_to_string(list_filter(string_split({text}, chr(10)), lambda x: NOT regexp_matches(x, {_quoted(reserved)})), chr(10))"


_values = lambda rows: ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in rows)

LICENSES = f"""
WITH k AS (
  SELECT sha256(c) AS h, whole, min(i) AS license_id FROM (
    SELECT i, {_canonical(_whole("t"))} AS c, true AS whole FROM (VALUES {_values(licenses.layouts())}) AS v(i, t)
    UNION ALL SELECT i, {_canonical("t")}, false FROM (VALUES {_values(licenses.notices())}) AS v(i, t)
  ) GROUP BY 1, 2
  UNION ALL SELECT h, true, i FROM (VALUES {_values((i, d) for i, digests in licenses.DIGESTS.items() for d in digests)}) AS v(i, h)
), d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
u AS (SELECT r, {_canonical(_whole("t"))} AS c, true AS whole FROM d
  UNION ALL SELECT r, {_canonical("l")}, false FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)),
f AS (
  SELECT r, max(CASE WHEN u.whole THEN license_id END) AS license_id, count(CASE WHEN NOT u.whole THEN 1 END) AS n_notices,
    string_agg(DISTINCT CASE WHEN NOT u.whole THEN license_id END, ',' ORDER BY CASE WHEN NOT u.whole THEN license_id END) AS notices
  FROM u JOIN k ON sha256(u.c) = k.h AND u.whole = k.whole WHERE u.c <> '' GROUP BY r
)
SELECT doc_id, license_id, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices FROM d LEFT JOIN f USING (r)
"""

COLLOCATIONS = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS s
  FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(s, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS v(k) WHERE len(w) >= k)
), f AS (
  SELECT lang, k, g, count(*) AS a FROM g GROUP BY ALL
), cut AS (
  SELECT f.lang, f.k, g, a, c, array_to_string(string_split(g, ' ')[:c], ' ') AS first, array_to_string(string_split(g, ' ')[c + 1:], ' ') AS rest
  FROM f, (VALUES (1), (2)) AS v(c) WHERE f.k > c AND a >= 10
), scored AS (
  SELECT cut.lang, cut.k, cut.g, cut.a, x.a AS l, y.a AS r, (1000000::HUGEINT * cut.a * cut.a // (x.a::HUGEINT * y.a))::BIGINT AS score,
    row_number() OVER (PARTITION BY cut.lang, cut.g ORDER BY 1000000::HUGEINT * cut.a * cut.a // (x.a::HUGEINT * y.a), c) AS nth
  FROM cut JOIN f x ON x.lang = cut.lang AND x.g = first AND x.k = c JOIN f y ON y.lang = cut.lang AND y.g = rest AND y.k = cut.k - c
), longest AS (
  SELECT lang, g, max(a) AS m FROM (
    SELECT lang, array_to_string(string_split(g, ' ')[:2], ' ') AS g, a FROM f WHERE k = 3 AND a >= 10
    UNION ALL SELECT lang, array_to_string(string_split(g, ' ')[2:], ' '), a FROM f WHERE k = 3 AND a >= 10
  ) GROUP BY ALL
), kept AS (
  SELECT lang, g AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank
  FROM scored LEFT JOIN longest m USING (lang, g) WHERE nth = 1 AND (scored.k = 3 OR m.m IS NULL OR 100 * m.m < 50 * a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank FROM s) WHERE rank <= 5
"""

ORACLES = {
    "op3_license_scan": LICENSES,
    "op2_warc": WARC,
    "op4_quality_rules": QUALITY_RULES,
    "op6_decontamination": DECONTAMINATION,
    "op12_collocations": COLLOCATIONS,
    "op13_top_k": TOP_K,
}
