"""The same results in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

from quillstream.llm import collocations, divergence, licenses

EXACT = """
    SELECT doc_id,
        max(doc_id) OVER same AS keep_id,
        count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept,
        sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# Lines are compared themselves, not by hash.
LINES = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
    ),
    words AS (
        SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos
        FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)
    ),
    windows AS (
        SELECT rid, pos, word, lead(word) OVER next AS second, lead(word, 2) OVER next AS third
        FROM words WINDOW next AS (PARTITION BY rid ORDER BY pos)
    ),
    twice AS (
        SELECT rid, pos FROM windows WHERE third IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY rid, word, second, third) > 1
    ),
    covered AS (
        SELECT rid, count(DISTINCT pos + step) AS n_repeat_words
        FROM twice, (SELECT unnest([0, 1, 2]) AS step) GROUP BY rid
    ),
    word_sums AS (
        SELECT rid, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM words GROUP BY rid
    ),
    lines AS (
        SELECT rid, source, text, line,
            trim(lower(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS plain,
            len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS line_words
        FROM (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS line FROM docs)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    ),
    duplicates AS (
        SELECT rid, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM lines GROUP BY rid
    ),
    hosts AS (SELECT source, count(DISTINCT text) AS documents FROM docs GROUP BY source),
    frequent AS (
        SELECT l.source, l.plain
        FROM (SELECT source, plain, count(DISTINCT text) AS found FROM lines GROUP BY source, plain) l
        JOIN hosts h ON h.source IS NOT DISTINCT FROM l.source
        WHERE found > 100 OR found > 5 AND found > 0.1 * documents
    ),
    removed AS (
        SELECT l.rid, sum(line_words)::BIGINT AS removed_words
        FROM lines l JOIN frequent f ON f.source IS NOT DISTINCT FROM l.source AND f.plain = l.plain
        GROUP BY l.rid
    ),
    facts AS (
        SELECT doc_id,
            coalesce(n_words, 0) AS n_words,
            coalesce(word_chars, 0) AS word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
            coalesce(n_dup_lines, 0) AS n_dup_lines,
            coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
            coalesce(removed_words, 0) AS removed_words
        FROM docs LEFT JOIN word_sums USING (rid) LEFT JOIN duplicates USING (rid)
            LEFT JOIN covered USING (rid) LEFT JOIN removed USING (rid)
    )
    SELECT *,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
            AND n_words - removed_words >= 0.5 * n_words AS kept
    FROM facts
"""

_ESCAPED = r"replace(replace(replace({0}, '\', '\\'), '#', '\h'), '<', '\l')"
_ROLE = r"replace(replace({0}, ':', '\c'), chr(10), '\n')"

CHATS = rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    )
    SELECT conv_id,
        count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(
            string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''
        )) AS loss_sha256,
        sum(
            length('### ') + length({_ROLE.format(_ESCAPED.format("role"))}) + length(': ')
            + length({_ESCAPED.format("text")}) + length('</turn>' || chr(10))
        )::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id
"""


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(x) for x in row) + ")" for row in rows)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WANTED = [(f"{n.label}/{k}", at, w) for n in licenses.NOTICE_LIST for k, key in enumerate(n.keys) for at, w in enumerate(key)]
_WANTED += [(label, at, w) for phrase, label in licenses.PHRASE_LIST for at, w in enumerate(phrase)]

LICENSES = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text
        FROM documents
    ),
    lists AS (SELECT rid, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM docs),
    words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM lists),
    notices(notice, size, looked_up, needed) AS (
        VALUES {_values([(n.label, len(n.words), n.looked_up, n.needed) for n in licenses.NOTICE_LIST])}
    ),
    postings(notice, step, word) AS (
        VALUES {_values([(n.label, at, w) for n in licenses.NOTICE_LIST for at, w in enumerate(n.words)])}
    ),
    phrases(phrase, step, word) AS (VALUES {_values(_WANTED)}),
    sizes AS (SELECT phrase, count(*) AS size FROM phrases GROUP BY phrase),
    places AS (
        SELECT rid, phrase, pos - step AS start, any_value(size) AS size
        FROM words JOIN phrases USING (word) JOIN sizes USING (phrase)
        GROUP BY rid, phrase, pos - step HAVING count(*) = any_value(sizes.size)
    ),
    base AS (
        SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
            list_sort(list(DISTINCT phrase)) AS labels
        FROM places WHERE NOT contains(phrase, '/') GROUP BY rid
    ),
    found AS (SELECT word, count(DISTINCT rid) AS documents FROM words SEMI JOIN postings USING (word) GROUP BY word),
    present AS (
        SELECT DISTINCT w.rid, p.notice, w.word FROM words w JOIN (SELECT DISTINCT notice, word FROM postings) p USING (word)
    ),
    looked_up AS (
        SELECT rid, notice, word FROM present JOIN found USING (word)
        QUALIFY row_number() OVER (PARTITION BY rid, notice ORDER BY documents, word) <= {licenses.LOOKED_UP}
    ),
    votes AS (
        SELECT rid, notice, word, pos - step AS start
        FROM looked_up JOIN words USING (rid, word) JOIN postings USING (notice, word)
    ),
    agreeing AS (
        SELECT rid, notice, start, count(DISTINCT word) OVER (
            PARTITION BY rid, notice ORDER BY start RANGE BETWEEN CURRENT ROW AND {licenses.SLACK} FOLLOWING
        ) AS agree
        FROM votes
    ),
    candidates AS (
        SELECT DISTINCT rid, notice, start, agree, size, looked_up FROM agreeing JOIN notices USING (notice)
        WHERE agree >= needed
    ),
    copies AS (
        SELECT c.rid, c.notice, c.start, any_value(agree / looked_up) AS share
        FROM candidates c JOIN places p ON p.rid = c.rid AND split_part(p.phrase, '/', 1) = c.notice
            AND contains(p.phrase, '/') AND p.start >= c.start - {licenses.SLACK}
            AND p.start + p.size <= c.start + c.size + {licenses.SLACK}
        GROUP BY c.rid, c.notice, c.start
        HAVING count(DISTINCT p.phrase) = (SELECT count(*) FROM sizes WHERE split_part(phrase, '/', 1) = c.notice AND contains(phrase, '/'))
    ),
    told AS (SELECT rid, max(share) AS share, list(DISTINCT notice) AS labels FROM copies GROUP BY rid)
    SELECT doc_id,
        len(w)::BIGINT AS n_words,
        coalesce(n_base, 0) AS n_base,
        first_word::BIGINT AS first_word,
        last_word::BIGINT AS last_word,
        coalesce(array_to_string(base.labels, ','), '') AS base_labels,
        coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(told.labels, [])))), ','), '')
            AS labels,
        CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
    FROM lists LEFT JOIN base USING (rid) LEFT JOIN told USING (rid)
"""

COLLOCATIONS = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS rid, coalesce(lang, '{collocations.NO_LANGUAGE}') AS lang,
            string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]') AS pieces
        FROM documents
    ),
    pieces AS (SELECT rid, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS part FROM docs),
    lists AS (SELECT rid, lang, part, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    words AS (SELECT rid, lang, part, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM lists),
    grams AS (
        SELECT lang, word, lead(word) OVER next AS second, lead(word, 2) OVER next AS third
        FROM words WINDOW next AS (PARTITION BY rid, part ORDER BY pos)
    ),
    sizes AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
    one AS (SELECT lang, word AS x, count(*) AS f FROM words GROUP BY ALL),
    two AS (SELECT lang, word AS x, second AS y, count(*) AS f FROM grams WHERE second IS NOT NULL GROUP BY ALL),
    three AS (SELECT lang, word AS x, second AS y, third AS z, count(*) AS f FROM grams WHERE third IS NOT NULL GROUP BY ALL),
    often AS (SELECT * FROM three WHERE f >= {collocations.MIN_FOUND}),
    cuts AS (
        SELECT t.lang, x || ' ' || y AS phrase, t.f AS a, 1 AS k, l.f AS l, r.f AS r
        FROM two t JOIN one l USING (lang, x) JOIN (SELECT lang, x AS y, f FROM one) r USING (lang, y)
        WHERE t.f >= {collocations.MIN_FOUND}
        UNION ALL
        SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, l.f, r.f
        FROM often t JOIN one l USING (lang, x) JOIN two r ON r.lang = t.lang AND r.x = t.y AND r.y = t.z
        UNION ALL
        SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, l.f, r.f
        FROM often t JOIN two l USING (lang, x, y) JOIN (SELECT lang, x AS z, f FROM one) r USING (lang, z)
    ),
    scored AS (
        SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ),
    around AS (
        SELECT lang, phrase, max(f) AS f FROM (
            SELECT lang, x || ' ' || y AS phrase, f FROM often UNION ALL SELECT lang, y || ' ' || z, f FROM often
        ) GROUP BY ALL
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM scored s JOIN sizes USING (lang) LEFT JOIN around o USING (lang, phrase)
    WHERE coalesce(100 * o.f < {collocations.WITHIN_PERCENT} * a, true)
    QUALIFY rank <= {collocations.TOP}
"""

DIVERGENCE = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
        FROM documents
    ),
    terms AS (SELECT rid, lang, source, unnest(w) AS term FROM docs),
    kept AS (SELECT lang, term FROM terms GROUP BY ALL HAVING count(DISTINCT rid) >= {divergence.MIN_DOCUMENTS}),
    counted AS (SELECT lang, source, term, count(*) AS times FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    pairs AS (SELECT DISTINCT lang, source FROM docs),
    numbers AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    sums AS (SELECT lang, source, sum(times) AS n FROM counted GROUP BY ALL),
    shares AS (
        SELECT g.lang, g.source, k.term, coalesce(times, 0) AS times,
            1 + (1000000000::HUGEINT * (coalesce(times, 0) + 1) // (coalesce(n, 0) + v))::BIGINT AS p
        FROM pairs g JOIN kept k USING (lang) JOIN numbers USING (lang)
            LEFT JOIN sums USING (lang, source) LEFT JOIN counted USING (lang, source, term)
    ),
    overall AS (
        SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(times) + 1) // (any_value(n) + any_value(v)))::BIGINT AS q
        FROM counted JOIN numbers USING (lang) JOIN (SELECT lang, sum(n) AS n FROM sums GROUP BY lang) USING (lang)
        GROUP BY lang, term
    ),
    compared AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL
    ),
    parts AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN compared c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN overall USING (lang, term)
        WHERE times > 0 AND p > q
    )
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
    QUALIFY part = 'pair' OR rank <= {divergence.TERMS_LISTED}
"""

LLM_ORACLES = {
    "op1_exact_dedup": EXACT,
    "op3_line_frequency": LINES,
    "op4_chat_formatting": CHATS,
    "op11_license_scan": LICENSES,
    "op12_phrase_collocations": COLLOCATIONS,
    "op13_source_divergence": DIVERGENCE,
}
