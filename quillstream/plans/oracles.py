"""For each registered query that SQL can express, the same result in DuckDB's SQL."""

from __future__ import annotations

from quillstream.functions.keywords import ACRONYM, CAPITAL, LETTER, SCORE_UNIT
from quillstream.functions.stopwords import ENGLISH
from quillstream.sources.tables import FIRST_EPOCH


# Stated here once more, in the syntax of RE2 and apart from the implementation's patterns.
SPACE = r"[ \t\n\x0B\f\r]"
TOKEN = r"[\p{L}\p{N}_]+(?:['-][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_ \t\n\x0B\f\r]"
WORD = r"^[\p{L}\p{N}_]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


STOP_LIST = ", ".join(_text(w) for w in ENGLISH)
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ITEMS = f"""items AS (
  SELECT doc_id AS id, 'comment' AS type, source AS "by", {FIRST_EPOCH} + 60 * doc_id AS time, text
  FROM documents)"""

ITEM_JSON = """to_json({'id': id, 'type': type, 'by': "by", 'time': time, 'text': text})"""

EVENT_JSON = """CAST(to_json({'event_id': event_id, 'user_id': user_id,
  'event_type': event_type, 'props': props}) AS VARCHAR)"""

# A mark behind every sentence end cuts the text; running lengths are the offsets.
SENTENCES = f"""pieces AS (
  SELECT id, string_split(
    regexp_replace(text, '([.!?]+)({SPACE}+)', '\\1\\2' || chr(1), 'g'), chr(1)) AS list
  FROM items),
cut AS (
  SELECT id, unnest(list) AS piece, generate_subscripts(list, 1) - 1 AS s FROM pieces),
placed AS (
  SELECT id, s, rtrim(piece, {BLANKS}) AS result,
    coalesce(sum(length(piece)) OVER (PARTITION BY id ORDER BY s
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM cut),
sentence AS (SELECT * FROM placed WHERE result <> '')"""

# Tokens of the gap-free pieces; the token is what is left of the piece without its blanks.
TOKENS = f"""gaps AS (
  SELECT id, s, b, regexp_extract_all(result, {_text(f'{SPACE}*(?:{TOKEN})')}, 0) AS list
  FROM sentence),
chunks AS (
  SELECT id, s, b, unnest(list) AS piece, generate_subscripts(list, 1) AS n FROM gaps),
token AS (
  SELECT id, s, ltrim(piece, {BLANKS}) AS tok,
    b + sum(length(piece)) OVER (PARTITION BY id, s ORDER BY n) - 1 AS e,
    row_number() OVER (PARTITION BY id ORDER BY s, n) - 1 AS pos
  FROM chunks)"""

WS_TOKENS = f"""split AS (
  SELECT id, text, string_split_regex(lower(text), '{SPACE}') AS list FROM items),
listed AS MATERIALIZED (
  SELECT id, text = '' AS bare, unnest(list) AS term, generate_subscripts(list, 1) AS n FROM split),
lasts AS (SELECT id, max(n) FILTER (WHERE term <> '') AS last_n FROM listed GROUP BY id),
ws AS (SELECT id, n, term FROM listed JOIN lasts USING (id) WHERE n <= coalesce(last_n, 0) OR bare)"""

IDF = """docs AS (SELECT count(*) AS m FROM documents),
freq AS (SELECT term, count(DISTINCT id) AS df FROM ws GROUP BY term),
weights AS (SELECT term, df, ln((m + 1.0) / (df + 1.0)) AS idf FROM freq, docs)"""

def _mix(block: str) -> str:
    """The mixing step of MurmurHash3 for one 32 bit block, before it meets the hash."""
    times = f"CAST(({block}) * 3432918353::HUGEINT % 4294967296 AS BIGINT)"
    turned = f"((({times}) << 15) | (({times}) >> 17)) & 4294967295"
    return f"CAST(({turned}) * 461845907::HUGEINT % 4294967296 AS BIGINT)"


def _hex_byte(at: str) -> str:
    """The byte at a position of ``h``, a text of hex digits; 0 beyond its end."""
    return (
        f"(greatest(instr('0123456789ABCDEF', substr(h, 2 * ({at}) + 1, 1)) - 1, 0) * 16"
        f" + greatest(instr('0123456789ABCDEF', substr(h, 2 * ({at}) + 2, 1)) - 1, 0))"
    )


def _finish(name: str, shift: int, factor: int) -> str:
    return f"CAST(xor({name}, {name} >> {shift}) * {factor}::HUGEINT % 4294967296 AS BIGINT)"


# MurmurHash3 (x86, 32 bit, seed 42) of every term's bytes, and its place among 2^18 buckets.
BUCKETS = f"""hexed AS MATERIALIZED (SELECT term, hex(encode(term)) AS h, strlen(term) AS n
  FROM (SELECT DISTINCT term FROM ws)),
blocks AS (
  SELECT *, list_transform(range(n // 4), lambda i: {_hex_byte("4 * i")}
    + 256 * {_hex_byte("4 * i + 1")} + 65536 * {_hex_byte("4 * i + 2")}
    + 16777216::BIGINT * {_hex_byte("4 * i + 3")}) AS ks,
    CASE WHEN n % 4 > 0 THEN {_hex_byte("n // 4 * 4")} ELSE 0 END
    + CASE WHEN n % 4 > 1 THEN 256 * {_hex_byte("n // 4 * 4 + 1")} ELSE 0 END
    + CASE WHEN n % 4 > 2 THEN 65536 * {_hex_byte("n // 4 * 4 + 2")} ELSE 0 END AS rest
  FROM hexed),
body AS (
  SELECT term, n, rest, list_reduce(
    list_concat([42::BIGINT], list_transform(ks, lambda k: {_mix("k")})),
    lambda a, k: ((((xor(a, k) << 13) | (xor(a, k) >> 19)) & 4294967295) * 5 + 3864292196)
      % 4294967296) AS a
  FROM blocks),
tailed AS (SELECT term, xor(xor(a, {_mix("rest")}), n) AS a FROM body),
once AS (SELECT term, {_finish("a", 16, 0x85EBCA6B)} AS a FROM tailed),
twice AS (SELECT term, {_finish("a", 13, 0xC2B2AE35)} AS a FROM once),
bucketed AS MATERIALIZED (SELECT term, xor(a, a >> 16) % 262144 AS bucket FROM twice)"""

LAST_TURN = """SELECT conv_id AS id, max(turn) AS turn, arg_max(role, turn) AS role,
  arg_max(text, turn) AS text
FROM conversations GROUP BY conv_id"""

LOOKUP = f"""WITH {ITEMS}, ids AS (SELECT DISTINCT event_id AS id FROM events)
SELECT ids.id, type, "by", time, text FROM ids LEFT JOIN items USING (id)"""

NEW_IDS = """SELECT unnest(generate_series(
  (SELECT max(doc_id) FROM documents) + 1, (SELECT max(event_id) FROM events))) AS id"""

BACKFILL = "SELECT unnest(generate_series(1, (SELECT max(event_id) FROM events))) AS id"

KEYWORDS = f"""word AS (
  SELECT id, s, pos, e - length(tok) + 1 AS b, e, lower(tok) AS w,
    regexp_matches(tok, {_text(CAPITAL)}) AS capital,
    regexp_matches(tok, {_text(ACRONYM)}) AS acronym
  FROM token WHERE regexp_matches(tok, {_text(WORD)})),
near AS (
  SELECT *,
    lag(s) OVER o AS s_before, lag(pos) OVER o AS pos_before, lag(w) OVER o AS w_before,
    lead(s) OVER o AS s_after, lead(pos) OVER o AS pos_after, lead(w) OVER o AS w_after
  FROM word WINDOW o AS (PARTITION BY id ORDER BY pos)),
linked AS (
  SELECT id, s, w, capital AND s_before IS NOT NULL AND s_before = s AS capital, acronym,
    CASE WHEN s_before = s AND pos_before = pos - 1 THEN w_before END AS l,
    CASE WHEN s_after = s AND pos_after = pos + 1 THEN w_after END AS r
  FROM near),
stat AS (
  SELECT id, w, count(*) AS tf,
    greatest(count(*) FILTER (WHERE capital), count(*) FILTER (WHERE acronym)) AS cased,
    median(s) AS med, count(DISTINCT s) AS in_s,
    CASE WHEN count(l) = 0 THEN 0.0 ELSE count(DISTINCT l)::DOUBLE / count(l) END
      + CASE WHEN count(r) = 0 THEN 0.0 ELSE count(DISTINCT r)::DOUBLE / count(r) END AS div
  FROM linked GROUP BY id, w),
total AS (
  SELECT id, count(*)::DOUBLE AS terms, sum(tf)::DOUBLE AS words, sum(tf * tf)::DOUBLE AS squares,
    max(tf) AS max_tf
  FROM stat GROUP BY id),
n_sent AS (SELECT id, max(s) + 1 AS n FROM token GROUP BY id),
term AS (
  SELECT stat.id, w,
    cased / (1.0::DOUBLE + ln(tf::DOUBLE)) AS c, ln(ln(3.0::DOUBLE + med)) AS p,
    1.0::DOUBLE + div * tf / max_tf AS rel,
    tf / (words / terms + sqrt(terms * squares - words * words) / terms) AS f,
    in_s::DOUBLE / n AS spread
  FROM stat JOIN total USING (id) JOIN n_sent USING (id)),
scored AS (
  SELECT word.id, s, pos, b, e, word.w, rel * p / (c + f / rel + spread / rel) AS sc,
    regexp_matches(word.w, {_text(LETTER)}) AND word.w NOT IN ({STOP_LIST}) AS edge
  FROM word JOIN term USING (id, w)),
ahead AS (
  SELECT *,
    lead(s, 1) OVER o AS s1, lead(pos, 1) OVER o AS pos1, lead(w, 1) OVER o AS w1,
    lead(sc, 1) OVER o AS sc1, lead(edge, 1) OVER o AS edge1, lead(e, 1) OVER o AS e1,
    lead(s, 2) OVER o AS s2, lead(pos, 2) OVER o AS pos2, lead(w, 2) OVER o AS w2,
    lead(sc, 2) OVER o AS sc2, lead(edge, 2) OVER o AS edge2, lead(e, 2) OVER o AS e2
  FROM scored WINDOW o AS (PARTITION BY id ORDER BY pos)),
gram AS (
  SELECT id, pos, b, e1 AS e, w || ' ' || w1 AS text, sc * sc1 AS product, sc + sc1 AS total
  FROM ahead WHERE edge AND edge1 AND s1 = s AND pos1 = pos + 1
  UNION ALL
  SELECT id, pos, b, e2, w || ' ' || w1 || ' ' || w2, sc * sc1 * sc2, sc + sc1 + sc2
  FROM ahead WHERE edge AND edge2 AND s2 = s AND pos2 = pos + 2),
keyword AS (
  SELECT id, text, arg_min(b, pos) AS b, arg_min(e, pos) AS e,
    floor(arg_min(product, pos) / (count(*) * (1.0::DOUBLE + arg_min(total, pos)))
      * {SCORE_UNIT}::DOUBLE + 0.5::DOUBLE) / {SCORE_UNIT}::DOUBLE AS score
  FROM gram GROUP BY id, text),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score, text) AS rank
  FROM keyword WHERE score <= 0.6)"""


# The vectors' size in the registered queries, and the label thresholds of the two jobs.
SIZE = 16
DOCUMENT_THRESHOLD, SENTENCE_THRESHOLD = 0.7, 0.6

SAID = f"""word_list AS (
  SELECT id, regexp_extract_all(lower(text), {_text(TOKEN)}, 0) AS list FROM items),
spoken AS (
  SELECT id, unnest(list) AS w, generate_subscripts(list, 1) AS n FROM word_list),
said AS (
  SELECT id, n, w, ('0x' || substr(md5(w), 1, 13))::BIGINT AS x FROM spoken)"""


def _vectors(name: str, window: int) -> str:
    """Whole numbers q of every bucket's vector, in units of 2^-15."""
    near = ", ".join(
        [f"lag(x, {o}) OVER o" for o in range(1, window + 1)]
        + ["x"]
        + [f"lead(x, {o}) OVER o" for o in range(1, window + 1)]
    )
    return f"""{name}_near AS (
  SELECT x, [{near}] AS list FROM said WINDOW o AS (PARTITION BY id ORDER BY n)),
{name}_pair AS (SELECT x, unnest(list) AS y FROM {name}_near),
{name}_cell AS (
  SELECT x % 262144 AS bucket, ((y // 262144) % 8589934592) % {SIZE} AS dim,
    sum(CASE WHEN y >= 2251799813685248 THEN 1 ELSE -1 END) AS n
  FROM {name}_pair WHERE y IS NOT NULL GROUP BY ALL),
{name}_log AS (
  SELECT bucket, dim, sign(n) * ln(1.0::DOUBLE + abs(n)::DOUBLE) AS t FROM {name}_cell),
{name}_norm AS (SELECT bucket, sqrt(sum(t * t)) AS norm FROM {name}_log GROUP BY bucket),
{name} AS (
  SELECT bucket, dim, CAST(CASE WHEN norm > 0 THEN floor(32768::DOUBLE * t / norm + 0.5::DOUBLE)
    ELSE 0 END AS BIGINT) AS q
  FROM {name}_log JOIN {name}_norm USING (bucket))"""


def _means(name: str, vectors: str, units: str, keys: str) -> str:
    """keys, dim, v: mean vectors of units, from rows of keys and x (null where a unit has no word);
    and their numbers in millionths as text."""
    return f"""{name}_sum AS (
  SELECT {keys}, dim, sum(q) AS total FROM {units} JOIN {vectors} ON x % 262144 = bucket
  GROUP BY {keys}, dim),
{name}_unit AS (SELECT {keys}, count(x) AS n FROM {units} GROUP BY {keys}),
{name} AS (
  SELECT {keys}, dim,
    CAST(coalesce(total, 0)::DOUBLE / 32768::DOUBLE / greatest(n, 1)::DOUBLE AS FLOAT) AS v
  FROM {name}_unit CROSS JOIN (SELECT unnest(range({SIZE})) AS dim) LEFT JOIN {name}_sum
  USING ({keys}, dim)),
{name}_text AS (
  SELECT {keys}, string_agg(
    CAST(CAST(floor(v::DOUBLE * 1000000::DOUBLE) AS BIGINT) AS VARCHAR), ',' ORDER BY dim) AS embedding
  FROM {name} GROUP BY {keys})"""


DOCUMENT_WORDS = "doc_word AS (SELECT items.id, x FROM items LEFT JOIN said USING (id))"

SENTENCE_WORDS = f"""sentence_list AS (
  SELECT id, s, regexp_extract_all(lower(result), {_text(TOKEN)}, 0) AS list FROM sentence),
sentence_token AS (SELECT id, s, unnest(list) AS w FROM sentence_list),
sentence_word AS (
  SELECT sentence.id, sentence.s, ('0x' || substr(md5(w), 1, 13))::BIGINT AS x
  FROM sentence LEFT JOIN sentence_token USING (id, s))"""

# Two classes with means of their own and a common variance of every number.
CLASSIFIER = """labelled AS (
  SELECT doc_id AS id, quality AS label, count(*)::DOUBLE AS w FROM labels
  WHERE quality IN (0, 1) GROUP BY ALL),
class AS (
  SELECT dim, label, sum(w) AS n, sum(w * v::DOUBLE) AS s, sum(w * v::DOUBLE * v::DOUBLE) AS ss
  FROM doc JOIN labelled USING (id) GROUP BY dim, label),
split AS (
  SELECT dim, b.n AS n1, a.n AS n0, b.s / b.n AS m1, a.s / a.n AS m0,
    (a.ss + b.ss - a.s * a.s / a.n - b.s * b.s / b.n) / (a.n + b.n) + 0.000001::DOUBLE AS variance
  FROM (SELECT * FROM class WHERE label = 0) a JOIN (SELECT * FROM class WHERE label = 1) b
  USING (dim)),
line AS (SELECT dim, (m1 - m0) / variance AS c FROM split),
base AS (
  SELECT max(ln((1 + n1) / (1 + n0))) - sum((m1 * m1 - m0 * m0) / (2 * variance)) AS c0 FROM split)"""


def _labels(name: str, vectors: str, keys: str, threshold: float) -> str:
    return f"""{name}_odds AS (
  SELECT {keys}, greatest(-30, least(30, any_value(c0) + sum(v::DOUBLE * c))) AS odds
  FROM {vectors} JOIN line USING (dim) CROSS JOIN base GROUP BY {keys}),
{name}_share AS (SELECT {keys}, 1::DOUBLE / (1::DOUBLE + exp(-odds)) AS positive FROM {name}_odds),
{name} AS (
  SELECT {keys}, positive, CASE WHEN greatest(positive, 1 - positive) < {threshold} THEN 'neutral'
    WHEN positive >= 0.5 THEN 'positive' ELSE 'negative' END AS sentiment
  FROM {name}_share)"""


DOCUMENT_VECTORS = f"""{ITEMS}, {SAID}, {_vectors("vec", 2)}, {DOCUMENT_WORDS},
{_means("doc", "vec", "doc_word", "id")}"""


ORACLES: dict[str, str] = {
    "stream_source": f"SELECT CAST(event_id AS VARCHAR) AS key, {EVENT_JSON} AS value FROM events",
    "stream_tail": f"""SELECT event_id AS "offset", CAST(event_id AS VARCHAR) AS key,
  {EVENT_JSON} AS value FROM events""",
    "stream_restart": f"SELECT CAST(event_id AS VARCHAR) AS key, {EVENT_JSON} AS value FROM events",
    "stream_quarantine": f"""WITH {ITEMS},
written AS (SELECT id, CAST({ITEM_JSON} AS VARCHAR) AS j FROM items),
raw AS (
  SELECT CAST(id AS VARCHAR) AS key, CASE id % 10 WHEN 1 THEN left(j, length(j) // 2) WHEN 3 THEN 'null'
    WHEN 5 THEN '{{"id":"x' || id || '"}}' WHEN 7 THEN '{{"type":"comment"}}' WHEN 9 THEN '[' || id || ']'
    ELSE j END AS value
  FROM written),
judged AS (
  SELECT key, value, CASE WHEN value = 'null' THEN 'missing' WHEN left(value, 1) <> '{{' THEN 'no-object'
    WHEN NOT json_valid(value) THEN 'malformed' WHEN json_type(value, '$.id') IS NULL THEN 'no-id'
    WHEN json_type(value, '$.id') NOT IN ('UBIGINT', 'BIGINT') THEN 'field-type' END AS fault
  FROM raw),
opened AS (SELECT *, CASE WHEN fault IS NULL THEN value END AS item FROM judged)
SELECT key, CAST(item->>'$.id' AS BIGINT) AS id, item->>'$.type' AS type, item->>'$.by' AS "by",
  CAST(item->>'$.time' AS BIGINT) AS time, item->>'$.text' AS text,
  CASE WHEN fault IS NOT NULL THEN value END AS value, fault
FROM opened""",
    "kv_decode": f"SELECT CAST(event_id AS VARCHAR) AS key, {EVENT_JSON} AS value FROM events",
    "archive_scan": f'WITH {ITEMS} SELECT id, type, "by", time, text FROM items',
    "frontier_delta": NEW_IDS,
    "stream_frontier": NEW_IDS,
    "stream_produce": f"""WITH {ITEMS}, ids AS (
  SELECT unnest(generate_series(0, (SELECT max(event_id) FROM events))) AS id)
SELECT CAST(ids.id AS VARCHAR) AS key,
  CASE WHEN type IS NULL THEN 'null' ELSE CAST({ITEM_JSON} AS VARCHAR) END AS value
FROM ids LEFT JOIN items USING (id)""",
    "backfill_range": BACKFILL,
    "backfill_archive": f"""WITH {ITEMS} SELECT id, type, "by", time, text FROM items
WHERE id BETWEEN 1 AND (SELECT max(event_id) FROM events)""",
    "progress_sample": f"SELECT id FROM ({BACKFILL}) WHERE id % 1000 = 0",
    "item_lookup": LOOKUP,
    "kv_encode": f"""WITH {ITEMS}
SELECT CAST(id AS VARCHAR) AS key, CAST({ITEM_JSON} AS VARCHAR) AS value FROM items""",
    "archive_upsert": LAST_TURN,
    "archive_compact": LAST_TURN,
    "archive_lookup": LOOKUP,
    "item_parse": f"""WITH {ITEMS}
SELECT CAST(id AS VARCHAR) AS key, id, CAST(NULL AS BOOLEAN) AS deleted, type, "by", time,
  CAST(NULL AS BOOLEAN) AS dead, text, CAST(NULL AS VARCHAR) AS url,
  CAST(NULL AS VARCHAR) AS title, CAST(NULL AS INTEGER) AS descendants,
  CAST(NULL AS INTEGER) AS score, CAST(NULL AS BIGINT) AS parent
FROM items""",
    "item_text": "SELECT doc_id AS id, text FROM documents",
    "item_normalize": f"""WITH {ITEMS}
SELECT id, type, "by", make_timestamp(time * 1000000) AS time, text, '' AS url, '' AS title,
  CAST(0 AS INTEGER) AS score
FROM items""",
    "drop_ghosts": """SELECT CAST(doc_id AS VARCHAR) AS key, doc_id AS id, source AS "by", text
FROM documents WHERE doc_id IN (SELECT event_id FROM events)""",
    "json_envelope": f"WITH {ITEMS} SELECT CAST({ITEM_JSON} AS VARCHAR) AS value FROM items",
    "json_field": """SELECT CAST(event_id AS VARCHAR) AS key, json_extract_string(props, '$.k') AS k
FROM events""",
    "json_compact": f"""WITH {ITEMS}
SELECT CAST(id AS VARCHAR) AS key, CAST(to_json({{'by': "by", 'extra': 5, 'id': id, 'text': text,
  'time': time, 'type': type}}) AS VARCHAR) AS value
FROM items""",
    "doc_assemble": """SELECT doc_id AS id, 'document' AS "annotatorType",
  CAST(0 AS INTEGER) AS "begin", CAST(length(text) - 1 AS INTEGER) AS "end", text AS result
FROM documents""",
    "sentences": f"""WITH {ITEMS}, {SENTENCES}
SELECT id, CAST(s AS INTEGER) AS position, CAST(b AS INTEGER) AS "begin",
  CAST(b + length(result) - 1 AS INTEGER) AS "end", result
FROM sentence""",
    "nlp_tokens": f"""WITH {ITEMS}, {SENTENCES}, {TOKENS}
SELECT id, CAST(pos AS INTEGER) AS position, CAST(s AS INTEGER) AS sentence,
  CAST(e - length(tok) + 1 AS INTEGER) AS "begin", CAST(e AS INTEGER) AS "end", tok AS result
FROM token""",
    "ws_tokens": f"""WITH {ITEMS}, {WS_TOKENS}
SELECT id, CAST(n - 1 AS INTEGER) AS position, term FROM ws""",
    "stop_words": f"""WITH {ITEMS}, {WS_TOKENS}
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY n) - 1 AS INTEGER) AS position, term
FROM ws WHERE term NOT IN ({STOP_LIST})""",
    "word_count": f"""WITH {ITEMS}
SELECT CAST(id AS VARCHAR) AS key, id, "by", make_timestamp(time * 1000000) AS time,
  CAST(len(regexp_extract_all(text, {_text(TOKEN)})) AS INTEGER) AS "wordCount"
FROM items""",
    "stream_json_sink": f"""SELECT doc_id AS id, source AS "by",
  CAST(len(regexp_extract_all(text, {_text(TOKEN)})) AS INTEGER) AS "wordCount"
FROM documents""",
    "hashing_tf": f"""WITH {ITEMS}, {WS_TOKENS}, {BUCKETS}
SELECT id, CAST(bucket AS INTEGER) AS bucket, CAST(count(*) AS DOUBLE) AS tf
FROM ws JOIN bucketed USING (term) GROUP BY id, bucket""",
    "term_freq": f"""WITH {ITEMS}, {WS_TOKENS}
SELECT id, term, count(*) AS tf FROM ws GROUP BY id, term""",
    "idf": f"""WITH {ITEMS}, {WS_TOKENS}, {IDF}
SELECT term, df, round(idf, 6) AS idf FROM weights""",
    "stream_fit": f"""WITH {ITEMS}, {WS_TOKENS}, {IDF}
SELECT term, df, round(idf, 6) AS idf FROM weights""",
    "tf_idf": f"""WITH {ITEMS}, {WS_TOKENS}, {IDF},
counts AS (SELECT id, term, count(*) AS tf FROM ws GROUP BY id, term)
SELECT id, term, tf, round(tf * idf, 6) AS tf_idf FROM counts JOIN weights USING (term)""",
    "fit_apply": f"""WITH {ITEMS}, {WS_TOKENS}, {IDF},
turn_list AS (
  SELECT conv_id || '-' || turn AS id, string_split_regex(lower(text), '{SPACE}') AS list, text
  FROM conversations),
turn_term AS (
  SELECT id, text, unnest(list) AS term, generate_subscripts(list, 1) AS n FROM turn_list),
turn_last AS (
  SELECT *, coalesce(max(n) FILTER (WHERE term <> '') OVER (PARTITION BY id), 0) AS last_n
  FROM turn_term),
turn_count AS (
  SELECT id, term, count(*) AS tf FROM turn_last WHERE n <= last_n OR text = ''
  GROUP BY id, term)
SELECT id, term, tf, round(tf * coalesce(idf, ln(m + 1.0)), 6) AS tf_idf
FROM turn_count LEFT JOIN weights USING (term), docs""",
    "keywords": f"""WITH {ITEMS}, {SENTENCES}, {TOKENS}, {KEYWORDS}
SELECT id, CAST(rank AS INTEGER) AS rank, CAST(b AS INTEGER) AS "begin", CAST(e AS INTEGER) AS "end",
  text AS keyword, round(score, 6) AS score
FROM ranked WHERE rank <= 10""",
    "annotate_items": f"""WITH {ITEMS}, {SENTENCES}, {WS_TOKENS},
s AS (SELECT id, count(*) AS n FROM sentence GROUP BY id),
t AS (SELECT id, count(*) AS n FROM ws GROUP BY id)
SELECT items.id, CAST(1 AS INTEGER) AS documents, CAST(coalesce(s.n, 0) AS INTEGER) AS sentences,
  CAST(coalesce(t.n, 0) AS INTEGER) AS tokens,
  CAST(len(regexp_extract_all(text, {_text(TOKEN)})) AS INTEGER) AS "wordCount"
FROM items LEFT JOIN s USING (id) LEFT JOIN t USING (id)""",
    "annotate_stream": f"""WITH {ITEMS}, {SENTENCES}, {WS_TOKENS},
s AS (SELECT id, count(*) AS n FROM sentence GROUP BY id),
t AS (SELECT id, count(*) AS n FROM ws GROUP BY id)
SELECT items.id, CAST(coalesce(s.n, 0) AS INTEGER) AS sentences,
  CAST(coalesce(t.n, 0) AS BIGINT) AS tf_total,
  CAST(len(regexp_extract_all(text, {_text(TOKEN)})) AS INTEGER) AS "wordCount"
FROM items LEFT JOIN s USING (id) LEFT JOIN t USING (id)""",
    "token_embeddings": f"""WITH {ITEMS}, {SENTENCES}, {TOKENS}, {SAID}, {_vectors("vec", 2)},
dense AS (
  SELECT bucket, string_agg(CAST(CAST(floor(CAST(coalesce(q, 0)::DOUBLE / 32768::DOUBLE AS FLOAT)::DOUBLE
    * 1000000::DOUBLE) AS BIGINT) AS VARCHAR), ',' ORDER BY dim) AS embedding
  FROM (SELECT DISTINCT bucket FROM vec) CROSS JOIN (SELECT unnest(range({SIZE})) AS dim)
    LEFT JOIN vec USING (bucket, dim)
  GROUP BY bucket)
SELECT id, CAST(pos AS INTEGER) AS position, tok AS token,
  coalesce(embedding, repeat('0,', {SIZE - 1}) || '0') AS embedding
FROM token LEFT JOIN dense ON ('0x' || substr(md5(lower(tok)), 1, 13))::BIGINT % 262144 = bucket""",
    "doc_embeddings": f"WITH {DOCUMENT_VECTORS} SELECT id, embedding FROM doc_text",
    "sentence_embeddings": f"""WITH {ITEMS}, {SENTENCES}, {SAID}, {_vectors("vec", 2)},
{SENTENCE_WORDS}, {_means("sent", "vec", "sentence_word", "id, s")}
SELECT id, CAST(s AS INTEGER) AS position, embedding FROM sent_text""",
    "sentiment": f"""WITH {DOCUMENT_VECTORS}, {CLASSIFIER},
{_labels("judged", "doc", "id", DOCUMENT_THRESHOLD)}
SELECT id, round(positive, 6) AS positive, sentiment FROM judged""",
    "document_job": f"""WITH {DOCUMENT_VECTORS}, {CLASSIFIER},
{_labels("judged", "doc", "id", DOCUMENT_THRESHOLD)},
bucket_total AS (SELECT bucket, sum(q) AS q FROM vec GROUP BY bucket),
counted AS (
  SELECT id, count(*) AS n, sum(q) AS total FROM said JOIN bucket_total ON x % 262144 = bucket
  GROUP BY id)
SELECT items.id, CAST(coalesce(n, 0) AS INTEGER) AS "wordCount",
  CAST(coalesce(n, 0) AS INTEGER) AS token_vectors, CAST(coalesce(total, 0) AS BIGINT) AS token_total,
  sentiment, embedding
FROM items JOIN judged USING (id) JOIN doc_text USING (id) LEFT JOIN counted USING (id)""",
    "sentence_job": f"""WITH {DOCUMENT_VECTORS}, {CLASSIFIER}, {SENTENCES}, {TOKENS}, {KEYWORDS},
{SENTENCE_WORDS}, {_means("sent", "vec", "sentence_word", "id, s")},
{_vectors("vec2", 1)}, {_means("sent2", "vec2", "sentence_word", "id, s")},
{_labels("judged", "sent", "id, s", SENTENCE_THRESHOLD)},
found AS (SELECT id, count(*) AS n FROM ranked WHERE rank <= 10 GROUP BY id)
SELECT id, CAST(s AS INTEGER) AS position, CAST(b AS INTEGER) AS "begin",
  CAST(b + length(result) - 1 AS INTEGER) AS "end", sentiment, sent_text.embedding AS embedding,
  sent2_text.embedding AS second, CAST(coalesce(n, 0) AS INTEGER) AS n_keywords
FROM sentence JOIN judged USING (id, s) JOIN sent_text USING (id, s) JOIN sent2_text USING (id, s)
  LEFT JOIN found USING (id)""",
    "model_roundtrip": f"""WITH {ITEMS}, {WS_TOKENS}, {BUCKETS},
counts AS MATERIALIZED (
  SELECT id, bucket, count(*) AS tf FROM ws JOIN bucketed USING (term) GROUP BY id, bucket),
docs AS (SELECT count(*) AS m FROM documents),
weights AS (
  SELECT bucket, ln((m + 1.0) / (count(*) + 1.0)) AS idf FROM counts, docs GROUP BY bucket, m)
SELECT id, CAST(bucket AS INTEGER) AS bucket, round(tf * idf, 6) AS tf_idf
FROM counts JOIN weights USING (bucket)""",
}
