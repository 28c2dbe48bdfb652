"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

from siltworks.llm.licenses import LEAST, NOT_KEPT, RULES, SENTENCE_END, SENTENCES, WRAPPED
from siltworks.llm.sharding import ROW_BYTES, SHARDS
from siltworks.llm.spelling import LEAST_LETTERS, LEAST_OCCURRENCES, MISSPELT, TIMES_MORE
from siltworks.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

ORACLES: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licenses() -> str:
    known = "MAP {" + ", ".join(f"{_text(said)}: '<{name}>'" for name, said in SENTENCES.items()) + "}"
    joined = "coalesce(text, '')"
    for pattern in WRAPPED:
        joined = f"regexp_replace({joined}, {_text(pattern)}, '\\1 \\2', 'g')"
    matched = "sequence"
    for name, wanted in RULES:
        matched = f"replace({matched}, '{''.join(f'<{w}>' for w in wanted)}', '[{name}]')"
    return f"""
WITH known AS (SELECT {known} AS ids),
parts AS (
  SELECT doc_id, string_split_regex({joined}, {_text(SENTENCE_END)}) AS p
  FROM documents),
said AS (
  SELECT doc_id, list_filter(list_transform(p, lambda x: trim(regexp_replace(lower(x), {_text(NOT_KEPT)}, ' ', 'g'))),
                             lambda x: regexp_matches(x, {_text(LEAST)})) AS s
  FROM parts),
ids AS (
  SELECT doc_id, regexp_replace(array_to_string(list_transform(s, lambda x: coalesce(known.ids[x], '<>')), ''), '(<>)+', '<>', 'g') AS sequence
  FROM said, known),
ruled AS (SELECT doc_id, sequence, {matched} AS matched FROM ids),
lists AS (
  SELECT doc_id, regexp_extract_all(sequence, '<(\\w+)>', 1) AS k, regexp_extract_all(matched, '\\[([^\\]]+)\\]', 1) AS l,
         regexp_extract_all(matched, '<(\\w+)>', 1) AS u
  FROM ruled)
SELECT doc_id, CAST(len(k) AS BIGINT) AS n_known, array_to_string(k, ' ') AS sequence, array_to_string(l, ' ') AS licenses,
       CAST(len(l) AS BIGINT) AS n_licenses, array_to_string(u, ' ') AS unmatched
FROM lists"""


def _jump(shards: str) -> str:
    """The last landing below the number of shards, from a recursive walk."""
    return f"""
  SELECT id, CAST(0 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j, CAST(id AS HUGEINT) AS key FROM ids
  UNION ALL
  SELECT id, j, CAST(trunc((j + 1) * (2147483648.0::DOUBLE / CAST(((key * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT) // 8589934592 + 1 AS DOUBLE))) AS BIGINT),
         (key * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT
  FROM walk{shards} WHERE j < {shards}"""


def _crc_of_bytes() -> list[int]:
    found = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ 3988292384 if c & 1 else c >> 1
        found.append(c)
    return found


def _shards() -> str:
    # the checksum of a text, byte by byte
    crc = "".join(f"{c:08x}" for c in _crc_of_bytes())
    step = f"xor(a >> 8, CAST(('0x' || substr('{crc}', 8 * CAST(xor(a & 255, x) AS INTEGER) + 1, 8)) AS UBIGINT))"
    return f"""
WITH RECURSIVE ids AS (SELECT DISTINCT coalesce(doc_id, 0) AS id FROM documents),
walk{SHARDS} AS ({_jump(str(SHARDS))}),
walk{SHARDS + 1} AS ({_jump(str(SHARDS + 1))}),
placed AS (SELECT id, max(b) AS shard FROM walk{SHARDS} GROUP BY id),
grown AS (SELECT id, max(b) AS shard FROM walk{SHARDS + 1} GROUP BY id),
texts AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
sums AS (
  SELECT doc_id, strlen(text) AS bytes,
         xor(list_reduce(list_transform(regexp_extract_all(h, '..'), lambda x: CAST(('0x' || x) AS UBIGINT)),
                         lambda a, x: {step}, CAST(4294967295 AS UBIGINT)), 4294967295) AS crc
  FROM texts)
SELECT s.doc_id, CAST(s.bytes + {ROW_BYTES} AS BIGINT) AS size, CAST(s.crc AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(p.shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY p.shard ORDER BY s.doc_id) - 1 AS slot,
       CAST(g.shard AS INTEGER) AS grown_shard
FROM sums s JOIN placed p ON p.id = coalesce(s.doc_id, 0) JOIN grown g ON g.id = coalesce(s.doc_id, 0)"""


def _warc() -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    piece = "CAST(('0x' || sha[i * 5 + 1 : i * 5 + 5]) AS BIGINT)"
    four = " || ".join(f"{letters}[CAST(({piece} >> {s}) & 31 AS BIGINT) + 1]" for s in (15, 10, 5, 0))
    return f"""
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha FROM pages),
led AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS leader FROM bodies)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(8), lambda i: {four}), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM leader THEN leader END AS refers_to
FROM led"""


ORACLES["op1_license_scan"] = _licenses()
ORACLES["op2_jump_shards"] = _shards()
ORACLES["op6_warc_index"] = _warc()


def _vector_codes() -> str:
    books = "c0"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT s.row, s.part, min(struct_pack(d := list_sum(list_transform(list_zip(s.s, c.s), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := c.entry)) AS near
  FROM parts s JOIN c{r} c USING (part) GROUP BY ALL)""")
        if r == ROUNDS:
            break
        steps.append(f"""
m{r} AS (
  SELECT part, entry, list(CAST(floor_of AS BIGINT) ORDER BY i) AS s FROM (
    SELECT s.part, a.near.e AS entry, i,
           (sum(s.s[i]) - (((sum(s.s[i]) % count(*)) + count(*)) % count(*))) // count(*) AS floor_of
    FROM parts s JOIN a{r} a USING (row, part), unnest(range(1, len(s.s) + 1)) AS u(i) GROUP BY s.part, a.near.e, i)
  GROUP BY part, entry),
c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.s, c.s) AS s FROM c{r} c LEFT JOIN m{r} m USING (part, entry))""")
    last = f"c{ROUNDS}"
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT row, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS s
  FROM kept, unnest(range({PARTS})) AS u(part)),
{books} AS MATERIALIZED (SELECT part, row - 1 AS entry, s FROM parts WHERE row <= {ENTRIES}),{",".join(steps)},
coded AS (
  SELECT row, string_agg(lpad(lower(hex(near.e)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(near.d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY row),
digest AS (
  SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM {last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (row), digest"""


def _spelling() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    crc = "".join(f"{c:08x}" for c in _crc_of_bytes())
    step = f"xor(a >> 8, CAST(('0x' || substr('{crc}', 8 * CAST(xor(a & 255, x) AS INTEGER) + 1, 8)) AS UBIGINT))"
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, '{upper}', '{upper.lower()}') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL),
summed AS (
  SELECT run, times,
         xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'),
                                        lambda x: CAST(('0x' || x) AS UBIGINT)),
                         lambda a, x: {step}, CAST(4294967295 AS UBIGINT)), 4294967295) AS h
  FROM runs),
said AS (
  SELECT times, CASE WHEN h % {MISSPELT} = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
  FROM summed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM said WHERE length(word) >= {LEAST_LETTERS}
  GROUP BY word HAVING sum(times) >= {LEAST_OCCURRENCES}),
holes AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || '*' || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS without
  FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
shorter AS (SELECT DISTINCT h.word, h.n, w.word AS other, w.n AS other_n FROM holes h JOIN words w ON w.word = h.without),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION ALL SELECT * FROM shorter
  UNION ALL SELECT other, other_n, word, n FROM shorter),
ranked AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
  FROM pairs),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.other_n >= {TIMES_MORE} * w.n THEN r.other END AS form,
         CASE WHEN r.other_n >= {TIMES_MORE} * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chain AS (
  SELECT word, form AS at FROM formed WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.at, f.word) AS root, f.n, f.n_near, f.form_n
FROM formed f LEFT JOIN ends e ON e.word = f.word"""


ORACLES["op12_vector_codes"] = _vector_codes()
ORACLES["op13_spelling_variants"] = _spelling()
