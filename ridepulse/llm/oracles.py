"""DuckDB SQL beside the queries."""

#: crc32 of a text's UTF-8 bytes, unsigned
CRC32 = """
create_table AS (SELECT list_transform(range(256), lambda i: list_reduce(
    list_concat([i::UBIGINT], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384::UBIGINT, c // 2) ELSE c // 2 END)) AS t)"""


def crc32(text: str) -> str:
    byte = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::UBIGINT)"
    return (
        f"xor(list_reduce(list_concat([4294967295::UBIGINT], {byte}), "
        "lambda c, b: xor(c // 256, t[(xor(c, b) % 256)::INT + 1])), 4294967295::UBIGINT)::BIGINT"
    )


SHARDING = f"""
WITH {CRC32},
scores AS (SELECT doc_id, i::INT AS i,
    -ln((('0x' || md5('k' || doc_id || '/' || i)[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) AS s
  FROM documents, range(41) AS r(i)),
won AS (SELECT doc_id, arg_min(i, s) FILTER (i < 40) AS shard, arg_min(i, s) AS grown_shard FROM scores GROUP BY doc_id)
SELECT d.doc_id, strlen(coalesce(text, ''))::BIGINT + 16 AS size, {crc32("coalesce(text, '')")} AS text_crc32, 'key' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY d.doc_id) - 1)::BIGINT AS slot, grown_shard
FROM documents d JOIN won USING (doc_id), create_table
"""

_ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    "|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_KINDS = [("assign", _ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]
SECRETS = f"""
WITH m AS ({' UNION ALL '.join(f'''
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(text, '{pattern}', 0) AS hits,
    regexp_extract_all(text, '{pattern}', {group}) AS vals, string_split_regex(text, '{pattern}') AS gaps
  FROM documents WHERE regexp_matches(text, '{pattern}')''' for rank, (kind, pattern, group, least) in enumerate(_KINDS))}),
e AS (SELECT doc_id, rank, kind, least, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(vals) AS val,
    unnest(gaps[1:len(hits)]) AS gap FROM m),
p AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM e),
s AS (SELECT doc_id, kind, rank, (stop - length(hit))::BIGINT AS start, stop::BIGINT AS stop FROM p WHERE length(val) >= least),
j AS (SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
    count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h
  FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN j USING (doc_id)
"""


def _words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
