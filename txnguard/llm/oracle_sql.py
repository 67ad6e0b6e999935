"""DuckDB SQL for the operators that SQL can express."""

from txnguard.llm.secret_scan import ADDED_KINDS, BASE_KINDS, PLACEHOLDER


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def secret_scan(max_owners: int = 2) -> str:
    one = " UNION ALL ".join(
        f"SELECT rid, doc_id, source, {i} AS ord, {_text(kind)} AS kind, {least} AS least, string_split_regex(t, {_text(pattern)}) AS b, "
        f"regexp_extract_all(t, {_text(pattern)}, 0) AS w, regexp_extract_all(t, {_text(pattern)}, {group}) AS v FROM d WHERE regexp_matches(t, {_text(pattern)})"
        for i, (kind, pattern, group, least, _) in enumerate((*BASE_KINDS, *ADDED_KINDS))
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
m AS ({one}),
p AS (
  SELECT rid, doc_id, source, ord, kind, least, unnest(list_transform(range(1, len(w) + 1), lambda i: {{
    'e': list_sum(list_transform(b[1:i], lambda x: length(x))) + list_sum(list_transform(w[1:i], lambda x: length(x))),
    'w': w[i], 'v': v[i]}})) AS x FROM m),
s AS (
  SELECT rid, doc_id, source, ord, kind, (x.e - length(x.w))::BIGINT AS st, x.e::BIGINT AS en, sha256(x.v) AS h,
    kind = 'pem' OR (length(x.v) >= 16 AND regexp_matches(x.v, '[0-9]') AND regexp_matches(x.v, '[A-Za-z]')
      AND NOT regexp_matches(x.v, {_text(PLACEHOLDER)})) AS live
  FROM p WHERE length(x.v) >= least),
o AS (
  SELECT h, count(*) > {max_owners} AS copied FROM (SELECT DISTINCT h, source FROM s) GROUP BY h),
j AS (
  SELECT rid,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, ord) FILTER (ord < {len(BASE_KINDS)}), '') AS base,
    coalesce(string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, ord) FILTER (ord < {len(BASE_KINDS)} OR NOT copied), '') AS spans,
    count(*) FILTER ((ord < {len(BASE_KINDS)} OR NOT copied) AND live AND NOT copied) AS n_live,
    count(*) FILTER (ord < {len(BASE_KINDS)} AND copied) AS n_copied
  FROM s JOIN o USING (h) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN j USING (rid)"""


def pivot_top_k(k: int = 10, scale: int = 1024, every: int = 100) -> str:
    return f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON NOT (q.vec_id = c.vec_id AND q.e = c.e) WHERE q.vec_id % {every} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""


def suffix_dedup(length: int = 50) -> str:
    """Bytes are written as two hex digits each; strings are all windows of them."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT rid, doc_id, p, substr(h, 2 * p + 1, {2 * length}) AS s
  FROM (SELECT rid, doc_id, h, unnest(range(0, greatest(len(h) // 2 - {length - 1}, 0))) AS p FROM d)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
f AS (SELECT rid, p FROM w JOIN m USING (s) WHERE doc_id > least),
g AS (SELECT rid, p, CASE WHEN p <= lag(p) OVER (PARTITION BY rid ORDER BY p) + {length} THEN 0 ELSE 1 END AS new FROM f),
i AS (SELECT rid, p, sum(new) OVER (PARTITION BY rid ORDER BY p) AS n FROM g),
x AS (SELECT rid, n, min(p) AS a, max(p) + {length} AS b FROM i GROUP BY rid, n),
y AS (SELECT rid, a, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before, b FROM x),
z AS (
  SELECT rid, count(*) AS n_spans, sum(b - a) AS gone, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS pieces
  FROM y JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(pieces, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN z USING (rid)"""


def merkle_manifest(fanout: int = 3) -> str:
    """Trees by recursion: nodes level by level, then each leaf's way up to the root."""

    def field(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    # CRC-32 bit by bit over the digits of the id; only its lowest bit is asked for.
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

    def nodes(name: str, leaves: str) -> str:
        return f"""
{name}(g, k, p, h, n) AS (
  SELECT g, 0, p, h, n FROM {leaves}
  UNION ALL
  SELECT g, k + 1, p // {fanout}, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + {fanout - 1}) // {fanout} FROM {name} WHERE n > 1 GROUP BY g, k, p // {fanout}),
{name}_near AS (
  SELECT g, k, p, n,
    coalesce(string_agg(h, '') OVER (PARTITION BY g, k, p // {fanout} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(h, '') OVER (PARTITION BY g, k, p // {fanout} ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name})"""

    def way(name: str, tree: str, start: str) -> str:
        return f"""
{name}(rid, g, k, p, cur, proof) AS (
  {start}
  UNION ALL
  SELECT rid, w.g, w.k + 1, w.p // {fanout}, sha256(before || cur || after), proof || before || after
  FROM {name} w JOIN {tree}_near s ON w.g = s.g AND w.k = s.k AND w.p = s.p WHERE n > 1)"""

    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS g, {leaf("text")} AS h,
    CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS other
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM d),
{nodes("low", "l")},
sub AS (SELECT g, h FROM low WHERE n = 1),
m AS (SELECT '' AS g, g AS name, h, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM sub),
{nodes("high", "m")},
{way("up", "low", "SELECT rid, g, 0, p, other, '' FROM l")},
half AS (SELECT rid, g, arg_max(cur, k) AS cur, arg_max(proof, k) AS proof FROM up GROUP BY rid, g),
{way("over", "high", "SELECT rid, m.g, 0, m.p, cur, proof FROM half JOIN m ON half.g = m.name")},
f AS (SELECT rid, arg_max(cur, k) AS folded_root, arg_max(proof, k) AS proof FROM over GROUP BY rid)
SELECT doc_id, l.h AS leaf, sub.h AS subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN f USING (rid) JOIN sub ON l.g = sub.g, (SELECT h AS root FROM high WHERE n = 1)"""


def hard_negatives(positives: int = 5, negatives: int = 10, scale: int = 256, every: int = 100, low: int = 30, high: int = 90) -> str:
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rid AS a, a.vec_id AS anchor_id, c.rid AS c, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.rid <> c.rid WHERE a.vec_id % {every} = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS FIRST, c) <= {positives}),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.vec_id NULLS FIRST, s.c) AS INT) AS rank
  FROM p JOIN s ON p.a = s.a WHERE NOT s.same AND {low} * p.score <= 100 * s.score AND 100 * s.score <= {high} * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {negatives}"""
