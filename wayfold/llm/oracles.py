"""SQL twins of those queries that SQL can express on whole tables in reasonable time."""

TOP_K = """
WITH v AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.id <> b.id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

SUBSTRING = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda s: s <> '') AS ws FROM documents),
p AS (SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT win, min(doc_id) AS m FROM p GROUP BY win),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM p JOIN f USING (win) WHERE m < doc_id),
k AS (SELECT doc_id, j, ws[j] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM w)),
r AS (SELECT k.doc_id, count(g.j) AS n_removed, string_agg(word, ' ' ORDER BY k.j) FILTER (WHERE g.j IS NULL) AS kept FROM k LEFT JOIN g ON k.doc_id = g.doc_id AND k.j = g.j GROUP BY k.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN r USING (doc_id)
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, m, array_to_string(ws[i:i+m-1], ' ') AS win FROM (SELECT item_id, ws, least(13, len(ws)) AS m, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
ms AS (SELECT DISTINCT m FROM iw),
dw AS (SELECT doc_id, i, m, array_to_string(ws[i:i+m-1], ' ') AS win FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, ms WHERE len(ws) >= m)),
hit AS (SELECT DISTINCT dw.doc_id, dw.i, dw.m, iw.item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.m = iw.m),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM hit) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

_SPACED = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda s: s <> '')"

NEAR_DEDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+3], ' ') AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM w UNION SELECT r.u, CASE WHEN l.a = r.v THEN l.b ELSE l.a END FROM reach r JOIN links l ON l.a = r.v OR l.b = r.v)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, r.least AS component_id, w.doc_id = r.least AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT u, min(v) AS least FROM reach GROUP BY u) r ON r.u = w.doc_id
"""


def _spans(kinds: list[tuple[str, str, str]], order: str) -> str:
    """Base spans of each document: (name, pattern, condition on the match m) of each kind, whose offsets follow from what lies between the matches."""
    found = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS o, '{name}' AS kind, regexp_extract_all(x, {pattern}) AS ms, regexp_split_to_array(x, {pattern}) AS gs FROM t" for k, (name, pattern, _) in enumerate(kinds)
    )
    kept = " OR ".join(f"o = {k} AND ({condition})" for k, (_, _, condition) in enumerate(kinds))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{name}') AS n_{name}" for name, _, _ in kinds)
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents), e AS ({found}),
f AS (SELECT doc_id, o, kind, ms[i] AS m, list_sum(list_transform(gs[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda g: length(g))), 0) AS a FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM e)),
d AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits FROM f),
g AS (SELECT * FROM d WHERE {kept}),
r AS (SELECT doc_id, {counts}, string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + length(m) AS BIGINT), ',' ORDER BY {order}) AS spans FROM g GROUP BY doc_id)
SELECT t.doc_id, {', '.join(f'coalesce(n_{name}, 0) AS n_{name}' for name, _, _ in kinds)}, sha256(coalesce(spans, '')) AS base_sha256 FROM t LEFT JOIN r USING (doc_id)
"""


_LUHN = "list_sum(list_transform(range(1, length(digits) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse(digits)[i] AS INT) WHEN CAST(reverse(digits)[i] AS INT) > 4 THEN 2 * CAST(reverse(digits)[i] AS INT) - 9 ELSE 2 * CAST(reverse(digits)[i] AS INT) END)) % 10 = 0"
PII_BASE = _spans(
    [
        ("email", r"'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'", "true"),
        ("ip", r"'[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'", "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || right(p, 3) AS INT) > 255)) = 0"),
        ("card", r"'[0-9]([\x20-]?[0-9])+'", f"length(digits) BETWEEN 13 AND 19 AND {_LUHN}"),
        ("phone", r"'\+[0-9][\x20().0-9-]+[0-9]'", "length(digits) BETWEEN 9 AND 15"),
    ],
    "o, a",
)
_ASSIGN = r"""'(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
SECRETS_BASE = _spans([("assign", _ASSIGN, f"length(regexp_extract(m, {_ASSIGN}, 2)) >= 12"), ("access", "'AKIA[A-Z0-9]+'", "length(m) >= 18"), ("hex", "'[0-9a-f]+'", "length(m) >= 16")], "a, o")

ORACLES = {
    "op1_pivot_top_k": TOP_K, "op2_pii_base": PII_BASE, "op3_minhash_near_dedup": NEAR_DEDUP, "op4_secret_scan_base": SECRETS_BASE, "op6_decontamination": DECONTAMINATION,
    "op9_substring_dedup": SUBSTRING,
}
