"""DuckDB SQL for the queries that SQL can express."""

def _secret_kind(no: int, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""SELECT r, owner, repo, {no} AS kind, unnest(range(len(m))) AS i, unnest(gaps) AS gap, unnest(m) AS match,
       unnest(v) AS value, {least} AS least
FROM (SELECT r, owner, repo, regexp_extract_all(text, {p}, 0) AS m, regexp_extract_all(text, {p}, {group}) AS v,
             string_split_regex(text, {p})[1:len(regexp_extract_all(text, {p}, 0))] AS gaps FROM d)"""


def _secrets() -> str:
    from .secret_scan import KINDS, OWNED, VARIETY

    kinds = " UNION ALL ".join(_secret_kind(no, k[1], k[2], k[3]) for no, k in enumerate(KINDS))
    owned = _secret_kind(len(KINDS), *OWNED[1:])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
                  coalesce(CAST(doc_id AS VARCHAR), '') AS repo FROM documents),
m AS ({kinds} UNION ALL {owned}),
p AS (SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY r, kind ORDER BY i) AS stop FROM m),
h AS (SELECT r, owner, repo, kind, value, CAST(stop - length(match) AS INTEGER) AS start, CAST(stop AS INTEGER) AS stop,
             regexp_matches(value, '[A-Za-z]') AND regexp_matches(value, '[0-9]')
                 AND len(list_distinct(string_split(value, ''))) >= {VARIETY} AS live
      FROM p WHERE length(value) >= least AND (kind < 3 OR (regexp_matches(value, '[a-z]')
           AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9].*[0-9]')))),
c AS (SELECT * FROM h WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM h AS b WHERE b.r = h.r AND b.kind < 3
           AND b.start < h.stop AND h.start < b.stop)),
o AS (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repo)) AS repos FROM c GROUP BY value),
s AS (SELECT r, kind, start, stop, owners >= 5 OR repos >= 20 AS example, owners <= 2 AND repos < 20 AND live AS live
      FROM c JOIN o USING (value) WHERE kind < 3 OR (owners <= 2 AND repos < 20)),
g AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
             count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (example) AS n_example,
             count(*) FILTER (live) AS n_live,
             string_agg(['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop, ','
                        ORDER BY start, kind) AS spans,
             string_agg(['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop, ','
                        ORDER BY start, kind) FILTER (kind < 3) AS base FROM s GROUP BY r)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_example, 0) AS n_example,
       coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN g USING (r)
"""


#: Common tables for crc32: ``crc`` holds the table of byte remainders as the list ``t``.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, b:
    CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t)"""


def _crc32(text: str) -> str:
    """crc32 of a text's UTF-8 bytes; ``t`` must be in scope."""
    code = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {code}), lambda c, b: "
            "xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")


SQL = {
    "op12_prefix_trie": rf"""
WITH {CRC_TABLE},
o AS (SELECT conv_id, strlen(coalesce(text, '')) AS bytes,
             sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                 sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM o), crc),
u AS (SELECT c.conv_id, 0 AS own, place, said, bytes FROM c JOIN o ON o.conv_id = base AND place <= h
      UNION ALL SELECT c.conv_id, 1, place, said, bytes FROM c JOIN o ON o.conv_id = c.conv_id AND place > h),
p AS (SELECT conv_id, bytes, row_number() OVER w AS depth, string_agg(said, '') OVER w AS path
      FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY own, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT conv_id, depth, path, bytes, max(depth) OVER (PARTITION BY conv_id) AS turns FROM p
      UNION ALL SELECT conv_id, 0, '', 0, coalesce((SELECT max(depth) FROM p WHERE p.conv_id = c.conv_id), 0) FROM c),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = turns), '')) AS ends_sha256
      FROM m GROUP BY path, depth),
k AS (SELECT n.*, left(path, (depth - 1) * 64) AS above, NOT EXISTS (
          SELECT 1 FROM n AS x WHERE x.depth = n.depth + 1 AND left(x.path, n.depth * 64) = n.path) AS leaf FROM n),
a AS (SELECT left(path, d * 64) AS path, d AS depth, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved_tokens,
             count(*) FILTER (depth = d + 1) AS n_children
      FROM (SELECT *, unnest(range(depth + 1)) AS d FROM k) GROUP BY ALL)
SELECT k.conv_id, CAST(depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, k.n_convs, n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN a USING (path, depth) LEFT JOIN (SELECT path AS above, depth + 1 AS depth, conv_id FROM n) up USING (above, depth)
""",
    "op13_spelling_variants": rf"""
WITH RECURSIVE {CRC_TABLE},
o AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
             translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
h AS (SELECT run, {_crc32("id || ':' || run")} AS h FROM o, crc),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
             ELSE run END AS word FROM h),
v AS MATERIALIZED (SELECT word, count(*) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
d AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
                   FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
p AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM d a JOIN d b USING (i, rest) WHERE a.word <> b.word
      UNION SELECT d.word, d.n, v.word, v.n FROM d JOIN v ON d.rest = v.word
      UNION SELECT v.word, v.n, d.word, d.n FROM d JOIN v ON d.rest = v.word),
b AS (SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
             row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM p),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * v.n THEN other END AS form,
                          CASE WHEN other_n >= 10 * v.n THEN other_n END AS form_n
                   FROM v LEFT JOIN b ON v.word = b.word AND place = 1),
r AS (SELECT word, word AS root, 0 AS step FROM f
      UNION ALL SELECT r.word, f.form, step + 1 FROM r JOIN f ON r.root = f.word WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(root, step) AS root FROM r GROUP BY word) USING (word)
""",
    "op5_secret_scan": _secrets(),
    "op1_topk_search": r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, min(vec) AS qv FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (SELECT query_id, vec_id, CAST(list_dot_product(qv, vec) AS BIGINT) AS score
      FROM q JOIN v ON vec_id <> query_id AND len(qv) = len(vec)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op3_mixing": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS hash
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
             2.0::DOUBLE * source_size AS lim FROM s),
o AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                 - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY lim / weight, source NULLS LAST
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit FROM w),
t AS (SELECT source, source_size, least(lim, coalesce(
          (SELECT unit FROM o AS p WHERE lim > unit * weight ORDER BY lim / weight, source NULLS LAST LIMIT 1)
          * weight, lim)) AS target FROM o),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
h AS (SELECT source, hash, sum(size) AS size FROM d GROUP BY source, hash),
r AS (SELECT h.source, h.hash, h.size, e.target - e.epochs * e.source_size AS budget,
             sum(h.size) OVER (PARTITION BY h.source ORDER BY h.hash) AS through
      FROM h JOIN e ON h.source IS NOT DISTINCT FROM e.source WHERE e.source_size > 0),
f AS (SELECT source, arg_min(CASE WHEN through - budget < budget - (through - size) THEN hash ELSE hash - 1 END, hash) AS cut
      FROM r WHERE through >= budget GROUP BY source)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, e.source_size, e.target,
       CAST((e.epochs + CASE WHEN d.hash <= f.cut THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source
""",
    "op7_line_dedup": r"""
WITH l AS (SELECT d.doc_id, i, unnest(x) AS line, unnest(range(len(x))) AS pos
           FROM (SELECT doc_id, row_number() OVER () AS i, string_split(coalesce(text, ''), chr(10)) AS x
                 FROM documents) d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS top, true AS common FROM k WHERE length(key) >= 20 GROUP BY key
      HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (common AND c.top IS DISTINCT FROM k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (common IS NULL OR c.top IS NOT DISTINCT FROM k.doc_id), ''))
           AS kept_sha256
FROM k LEFT JOIN c USING (key) GROUP BY k.i, k.doc_id
""",
    "op9_exact_dedup": r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       coalesce(doc_id = min(doc_id) OVER w, count(*) OVER w = 1) AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
""",
}
