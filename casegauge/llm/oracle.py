"""DuckDB SQL for the operators that SQL can express. Patterns and limits are stated here
anew, so that a mistake in an operator doesn't pass unseen."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP3 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i
        FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id AS id, doc_id AS reach FROM documents
  UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.reach),
c AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.id = d.doc_id
"""

OP5 = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '{_WORD}') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM t),
g AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n >= 2),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM again) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (r)),
f AS (
  SELECT *,
    (CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 75 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN n_dup_lines >= 5 AND 20 * n_dup_lines > n_words THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 40 * n_words THEN 16 ELSE 0 END) AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  CAST(failed AS INTEGER) AS failed, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept
FROM f
"""

# Shards take turns: in a turn, a shard's offset and step lead to its first free slot. One
# recursion step is one claim.
OP6 = """
WITH RECURSIVE s AS (
  SELECT i AS shard,
    CAST(('0x' || substr(md5('offset:shard-' || lpad(CAST(i AS VARCHAR), 2, '0')), 1, 15)) AS BIGINT)
      % 4099 AS o,
    CAST(('0x' || substr(md5('step:shard-' || lpad(CAST(i AS VARCHAR), 2, '0')), 1, 15)) AS BIGINT)
      % 4098 + 1 AS st
  FROM range(31) x(i)),
o AS (SELECT list(o ORDER BY shard) AS o, list(st ORDER BY shard) AS st FROM s),
claim AS (
  SELECT 0 AS turn, list_transform(range(4099), lambda x: -1) AS owner,
    list_transform(range(31), lambda x: 0) AS seen
  UNION ALL
  SELECT turn + 1, owner[:slot] || [turn % 31] || owner[slot + 2:],
    seen[:turn % 31] || [j + 1] || seen[turn % 31 + 2:]
  FROM (
    SELECT turn, owner, seen, j, (o[turn % 31 + 1] + j * st[turn % 31 + 1]) % 4099 AS slot
    FROM (
      SELECT turn, owner, seen, o, st, list_filter(range(seen[turn % 31 + 1], 4099),
        lambda j: owner[(o[turn % 31 + 1] + j * st[turn % 31 + 1]) % 4099 + 1] = -1)[1] AS j
      FROM claim, o WHERE turn < 4099))),
full_table AS (SELECT owner FROM claim WHERE turn = 4099),
d AS (
  SELECT doc_id, CAST(CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT)
    % 4099 AS INTEGER) AS slot FROM documents)
SELECT doc_id, slot, CAST(owner[slot + 1] AS INTEGER) AS shard FROM d, full_table
"""

OP8 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
m AS (SELECT h, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM p LEFT JOIN m USING (h)
"""

# A round of codebooks is a pair of tables: the nearest entry of every part, and the entries' new
# components. Components are HUGEINT, so nothing rounds.
_OP12_NEAREST = """
n{r} AS MATERIALIZED (
  SELECT id, part, x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c),
    lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := entry)) AS best
  FROM v JOIN b{r} USING (part) GROUP BY id, part, x)"""
_OP12_ENTRIES = """
b{s} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN (
    SELECT part, entry, list((t - ((t % n) + n) % n) // n ORDER BY i) AS c FROM (
      SELECT part, best.e AS entry, i, sum(x[i]) AS t, count(*) AS n
      FROM n{r}, (SELECT unnest(range(1, 9)) AS i) GROUP BY 1, 2, 3) GROUP BY 1, 2) m
  USING (part, entry))"""
OP12 = """
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT id, part, x[part * 8 + 1:part * 8 + 8] AS x FROM k, (SELECT unnest(range(8)) AS part)),
b0 AS (SELECT part, id - 1 AS entry, x AS c FROM v WHERE id <= 16),""" + ",".join(
    _OP12_NEAREST.format(r=r) + "," + _OP12_ENTRIES.format(r=r, s=r + 1) for r in range(6)) + "," \
    + _OP12_NEAREST.format(r=6) + """,
f AS (
  SELECT id, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY part) AS code,
    CAST(sum(best.d) AS BIGINT) AS error FROM n6 GROUP BY id),
h AS (
  SELECT sha256(string_agg(CAST(c[i] AS VARCHAR), ',' ORDER BY part, entry, i)) AS books
  FROM b6, (SELECT unnest(range(1, 9)) AS i))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  books AS codebooks_sha256
FROM k JOIN f USING (id), h
"""

_ENC = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256({})".format(" || ".join(_ENC.format(c) for c in (
    "doc_id", "source", "lang", "n_chars", "text")))
_SIBLINGS = """
  SELECT a.r, {up}b.level, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i >> (3 * b.level)) AS l,
    string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i >> (3 * b.level)) AS g
  FROM {a} a JOIN {b} b ON {on} b.n > 1 AND b.i >> 3 = a.i >> (3 * b.level + 3) GROUP BY 1, 2"""
OP13 = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('1' || lang, '0') AS k, {_LEAF} AS leaf,
    {_LEAF.replace(_ENC.format("text"), _ENC.format(
        "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))} AS changed,
    list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
      lambda crc, c: list_reduce(range(8), lambda x, j: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, c)),
      4294967295) AS crc
  FROM documents),
p AS MATERIALIZED (
  SELECT *, CAST(row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS i,
    count(*) OVER (PARTITION BY k) AS n FROM d),
low(k, level, i, n, h) AS (
  SELECT k, 0, i, n, leaf FROM p UNION ALL
  SELECT k, level + 1, i >> 3, (n + 7) >> 3, sha256(string_agg(h, '' ORDER BY i))
  FROM low WHERE n > 1 GROUP BY k, level, i >> 3, (n + 7) >> 3),
s AS MATERIALIZED (
  SELECT k, k AS r, h, CAST(row_number() OVER (ORDER BY k) - 1 AS BIGINT) AS i, count(*) OVER () AS n
  FROM low WHERE n = 1),
high(level, i, n, h) AS (
  SELECT 0, i, n, h FROM s UNION ALL
  SELECT level + 1, i >> 3, (n + 7) >> 3, sha256(string_agg(h, '' ORDER BY i))
  FROM high WHERE n > 1 GROUP BY level, i >> 3, (n + 7) >> 3),
own AS ({_SIBLINGS.format(up="", a="p", b="low", on="a.k = b.k AND")}),
top AS ({_SIBLINGS.format(up="", a="s", b="high", on="")}),
path AS MATERIALIZED (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY up, level) AS step, l, g FROM (
    SELECT r, 0 AS up, level, coalesce(l, '') AS l, coalesce(g, '') AS g FROM own
    UNION ALL
    SELECT p.r, 1, level, coalesce(l, ''), coalesce(g, '') FROM p JOIN top ON top.r = p.k)),
fold(r, step, h) AS (
  SELECT r, 0, CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN coalesce(changed, leaf) ELSE leaf END FROM p
  UNION ALL
  SELECT fold.r, path.step, sha256(l || h || g) FROM fold JOIN path
    ON path.r = fold.r AND path.step = fold.step + 1),
proof AS (SELECT r, sha256(string_agg(l || g, '' ORDER BY step)) AS proof_sha256 FROM path GROUP BY r)
SELECT doc_id, leaf, s.h AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
  f.folded_root, f.folded_root = root AS verified
FROM p JOIN s USING (k) LEFT JOIN proof ON proof.r = p.r
  JOIN (SELECT r, arg_max(h, step) AS folded_root FROM fold GROUP BY r) f ON f.r = p.r,
  (SELECT h AS root FROM high WHERE n = 1)
"""

SQL = {"op12_vector_codes": OP12, "op13_merkle": OP13, "op3_near_dup": OP3, "op5_quality": OP5, "op6_sharding": OP6, "op8_warc": OP8}
