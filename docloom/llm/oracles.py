"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from docloom.llm.shared import LOWER, UPPER

ASCII_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
WORD = r"[^\x20\x09-\x0D]+"


def _sql(s: str) -> str:
    return s.replace("'", "''")


OP8 = f"""
WITH d AS (SELECT doc_id, {ASCII_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
                  md5('mix-1:' || doc_id::VARCHAR) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5.0e0, 2.0e0, 1.0e0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
             source_size * 2.0e0 AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5e0 AS total FROM s),
r AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM w),
t AS (SELECT *, least(cap, coalesce(max(CASE WHEN lv * weight <= cap THEN lv END) OVER () * weight, cap)) AS target FROM r),
p AS (SELECT row_number() OVER () AS rn, d.*, t.source_size, t.target, round(t.target)::BIGINT AS quota,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT greatest(12, ceil(log2((SELECT count(*) FROM d) / 64.0e0)), ceil(log2(2 * count(*) + 1.0e0)))::BIGINT AS bits, count(*) AS sources, coalesce(sum(round(target)), 0)::BIGINT AS words FROM t),
bs AS (SELECT bits, greatest(1, ceil(words / ((1 << bits) - sources)::DOUBLE))::BIGINT AS b FROM n),
own AS (SELECT source, nb, (sum(nb) OVER (ORDER BY source NULLS LAST) - nb)::BIGINT AS lo FROM (SELECT source, ceil(round(target) / b::DOUBLE)::BIGINT AS nb FROM t, bs) WHERE nb > 0),
points AS (SELECT source, unnest(range(lo, lo + nb)) AS point FROM own),
slots AS (SELECT source, list_sum(list_transform(range(bits), lambda x: ((point >> x) & 1) << (bits - 1 - x)))::BIGINT AS slot FROM points, bs),
ranked AS (SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS block FROM slots),
turns AS (SELECT rn, source, start + turn * source_size AS f, least(start + turn * source_size + size, quota) AS e FROM p, (SELECT unnest([0, 1]) AS turn) WHERE size > 0),
pieces AS (SELECT rn, source, f, e, unnest(range(f // b, (e - 1) // b + 1)) AS block, b FROM turns, bs WHERE f < e),
takes AS (SELECT rn, sum(least(e, (pieces.block + 1) * b) - greatest(f, pieces.block * b))::BIGINT AS taken, min(slot) AS first_slot
          FROM pieces JOIN ranked ON pieces.source IS NOT DISTINCT FROM ranked.source AND pieces.block = ranked.block GROUP BY rn)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot FROM p LEFT JOIN takes USING (rn)
"""

OP9 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\', '\s'), '</turn>', '\t'), '### ', '\h') AS esc FROM c),
f AS (SELECT *, CASE WHEN contains(text, '</turn>') OR contains(text, '### ') OR contains(text, '\s') OR contains(text, '\t') OR contains(text, '\h')
                     THEN esc ELSE text END AS body FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### ' || role || ': ' || body || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


OP10 = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(lower_text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
           FROM (SELECT doc_id, LOWERED AS lower_text FROM documents)),
i AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
grams AS (SELECT rn, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
       FROM (SELECT d.*, l.n, unnest(range(1, len(w) - l.n + 2)) AS p FROM d, (SELECT DISTINCT n FROM i) l WHERE len(w) >= l.n)),
h AS (SELECT DISTINCT rn, item_id, p, win.n FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
hit AS (SELECT rn, count(DISTINCT q) AS n_hit FROM (SELECT rn, unnest(range(p, p + n)) AS q FROM h) GROUP BY rn),
its AS (SELECT rn, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT rn, item_id::VARCHAR AS x FROM h) GROUP BY rn)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rn) LEFT JOIN its USING (rn)
""".replace("LOWERED", ASCII_LOWER)


def _located(pattern: str, rank: int, keep: str = "") -> str:
    """Spans of one kind: matches and gaps alternate, so running sums of their lengths are the positions."""
    return f"""
SELECT doc_id, rn, {rank} AS rank, s, s + length(m) AS e, m FROM (
  SELECT doc_id, rn, m, (sum(length(g) + length(m)) OVER (PARTITION BY rn ORDER BY i) - length(m))::BIGINT AS s, i
  FROM (SELECT doc_id, rn, unnest(regexp_extract_all(t, '{_sql(pattern)}', 0)) AS m,
               unnest((regexp_split_to_array(t, '{_sql(pattern)}'))[1:len(regexp_extract_all(t, '{_sql(pattern)}', 0))]) AS g,
               unnest(range(len(regexp_extract_all(t, '{_sql(pattern)}', 0)))) AS i
        FROM d WHERE regexp_matches(t, '{_sql(pattern)}'))) {keep}"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _op2() -> str:
    """Patterns, lengths and bits are written here again, so that a wrong one of the operator shows."""
    w = 20
    keys = "|".join(_either_case(k) for k in ("password", "passwd", "secret", "token", "api_?key"))
    assign = f"""({keys})["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)"""
    words = ("EXAMPLE", "example", "PLACEHOLDER", "placeholder", "CHANGEME", "changeme")
    shapes = ("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", "^[a-z][a-z/_=-]*$", "^[A-Z][A-Z/_=-]*$", "^[0-9+/_=-]+$")
    allowed = " OR ".join([*(f"contains(m, '{x}')" for x in words), *(f"regexp_matches(m, '{p}')" for p in shapes)])
    bits = "CASE WHEN regexp_matches(m, '^[0-9a-fA-F]+$') THEN 3.0e0 WHEN regexp_matches(m, '^[A-Za-z]+$') THEN 4.1e0 ELSE 3.75e0 END"
    kinds = "['assign', 'access', 'hex', 'entropy'][rank + 1]"
    text = f"string_agg({kinds} || ':' || s || ':' || e, ',' ORDER BY s, rank, e)"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rn, coalesce(text, '') AS t FROM documents),
base AS ({_located(assign, 0, f"WHERE length(regexp_extract(m, '{_sql(assign)}', 2)) >= 8")}
  UNION ALL {_located("AKIA[A-Z0-9]+", 1, "WHERE length(m) >= 16")}
  UNION ALL {_located("[0-9a-f]+", 2, "WHERE length(m) >= 32")}),
runs AS ({_located("[A-Za-z0-9+/_=-]+", 3, "WHERE length(m) >= 20")}),
free AS (SELECT * FROM runs r WHERE NOT ({allowed}) AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rn = r.rn AND b.s < r.e AND r.s < b.e)),
wins AS (SELECT rn, s, m, unnest(range(1, length(m) - {w} + 2)) AS pos FROM free),
chars AS (SELECT rn, s, m, pos, c, count(*) AS n FROM (SELECT rn, s, m, pos, unnest(string_split(substring(m, pos, {w}), '')) AS c FROM wins) GROUP BY ALL),
ent AS (SELECT rn, s, m, pos, sum(n * log2(n)) AS h FROM chars GROUP BY rn, s, m, pos),
high AS (SELECT rn, s, m FROM ent GROUP BY rn, s, m HAVING round(min(h), 9) <= round({w} * (log2({w}) - ({bits})), 9)),
extra AS (SELECT f.* FROM free f JOIN high h ON f.rn = h.rn AND f.s = h.s),
b AS (SELECT rn, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex, {text} AS t FROM base GROUP BY rn),
a AS (SELECT rn, {text} AS t FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY rn)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.t, '')) AS base_sha256, coalesce(a.t, '') AS spans
FROM d LEFT JOIN b USING (rn) LEFT JOIN a USING (rn)
"""


ORACLES = {"op2_secret_scans": _op2(), "op7_mixing": OP7, "op8_exact_dedup": OP8, "op9_chat_formatting": OP9, "op10_decontamination": OP10}


def _base32(digest: str) -> str:
    """Base32 of 40 hexadecimal digits: 5 digits at a time are 4 letters."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    parts = []
    for i in range(8):
        n = f"('0x' || substring({digest}, {5 * i + 1}, 5))::BIGINT"
        parts += [f"substring({letters}, ((({n}) >> {s}) & 31)::BIGINT + 1, 1)" for s in (15, 10, 5, 0)]
    return " || ".join(parts)


ORACLES["op3_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM p)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, {_base32("d")} AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN NULL ELSE true END AS digest_ok
FROM k
"""
ORACLES["op5_html_extraction"] = r"""
WITH p AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)', 1, 's') AS a FROM pages),
b AS (SELECT page_id, url, regexp_split_to_array(string_split(a, '</article>')[1], '</?(?:h1|p|br)>') AS parts FROM p),
d AS (SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(replace(replace(replace(replace(
        regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#39;', chr(39)), '&amp;?', '&', 'g')) AS parts FROM b),
t AS (SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS lines FROM d)
SELECT page_id, url, array_to_string(lines, chr(10)) AS text, length(array_to_string(lines, chr(10)))::BIGINT AS n_chars FROM t
"""


def _op11(k: int = 8, rounds: int = 10) -> str:
    """Plain k-means: every vector against every centroid in each round."""

    def nearest(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (SELECT rn, cluster, d FROM (SELECT *, row_number() OVER (PARTITION BY rn ORDER BY d, cluster) AS n FROM
  (SELECT rn, cluster, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d FROM x JOIN c{r} c USING (pos) GROUP BY rn, cluster)) WHERE n = 1)"""

    steps = []
    for r in range(rounds):
        steps += [nearest(r), f"""c{r + 1} AS MATERIALIZED (SELECT cluster, pos, CASE WHEN n IS NULL THEN c.v ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS v
  FROM c{r} c LEFT JOIN (SELECT cluster, pos, sum(v) AS s, count(*) AS n FROM a{r} JOIN x USING (rn) GROUP BY cluster, pos) m USING (cluster, pos))"""]
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: coalesce(isfinite(y), false))) = 64),
x AS MATERIALIZED (SELECT rn, unnest(range(64)) AS pos, unnest(v) AS v FROM kept),
c0 AS MATERIALIZED (SELECT cluster, unnest(range(64)) AS pos, unnest(v) AS v FROM
  (SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < {k})),
{", ".join(steps)},
{nearest(rounds)},
h AS (SELECT cluster, sha256(string_agg(v::VARCHAR, ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, cluster::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (rn) JOIN h USING (cluster)
"""


ORACLES["op11_centroid_clustering"] = _op11()

#: The log ratios are rounded to multiples of 2^-20 here as well; the bound is -0.2.
ORACLES["op12_quality_rules"] = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT rn, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
runs AS (SELECT rn, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT rn, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT rn, i FROM runs QUALIFY count(*) OVER (PARTITION BY rn, a, b, c) > 1),
rep AS (SELECT rn, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(3)) AS k) GROUP BY rn),
dup AS (SELECT rn, (count(*) - count(DISTINCT line))::BIGINT AS n FROM (SELECT rn, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rn),
tok AS MATERIALIZED (SELECT rn, row_number() OVER (PARTITION BY rn ORDER BY i, j) AS p, ('0x' || md5(x)[1:8])::BIGINT AS h FROM
  (SELECT rn, i, unnest(xs) AS x, unnest(range(len(xs))) AS j FROM
    (SELECT rn, i, regexp_extract_all(translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+|[^0-9a-z\x{80}-\x{10FFFF}]+') AS xs FROM
      (SELECT rn, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w)))),
gram AS MATERIALIZED (SELECT rn, h % 10000 AS bucket FROM tok
  UNION ALL SELECT rn, ((h % 10000) * 1000003 + g) % 10000 FROM (SELECT rn, h, lead(h) OVER (PARTITION BY rn ORDER BY p) AS g FROM tok) WHERE g IS NOT NULL),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND max(coalesce(toxic, 0)) = 0),
cnt AS (SELECT b.bucket, count(g.rn)::DOUBLE AS raw, (count(g.rn) FILTER (WHERE d.doc_id IN (SELECT doc_id FROM good)))::DOUBLE AS trusted
  FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN gram g USING (bucket) LEFT JOIN d USING (rn) GROUP BY b.bucket),
tot AS (SELECT sum(raw) AS r, sum(trusted) AS g FROM cnt),
weight AS (SELECT bucket, CASE WHEN g = 0 THEN 0 ELSE floor((ln((trusted + 1) / (g + 10000)) - ln((raw + 1) / (r + 10000))) * 1048576 + 0.5) END::BIGINT AS v FROM cnt, tot),
score AS (SELECT rn, count(*) AS n, sum(v) AS s FROM gram JOIN weight USING (bucket) GROUP BY rn),
base AS (SELECT d.rn, doc_id, len(ws)::BIGINT AS n_words, list_sum(list_transform(ws, lambda x: length(x)))::BIGINT AS word_chars, length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(sc.s >= sc.n * -209716, true) AS enough
  FROM d JOIN w USING (rn) LEFT JOIN dup USING (rn) LEFT JOIN rep USING (rn) LEFT JOIN score sc USING (rn))
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND enough AS kept
FROM base
"""
