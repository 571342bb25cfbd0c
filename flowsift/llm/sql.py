"""DuckDB twins of the dealt queries, where SQL can express them."""

from __future__ import annotations

from . import licenses

#: Words ``[^\x20\x09-\x0D]+`` of a text in DuckDB.
W = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

def _op1() -> str:
    """Brute force: every block against every template, every place against every phrase."""
    sets = licenses.template_sets(licenses.TEMPLATES, licenses.THRESHOLD)
    quote = lambda ws: "[" + ", ".join(f"'{x}'" for x in ws) + "]"
    templates = ", ".join(f"('{label}', {quote(ws)}, {alpha})" for label, ws, alpha in sets)
    phrases = ", ".join(f"({quote(p.split())}, '{label}')" for p, label in licenses.PHRASES.items())
    return rf"""
WITH t(label, ws, alpha) AS (VALUES {templates}), p(ws, label) AS (VALUES {phrases}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
h AS (SELECT rid, i - 1 AS place, label FROM (SELECT rid, w, unnest(generate_series(1, len(w))) AS i FROM d)
      JOIN p ON w[i:i + len(ws) - 1] = ws),
b AS (SELECT rid, list_distinct(w[s:s + 255]) AS w
      FROM (SELECT rid, w, unnest(generate_series(1, greatest(len(w) - 128, 1), 128)) AS s FROM d)),
m AS (SELECT rid, label, len(list_intersect(b.w, t.ws)) / len(t.ws) AS c FROM b, t
      WHERE len(list_intersect(b.w, t.ws)) >= alpha),
hh AS (SELECT rid, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
              string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h GROUP BY rid),
ll AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
       FROM (SELECT rid, label FROM h UNION ALL SELECT rid, label FROM m) GROUP BY rid),
mm AS (SELECT rid, max(c) AS c FROM m GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score
FROM d LEFT JOIN hh USING (rid) LEFT JOIN ll USING (rid) LEFT JOIN mm USING (rid)
"""


OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {W} AS w FROM documents),
g AS (SELECT rid, doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h
      FROM (SELECT rid, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS p FROM d)),
f AS (SELECT h, min(doc_id) AS low FROM g GROUP BY h),
x AS (SELECT rid, unnest(generate_series(p, p + 49)) AS p FROM g JOIN f USING (h) WHERE doc_id > low),
c AS (SELECT rid, list(DISTINCT p) AS ps FROM x GROUP BY rid),
k AS (SELECT doc_id, w, CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda v, i: NOT list_contains(ps, i)) END AS kept
      FROM d LEFT JOIN c USING (rid))
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(kept))::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""

OP4 = rf"""
WITH d AS (SELECT doc_id, source, len({W})::BIGINT AS size,
                  md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::BIGINT AS weight, 2 * source_size AS cap FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total,
             coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
c AS (SELECT *, (total * 150 - before * 100) * weight > cap * rest * 100 AS clamped FROM o),
l AS (SELECT *, sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER () AS used,
             sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER () AS open_weight FROM c),
t AS (SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE
             ELSE ((total * 150 - used * 100) * weight)::DOUBLE / (open_weight * 100)::DOUBLE END AS target FROM l),
q AS (SELECT *, floor(target)::BIGINT AS owed,
             CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS reps FROM t),
r AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.reps, q.owed - q.reps * q.source_size AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (reps * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM r
"""

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {W} AS w FROM documents),
g AS (SELECT rid, p, hash(w[p:p + 4]) AS h, w[p:p + 4] AS gram
      FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 4)) AS p FROM d)),
r AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c >= 2),
m AS (SELECT rid, sum(least(5, coalesce(nxt - p, 5)))::BIGINT AS n_repeat_words
      FROM (SELECT rid, p, lead(p) OVER (PARTITION BY rid ORDER BY p) AS nxt FROM r) GROUP BY rid),
x AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letters
      FROM d LEFT JOIN m USING (rid)),
y AS (SELECT doc_id, n_letters, len(list_filter(ls, lambda l: regexp_matches(l, '^[\t-\r ]*[-*•]'))) AS n_bullets,
             len(list_filter(ls, lambda l: regexp_matches(l, '(\.\.\.|…)[\t-\r ]*$'))) AS n_ellipses, n_words, word_chars, n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             n_repeat_words, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed, len(ls) AS n_lines FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR n_symbols * 100 > 30 * n_words
            OR n_dup_lines * 100 > 50 * n_lines OR n_letters * 100 < 50 * n_words
            OR n_lines >= 3 AND (n_bullets * 100 >= 90 * n_lines OR n_ellipses * 100 > 30 * n_lines)) AS kept FROM y
"""

OP6 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT rid, w[p:p + 3] AS g FROM (SELECT rid, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS p
                                             FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
i AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT a AS rid, a AS node FROM (SELECT DISTINCT a FROM e) UNION SELECT r.rid, e.b FROM r JOIN e ON r.node = e.a),
m AS (SELECT r.rid, min(d.doc_id) AS component_id FROM r JOIN d ON d.rid = r.node GROUP BY r.rid)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM d LEFT JOIN n USING (rid) LEFT JOIN m USING (rid)
"""

OP8 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT rid, coalesce(source, chr(0)) AS site, p, trim(ls[p], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
      FROM (SELECT rid, source, ls, unnest(generate_series(1, len(ls))) AS p FROM d)),
n AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
b AS (SELECT line FROM n WHERE n > 0 GROUP BY line HAVING count(DISTINCT site) >= 8),
h AS (SELECT rid, list(p) AS ps, sum(n) AS lost FROM n JOIN b USING (line) GROUP BY rid),
t AS (SELECT rid, sum(n) AS total FROM n GROUP BY rid),
k AS (SELECT d.doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(len(ps), 0) AS n_boilerplate,
             CASE WHEN lost * 2 <= total THEN list_filter(ls, lambda x, i: NOT list_contains(ps, i)) ELSE ls END AS kept
      FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid))
SELECT doc_id, n_lines::BIGINT AS n_lines, n_boilerplate::BIGINT AS n_boilerplate,
       (n_lines - coalesce(len(kept), 0))::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256 FROM k
"""

#: crc32 of a decimal id, bit by bit: 256 + byte starts a byte, 0 shifts by one bit.
CRC = r"""xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda b: [256 + ord(b)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: CASE WHEN x >= 256 THEN xor(c, x - 256) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {W} AS w, {CRC} AS h FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
b AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
m AS MATERIALIZED (SELECT rid, doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN
        list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM b),
s AS (SELECT rid, p, w[p + 1:p + 6] AS gram FROM (SELECT rid, w, unnest(range(len(w) - 5)) AS p FROM m)),
e AS (SELECT x.rid, x.p, y.p - x.p AS q FROM s x JOIN s y ON x.rid = y.rid AND x.gram = y.gram AND x.p < y.p),
i AS MATERIALIZED (SELECT rid, q, min(p) AS s, max(p) + 6 + q AS e
      FROM (SELECT *, p - row_number() OVER (PARTITION BY rid, q ORDER BY p) AS island FROM e) GROUP BY rid, q, island),
r AS MATERIALIZED (SELECT rid, s, e - s AS len, q FROM i WHERE e - s >= greatest(12, 2 * q) AND NOT EXISTS (
        SELECT 1 FROM i k WHERE k.rid = i.rid AND k.q < i.q AND k.s <= i.s AND k.e >= i.e)),
o AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
             first(s ORDER BY len DESC, s, q) AS start, first(len ORDER BY len DESC, s, q) AS length,
             first(q ORDER BY len DESC, s, q) AS period FROM r GROUP BY rid),
g AS (SELECT DISTINCT rid, unnest(range(s + q, s + len)) AS p FROM r),
k AS (SELECT rid, string_agg(v, ' ' ORDER BY p) AS kept
      FROM (SELECT rid, unnest(w) AS v, unnest(range(len(w))) AS p FROM m) ANTI JOIN g USING (rid, p) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(kept, '')) AS collapsed_sha256
FROM m LEFT JOIN o USING (rid) LEFT JOIN k USING (rid)
"""


def _op13(k: int = 40, rounds: int = 5, length: int = 64) -> str:
    """All distances in every round. Components are whole numbers in doubles: sums below 2**53 are exact."""
    steps = [rf"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda x: isfinite(x))) = {length}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
      FROM (SELECT sha256('2:' || vec_id) AS h, v FROM x ORDER BY h, v LIMIT {k}))"""]
    for r in range(rounds + 1):
        steps.append(rf"""
a{r} AS MATERIALIZED (SELECT rid, vec_id, x.v, c, list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, y.v)
             + list_inner_product(y.v, y.v) AS d
      FROM x, c{r} y QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(rf"""
c{r + 1} AS MATERIALIZED (SELECT y.c, coalesce(z.v, y.v) AS v FROM c{r} y LEFT JOIN
      (SELECT c, list(((s - ((s % n + n) % n)) // n)::DOUBLE ORDER BY i) AS v
       FROM (SELECT c, i, sum(e)::HUGEINT AS s, count(*) AS n
             FROM (SELECT c, unnest(v)::BIGINT AS e, unnest(range({length})) AS i FROM a{r}) GROUP BY c, i)
       GROUP BY c) z ON y.c = z.c)""")
    return ",".join(steps) + rf"""
SELECT vec_id, a.c::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(y.v, lambda e: e::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} y ON a.c = y.c
"""


ORACLE = {
    "op1_licenses": _op1(),
    "op2_substrings": OP2,
    "op4_mixing": OP4,
    "op6_near_dups": OP6,
    "op8_line_dedup": OP8,
    "op9_quality": OP9,
    "op12_runs": OP12,
    "op13_centroids": _op13(),
}
