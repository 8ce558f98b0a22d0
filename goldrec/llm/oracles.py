"""DuckDB SQL for the queries that SQL can express, written by plain all-pairs means.

Not expressible: op4 (a tokeniser), op5 (XXH64), op9 (a fitted classifier).
"""

from __future__ import annotations

import re

from goldrec.llm.licenses import GAP, NEEDED, PHRASES, TEMPLATES, THRESHOLD, label_of, least_overlap, template_words
from goldrec.llm.secret_scan import RULES
from goldrec.llm.urls import BASE, DEPTH, MANY, NEW, PRIOR, REJECT, SIGMAS
from goldrec.llm.urls import RULES as URL_RULES
from goldrec.llm.vector_codes import ENTRIES, PARTS
from goldrec.llm.vector_codes import ROUNDS as CODE_ROUNDS
from goldrec.llm.vector_codes import SCALE as CODE_SCALE

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 11))) AS i FROM d)),
firsts AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (SELECT doc_id, i FROM win JOIN firsts USING (s) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM hit, (SELECT unnest(range(0, 13)) AS j)),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP2 = f"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, '-'), coalesce(source, '-'), coalesce(md5(text), '-'))), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / w, source IS NULL, source) AS k,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS held,
    sum(w) OVER (ORDER BY 3 * source_size / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS free
  FROM s),
lev AS (SELECT ((SELECT sum(source_size) FROM s)::BIGINT - held) / free AS x FROM o WHERE 3 * source_size >= ((SELECT sum(source_size) FROM s)::BIGINT - held) / free * w ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(3 * source_size, (SELECT x FROM lev) * w)::DOUBLE AS target FROM s),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS times, target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END) * source_size AS rest FROM t),
m AS (SELECT source, h, sum(size)::BIGINT AS mass FROM d WHERE size > 0 GROUP BY source, h),
c AS (SELECT source, h, mass, sum(mass) OVER (PARTITION BY source ORDER BY h) AS until FROM m),
cut AS (
  SELECT p.source, h + CASE WHEN until - rest < rest - (until - mass) THEN 1 ELSE 0 END AS cut
  FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source WHERE rest > 0 AND until - mass <= rest AND rest < until)
SELECT doc_id, size, source_size, target, (size * (times + CASE WHEN h < coalesce(cut, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
"""

OP3 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, m AS component_id, vec_id = m AS kept
FROM embeddings JOIN root ON root.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op6() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, i - 1 AS i, '{label}' AS label FROM spot WHERE "
        + " AND ".join(f"w[i + {j}] = '{x}'" if j else f"w[i] = '{x}'" for j, x in enumerate(phrase.split(" ")))
        for phrase, label in PHRASES.items()
    )
    lengths = {k: len([w for w in re.split(GAP, t.lower()) if w]) for k, t in TEMPLATES.items()}
    listed = lambda words: "[" + ", ".join(map(_quoted, sorted(words))) + "]::VARCHAR[]"
    templates = ", ".join(
        f"('{label_of(k)}', {listed(v)}, {listed(NEEDED.get(k, ()))}, {len(v)}, {least_overlap(len(v), THRESHOLD)}, {lengths[k]})" for k, v in template_words(TEMPLATES).items()
    )
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
ws AS (SELECT doc_id, t, regexp_extract_all(t, '{word}') AS w FROM d),
spot AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM ws),
hit AS ({phrases}),
base AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z, list_sort(list(DISTINCT label)) AS labels FROM hit GROUP BY doc_id),
template(label, tw, must, total, need, length) AS (VALUES {templates}),
able AS (SELECT doc_id, t, w, template.* FROM ws JOIN template ON len(list_intersect(w, tw)) >= need AND list_has_all(w, must)),
lines AS (SELECT doc_id, tw, must, label, total, need, regexp_extract_all(unnest(string_split(t, chr(10))), '{word}') AS b FROM able),
starts AS (SELECT doc_id, tw, must, label, total, need, length, w, unnest(range(1, len(w) + 1)) AS i FROM able),
blocks AS (SELECT * FROM lines UNION ALL SELECT doc_id, tw, must, label, total, need, w[i:i + length - 1] AS b FROM starts WHERE list_contains(tw, w[i])),
close AS (SELECT doc_id, label, len(list_intersect(b, tw)) / total AS c FROM blocks WHERE len(list_intersect(b, tw)) >= need AND list_has_all(b, must)),
more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(c) AS c FROM close GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM ws LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""


def op7() -> str:
    def plain(pattern: str) -> str:  # DuckDB's (?i) folds other letters too
        if not pattern.startswith("(?i)"):
            return pattern
        head, tail = pattern[4:].split(")", 1)
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in head) + ")" + tail

    parts = []
    for i, r in enumerate(RULES):
        rx = _quoted(plain(r.pattern))
        parts.append(
            f"SELECT doc_id, {i} AS k, '{r.kind}' AS kind, m, j, least_, {r.least} AS least, "
            "list_sum(list_transform(p[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:j - 1], lambda x: length(x))), 0) AS a "
            f"FROM (SELECT doc_id, m, p, least_, unnest(range(1, len(m) + 1)) AS j FROM (SELECT doc_id, regexp_extract_all(t, {rx}) AS m, "
            f"string_split_regex(t, {rx}) AS p, regexp_extract_all(t, {rx}, {r.group}) AS least_ FROM d))"
        )
    spans = " UNION ALL ".join(parts)
    line = "string_agg(kind || ':' || a || ':' || (a + length(m[j])), ',' ORDER BY a, k)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
span AS (SELECT doc_id, k, kind, m, j, a::BIGINT AS a FROM ({spans}) WHERE length(least_[j]) >= least),
per AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    {line} FILTER (k < 3) AS base, {line} AS spans
  FROM span GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
"""


OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""


def op10() -> str:
    def rule(value) -> str:
        cases = "".join(
            f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h, p)}'"
            for v, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
        )
        return f"CASE{cases} END"

    segment = (
        "CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '{n}' WHEN regexp_matches(s, '^[0-9]+\\.[A-Za-z]{1,5}$') THEN regexp_replace(s, '^[0-9]+', '{n}') "
        "WHEN regexp_matches(s, '^[0-9A-Za-z_-]{12,}$') AND regexp_matches(s, '[0-9]') THEN '{id}' ELSE s END"
    )
    levels, last = "", "shape0"
    for i in range(1, DEPTH + 1):
        levels += f"""
child{i} AS (SELECT host, template, segs[{i}] AS seg, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked
  FROM {last} WHERE len(segs) >= {i} GROUP BY host, template, segs[{i}]),
parent{i} AS (SELECT host, template, count(*) AS k, sum(n) AS pn, sum(labelled) AS pl, sum(blocked) AS pb FROM child{i} GROUP BY host, template),
named{i} AS (SELECT host, template, seg, CASE WHEN NOT starts_with(seg, '{{') AND ((k >= {MANY} AND k >= {NEW} * pn)
    OR (labelled > 0 AND pl > labelled AND abs(blocked / labelled - share) <= {SIGMAS} * sqrt(share * (1 - share) / labelled)))
    THEN '*' ELSE seg END AS name FROM (SELECT *, (pb - blocked + 1) / (pl - labelled + 2) AS share FROM child{i} JOIN parent{i} USING (host, template))),
shape{i} AS (SELECT t.host, t.segs, t.n, t.labelled, t.blocked, t.wl, t.wb, CASE WHEN name IS NULL THEN t.template ELSE t.template || '/' || name END AS template
  FROM {last} t LEFT JOIN named{i} m ON t.host = m.host AND t.template = m.template AND t.segs[{i}] = m.seg),"""
        last = f"shape{i}"

    def smooth(up: str, labelled: str = "wl", blocked: str = "wb") -> str:
        return f"(sum({blocked}) + {PRIOR} * {up}) / (sum({labelled}) + {PRIOR})"

    wide = " OR ".join(f"rule = '{h}{p}'" for _, h, p in URL_RULES if p == "/")

    return f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
given AS (SELECT *, {rule(lambda v, h, p: h + p)} AS rule, {rule(lambda v, h, p: v)} AS given,
  list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: {segment}) AS c FROM hp),
r AS (SELECT page_id, host, path, rule, given, CASE WHEN len(c) > {DEPTH} THEN list_concat(c[1:{DEPTH - 1}], [array_to_string(c[{DEPTH}:], '/')]) ELSE c END AS segs FROM given),
shape0 AS (SELECT host, segs, count(*) AS n, count(given) AS labelled, count(*) FILTER (given = 'block') AS blocked,
  count(*) FILTER ({wide}) AS wl, count(*) FILTER (given = 'block' AND ({wide})) AS wb, '' AS template FROM r GROUP BY host, segs),{levels}
tree AS (SELECT *, regexp_extract(host, '([^.]*\\.)?[^.]*$') AS domain FROM {last}),
d AS (SELECT domain, {smooth(str(BASE))} AS p FROM tree GROUP BY domain),
h AS (SELECT domain, host, {smooth('any_value(d.p)')} AS p FROM tree JOIN d USING (domain) GROUP BY domain, host),
t AS (SELECT host, template, {smooth('any_value(h.p)', 'labelled', 'blocked')} AS p FROM tree JOIN h USING (domain, host) GROUP BY host, template),
judged AS (SELECT host, segs, template, p FROM tree JOIN t USING (host, template))
SELECT page_id, r.host, path, rule, coalesce(given, CASE WHEN p > {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, template, p::DOUBLE AS purity
FROM r JOIN judged USING (host, segs)
"""


def op11() -> str:
    """All rounds written out; whole numbers throughout."""

    def nearest(book: str) -> str:
        distance = "list_sum(list_transform(range(1, len(x) + 1), lambda j: (x[j] - c[j]) * (x[j] - c[j])))"
        return f"SELECT rid, label, p, x, arg_min(k, d * 16 + k) AS k, min(d) AS d FROM (SELECT rid, label, p, x, k, {distance} AS d FROM part JOIN {book} USING (p)) GROUP BY rid, label, p, x"

    rounds = ""
    for i in range(CODE_ROUNDS):
        rounds += f"""
near{i} AS MATERIALIZED ({nearest(f"book{i}")}),
mean{i} AS (SELECT p, k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS m FROM (
  SELECT p, k, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM near{i}, unnest(range(1, len(x) + 1)) AS t(j) GROUP BY p, k, j) GROUP BY p, k),
book{i + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(m, c) AS c FROM book{i} b LEFT JOIN mean{i} USING (p, k)),"""
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor({CODE_SCALE} * x)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT rid, vec_id, label, p, e[p * len(e) // {PARTS} + 1:(p + 1) * len(e) // {PARTS}] AS x FROM v, unnest(range(0, {PARTS})) AS t(p)),
book0 AS MATERIALIZED (SELECT p, rid - 1 AS k, x AS c FROM part WHERE rid <= {ENTRIES}),{rounds}
final AS MATERIALIZED ({nearest(f"book{CODE_ROUNDS}")}),
row AS (SELECT rid, label, string_agg(format('{{:02x}}', k), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM final GROUP BY rid, label),
per AS (SELECT label, sum(error)::BIGINT AS label_error FROM row GROUP BY label),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM book{CODE_ROUNDS})
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM row JOIN v USING (rid) JOIN per ON row.label IS NOT DISTINCT FROM per.label, digest
"""


OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER w)::INTEGER AS rank, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) QUALIFY row_number() OVER w <= 10
"""

OP13 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
win AS (SELECT r, doc_id, i, md5(b[i:i + 49]) AS s FROM (SELECT r, doc_id, b, unnest(range(1, octet_length(b) - 48)) AS i FROM d)),
firsts AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (SELECT r, i FROM win JOIN firsts USING (s) WHERE m < doc_id),
span AS (SELECT r, i, max(i) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM hit),
run AS (SELECT r, i, sum(CASE WHEN last IS NULL OR i > last + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k FROM span),
gone AS (SELECT r, k, min(i) AS a, max(i) + 49 AS z FROM run GROUP BY r, k),
edge AS (SELECT r, a, z, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) AS prev, row_number() OVER (PARTITION BY r ORDER BY a DESC) AS back FROM gone),
part AS (
  SELECT r, a AS o, hex(b[prev + 1:a - 1]) AS x FROM edge JOIN d USING (r)
  UNION ALL SELECT r, z + 1 AS o, hex(b[z + 1:octet_length(b)]) AS x FROM edge JOIN d USING (r) WHERE back = 1),
kept AS (SELECT r, string_agg(x, '' ORDER BY o) AS x FROM part GROUP BY r),
n AS (SELECT r, sum(z - a + 1) AS n, count(*) AS k FROM gone GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(k, 0)::BIGINT AS n_spans,
  sha256(CASE WHEN n IS NULL THEN b ELSE unhex(x) END) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""


ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op2_mixing": OP2,
    "op3_embedding_near_dedup": OP3,
    "op6_licenses": op6(),
    "op7_secrets": op7(),
    "op8_top_k": OP8,
    "op10_url_filter": op10(),
    "op11_vector_codes": op11(),
    "op12_hard_negatives": OP12,
    "op13_suffix_array": OP13,
}
