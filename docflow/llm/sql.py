"""DuckDB counterparts of the queries that SQL can express."""

from docflow.llm.license_scan import CONTAINMENT_PERCENT, PHRASES, TEMPLATES

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT *, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS latest FROM p),
r AS (SELECT *, page_id IS DISTINCT FROM latest AND latest IS NOT NULL AS revisit FROM d)
SELECT page_id, octet_length(payload) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    ((('0x' || substr(h, CAST(1 + 5 * (j // 4) AS INTEGER), 5))::INTEGER >> CAST(15 - 5 * (j % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '')
    AS payload_digest,
  CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN revisit THEN latest END AS refers_to
FROM r
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""

MIXING = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS s, coalesce(octet_length(encode(text)), 0) + 1 AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k FROM documents),
w AS (SELECT s, CAST(floor(sqrt(CAST(sum(size) AS DOUBLE))) AS BIGINT) AS w FROM d GROUP BY s),
p AS (
  SELECT s, (1024 - count(*) OVER ()) * w // sum(w) OVER () AS part, (1024 - count(*) OVER ()) * w % sum(w) OVER () AS rest,
    1024 - count(*) OVER () AS spare FROM w),
q AS (
  SELECT s, CAST(1 + part + CASE WHEN row_number() OVER (ORDER BY rest DESC, s) <= spare - sum(part) OVER () THEN 1 ELSE 0 END AS INTEGER) AS q
  FROM p),
qs AS (SELECT list(s ORDER BY s) AS ss, list(q ORDER BY s) AS qq FROM q),
run AS (
  SELECT -1 AS t, list_transform(qq, lambda x: 0) AS done, CAST(NULL AS INTEGER) AS pick FROM qs
  UNION ALL
  SELECT t + 1, list_transform(range(len(done)), lambda j: done[j + 1] + CASE WHEN j = next THEN 1 ELSE 0 END), next
  FROM (
    SELECT t, done, CAST(list_min(list_filter(list_transform(range(len(done)), lambda j:
      CASE WHEN done[j + 1] < qq[j + 1] AND done[j + 1] * 1024 < (t + 2) * qq[j + 1]
        THEN ((done[j + 1] + 1) * 1024 + qq[j + 1] - 1) // qq[j + 1] * 1000000 + j END), lambda x: x IS NOT NULL)) % 1000000 AS INTEGER) AS next
    FROM run, qs WHERE t < 1023)),
plan AS (
  SELECT ss[pick + 1] AS s, qq[pick + 1] AS q, t AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k
  FROM run, qs WHERE pick IS NOT NULL),
b AS (
  SELECT *, sum(size) OVER (PARTITION BY s ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS pos FROM d)
SELECT doc_id, source, CAST(pos // 65536 AS BIGINT) AS mix_block,
  CAST(pos // 65536 // q * 1024 + slot AS BIGINT) AS mix_slot, CAST(pos % 65536 AS BIGINT) AS mix_offset
FROM b JOIN plan ON plan.s = b.s AND plan.k = (pos // 65536) % q
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, range(1, 5) AS lengths(m) WHERE len(w) >= m)
  GROUP BY ALL),
counts AS (SELECT * FROM grams WHERE f >= 30),
candidates AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE m > 1),
cuts AS (
  SELECT lang, m, phrase, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1 : m], ' ') AS q
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)),
scores AS (
  SELECT c.lang, c.m, c.phrase, a, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS score, k
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = p JOIN counts y ON y.lang = c.lang AND y.phrase = q),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i : i + n - 1], ' ') AS phrase, max(a) AS top
  FROM (
    SELECT lang, w, a, n, unnest(range(1, m - n + 2)) AS i
    FROM (SELECT *, unnest(range(2, m)) AS n FROM candidates WHERE m > 2))
  GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n,
  CAST(score AS BIGINT) AS score
FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase JOIN totals t ON t.lang = b.lang
WHERE top IS NULL OR 100::HUGEINT * top < 80::HUGEINT * a
QUALIFY rank <= 2000
"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

LICENSES = f"""
WITH given(template, label, body) AS (VALUES {", ".join(f"({i}, '{label}', '{body}')" for i, (label, body) in enumerate(TEMPLATES))}),
cut AS (SELECT template, label, {_WORDS.format("body")} AS w FROM given),
step AS (SELECT max(len(w)) AS s FROM cut),
held AS (
  SELECT template, label, len(list_distinct(w)) AS size, ({CONTAINMENT_PERCENT} * len(list_distinct(w)) + 99) // 100 AS need,
    unnest(list_distinct(w)) AS word FROM cut),
phrases(label, p) AS (VALUES {", ".join(f"('{label}', string_split('{phrase}', ' '))" for phrase, label in PHRASES.items())}),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
places AS (
  SELECT rid, label, i FROM (SELECT rid, w, p, label, unnest(range(0, len(w) - len(p) + 1)) AS i FROM d, phrases)
  WHERE w[i + 1 : i + len(p)] = p),
base AS (
  SELECT rid, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY rid),
tokens AS (SELECT rid, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
blocks AS (
  SELECT DISTINCT rid, block, word FROM (SELECT rid, n, s, word, unnest([i // s - 1, i // s]) AS block FROM tokens, step)
  WHERE block = 0 OR block > 0 AND (block + 1) * s < n),
matches AS (
  SELECT rid, label, count(*)::DOUBLE / size AS c FROM blocks JOIN held USING (word)
  GROUP BY rid, block, template, label, size, need HAVING count(*) >= need),
best AS (SELECT rid, max(c) AS c FROM matches GROUP BY rid),
listed AS (
  SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT rid, label FROM places UNION SELECT rid, label FROM matches) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(base.labels, '') AS base_labels,
  coalesce(listed.labels, '') AS labels, CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN best USING (rid) LEFT JOIN listed USING (rid)
"""


def _lloyd(rounds: int) -> str:
    """Assignments ``a0`` .. and codebooks ``c0`` .. of each round."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, p, any_value(x) AS x, min(CAST(xx + yy - 2 * list_inner_product(x, y) AS BIGINT) * 256 + entry) AS best
  FROM parts JOIN (SELECT p, entry, y, list_inner_product(y, y) AS yy FROM c{r}) USING (p) GROUP BY rid, p)""")
        if r < rounds:
            out.append(f"""
m{r} AS (
  SELECT p, entry, list(floor(total / n) ORDER BY j) AS y FROM (
    SELECT p, best % 256 AS entry, j, sum(v) AS total, count(*) AS n
    FROM (SELECT p, best, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM a{r}) GROUP BY ALL)
  GROUP BY p, entry),
c{r + 1} AS MATERIALIZED (SELECT c.p, c.entry, coalesce(m.y, c.y) AS y FROM c{r} c LEFT JOIN m{r} m USING (p, entry))""")
    return ",".join(out)


CODES = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT rid, p, e[p * (len(e) // 4) + 1 : (p + 1) * (len(e) // 4)] AS x FROM v, range(4) AS four(p)),
parts AS MATERIALIZED (SELECT *, list_inner_product(x, x) AS xx FROM cut),
c0 AS MATERIALIZED (SELECT p, rid - 1 AS entry, x AS y FROM parts WHERE rid <= 256),{_lloyd(4)},
book AS (
  SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, entry, j)) AS h
  FROM (SELECT p, entry, unnest(y) AS v, generate_subscripts(y, 1) AS j FROM c4)),
coded AS (
  SELECT rid, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM a4 GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN coded USING (rid), book
"""
