"""DuckDB SQL with the rows of the queries that SQL can express."""

OP1 = r"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) = 0 THEN []
         WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
),
e AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * common >= 75 * (x.n + y.n - common)
),
r AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION
  SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d
LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""

OP2 = r"""
WITH
words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
),
items AS (
  SELECT DISTINCT id AS item_id, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM (SELECT id, w, least(13, len(w)) AS size FROM words WHERE kind = 'b' AND len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM items),
places AS (
  SELECT id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM words, sizes WHERE kind = 'd' AND len(w) >= size
),
hits AS (
  SELECT p.id, p.i, p.size, x.item_id FROM places p JOIN items x ON x.size = p.size AND x.phrase = array_to_string(p.w[p.i:p.i + p.size - 1], ' ')
),
hit_words AS (
  SELECT id, count(DISTINCT word) AS n_hit FROM (SELECT id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY id
),
hit_items AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY id
)
SELECT d.id AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
  sha256(coalesce(n.joined, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM words d LEFT JOIN hit_words h ON h.id = d.id LEFT JOIN hit_items n ON n.id = d.id
WHERE d.kind = 'd'
"""

_BASE = r"""
t AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text FROM documents),
p(kind, name, pattern) AS (VALUES
  (0, 'assign', '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
  (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'), (3, 'live', '[A-Za-z0-9_-]{20,}')
),
found AS (
  SELECT doc_id, owner, kind, name, regexp_extract_all(text, pattern) AS hit, string_split_regex(text, pattern) AS gap FROM t, p
),
spans AS (
  SELECT doc_id, owner, kind, name, hit[i] AS hit, list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hit[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(hit) + 1)) AS i FROM found)
),
valued AS (
  SELECT doc_id, owner, kind, name, CAST(start AS BIGINT) AS start, CAST(start + length(hit) AS BIGINT) AS stop,
    CASE WHEN kind = 0 THEN regexp_extract(hit, '(?i)^(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?(.*)$', 1) ELSE hit END AS v
  FROM spans
),
base AS (
  SELECT * FROM valued WHERE (kind = 0 AND length(v) >= 6) OR (kind = 1 AND length(v) >= 20) OR (kind = 2 AND length(v) >= 24)
),
added AS (
  SELECT * FROM valued l WHERE kind = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = l.doc_id AND b.start < l.stop AND l.start < b.stop)
),
owned AS (
  SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT doc_id) AS repositories, count(DISTINCT owner) >= 3 OR count(DISTINCT doc_id) >= 20 AS wide FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY v
),
every AS (
  SELECT x.*, o.wide, o.owners, o.repositories FROM (SELECT * FROM base UNION ALL SELECT * FROM added) x JOIN owned o ON o.v = x.v
)
"""

OP4 = "WITH " + _BASE + r"""
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b.joined, '')) AS base_sha256, coalesce(b.spans, '') AS spans, coalesce(b.n_live, 0) AS n_live, coalesce(b.n_wide, 0) AS n_wide,
  coalesce(most_owners, 0) AS most_owners, coalesce(most_repositories, 0) AS most_repositories
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3) AS joined,
    string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3 OR NOT wide) AS spans,
    count(DISTINCT v) FILTER (NOT wide) AS n_live, count(DISTINCT v) FILTER (wide) AS n_wide,
    max(owners) AS most_owners, max(repositories) AS most_repositories
  FROM every GROUP BY doc_id
) b ON b.doc_id = d.doc_id
"""

OP6 = r"""
WITH
rows_ AS (
  SELECT doc_id, 'd' || CAST(ascii(substr(md5(coalesce(source, '')), 1, 1)) % 3 AS VARCHAR) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
),
leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens FROM rows_ GROUP BY ALL
),
tree AS (
  SELECT 1 AS level, '' AS parent, domain AS name, domain AS path, sum(tokens) AS tokens, CASE domain WHEN 'd0' THEN 5 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END AS weight FROM leaves GROUP BY domain
  UNION ALL
  SELECT 2, domain, lang, domain || '/' || lang, sum(tokens), CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 3 WHEN 'es' THEN 2 ELSE 1 END FROM leaves GROUP BY domain, lang
  UNION ALL
  SELECT 3, domain || '/' || lang, source, domain || '/' || lang || '/' || source, tokens, 1 FROM leaves
),
needs AS (
  SELECT *, 2 * tokens AS capacity FROM tree
),
ordered AS (
  SELECT *, sum(capacity) OVER (PARTITION BY level, parent ORDER BY CAST(capacity AS DOUBLE) / weight, name) - capacity AS before,
    sum(weight) OVER (PARTITION BY level, parent) - sum(weight) OVER (PARTITION BY level, parent ORDER BY CAST(capacity AS DOUBLE) / weight, name) + weight AS behind,
    sum(capacity) OVER (PARTITION BY level, parent) AS can
  FROM needs
),
@LEVELS@
budgets AS (
  SELECT l.domain, l.lang, l.source, CAST(l.tokens AS BIGINT) AS tokens, CAST(b.share AS BIGINT) AS budget, CAST(b.share // l.tokens AS INTEGER) AS whole, CAST(b.share % l.tokens AS BIGINT) AS rest
  FROM leaves l JOIN share3 b ON b.path = l.domain || '/' || l.lang || '/' || l.source WHERE l.tokens > 0 AND b.share > 0
),
chosen AS (
  SELECT r.*, b.budget, b.whole, b.rest FROM rows_ r JOIN budgets b USING (domain, lang, source) WHERE r.n_tokens > 0
),
part AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('7:' || whole || ':' || doc_id) ROWS UNBOUNDED PRECEDING) AS upto FROM chosen
)
SELECT doc_id, domain, lang, source, CAST(unnest(range(0, whole)) AS INTEGER) AS epoch, n_tokens, budget FROM chosen
UNION ALL
SELECT doc_id, domain, lang, source, whole, n_tokens, budget FROM part WHERE upto <= rest
"""

_LEVEL = """
given{n} AS (
  SELECT o.*, least({budget}, o.can) AS budget FROM ordered o {join} WHERE o.level = {n}
),
full{n} AS (
  SELECT *, capacity * behind <= (budget - before) * weight AS is_full FROM given{n}
),
rest{n} AS (
  SELECT *, budget - coalesce(sum(capacity) FILTER (is_full) OVER (PARTITION BY parent), 0) AS rest, CASE WHEN is_full THEN 0 ELSE weight END AS w FROM full{n}
),
upto{n} AS (
  SELECT *, CAST(sum(w) OVER (PARTITION BY parent ORDER BY name) AS HUGEINT) AS upto, CAST(sum(w) OVER (PARTITION BY parent) AS HUGEINT) AS whole_weight FROM rest{n}
),
share{n} AS (
  SELECT path, CASE WHEN is_full THEN capacity ELSE (rest * upto) // whole_weight - (rest * (upto - w)) // whole_weight END AS share FROM upto{n}
),"""

OP6 = OP6.replace("@LEVELS@", "".join(
    _LEVEL.format(n=n, budget="(SELECT 3 * sum(tokens) // 5 FROM leaves)" if n == 1 else "b.share", join="" if n == 1 else f"JOIN share{n - 1} b ON b.path = o.parent")
    for n in (1, 2, 3)
))

OP8 = r"""
WITH
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS nth FROM places),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM ranked WHERE nth > 1),
every AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS text, count(*) AS n FROM every e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i WHERE g.i IS NULL GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

OP12 = r"""
WITH
p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM p, range(1, 6) AS r(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, j, x.f AS l, y.f AS r, n.n, (CAST(1000 AS HUGEINT) * c.a * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM c JOIN range(1, 5) AS q(j) ON j < c.k
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:c.k], ' ')
  JOIN n ON n.lang = c.lang
),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
held AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN c d ON d.lang = c.lang AND d.k > c.k AND d.a >= c.a AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')
),
ranked AS (
  SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, c.a DESC, c.phrase) AS rank, c.phrase, c.a, l, r, x.n, score
  FROM c JOIN weakest x ON x.lang = c.lang AND x.phrase = c.phrase
  WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = c.lang AND h.phrase = c.phrase)
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

OP13 = r"""
WITH RECURSIVE
d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
    (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN d.doc_id > first THEN 16 ELSE 0 END) AS mask
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id
),
m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM f GROUP BY part, mask),
o AS (
  SELECT '' AS filter_order, 0 AS step
  UNION ALL
  SELECT filter_order || substr('ABCDE', i, 1), step + 1 FROM o, range(1, 6) AS r(i)
  WHERE step < 5 AND NOT contains(filter_order, substr('ABCDE', i, 1))
),
s AS (
  SELECT filter_order, i AS step, 1 << (strpos('ABCDE', substr(filter_order, i, 1)) - 1) AS own,
    list_sum(list_transform(range(1, i + 1), lambda k: 1 << (strpos('ABCDE', substr(filter_order, k, 1)) - 1))) AS upto
  FROM o, range(1, 6) AS r(i) WHERE o.step = 5
),
x AS (
  SELECT part, filter_order, s.step, own,
    sum(CASE WHEN mask & upto = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & upto = own THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own = own AND mask & upto <> own THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & upto = own THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & upto = own THEN bad ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY part, filter_order, s.step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM x
"""

ORACLE: dict[str, str] = {
    "op1_near_dedup": OP1, "op2_decontaminate": OP2, "op4_secrets": OP4, "op6_mix": OP6, "op8_substring_dedup": OP8,
    "op12_collocations": OP12, "op13_filter_audit": OP13,
}
