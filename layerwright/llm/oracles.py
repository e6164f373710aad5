"""DuckDB SQL for the queries that SQL can express: the plain definition, without the operators' methods."""

from layerwright.llm.license_scan import AGREE, LOOKUPS, PHRASES, TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORD = r"[^\x20\x09-\x0D]+"

# Smallest reachable id over links(a, b) in both directions, by repeated minima.
_COMPONENTS = """
  reach(id, root) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id WHERE r.root < l.b
  ),
  roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  ok AS (
    SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
    WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
  ),
  links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM ok p JOIN ok q ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
    WHERE list_dot_product(p.e, q.e) / (p.norm * q.norm) >= 0.95
  ),
  nodes AS (SELECT vec_id AS id FROM v),
  {_COMPONENTS}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, root AS component_id, vec_id = root AS kept
FROM v JOIN roots ON id = vec_id
"""

_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_BENCH_WORD}') AS w FROM documents),
  i AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_BENCH_WORD}') AS w FROM benchmark),
  iw AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0)
  ),
  sizes AS (SELECT DISTINCT size FROM iw),
  dw AS (
    SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS gram
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)
  ),
  hits AS (SELECT doc_id, dw.size, k, item_id FROM dw JOIN iw ON dw.size = iw.size AND dw.gram = iw.gram),
  covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM hits) GROUP BY doc_id),
  found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACE_WORD}') AS w FROM documents),
  s AS (
    SELECT DISTINCT doc_id, hash(array_to_string(w[k : k + least(len(w), 5) - 1], ' ')) AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS k FROM d WHERE len(w) > 0)
  ),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  common AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.g = q.g AND p.doc_id < q.doc_id GROUP BY ALL),
  pairs AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
  links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
  nodes AS (SELECT doc_id AS id FROM documents),
  {_COMPONENTS}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, root AS component_id, d.doc_id = root AS kept
FROM d JOIN roots ON id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE_WORD}') AS w FROM documents),
  wins AS (
    SELECT doc_id, k, array_to_string(w[k : k + 19], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM d WHERE len(w) >= 20)
  ),
  first AS (SELECT hash(g) AS h, g, min((doc_id, k)) AS f FROM wins GROUP BY g),
  repeats AS (SELECT doc_id, k FROM wins JOIN first ON hash(wins.g) = h AND wins.g = first.g WHERE (doc_id, k) > f),
  gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS place FROM repeats),
  per_doc AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
  kept AS (
    SELECT d.doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
           CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END AS stay
    FROM d LEFT JOIN per_doc USING (doc_id)
  )
SELECT doc_id, n_words, n_removed, sha256(array_to_string(stay, ' ')) AS kept_sha256 FROM kept
"""

_STRENGTH = """
  SELECT rate, CASE WHEN n IS NULL OR n = 0 OR g < 2 OR n = g THEN 10.0
    WHEN share > 0 THEN least(1000.0, greatest(1.0, 1 / share - 1)) ELSE 1000.0 END AS k
  FROM (SELECT *, CASE WHEN msb + (size - 1) * msw > 0 THEN (msb - msw) / (msb + (size - 1) * msw) ELSE 0.0 END AS share
  FROM (SELECT *, (between_ - n * rate * rate) / (g - 1) AS msb, within_ / (n - g) AS msw, (n - nn / n) / (g - 1) AS size
  FROM (SELECT *, CASE WHEN n > 0 THEN bad / n ELSE 0.0 END AS rate
  FROM (SELECT count(*) AS g, sum(n) AS n, sum(bad) AS bad, sum(n * n) AS nn, sum(bad * bad / n) AS between_, sum(bad * (n - bad) / n) AS within_
        FROM {0} WHERE n > 0))))
"""

URLS = f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
  parsed AS (
    SELECT page_id, translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
  ),
  known AS (SELECT doc_id, CAST(coalesce(quality = 0 OR toxic = 1) AS INTEGER) AS bad FROM labels),
  h AS (
    SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, string_split(host, '.') AS l
    FROM parsed LEFT JOIN known ON doc_id = page_id GROUP BY host
  ),
  hosts AS (SELECT host, n, bad, array_to_string(l[greatest(len(l) - 1, 1) : len(l)], '.') AS domain, l[-1] AS suffix FROM h),
  domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
  suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
  ks AS ({_STRENGTH.format("suffixes")}), kd AS ({_STRENGTH.format("domains")}), kh AS ({_STRENGTH.format("hosts")}),
  s AS (SELECT suffix, (bad + k * rate) / (n + k) AS above FROM suffixes, ks),
  d AS (SELECT domain, (bad + k * above) / (n + k) AS prior FROM domains JOIN s USING (suffix), kd),
  ab AS (SELECT host, bad + k * prior AS a, n - bad + k * (1 - prior) AS b FROM hosts JOIN d USING (domain), kh),
  judged AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.3 AS blocked FROM ab),
  rules(verdict, rule) AS (VALUES ('block', 'net/'), ('allow', 'example.net/en/'), ('block', 'example.com/de/'), ('allow', 'org/fr/')),
  parts AS (SELECT verdict, rule, split_part(rule, '/', 1) AS owner, substr(rule, instr(rule, '/')) AS prefix FROM rules),
  fits AS (
    SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
    FROM parsed JOIN parts ON (host = owner OR ends_with(host, '.' || owner)) AND starts_with(path, prefix) GROUP BY page_id
  )
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p JOIN judged USING (host) LEFT JOIN fits f ON f.page_id = p.page_id
"""

MIX = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_SPACE_WORD}')) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0') AS key, md5(text) AS text_id FROM documents
  ),
  src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
  w AS (SELECT *, CAST([3, 1, 2][place % 3 + 1] AS HUGEINT) AS weight, 2 * CAST(source_size AS HUGEINT) AS cap FROM src),
  run AS (
    SELECT *, sum(source_size) OVER () * 150 AS wanted,
      coalesce(sum(cap) OVER (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
      sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_
    FROM w
  ),
  marked AS (SELECT *, cap * left_ * 100 <= weight * (wanted - 100 * filled) AS full_ FROM run),
  targets AS (
    SELECT source, source_size, CASE WHEN full_ THEN CAST(cap AS DOUBLE)
      ELSE CAST(weight * (wanted - 100 * coalesce(sum(cap) FILTER (WHERE full_) OVER (), 0)) AS DOUBLE)
           / (CAST(sum(weight) FILTER (WHERE NOT full_) OVER () AS DOUBLE) * 100) END AS target FROM marked
  ),
  quotas AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS words,
           (CAST(floor(target + 0.5) AS BIGINT) + 4095) // 4096 AS quota FROM targets
  ),
  shares AS (SELECT *, coalesce(sum(quota) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS edge FROM quotas),
  total AS (SELECT coalesce(sum(quota), 0) AS n, length(bin(CAST(greatest(coalesce(sum(quota), 0) - 1, 0) AS BIGINT))) AS bits FROM quotas),
  points AS (
    SELECT k, CAST(list_sum(list_transform(range(bits), lambda i: ((k >> i) & 1) << (bits - 1 - i))) AS BIGINT) AS point
    FROM (SELECT unnest(range(1 << bits)) AS k, bits FROM total)
  ),
  slots AS (
    SELECT place, k, row_number() OVER (PARTITION BY place ORDER BY k) - 1 AS block FROM points JOIN shares ON point >= edge AND point < edge + quota
  ),
  line AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, text_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
           row_number() OVER () AS r FROM sized
  ),
  laps AS (
    SELECT r, size, place, words, start + lap * source_size AS a, start + lap * source_size + size AS z
    FROM line JOIN shares ON line.source IS NOT DISTINCT FROM shares.source, (SELECT unnest([0, 1]) AS lap) WHERE size > 0
  ),
  pieces AS (
    SELECT r, place, block, greatest(least(z, (block + 1) * 4096, words) - greatest(a, block * 4096), 0) AS part
    FROM (SELECT *, unnest(range(CAST(a // 4096 AS BIGINT), CAST((z - 1) // 4096 + 1 AS BIGINT))) AS block FROM laps)
  ),
  joined AS (SELECT r, sum(part) AS taken, min(k) AS first_slot, count(*) AS n_slots FROM pieces JOIN slots USING (place, block) WHERE part > 0 GROUP BY r)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, first_slot, coalesce(n_slots, 0) AS n_slots
FROM line JOIN shares ON line.source IS NOT DISTINCT FROM shares.source LEFT JOIN joined USING (r)
"""

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
  g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest, n) ELSE page_id END AS last FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM g
"""

HARD_NEGATIVES = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
  ),
  s AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS alike, CAST(list_dot_product(a.c, r.c) AS BIGINT) AS score
    FROM e a JOIN e r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
  ),
  p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
  )
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def _licenses() -> str:
    words = [(n, w, i) for n, t in enumerate(TEMPLATES) for i, w in enumerate(t.words)]
    keys = [(n, t.key_at + i, t.key.count(" ") + 1) for n, t in enumerate(TEMPLATES) for i in range(t.key.count(" ") + 1)]
    values = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    grams = {1: "word", 2: "word || ' ' || w2", 3: "word || ' ' || w2 || ' ' || w3", 4: "word || ' ' || w2 || ' ' || w3 || ' ' || w4"}
    phrase = " UNION ALL ".join(f"SELECT r, spot, '{label}' AS label FROM near WHERE {grams[p.count(' ') + 1]} = '{p}'" for p, label in PHRASES.items())
    return f"""
WITH names(template, label) AS (VALUES {values([(n, t.label) for n, t in enumerate(TEMPLATES)])}),
  posting(template, word, place) AS (VALUES {values(words)}),
  key_place(template, place, size) AS (VALUES {values(keys)}),
  sizes AS (SELECT template, count(DISTINCT word) AS n FROM posting GROUP BY template),
  d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_BENCH_WORD}') AS w FROM documents),
  x AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS spot FROM d),
  near AS (
    SELECT *, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4 FROM x WINDOW o AS (PARTITION BY r ORDER BY spot)
  ),
  base AS ({phrase}),
  bases AS (SELECT r, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word FROM base GROUP BY r),
  weights AS (
    SELECT word, length(bin((SELECT count(*) FROM d) // count(DISTINCT r))) AS weight FROM x WHERE word IN (SELECT word FROM posting) GROUP BY word
  ),
  full_weight AS (SELECT template, sum(coalesce(weight, 0)) AS all_weight FROM posting LEFT JOIN weights USING (word) GROUP BY template),
  few AS (
    SELECT template, word FROM (SELECT DISTINCT template, word, weight FROM posting JOIN weights USING (word))
    QUALIFY row_number() OVER (PARTITION BY template ORDER BY weight DESC, word) <= {LOOKUPS}
  ),
  in_play AS (
    SELECT r, template FROM (SELECT DISTINCT r, template, word FROM x JOIN few USING (word)) JOIN sizes USING (template)
    GROUP BY r, template, n HAVING count(*) >= least({AGREE}, n)
  ),
  starts AS (
    SELECT x.r, p.template, spot - place AS start, count(*) AS agreeing
    FROM x JOIN few USING (word) JOIN in_play i ON i.r = x.r AND i.template = few.template JOIN posting p ON p.template = few.template AND p.word = few.word GROUP BY ALL
  ),
  keyed AS (
    SELECT s.r, s.template, s.start FROM starts s JOIN sizes z USING (template) JOIN key_place k ON k.template = s.template
    JOIN posting p ON p.template = s.template AND p.place = k.place JOIN x ON x.r = s.r AND x.spot = s.start + k.place AND x.word = p.word
    WHERE agreeing >= least({AGREE}, z.n) GROUP BY ALL HAVING count(*) = any_value(k.size)
  ),
  found AS (
    SELECT k.r, k.template, sum(weight) / any_value(all_weight) AS score
    FROM keyed k JOIN posting p ON p.template = k.template JOIN x ON x.r = k.r AND x.spot = k.start + p.place AND x.word = p.word
    JOIN weights w ON w.word = p.word JOIN full_weight f ON f.template = k.template GROUP BY k.r, k.template, k.start
  ),
  best AS (SELECT r, max(score) AS score FROM found GROUP BY r),
  marks AS (SELECT r, label, true AS plain FROM base UNION SELECT r, label, false FROM found JOIN names USING (template)),
  labelled AS (
    SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE plain) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM marks GROUP BY r
  )
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN bases USING (r) LEFT JOIN labelled USING (r) LEFT JOIN best USING (r)
"""


LICENSES = _licenses()
