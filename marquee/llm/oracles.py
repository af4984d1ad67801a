"""DuckDB SQL for the results of the operators that SQL can state."""

QUALITY_RULES = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
grams AS (
  SELECT r, i, words[i : i + 4] AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT w.r, doc_id, lang, source, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words END AS symbols,
         CASE WHEN n_words > 0 THEN 1000 * n_dup_lines // n_words END AS dup_lines,
         CASE WHEN n_words > 0 THEN 100 * word_chars // n_words END AS word_length
  FROM m),
v AS (UNPIVOT (SELECT lang, source, symbols, dup_lines, word_length FROM b WHERE NOT base_failed)
      ON symbols, dup_lines, word_length INTO NAME measure VALUE x),
s AS (SELECT lang, source, measure, CASE WHEN x <= 10000 THEN x
             ELSE floor(10000 * pow(1.02::DOUBLE, floor(ln(x / 10000.0::DOUBLE) / ln(1.02::DOUBLE))))::BIGINT END AS bin FROM v),
levels AS (
  SELECT 2 AS level, lang, source, measure, bin FROM s
  UNION ALL SELECT 1, lang, NULL, measure, bin FROM s
  UNION ALL SELECT 0, NULL, NULL, measure, bin FROM s),
q AS (
  SELECT level, lang, source, measure, count(*) AS total, quantile_disc(bin, 0.25) AS q1, quantile_disc(bin, 0.75) AS q3
  FROM levels GROUP BY level, lang, source, measure),
f AS (
  SELECT level, lang, source, measure, total,
         q1 - greatest(3 * (q3 - q1), CASE measure WHEN 'word_length' THEN 300 ELSE 100 END,
                  CASE WHEN q3 > 10000 THEN ceil(q3 * (1.02::DOUBLE - 1)) + 2 ELSE 0 END) AS low,
         q3 + greatest(3 * (q3 - q1), CASE measure WHEN 'word_length' THEN 300 ELSE 100 END,
                  CASE WHEN q3 > 10000 THEN ceil(q3 * (1.02::DOUBLE - 1)) + 2 ELSE 0 END) AS high
  FROM q),
p AS (
  SELECT level, lang, source, max(total) AS total, max(high) FILTER (measure = 'symbols') AS symbols_high,
         max(high) FILTER (measure = 'dup_lines') AS dup_lines_high,
         max(low) FILTER (measure = 'word_length') AS word_length_low, max(high) FILTER (measure = 'word_length') AS word_length_high
  FROM f GROUP BY level, lang, source),
c AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.r ORDER BY p.level DESC) AS choice, p.* EXCLUDE (lang, source)
  FROM b LEFT JOIN p ON (p.level = 0 OR p.lang = b.lang) AND (p.level < 2 OR p.source = b.source) AND (p.level = 0 OR p.total >= 200))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN base_failed THEN false ELSE symbols <= symbols_high AND dup_lines <= dup_lines_high
            AND word_length BETWEEN word_length_low AND word_length_high END AS kept
FROM c WHERE choice = 1
"""

WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS owner FROM p),
t AS (SELECT *, payload_bytes >= 1000 AND owner IS NOT NULL AND page_id IS DISTINCT FROM owner AS again FROM o)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN owner END AS refers_to
FROM t
"""


def _mixing(max_repeats: float = 2.0, entropy: float = 0.999, block_tokens: int = 4_000_000, seed: str = "mix") -> str:
    """The exponent's sections, one after another, then passes, blocks and slots by plain windows."""
    rounds, low, high = [], "0.0::DOUBLE", "1.0::DOUBLE"
    for k in range(5):
        rounds.append(f"""
g{k} AS (SELECT i, {low} + i * ({high} - {low}) / 32 AS a FROM range(0, 33) t(i)),
e{k} AS (
  SELECT i, a, sum(pow(share, a)) AS z, sum(pow(share, a) * ln(share)) AS q, max(pow(share, a) / tokens) / min(pow(share, a) / tokens) AS repeats, any_value(sources) AS sources
  FROM s, g{k} GROUP BY i, a),
b{k} AS (SELECT min(i) AS i FROM e{k} WHERE repeats <= {max_repeats} AND ln(z) - a * q / z <= {entropy} * ln(sources) + 1e-12),
r{k} AS (SELECT coalesce((SELECT a FROM g{k} WHERE g{k}.i = greatest(b{k}.i - 1, 0)), 1.0) AS low, coalesce((SELECT a FROM g{k} WHERE g{k}.i = b{k}.i), 1.0) AS high FROM b{k})""")
        low, high = f"(SELECT low FROM r{k})", f"(SELECT high FROM r{k})"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
t AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source),
s AS (SELECT source, tokens, tokens / sum(tokens) OVER () AS share, (count(*) OVER ())::DOUBLE AS sources FROM t WHERE tokens > 0),{",".join(rounds)},
p AS (SELECT source, tokens, pow(share, (SELECT high FROM r4)) AS power FROM s),
w AS (
  SELECT source, power / sum(power) OVER () AS weight,
         greatest(tokens, floor(tokens * (power / tokens / min(power / tokens) OVER ()) + 1e-6)::BIGINT) AS budget FROM p),
u AS (
  SELECT t.source, tokens, coalesce(weight, 0.0) AS weight, coalesce(budget, 0) AS budget,
         CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS passes, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM t LEFT JOIN w USING (source)),
n AS (SELECT greatest(1, ceil(sum(budget) / {block_tokens}))::BIGINT AS blocks FROM u),
k AS (SELECT blocks, (SELECT min(d) FROM range(2, 16) t(d) WHERE pow(16, d) >= 4 * blocks) AS digits FROM n),
l AS (
  SELECT r, coalesce(sum(n_tokens) OVER (PARTITION BY source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) < rest AS more
  FROM (SELECT d.*, rest, md5(concat_ws('|', '{seed}', passes, doc_id)) AS hash FROM d JOIN u USING (source))),
x AS (
  SELECT d.*, tokens, weight, budget, e AS epoch, md5(concat_ws('|', '{seed}', e, doc_id)) AS hash
  FROM d JOIN u USING (source) JOIN l USING (r), LATERAL (SELECT unnest(range(0, passes + CASE WHEN more THEN 1 ELSE 0 END)) AS e)),
q AS (
  SELECT source, epoch, left(hash, digits) AS bucket, any_value(tokens) AS tokens, any_value(budget) AS budget, any_value(blocks) AS blocks, sum(n_tokens) AS n
  FROM x, k GROUP BY source, epoch, left(hash, digits)),
z AS (
  SELECT source, epoch, bucket, CASE WHEN budget > 0 THEN
         least(blocks - 1, floor((epoch * tokens + sum(n) OVER (PARTITION BY source, epoch ORDER BY bucket) - n)::DOUBLE * blocks / budget))::BIGINT
         ELSE ('0x' || bucket)::BIGINT * blocks // pow(16, length(bucket))::BIGINT END AS block FROM q)
SELECT doc_id, x.source, x.epoch, n_tokens, round(weight, 9) AS weight, block, row_number() OVER (PARTITION BY block ORDER BY hash, x.source, x.epoch, n_tokens) - 1 AS slot
FROM x, k, z WHERE z.source = x.source AND z.epoch = x.epoch AND z.bucket = left(x.hash, digits)
"""


MIXING = _mixing()


def _centroids(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    """Rounds one after another, each comparing every vector with every centroid."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
d{i} AS (
  SELECT r, c, list_sum(list_transform(range(1, {dims + 1}), lambda i: (p.v[i] - c{i}.v[i]) * (p.v[i] - c{i}.v[i])))::BIGINT AS d FROM p, c{i}),
a{i} AS (SELECT r, first(c ORDER BY d, c) AS c, min(d) AS d FROM d{i} GROUP BY r)""")
        if i < rounds:
            steps.append(f"""
s{i} AS (SELECT a{i}.c, i, sum(p.v[i])::BIGINT AS s, count(*) AS n FROM a{i} JOIN p USING (r), range(1, {dims + 1}) t(i) GROUP BY a{i}.c, i),
m{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{i} GROUP BY c),
c{i + 1} AS (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    return f"""
WITH p AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = {dims}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), v) - 1 AS c, v FROM p QUALIFY c < {k}),{",".join(steps)}
SELECT vec_id, a{rounds}.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a{rounds}.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = a{rounds}.c JOIN (SELECT r, vec_id FROM p) USING (r)
"""


CENTROIDS = _centroids()

RESAMPLING = r"""
WITH crc AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(0, 256) b(i))),
w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
f AS MATERIALIZED (SELECT r, unnest(words) AS word FROM w),
g AS MATERIALIZED (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
x AS (SELECT word, hex(encode(word)) AS digits FROM (SELECT word FROM f UNION SELECT word FROM g)),
h AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(digits) // 2), lambda k: ('0x' || digits[2 * k + 1 : 2 * k + 2])::BIGINT)),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM x, crc),
s AS (SELECT bucket, count(*) AS s FROM f JOIN h USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM g JOIN h USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (sum(coalesce(s, 0)) OVER () + 10000)::DOUBLE)
                                 / ((coalesce(s, 0) + 1)::DOUBLE * (sum(coalesce(t, 0)) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM f JOIN h USING (word) JOIN gains USING (bucket) GROUP BY r),
scores AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256(concat('2024:', doc_id)), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN weights USING (r)),
ranks AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS drawn FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank FROM scores LEFT JOIN ranks USING (r)
"""
