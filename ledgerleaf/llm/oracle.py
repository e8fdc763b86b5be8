"""The queries of the corpus operators as plain SQL, where SQL can express them.

There is none for encoding (1), alignments (3), diagonal votes (5) and sliding
entropy (10); tests compare these with brute force.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_lines"] = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
sets AS (
  SELECT doc_id, line_no,
         list_distinct(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+')) AS words
  FROM lines),
judged AS (
  SELECT row_number() OVER (ORDER BY doc_id, line_no) AS id, *, len(words) AS n
  FROM sets WHERE len(words) >= 1),
tokens AS (SELECT id, n, unnest(words) AS word FROM judged),
counted AS (SELECT *, count(*) OVER (PARTITION BY word) AS c FROM tokens),
placed AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c, word) AS place FROM counted),
prefix AS (SELECT id, word FROM placed WHERE place <= n - (80 * n + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT a.id AS x, b.id AS y
  FROM prefix a JOIN prefix b ON a.word = b.word AND a.id < b.id),
matched AS (
  SELECT y, len(list_intersect(a.words, b.words)) AS shared, a.n + b.n AS total
  FROM pairs JOIN judged a ON a.id = x JOIN judged b ON b.id = y)
SELECT doc_id, line_no FROM judged
WHERE id IN (SELECT y FROM matched WHERE 100 * shared >= 80 * (total - shared))
"""

ORACLE["op4_urls"] = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parsed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT page_id, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC) AS rank
  FROM parsed p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
judged AS (
  SELECT p.page_id, p.host, p.path, f.rule, f.verdict
  FROM parsed p LEFT JOIN fits f ON f.page_id = p.page_id AND f.rank = 1),
parts AS (
  SELECT *, string_split(host, '.') AS names FROM (SELECT DISTINCT host FROM judged)),
suffixed AS (
  SELECT host, names, CASE WHEN array_to_string(names[-2:], '.') IN (
      'co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'co.jp',
      'or.jp', 'ac.jp', 'com.br', 'com.cn', 'com.mx', 'com.ar', 'co.in', 'co.kr', 'co.za')
    THEN 2 ELSE 1 END AS size FROM parts),
hosts AS (
  SELECT h.host, array_to_string(h.names[-h.size:], '.') AS suffix,
    array_to_string(h.names[-(h.size + 1):], '.') AS domain,
    count(j.verdict)::DOUBLE AS n,
    coalesce(sum((j.verdict = 'block')::INT), 0)::DOUBLE AS bad
  FROM suffixed h JOIN judged j ON j.host = h.host GROUP BY ALL),
everything AS (SELECT sum(bad) AS bad, sum(n) AS n FROM hosts),
suffix_units AS (
  SELECT s.*, (e.bad - s.bad + 1) / (e.n - s.n + 2) AS prior
  FROM (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix) s, everything e),
suffix_share AS (
  SELECT sum((bad - n * prior) * (bad - n * prior) / n - prior * (1 - prior)) AS above,
         sum(prior * (1 - prior) * (n - 1)) AS room,
         greatest(1.0, least(10000.0, sum(n))) AS most FROM suffix_units WHERE n > 0),
suffix_strength AS (
  SELECT CASE WHEN room > 0 AND above / room > 0
    THEN least(greatest(1 / (above / room) - 1, 1.0), most)
    WHEN room > 0 THEN most ELSE 1.0 END AS s
  FROM suffix_share),
domain_units AS (
  SELECT d.*, (m.bad - d.bad + s * m.prior) / (m.n - d.n + s) AS prior
  FROM (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix) d
  JOIN suffix_units m ON m.suffix = d.suffix, suffix_strength),
domain_share AS (
  SELECT sum((bad - n * prior) * (bad - n * prior) / n - prior * (1 - prior)) AS above,
         sum(prior * (1 - prior) * (n - 1)) AS room,
         greatest(1.0, least(10000.0, sum(n))) AS most FROM domain_units WHERE n > 0),
domain_strength AS (
  SELECT CASE WHEN room > 0 AND above / room > 0
    THEN least(greatest(1 / (above / room) - 1, 1.0), most)
    WHEN room > 0 THEN most ELSE 1.0 END AS s
  FROM domain_share),
host_units AS (
  SELECT h.host, h.n, h.bad, (m.bad - h.bad + s * m.prior) / (m.n - h.n + s) AS prior
  FROM hosts h JOIN domain_units m ON m.domain = h.domain AND m.suffix = h.suffix, domain_strength),
host_share AS (
  SELECT sum((bad - n * prior) * (bad - n * prior) / n - prior * (1 - prior)) AS above,
         sum(prior * (1 - prior) * (n - 1)) AS room,
         greatest(1.0, least(10000.0, sum(n))) AS most FROM host_units WHERE n > 0),
host_strength AS (
  SELECT CASE WHEN room > 0 AND above / room > 0
    THEN least(greatest(1 / (above / room) - 1, 1.0), most)
    WHEN room > 0 THEN most ELSE 1.0 END AS s
  FROM host_share),
host_mean AS (SELECT host, n + s AS weight, (bad + s * prior) / (n + s) AS mean FROM host_units, host_strength),
low AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) AS low FROM host_mean)
SELECT j.page_id, j.host, j.path, j.rule,
  coalesce(j.verdict, CASE WHEN l.low > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j JOIN low l ON l.host = j.host
"""

ORACLE["op6_warc"] = r"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM payloads),
bits AS (SELECT *, from_hex(sha1(html))::BIT::VARCHAR AS bits FROM firsts)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
      + 16 * substr(bits, 5 * i::INT + 1, 1)::INT + 8 * substr(bits, 5 * i::INT + 2, 1)::INT
      + 4 * substr(bits, 5 * i::INT + 3, 1)::INT + 2 * substr(bits, 5 * i::INT + 4, 1)::INT
      + substr(bits, 5 * i::INT + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM bits
"""

ORACLE["op7_quality"] = r"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
twins AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM grams)
  WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twins) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (
  SELECT s.doc_id, s.source, len(s.words) AS n_words,
    length(array_to_string(s.words, '')) AS word_chars,
    length(s.text) - length(regexp_replace(s.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(l.n_dup, 0) AS n_dup_lines, coalesce(l.n_lines, 0) AS n_lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
failed AS (
  SELECT *, base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS any_failed FROM based),
hosts AS (
  SELECT source, count(*)::DOUBLE AS n, sum(any_failed::INT)::DOUBLE AS f FROM failed GROUP BY source),
total AS (
  SELECT sum(f) / sum(n) AS mean, sum(n) AS docs, count(*)::DOUBLE AS hosts, sum(f * f / n) AS squares
  FROM hosts),
spread AS (
  SELECT mean, mean * (1 - mean) AS chance,
    (squares - docs * mean * mean - (hosts - 1) * mean * (1 - mean))
      / greatest(docs - (hosts - 1), 1.0) AS variance FROM total),
prior AS (
  SELECT mean, CASE WHEN variance > 0
    THEN least(greatest(chance / variance - 1, 1.0), 10000.0) ELSE 10000.0 END AS strength FROM spread),
rates AS (
  SELECT source, n + strength AS size, (f + mean * strength) / (n + strength) AS rate FROM hosts, prior),
verdicts AS (
  SELECT source, CASE
    WHEN rate - 2.0 * sqrt(rate * (1 - rate) / (size + 1)) > 0.5 THEN 'rejected'
    WHEN rate + 2.0 * sqrt(rate * (1 - rate) / (size + 1)) <= 0.01 THEN 'trusted'
    ELSE 'watched' END AS host_verdict FROM rates)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR host_verdict = 'rejected' OR (host_verdict = 'watched' AND any_failed)) AS kept,
  host_verdict
FROM failed f JOIN verdicts v ON f.source IS NOT DISTINCT FROM v.source
"""

ORACLE["op8_near_duplicates"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i
        FROM split WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other),
named AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT n.doc_id, coalesce(s.n, 0) AS n_shingles, n.component_id, n.doc_id = n.component_id AS kept
FROM named n LEFT JOIN sizes s USING (doc_id)
"""

ORACLE["op9_substrings"] = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM split)),
later AS (
  SELECT doc_id, i FROM (
    SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS rank FROM windows)
  WHERE rank > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, generate_subscripts(words, 1) AS p, unnest(words) AS word FROM split),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.p) AS text, count(*) AS n
  FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p GROUP BY w.doc_id)
SELECT s.doc_id, len(s.words) AS n_words, len(s.words) - coalesce(k.n, 0) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)
"""

ORACLE["op13_resampling"] = r"""
WITH RECURSIVE steps(b, i, c) AS (
  SELECT range::BIGINT, 0, range::BIGINT FROM range(256)
  UNION ALL
  SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM steps WHERE i < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM steps WHERE i = 8),
split AS MATERIALIZED (
  SELECT own, id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT TRUE AS own, doc_id AS id, text FROM documents
        UNION ALL SELECT FALSE, item_id, text FROM benchmark)),
features AS MATERIALIZED (
  SELECT own, id, unnest(words) AS feature FROM split
  UNION ALL
  SELECT own, id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
  FROM split),
hashed AS MATERIALIZED (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, bytes), lambda s, x:
    xor(s >> 8, t[xor(s & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT feature, list_transform(range(octet_length(encode(feature))), lambda i:
          ('0x' || substr(hex(encode(feature)), 2 * i::INT + 1, 2))::BIGINT) AS bytes
        FROM (SELECT DISTINCT feature FROM features)), crc),
placed AS MATERIALIZED (SELECT own, id, bucket FROM features JOIN hashed USING (feature)),
counts AS (
  SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t
  FROM placed GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln(((c.t + 1)::DOUBLE * (a.s + 10000))
    / ((c.s + 1)::DOUBLE * (a.t + 10000))))::BIGINT AS gain
  FROM counts c, totals a),
weights AS (
  SELECT id, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM placed JOIN gains USING (bucket) WHERE own GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(words) AS n_words, greatest(2 * len(words) - 1, 0) AS n_features,
    coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (id) WHERE own),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

ORACLE["op11_phrases"] = r"""
WITH split AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM split),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
places AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p
  FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k)),
counted AS (
  SELECT lang, k, p, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, p, f, len(p) AS size, unnest(range(1, len(p))) AS k FROM counted WHERE k > 1),
scored AS (
  SELECT c.lang, c.p, c.f AS a, a.f AS l, b.f AS r, c.k,
    (2000000::HUGEINT * c.f) // (a.f + b.f) AS score
  FROM cuts c JOIN counted a ON a.lang = c.lang AND a.p = c.p[:c.k]
  JOIN counted b ON b.lang = c.lang AND b.p = c.p[c.k + 1:]),
least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, f, unnest(flatten(list_transform(range(2, k), lambda n:
    list_transform(range(1, k - n + 2), lambda i: p[i:i + n - 1])))) AS p
  FROM counted WHERE k > 2),
longest AS (SELECT lang, p, max(f) AS f FROM inner_parts GROUP BY lang, p),
kept AS (
  SELECT s.* FROM least s LEFT JOIN longest g ON g.lang = s.lang AND g.p = s.p
  WHERE coalesce(100 * g.f, 0) < 80 * s.a),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score::BIGINT AS score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
