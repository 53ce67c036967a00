"""DuckDB forms of the queries that SQL can express. Meant for small tables."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

LINE_DEDUP = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, i, parts[i] AS line, {LOWER.format(f"trim(parts[i], {BLANKS})")} AS key
  FROM split, unnest(range(1, len(parts) + 1)) AS t(i)
), common AS (
  SELECT key, max(doc_id) AS last_doc
  FROM (SELECT DISTINCT doc_id, key FROM lines WHERE length(key) >= 20)
  GROUP BY key HAVING count(*) >= 3
), marked AS (
  SELECT doc_id, i, line, common.key IS NOT NULL AND doc_id <> last_doc AS lost
  FROM lines LEFT JOIN common ON lines.key = common.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: One round of CRC-32 for each byte, by a table of 256 entries built from the polynomial.
SHARDING = """
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, _: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS entries
), rows AS (
  SELECT doc_id, coalesce(text, '') AS body FROM documents
), keyed AS (
  SELECT doc_id, octet_length(encode(body)) + 16 AS size,
    CAST('0x' || substr(md5(body), 1, 15) AS BIGINT) AS h,
    list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda b: CAST('0x' || b AS BIGINT)) AS bytes
  FROM rows
), summed AS (
  SELECT doc_id, size, h, xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), bytes),
      lambda c, b: xor(c >> 8, entries[1 + CAST(xor(c, b) & 255 AS BIGINT)]))) AS text_crc32,
    sum(size) OVER (ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - size AS below,
    sum(size) OVER () AS total
  FROM keyed, crc
), placed AS (
  SELECT *, CAST(below * 40 // total AS INTEGER) AS shard FROM summed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY h, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(i)
  WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes AS x ON a = x.doc_id JOIN sizes AS y ON b = y.doc_id
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
), labelled AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT labelled.doc_id, coalesce(n, 0) AS n_shingles, component_id, labelled.doc_id = component_id AS kept
FROM labelled LEFT JOIN sizes ON labelled.doc_id = sizes.doc_id
"""

MIXING = """
WITH sizes AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), rates AS (
  SELECT source, n, power(n, 0.5) / sum(power(n, 0.5)) OVER () * CAST(sum(n) OVER () AS DOUBLE) / n AS rate FROM sizes
), steps AS (
  SELECT source, sum(exp(-rate) * power(rate, k) / factorial(CAST(k AS INTEGER)))
    OVER (PARTITION BY source ORDER BY k) AS upto
  FROM rates, unnest(range(0, 33)) AS t(k)
), drawn AS (
  SELECT documents.*, round(rate, 9) AS rate,
    CAST('0x' || substr(md5('20:' || documents.doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents JOIN rates ON documents.source IS NOT DISTINCT FROM rates.source
), counted AS (
  SELECT drawn.*, (SELECT count(*) FROM steps WHERE steps.source IS NOT DISTINCT FROM drawn.source AND upto <= u) AS times
  FROM drawn
)
SELECT doc_id, source, lang, text, n_chars, CAST(copy AS INTEGER) AS copy, CAST(times AS INTEGER) AS n_copies, rate,
  md5('20:' || doc_id || ':' || copy || ':place') AS shuffle_key
FROM counted, unnest(range(0, times)) AS t(copy)
"""

#: The rules and the block list are those of ``urls``.
URL_FILTERS = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fitting AS (
  SELECT page_id, rules.host || rules.path AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rules.host || rules.path) DESC) AS place
  FROM parsed JOIN rules
    ON (parsed.host = rules.host OR ends_with(parsed.host, '.' || rules.host)) AND starts_with(parsed.path, rules.path)
)
SELECT page_id, host, path, rule, coalesce(verdict,
  CASE WHEN regexp_matches(host, '(^|[.-])(ads|bets|casino|pills|spam)([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed LEFT JOIN (SELECT * FROM fitting WHERE place = 1) AS best USING (page_id)
"""

FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS first_id FROM d GROUP BY t
), marked AS (
  SELECT d.doc_id, part,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN d.doc_id > first_id THEN 'E' ELSE '' END AS failed
  FROM d JOIN firsts USING (t)
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, failed, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad
  FROM marked LEFT JOIN known USING (doc_id) GROUP BY part, failed
), letters(x) AS (
  VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters AS a JOIN letters AS b ON b.x <> a.x JOIN letters AS c ON c.x NOT IN (a.x, b.x)
  JOIN letters AS d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters AS e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), seen AS (
  SELECT part, filter_order, step, f, n, good, bad, contains(failed, f) AS fails, failed = f AS only_f,
    length(failed) > length(translate(failed, earlier, '')) AS gone
  FROM masks CROSS JOIN steps
), summed AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN only_f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND fails THEN bad ELSE 0 END) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM summed
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), parts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)
), runs AS (
  SELECT lang, w[i] AS one, CASE WHEN i + 1 <= len(w) THEN w[i] || ' ' || w[i + 1] END AS two,
    CASE WHEN i + 2 <= len(w) THEN w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS three
  FROM parts
), f AS (
  SELECT lang, one AS phrase, 1 AS k, count(*) AS a FROM runs GROUP BY ALL
  UNION ALL SELECT lang, two, 2, count(*) FROM runs WHERE two IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, three, 3, count(*) FROM runs WHERE three IS NOT NULL GROUP BY ALL
), sizes AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10
), parted AS (
  SELECT lang, phrase, k, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:k], ' ') AS tail
  FROM candidates, (SELECT unnest([1, 2]) AS cut) WHERE cut < k
), scored AS (
  SELECT parted.*, x.a AS l, y.a AS r,
    CAST(1000000 * CAST(parted.a AS HUGEINT) * parted.a // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM parted JOIN f AS x ON x.lang = parted.lang AND x.phrase = head JOIN f AS y ON y.lang = parted.lang AND y.phrase = tail
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored
), inner_pairs AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a AS longer FROM candidates WHERE k = 3
), covered AS (
  SELECT lang, phrase, max(longer) AS longer FROM inner_pairs GROUP BY lang, phrase
), left_over AS (
  SELECT lowest.* FROM lowest LEFT JOIN covered ON covered.lang = lowest.lang AND covered.phrase = lowest.phrase
  WHERE place = 1 AND (k = 3 OR longer IS NULL OR 100 * longer < 50 * a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM left_over
)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN sizes ON sizes.lang = ranked.lang WHERE rank <= 2000
"""

ALL = {
    "op1_top_k": TOP_K,
    "op3_line_dedup": LINE_DEDUP,
    "op4_sharding": SHARDING,
    "op6_near_dedup": NEAR_DEDUP,
    "op8_mixing": MIXING,
    "op11_filter_audit": FILTER_AUDIT,
    "op12_url_filters": URL_FILTERS,
    "op13_collocations": COLLOCATIONS,
}
