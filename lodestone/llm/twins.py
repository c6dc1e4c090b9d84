"""DuckDB SQL of queries whose operators are too long-winded for Spark SQL, but whose results are plain to state.

Each text computes the query's columns from the definition alone: no digits, index or ranges, but every window of
every text, compared by its bytes or words. Fit for small tables.
"""

from __future__ import annotations

from . import decontam, simhash, suffix_dedup

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The polynomial of CRC-32 and the word pattern as the contract deals it.
CRC_POLYNOMIAL = 3988292384
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The five primes of XXH64.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
#: A doc_id for rows without one: later than every other.
LAST = (1 << 63) - 1


def suffix_dedup_sql(window: int = suffix_dedup.WINDOW) -> str:
    """``op2``: all windows of all texts, grouped by their bytes."""
    return f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {LAST}) AS d, encode(coalesce(text, '')) AS b FROM documents
), windows AS (
  SELECT r, d, i, array_slice(b, i + 1, i + {window}) AS s FROM (SELECT r, d, b, unnest(range(octet_length(b) - {window - 1})) AS i FROM docs)
), later AS (
  SELECT r, i FROM (SELECT r, i, d, min(d) OVER (PARTITION BY s) AS first_d FROM windows) WHERE d > first_d
), marked AS (
  SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS run
  FROM (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {window} THEN 0 ELSE 1 END AS fresh FROM later)
), spans AS (
  SELECT r, min(i) AS a, max(i) + {window} AS e FROM marked GROUP BY r, run
), gaps AS (
  SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS e FROM spans
  UNION ALL
  SELECT docs.r, coalesce(max(spans.e), 0), any_value(octet_length(b)) FROM docs LEFT JOIN spans USING (r) GROUP BY docs.r
), kept AS (
  SELECT r, sha256(unhex(coalesce(string_agg(hex(array_slice(b, a + 1, e)), '' ORDER BY a) FILTER (WHERE e > a), ''))) AS kept_sha256
  FROM gaps JOIN docs USING (r) GROUP BY r
), removed AS (
  SELECT r, sum(e - a) AS n, count(*) AS spans FROM spans GROUP BY r
)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, kept_sha256
FROM docs JOIN kept USING (r) LEFT JOIN removed USING (r)
"""


def sharding_sql(n_shards: int = 16, seed: int = 17) -> str:
    """``op3``: one window over each stratum and one over all rows; CRC-32 byte by byte."""
    return f"""
WITH crc AS MATERIALIZED (
  SELECT list(value ORDER BY n) AS step
  FROM (SELECT n, list_reduce(range(8), lambda c, k: xor(c >> 1, {CRC_POLYNOMIAL} * (c & 1)), n) AS value FROM range(256) AS t(n))
), read AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS stratum, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes,
    md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), rows AS MATERIALIZED (
  SELECT doc_id, stratum, size, h,
    xor(list_reduce(bytes, lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM read, crc
), ranked AS (
  SELECT *, (2 * (row_number() OVER (PARTITION BY stratum ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1) + 1) / (2 * count(*) OVER (PARTITION BY stratum)) AS frac
  FROM rows
), placed AS (
  SELECT *, row_number() OVER (ORDER BY frac, stratum, h, doc_id NULLS FIRST, text_crc32, size) - 1 AS g, count(*) OVER () AS n FROM ranked
), cut AS (
  SELECT *, (g * {n_shards}) // n AS shard FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(g - (shard * n + {n_shards - 1}) // {n_shards} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""


def decontamination_sql(window: int = decontam.WINDOW, within: int = 2 * decontam.WINDOW) -> str:
    """``op4``: every run of words of every document against every benchmark window; near ones from each window's rarest word."""
    words = lambda c: f"regexp_extract_all(translate(coalesce({c}, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
    leads = ", ".join(f"lead(w, {j}) OVER (PARTITION BY r ORDER BY p)" for j in range(1, window))
    return f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {words('text')} AS ws FROM documents
), places AS MATERIALIZED (
  SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM docs
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words('text')} AS ws FROM benchmark
), owned AS MATERIALIZED (
  SELECT DISTINCT item, ws[s + 1 : s + {window}] AS terms
  FROM (SELECT item, ws, unnest(range(greatest(1, len(ws) - {window - 1}))) AS s FROM items WHERE len(ws) > 0)
), known AS MATERIALIZED (
  SELECT row_number() OVER () AS k, terms, len(terms) AS n, array_to_string(terms, ' ') AS phrase FROM (SELECT DISTINCT terms FROM owned)
), runs AS (
  SELECT r, p, [w, {leads}] AS ws FROM places
), hits AS MATERIALIZED (
  SELECT r, p, k, known.n FROM (SELECT r, p, n, array_to_string(ws[1:n], ' ') AS phrase FROM runs, (SELECT DISTINCT n FROM known) WHERE ws[n] IS NOT NULL) AS own
  JOIN known ON known.phrase = own.phrase AND known.n = own.n
), hit_words AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits JOIN known USING (k) JOIN owned USING (terms)) GROUP BY r
), term AS MATERIALIZED (
  SELECT DISTINCT k, unnest(terms) AS w FROM known
), frequency AS (
  SELECT term.w, count(p) AS f FROM (SELECT DISTINCT w FROM term) AS term LEFT JOIN places USING (w) GROUP BY term.w
), rarest AS MATERIALIZED (
  SELECT k, arg_min(w, f) AS w, count(*) AS m FROM term JOIN frequency USING (w) GROUP BY k HAVING min(f) > 0
), around AS (
  SELECT a.k, a.m, p.r, p.p, term.w, q.p AS q
  FROM rarest AS a JOIN places AS p USING (w) JOIN term ON term.k = a.k JOIN places AS q ON q.r = p.r AND q.w = term.w AND q.p BETWEEN p.p - {within - 1} AND p.p + {within - 1}
), likely AS (
  SELECT k, m, r, p, list([w, CAST(q AS VARCHAR)]) AS found FROM around GROUP BY k, m, r, p HAVING count(DISTINCT w) = m
), near AS (
  SELECT DISTINCT k, r FROM (SELECT k, m, r, found, unnest(range(p - {within - 1}, p + 1)) AS s FROM likely)
  WHERE len(list_distinct([x[1] for x in found if CAST(x[2] AS BIGINT) BETWEEN s AND s + {within - 1}])) = m
), near_items AS (
  SELECT r, count(DISTINCT item) AS n_near_items FROM near JOIN known USING (k) JOIN owned USING (terms) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near_items, 0) AS BIGINT) AS n_near_items
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r) LEFT JOIN near_items USING (r)
"""


def _xxh64(seed: int) -> list[str]:
    """SELECT lists, one after the other, from ``bytes`` (a list of numbers) to ``h``; arithmetic modulo 2^64 in 128 bits."""
    one, two, three, four, five = (f"{p}::UHUGEINT" for p in PRIMES)
    word = (1 << 64) - 1
    low = lambda x: f"(({x}) & {word}::UHUGEINT)"
    turn = lambda x, n: low(f"({x} << {n}) | ({x} >> {64 - n})")
    mixed = lambda v, x: low(f"{turn(low(f'{v} + {low(f'{x} * {two}')}'), 31)} * {one}")
    number = lambda at, n: "(" + " + ".join(f"bytes[{at} + {j + 1}]::UHUGEINT * {1 << 8 * j}::UHUGEINT" for j in range(n)) + ")"
    starts = [(seed + PRIMES[0] + PRIMES[1]) & word, (seed + PRIMES[1]) & word, seed, (seed - PRIMES[0]) & word]
    lanes = [f"list_reduce([{number(f'i * 32 + {8 * k}', 8)} for i in range(n // 32)], lambda v, x: {mixed('v', 'x')}, {s}::UHUGEINT) AS v{k}" for k, s in enumerate(starts)]
    whole = low(" + ".join(turn(f"v{k}", n) for k, n in enumerate((1, 7, 12, 18))))
    merged = f"list_reduce([v0, v1, v2, v3], lambda h, v: {low(f'xor(h, {mixed('0::UHUGEINT', 'v')}) * {one} + {four}')}, {whole})"
    eight = f"list_reduce([{number('n // 32 * 32 + i * 8', 8)} for i in range(n % 32 // 8)], lambda h, x: {low(f'{turn(f"xor(h, {mixed('0::UHUGEINT', 'x')})", 27)} * {one} + {four}')}, h)"
    quad = f"list_reduce([{number('n // 8 * 8', 4)} for i in range(n % 8 // 4)], lambda h, x: {low(f'{turn(f"xor(h, {low(f'x * {one}')})", 23)} * {two} + {three}')}, h)"
    single = f"list_reduce([bytes[n // 4 * 4 + i + 1]::UHUGEINT for i in range(n % 4)], lambda h, x: {low(f'{turn(f"xor(h, {low(f'x * {five}')})", 11)} * {one}')}, h)"
    return [
        "words, n, bytes, " + ", ".join(lanes),
        f"words, n, bytes, {low(f'n::UHUGEINT + CASE WHEN n < 32 THEN {(seed + PRIMES[4]) & word}::UHUGEINT ELSE {merged} END')} AS h",
        f"words, n, bytes, {eight} AS h",
        f"words, n, bytes, {quad} AS h",
        f"words, n, bytes, {single} AS h",
        f"words, {low(f'xor(h, h >> 33) * {two}')} AS h",
        f"words, {low(f'xor(h, h >> 29) * {three}')} AS h",
        "words, CAST(xor(h, h >> 32) AS UBIGINT) AS h",
    ]


def simhash_sql(shingle: int = 4, radius: int = simhash.RADIUS, seed: int = 42) -> str:
    """``op7``: every pair of distinct fingerprints, and all that can be reached from each."""
    leads = "".join(f", lead(w, {j}) OVER (PARTITION BY r ORDER BY p)" for j in range(1, shingle))
    hashed = ["known AS (SELECT words, octet_length(encode(words)) AS n, list_transform(regexp_extract_all(hex(encode(words)), '..'), lambda x: CAST('0x' || x AS UTINYINT)) AS bytes FROM (SELECT DISTINCT words FROM shingles))"]
    for k, select in enumerate(_xxh64(seed)):
        hashed.append(f"x{k} AS (SELECT {select} FROM {f'x{k - 1}' if k else 'known'})")
    bits = " + ".join(f"CASE WHEN 2 * sum(CAST((h >> {b}) & 1 AS BIGINT)) > count(*) THEN {1 << b}::UHUGEINT ELSE 0::UHUGEINT END" for b in range(64))
    return f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), runs AS (
  SELECT r, [w{leads}] AS ws FROM (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM docs)
), shingles AS MATERIALIZED (
  SELECT r, array_to_string(ws, ' ') AS words FROM runs WHERE ws[{shingle}] IS NOT NULL
  UNION ALL
  SELECT r, array_to_string(ws, ' ') FROM docs WHERE len(ws) BETWEEN 1 AND {shingle - 1}
), {", ".join(hashed)}, made AS (
  SELECT r, CAST({bits} AS UBIGINT) AS fp FROM shingles JOIN x{len(hashed) - 2} USING (words) GROUP BY r
), marked AS MATERIALIZED (
  SELECT doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM docs LEFT JOIN made USING (r)
), points AS MATERIALIZED (
  SELECT fp, min(doc_id) AS least FROM marked GROUP BY fp
), links AS MATERIALIZED (
  SELECT a.fp AS a, b.fp AS b FROM points AS a JOIN points AS b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= {radius}
), reached AS (
  SELECT fp AS a, fp AS b FROM points
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), named AS (
  SELECT a AS fp, min(least) AS component_id FROM reached JOIN points ON points.fp = reached.b GROUP BY a
)
SELECT doc_id, lower(lpad(hex(fp), 16, '0')) AS fingerprint, component_id FROM marked JOIN named USING (fp)
"""
