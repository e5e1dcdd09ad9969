"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from sondelake.llm.repetition import BASE_WIDTH, LIMITS, LINE_LIMIT

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), patterns AS (
  SELECT DISTINCT item, least(13, len(w)) AS width, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS pattern
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0
), widths AS (
  SELECT DISTINCT width FROM patterns
), windows AS (
  SELECT doc_id, width, i, array_to_string(w[i : i + width - 1], ' ') AS pattern
  FROM d, widths, unnest(range(1, CAST(len(w) AS BIGINT) - width + 2)) AS t(i)
), found AS (
  SELECT doc_id, i, windows.width, item FROM windows JOIN patterns ON windows.pattern = patterns.pattern AND windows.width = patterns.width
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = rf"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), x AS (
  SELECT doc_id, i, sha256(array_to_string(w[i : i + 49], ' ')) AS h
  FROM d, unnest(range(1, CAST(len(w) AS BIGINT) - 48)) AS t(i)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS low FROM x) WHERE low < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM later
), lists AS (
  SELECT doc_id, list(p) AS ps, count(*) AS n_removed FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ')
    ELSE (SELECT coalesce(string_agg(w[p], ' ' ORDER BY p), '') FROM unnest(range(1, CAST(len(w) AS BIGINT) + 1)) AS t(p)
          WHERE NOT list_contains(ps, p)) END) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id)
"""

OP6 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS shingle, len(w) >= 4 AS whole
  FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.whole = y.whole AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * shared >= 85 * (na.n + nb.n - shared)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON d.doc_id = r.a
"""

#: Water filling and sampling without key ranges: one order per source.
OP8 = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
    1.0 / (1.0 + CAST(20.0 * len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS DOUBLE) / greatest(coalesce(length(text), 1), 1)) AS weight,
    (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + CAST(0.5 AS DOUBLE)) / 4503599627370496.0 AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM d GROUP BY source
), r AS (
  SELECT *, CAST([5, 2, 1][1 + place % 3] AS DOUBLE) AS share, CAST(3 * source_size AS DOUBLE) AS bound FROM s
), f AS (
  SELECT *, bound / share AS ratio,
    (sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY bound / share, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(share) OVER (ORDER BY bound / share, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r
), t AS (
  SELECT source, source_size, round(least(bound, coalesce((SELECT min_by(level, ratio) FROM f WHERE ratio > level) * share, bound)), 6) AS target FROM f
), k AS (
  SELECT d.*, source_size, target,
    CASE WHEN source_size > 0 THEN least(CAST(round(target) AS BIGINT) // source_size, 3) ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / weight, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, target, weight,
  CAST(epochs * size + greatest(0, least(size, CAST(round(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM k
"""


def _repetition() -> str:
    grams = ", ".join(
        rf"""hits{n} AS (
  SELECT DISTINCT r, unnest(range(i, i + {n})) AS p
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i : i + {n - 1}], ' ')) AS many
    FROM d, unnest(range(1, CAST(len(w) AS BIGINT) - {n - 2})) AS t(i))
  WHERE many > 1
), sums{n} AS (
  SELECT r, count(*) AS words, sum(length(w[p])) AS chars FROM hits{n} JOIN d USING (r) GROUP BY r
)"""
        for n in (BASE_WIDTH, *LIMITS)
    )
    joins = " ".join(f"LEFT JOIN sums{n} USING (r)" for n in (BASE_WIDTH, *LIMITS))
    chars = ", ".join(f"CAST(coalesce(sums{n}.chars, 0) AS BIGINT) AS dup_chars_{n}" for n in LIMITS)
    limits = {"dup_line_chars": LINE_LIMIT} | {f"dup_chars_{n}": limit for n, limit in LIMITS.items()}
    good = " AND ".join(f"{column} <= CAST({limit} AS DOUBLE) * word_chars" for column, limit in limits.items())
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
), {grams}, lines AS (
  SELECT r, line, row_number() OVER (PARTITION BY r, line) > 1 AS again
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), repeats AS (
  SELECT r, count(*) AS n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS chars FROM lines WHERE again GROUP BY r
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(sums{BASE_WIDTH}.words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(repeats.chars, 0) AS BIGINT) AS dup_line_chars, {chars}
  FROM d LEFT JOIN repeats USING (r) {joins}
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT *, NOT base_failed AND {good} AS kept FROM judged
"""


OP7 = _repetition()

# The checksum byte by byte, eight shifts each.
_CRC32 = """xor(CAST(4294967295 AS UBIGINT), list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS UBIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(8) AS UBIGINT[])),
      lambda x, y: xor(x >> 1, CAST(3988292384 AS UBIGINT) * (x & 1)))))"""

OP11 = f"""
WITH turns AS (
  SELECT conv_id, length(coalesce(text, '')) AS size,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS digest,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, CAST({_CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), heads AS (
  SELECT c.conv_id, p, digest, size FROM convs c JOIN turns t ON t.conv_id = c.base AND t.p < c.h
), counts AS (
  SELECT c.conv_id, h, count(p) AS n FROM convs c LEFT JOIN heads USING (conv_id) GROUP BY c.conv_id, h
), rebuilt AS (
  SELECT conv_id, p, digest, size FROM heads
  UNION ALL SELECT conv_id, p - h + n, digest, size FROM turns JOIN counts USING (conv_id) WHERE p >= h
), lists AS (
  SELECT c.conv_id, coalesce(list(digest ORDER BY p) FILTER (digest IS NOT NULL), []) AS ds,
    coalesce(list(size ORDER BY p) FILTER (digest IS NOT NULL), []) AS sizes
  FROM convs c LEFT JOIN rebuilt USING (conv_id) GROUP BY c.conv_id
), members AS (
  SELECT conv_id, d, len(ds) AS n, array_to_string(ds[1:d], ',') AS k, array_to_string(ds[1:d-1], ',') AS up, ds, sizes
  FROM lists, unnest(range(0, CAST(len(ds) AS BIGINT) + 1)) AS t(d)
), nodes AS (
  SELECT k, d, CASE WHEN d > 0 THEN any_value(up) END AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(ds[1:d]) AS ds,
    CASE WHEN d > 0 THEN any_value(sizes[d]) ELSE 0 END AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM members GROUP BY k, d
), children AS (
  SELECT up, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up
), known AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.up = n.k
), sums AS (
  SELECT array_to_string(ds[1:a], ',') AS k, sum((n_convs - 1) * size) AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM known, unnest(range(0, CAST(d AS BIGINT) + 1)) AS t(a) GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM known n JOIN sums USING (k) LEFT JOIN nodes p ON p.k = n.up
"""


def _centroids(k: int = 40, rounds: int = 5) -> str:
    steps = []
    nearest = """a{0} AS MATERIALIZED (
  SELECT v.i, arg_min(c.number, (q, c.number)) AS number, min(q) AS distance
  FROM v, c{0} c, LATERAL (SELECT list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS q)
  GROUP BY v.i
)"""
    for r in range(rounds):
        steps.append(nearest.format(r))
        steps.append(
            f"""m{r} AS MATERIALIZED (
  SELECT number, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x
  FROM (SELECT number, j, sum(CAST(x[j] AS HUGEINT)) AS s, count(*) AS n FROM v JOIN a{r} USING (i), range(1, 65) AS t(j) GROUP BY number, j)
  GROUP BY number
), c{r + 1} AS MATERIALIZED (SELECT c.number, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (number))"""
        )
    steps.append(nearest.format(rounds))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND list_count(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS number, x
  FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT {k})
), {", ".join(steps)}
SELECT vec_id, CAST(number AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY number) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (i) JOIN c{rounds} c USING (number)
"""


OP13 = _centroids()

ORACLES: dict[str, str] = {
    "op4_decontamination": OP4,
    "op5_substring_dedup": OP5,
    "op6_ngram_join": OP6,
    "op7_repetition": OP7,
    "op8_mixing": OP8,
    "op11_prefix_trie": OP11,
    "op13_centroids": OP13,
}
