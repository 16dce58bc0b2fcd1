"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from adevents.llm import collocations, hadamard_clusters, quality, sharding, substring_dedup, url_filter

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"


def _contamination() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lower("text")}, '{word}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_lower("text")}, '{word}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)
),
hit AS (SELECT rid, i, k, item_id FROM dw JOIN win USING (k, g)),
words AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n, array_to_string(list(item ORDER BY item), ',') AS names
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hit) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.names, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""


def _shards(shards: int = 24) -> str:
    in_order = "ORDER BY doc_id NULLS FIRST, text_crc32, size"
    return f"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(0, 8)),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(0, 256)) AS i)
  )
),
h AS (
  SELECT row_number() OVER () AS rid, doc_id, octet_length(encode(coalesce(text, ''))) + {sharding.ROW_OVERHEAD} AS size,
    hex(encode(coalesce(text, ''))) AS hex
  FROM documents
),
s AS (
  SELECT doc_id, size::BIGINT AS size, xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(regexp_extract_all(hex, '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[xor(c % 256, x) + 1]))) AS text_crc32
  FROM h, steps
),
placed AS (
  SELECT *, (sum(size) OVER ({in_order} ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start, sum(size) OVER () AS whole,
    row_number() OVER ({in_order}) AS position
  FROM s
),
cut AS (SELECT *, least(((2 * start + size) * {shards}) // greatest(2 * whole, 1), {shards - 1})::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, position - min(position) OVER (PARTITION BY shard) AS slot,
  NULL::INTEGER AS grown_shard, start
FROM cut"""


def _repeats() -> str:
    n = substring_dedup.WINDOW
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (
  SELECT rid, i, md5(array_to_string(w[i:i + {n - 1}], ' ')) AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n})
),
again AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS MATERIALIZED (SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(i, i + {n})) AS p FROM win JOIN again USING (g))),
runs AS (
  SELECT rid, min(p) - 1 AS first, max(p) AS behind, count(*) AS n
  FROM (SELECT rid, p, p - row_number() OVER (PARTITION BY rid ORDER BY p) AS run FROM gone) GROUP BY rid, run
),
cut AS (
  SELECT rid, sum(n)::BIGINT AS n, string_agg(first || '-' || behind, ',' ORDER BY first) AS removed FROM runs GROUP BY rid
),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS text
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (rid, p) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(cut.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256,
  coalesce(cut.removed, '') AS removed
FROM d LEFT JOIN cut USING (rid) LEFT JOIN kept USING (rid)"""


def _near_duplicates() -> str:
    return rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lower("text")}, '{_WORD}') AS w FROM documents
),
sh AS MATERIALIZED (
  SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
sized AS (SELECT rid, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS set_key FROM sh GROUP BY rid),
class AS MATERIALIZED (
  SELECT set_key, n, min(rid) AS rep, min(doc_id) AS class_id FROM sized JOIN d USING (rid) GROUP BY set_key, n
),
rs AS MATERIALIZED (SELECT rid, g, n FROM sh JOIN class ON rid = rep),
link AS MATERIALIZED (
  SELECT x.rid AS a, y.rid AS b FROM rs x JOIN rs y ON x.g = y.g AND x.rid <> y.rid
  GROUP BY x.rid, y.rid, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
),
reach(a, b) AS (SELECT rep, rep FROM class UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
component AS (SELECT a AS rep, min(class_id) AS component_id FROM reach JOIN class ON reach.b = class.rep GROUP BY a)
SELECT doc_id, coalesce(sized.n, 0)::BIGINT AS n_shingles,
  CASE WHEN sized.n IS NULL THEN doc_id ELSE component_id END AS component_id,
  CASE WHEN sized.n IS NULL THEN doc_id ELSE class_id END AS class_id
FROM d LEFT JOIN sized USING (rid) LEFT JOIN class USING (set_key, n) LEFT JOIN component USING (rep)"""


def _quality() -> str:
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('s' || source, 'n') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents
),
win AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
),
twice AS (SELECT rid, g FROM win GROUP BY rid, g HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM win JOIN twice USING (rid, g)) GROUP BY rid
),
ln AS (
  SELECT rid, host, line, len(regexp_extract_all(line, '{_WORD}')) AS words,
    trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[0-9]+', '0', 'g')) AS norm
  FROM (SELECT rid, host, unnest(string_split(text, chr(10))) AS line FROM d)
),
lk AS (SELECT rid, host, words, ('0x' || substr(md5(norm), 1, 15))::BIGINT AS key FROM ln WHERE norm <> ''),
sets AS (SELECT rid, array_to_string(list_sort(list(DISTINCT key)), ',') AS line_set FROM lk GROUP BY rid),
common AS (
  SELECT host, key FROM lk JOIN sets USING (rid) GROUP BY host, key HAVING count(DISTINCT line_set) > {quality.MIN_DOCS}
),
gone AS (SELECT rid, sum(words)::BIGINT AS n FROM lk JOIN common USING (host, key) GROUP BY rid),
dup AS (
  SELECT rid, (count(*) - count(DISTINCT line))::BIGINT AS n FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
),
f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '{quality.SYMBOLS}', '')))::BIGINT AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed_words
  FROM d LEFT JOIN covered USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN gone USING (rid)
)
SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
  AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < {quality.MIN_WORDS}
           OR n_removed_words > n_words * {quality.MAX_REMOVED}::DOUBLE)) AS kept
FROM f"""


def _urls() -> str:
    rules = sorted(url_filter.RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    fits = [
        (f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, act) for act, h, p in rules
    ]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{name}'" for c, name, _ in fits) + " END"
    action = "CASE " + " ".join(f"WHEN {c} THEN '{act}'" for c, _, act in fits) + " END"
    listed = rf"(^|\.)({'|'.join(url_filter.LISTED_NAMES)})(\.|:|$)"
    return rf"""
WITH r AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
p AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*[^?#]*\?([^#]*)', 1) AS query,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r
),
c AS (
  SELECT *, host || regexp_replace(path, '/+$', '') ||
    CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical_url
  FROM (SELECT *, list_sort(list_filter(string_split(query, '&'),
          lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref)(=|$)'))) AS params FROM p)
),
j AS (
  SELECT page_id, host, path, {rule} AS rule, {action} AS action, canonical_url,
    canonical_url <> '' AND canonical_url IN (SELECT canonical_url FROM c WHERE regexp_matches(host, '{listed}')) AS listed
  FROM c
)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict,
  canonical_url, listed
FROM j"""


def _collocations() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    least, first, longest = collocations.THRESHOLD, collocations.FIRST, collocations.LONGEST
    return rf"""
WITH d AS (
  SELECT coalesce(lang, '{collocations.NO_LANG}') AS lang, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS t FROM documents
),
p AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-
]')) AS piece FROM d)
),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, {longest + 1})) AS k) WHERE len(w) >= k)
),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM g GROUP BY lang, k, phrase HAVING count(*) >= {least}),
cuts AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS s, unnest(range(1, k)) AS j FROM f WHERE k > 1),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, l.n AS l, r.n AS r, total.n AS n, (1000 * c.a * total.n) // (l.n * r.n) AS score, j
  FROM cuts c JOIN total USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.s[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.s[j + 1:], ' ')
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (
  SELECT lang, array_to_string(s[i:i + m - 1], ' ') AS phrase, max(n) AS n
  FROM (SELECT lang, string_split(phrase, ' ') AS s, n, m, unnest(range(1, k - m + 2)) AS i
        FROM f, (SELECT unnest(range(2, {longest})) AS m) WHERE m < k)
  GROUP BY 1, 2
),
kept AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE longer.n IS NULL OR 100 * longer.n < 100 * best.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= {first}"""


def _clusters() -> str:
    h = hadamard_clusters
    places = f"unnest(range(1, {h.SIZE + 1}))"
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({h.SCALE} * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE len(embedding) = {h.SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {h.SIZE}
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY digest, e) - 1 AS k, e
  FROM (SELECT sha256('{h.SEED}:' || coalesce(vec_id::VARCHAR, '')) AS digest, e FROM v) ORDER BY digest, e LIMIT {h.CLUSTERS}
)""",
    ]
    distance = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for r in range(h.ROUNDS + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
  SELECT rid, vec_id, v.e, k, {distance} AS d FROM v, c{r} c
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1
)"""
        )
        if r < h.ROUNDS:
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS e
    FROM (SELECT k, i, sum(e[i]) AS s, count(*)::HUGEINT AS n FROM (SELECT k, e, {places} AS i FROM a{r}) GROUP BY k, i) GROUP BY k
  ) m USING (k)
)"""
            )
    last = f"a{h.ROUNDS}"
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, a.k::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256,
  count(*) OVER (PARTITION BY a.k) AS cluster_size
FROM {last} a JOIN c{h.ROUNDS} c ON a.k = c.k"""


ORACLES: dict[str, str] = {
    "op2_decontamination": _contamination(),
    "op5_sharding": _shards(),
    "op6_quality_rules": _quality(),
    "op7_url_filter": _urls(),
    "op9_substring_dedup": _repeats(),
    "op10_ngram_jaccard_join": _near_duplicates(),
    "op12_collocations": _collocations(),
    "op13_hadamard_clusters": _clusters(),
}
