"""SQL that must give the same rows as the queries, where SQL can say what they do."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]"

NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+3], ' ') END AS g
  FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS u(i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)
), edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
lowest AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN lowest ON a = d.doc_id
"""


def _shrunk(rule: str) -> str:
    return f"(h.{rule} + t.{rule}_k * t.{rule}_m) / (h.n_docs + t.{rule}_k)"


def _moments(rule: str) -> str:
    return (
        f"sum({rule}) / sum(n_docs) AS {rule}_m, "
        f"sum(n_docs * pow({rule} / n_docs, 2)) / sum(n_docs) - pow(sum({rule}) / sum(n_docs), 2) "
        f"- (sum({rule}) / sum(n_docs)) * (1 - sum({rule}) / sum(n_docs)) * count(*) / sum(n_docs) AS {rule}_e"
    )


def _strength(rule: str) -> str:
    return (
        f"{rule}_m, greatest(1.0, least(1e6, CASE WHEN {rule}_e > 0 "
        f"THEN {rule}_m * (1 - {rule}_m) / {rule}_e - 1 ELSE 1e6 END)) AS {rule}_k"
    )


_RULES = ("base_failed", "symbols_failed", "lines_failed")

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w FROM documents
), window_ AS (
  SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 3, 1))) AS u(i)
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM window_) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 5)) AS u(k) GROUP BY 1
), line AS (
  SELECT doc_id, l, count(*) AS c FROM d, unnest(string_split(t, chr(10))) AS u(l) WHERE regexp_matches(l, '{_WORD}') GROUP BY 1, 2
), lines AS (SELECT doc_id, sum(c)::BIGINT AS n, sum(c - 1)::BIGINT AS dup FROM line GROUP BY 1),
m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(lines.n, 0) AS n_lines,
    coalesce(lines.dup, 0) AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), r AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    100 * n_symbols > 10 * word_chars AS symbols_failed, 100 * n_dup_lines > 30 * n_lines AS lines_failed FROM m
), h AS (
  SELECT source, count(*) AS n_docs, {", ".join(f"count(*) FILTER ({x})::DOUBLE AS {x}" for x in _RULES)} FROM r GROUP BY 1
), moments AS (SELECT {", ".join(map(_moments, _RULES))} FROM h),
t AS (SELECT {", ".join(map(_strength, _RULES))} FROM moments),
v AS (SELECT h.source, greatest({", ".join(map(_shrunk, _RULES))}) > 0.5 AS host_rejected,
  {_shrunk("symbols_failed")} > 4.0 * t.symbols_failed_m AS symbols_excused FROM h, t)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, symbols_failed, host_rejected,
  symbols_excused, NOT base_failed AND NOT host_rejected AND (NOT symbols_failed OR symbols_excused) AS kept
FROM r JOIN v ON r.source IS NOT DISTINCT FROM v.source
"""


def _assigned(number: int) -> str:
    """Vectors by their nearest of the centroids of a round, the smaller number if two are as near."""
    return f"""a{number} AS MATERIALIZED (
  SELECT r, arg_min(j, (d, j)) AS j, min(d) AS d FROM (
    SELECT v.r, c.j, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{number} c USING (i) GROUP BY v.r, c.j
  ) GROUP BY r
)"""


def _moved(number: int) -> str:
    """Centroids after a round: exact floors of the means, unless no vector is left."""
    return f"""c{number + 1} AS MATERIALIZED (
  SELECT j, i, coalesce(m.x, c.x) AS x FROM c{number} c LEFT JOIN (
    SELECT a.j, v.i, (sum(v.x) - (sum(v.x) % count(*) + count(*)) % count(*)) // count(*) AS x
    FROM a{number} a JOIN v USING (r) GROUP BY a.j, v.i
  ) m USING (j, i)
)"""


_ROUNDS = 5

CENTROID_CLUSTERING = f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER () AS r, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding::DOUBLE[], lambda x: x IS NOT NULL AND isfinite(x)))
), v AS MATERIALIZED (
  SELECT r, u.i, floor(256 * e[u.i])::HUGEINT AS x FROM kept, unnest(range(1, 65)) AS u(i)
), first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS j FROM kept QUALIFY j < 40
), c0 AS MATERIALIZED (SELECT f.j, v.i, v.x FROM first f JOIN v USING (r)),
{", ".join(f"{_assigned(n)}, {_moved(n)}" for n in range(_ROUNDS))}, {_assigned(_ROUNDS)},
digest AS (SELECT j, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS s FROM c{_ROUNDS} GROUP BY 1)
SELECT vec_id, j::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, s AS centroid_sha256
FROM a{_ROUNDS} JOIN kept USING (r) JOIN digest USING (j)
"""

_CRC32 = (
    "xor(4294967295, list_reduce([b::BIGINT for b in list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c))], "
    "lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END), 4294967295::BIGINT))"
)

PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, strlen(coalesce(text, '')) AS size,
    sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS step
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'s': step, 'b': size}} ORDER BY turn NULLS FIRST, role, step) AS steps, {_CRC32} % 9 AS h FROM t GROUP BY 1
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.steps[1:o.h], []), o.steps[o.h + 1:]) AS steps
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), keyed AS (
  SELECT conv_id, len(steps) AS n, list_transform(steps, lambda s: s.s) AS key, list_transform(steps, lambda s: s.b) AS sizes FROM rebuilt
), node AS MATERIALIZED (
  SELECT d AS depth, key[1:d] AS key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN sizes[d] ELSE 0 END) AS size,
    coalesce(string_agg(CASE WHEN n = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
  FROM keyed, unnest(range(0, n + 1)) AS u(d) GROUP BY 1, 2
), child AS (SELECT depth - 1 AS depth, key[1:depth - 1] AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
counted AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (depth, key)),
below AS (
  SELECT d AS depth, key[1:d] AS key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM counted, unnest(range(0, depth + 1)) AS u(d) GROUP BY 1, 2
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(c.ends) AS ends_sha256
FROM counted c JOIN below USING (depth, key) LEFT JOIN node p ON p.depth = c.depth - 1 AND p.key = c.key[1:c.depth - 1]
"""
