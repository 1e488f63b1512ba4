"""SQL of the operators that SQL can express, for DuckDB over the same tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SET_JOIN = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 2], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM texts WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), seen AS (
  SELECT s, count(*) AS df FROM shingles GROUP BY s
), ranked AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY df, s) AS place FROM shingles JOIN seen USING (s)
), prefixes AS (
  SELECT doc_id, s, n FROM ranked JOIN sizes USING (doc_id) WHERE place <= n - (9 * n + 9) // 10 + 1
), candidates AS (
  SELECT DISTINCT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny
  FROM prefixes a JOIN prefixes b ON a.s = b.s AND a.doc_id < b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
), links AS (
  SELECT x, y FROM candidates JOIN shingles a ON a.doc_id = x JOIN shingles b ON b.doc_id = y AND b.s = a.s
  GROUP BY x, y, nx, ny HAVING 100 * count(*) >= 90 * (nx + ny - count(*))
), edges AS (
  SELECT x AS a, y AS b FROM links UNION SELECT y, x FROM links
), reached AS (
  SELECT doc_id AS pos, doc_id AS low FROM documents
  UNION
  SELECT b, low FROM reached JOIN edges ON a = pos
), lows AS (
  SELECT pos, min(low) AS component_id FROM reached GROUP BY pos
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN lows ON pos = doc_id
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), phrases AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k)
  GROUP BY lang, k, phrase
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1 AND f >= 30
), cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS x, array_to_string(w[cut + 1 : k], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)
), scores AS (
  SELECT cuts.lang, cuts.phrase, a, cut, p.f AS l, q.f AS r, ((2000000::HUGEINT * a) // (p.f + q.f)::HUGEINT)::BIGINT AS score
  FROM cuts JOIN phrases p ON p.lang = cuts.lang AND p.phrase = x JOIN phrases q ON q.lang = cuts.lang AND q.phrase = y
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM candidates, (VALUES (2), (3)) AS shorter(m) WHERE m < k)
  GROUP BY lang, phrase
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN totals USING (lang) WHERE rank <= 2000
"""


def _levels(name: str, levels: int) -> str:
    """Levels of trees over the table `name`0 (tree, n, pos, digest): eight nodes become one while there are several."""
    parts = []
    for k in range(levels):
        several = f"(n + {8**k - 1}) // {8**k} > 1"
        order = "PARTITION BY tree, pos // 8 ORDER BY pos"
        parts.append(f"""{name}{k}s AS (
  SELECT *, {several} AS several,
    coalesce(string_agg(digest, '') OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
    coalesce(string_agg(digest, '') OVER ({order} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM {name}{k}
), {name}{k + 1} AS (
  SELECT tree, n, pos // 8 AS pos, CASE WHEN bool_or(several) THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest
  FROM {name}{k}s GROUP BY tree, n, pos // 8
)""")
    return ", ".join(parts)


def _climb(name: str, start: str, key: str, levels: int) -> str:
    """The table `start` (`key`, tree, pos, proof, acc) led up through the levels."""
    parts, before = [], start
    for k in range(levels):
        parts.append(f"""{name}_up{k} AS (
  SELECT b.* EXCLUDE (pos, proof, acc), b.pos // 8 AS pos, proof || CASE WHEN several THEN lft || rgt ELSE '' END AS proof,
    CASE WHEN several THEN sha256(lft || acc || rgt) ELSE acc END AS acc
  FROM {before} b JOIN {name}{k}s s ON s.tree = b.tree AND s.pos = b.pos
)""")
        before = f"{name}_up{k}"
    return ", ".join(parts)


def merkle(leaf_levels: int = 7, lang_levels: int = 3) -> str:
    """So many levels are written out: eight to that power documents of a language, and languages."""
    field = lambda x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    head = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = "list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])))"
    crc = f"xor(list_reduce({steps}, lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, sha256({head} || {field("text")}) AS leaf,
    CASE WHEN {crc} % 3 = 0 THEN sha256({head} || {field(lowered)}) END AS tampered
  FROM documents
), placed AS (
  SELECT *, count(*) OVER (PARTITION BY tree) AS n,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), t0 AS (
  SELECT tree, n, pos, leaf AS digest FROM placed
), {_levels("t", leaf_levels)}, begun AS (
  SELECT doc_id, tree, pos, leaf, '' AS proof, coalesce(tampered, leaf) AS acc FROM placed
), {_climb("t", "begun", "doc_id", leaf_levels)}, u0 AS (
  SELECT '' AS tree, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS pos, digest, tree AS lang_tree FROM t{leaf_levels}
), {_levels("u", lang_levels)}, crossed AS (
  SELECT doc_id, leaf, u0.digest AS subroot, u0.tree, u0.pos, proof, acc FROM t_up{leaf_levels - 1} b JOIN u0 ON u0.lang_tree = b.tree
), {_climb("u", "crossed", "doc_id", lang_levels)}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = digest AS verified
FROM u_up{lang_levels - 1}, u{lang_levels}
"""
