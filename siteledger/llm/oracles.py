"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op7_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(length(text), 0) AS size,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) AS kept,
       text_sha256
FROM d
"""

ORACLES["op9_url_filters"] = r"""
WITH s AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
p AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM s),
c AS (
    SELECT *, regexp_replace(host, '^(www|m)\.', '')
              || regexp_replace(regexp_replace(path, '(/index)?\.html?$', ''), '/+$', '') AS canonical
    FROM p),
rules(verdict, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
    SELECT c.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
           arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM c JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)
    GROUP BY c.page_id),
listed AS (
    SELECT DISTINCT canonical FROM c
    WHERE regexp_matches('.' || host, '\.(ads-track|spam-farm|casino-win|adult-x|cheap-pills|free-bets)\.'))
SELECT c.page_id, c.host, c.path, b.rule,
       coalesce(b.verdict, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       b.rule IS NULL AND l.canonical IS NOT NULL AS listed
FROM c LEFT JOIN best b USING (page_id) LEFT JOIN listed l ON c.canonical = l.canonical
"""

ORACLES["op6_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents),
s AS (
    SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
    FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id
      GROUP BY ALL),
links AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
          WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id, n.doc_id = min(r.c) AS kept
FROM n JOIN reach r USING (doc_id) GROUP BY n.doc_id, n.n
"""

ORACLES["op3_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(vec_id, c) AS (SELECT vec_id, vec_id FROM embeddings
                     UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.vec_id)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, min(r.c) AS component_id,
       e.vec_id = min(r.c) AS kept
FROM embeddings e JOIN reach r USING (vec_id) GROUP BY e.vec_id
"""

ORACLES["op4_chat_format"] = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) ORDER BY turn, role, text) AS turns
      FROM t GROUP BY conv_id),
g AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_equal FROM c GROUP BY turns)
SELECT a.conv_id, 0 AS part, len(a.turns)::INTEGER AS n_turns, a.n_equal, array_to_string(a.turns, '') AS rendered
FROM g a WHERE NOT EXISTS (SELECT 1 FROM g b WHERE len(b.turns) > len(a.turns) AND b.turns[1:len(a.turns)] = a.turns)
"""

ORACLES["op11_merkle_manifest"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce('=' || lang, '') AS g, n_chars, row_number() OVER () AS nr,
           CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
           || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
           CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
           list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
               lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                                        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS state
    FROM documents),
h AS (
    SELECT doc_id, g, nr,
           sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
           CASE WHEN xor(state, 4294967295) % 7 = 0 THEN sha256(head || CASE WHEN n_chars IS NULL THEN '-'
               ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END || tail) END AS tampered
    FROM d),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, nr) - 1 AS pos,
           count(*) OVER (PARTITION BY g) AS n
    FROM h),
nodes(g, lvl, pos, digest, n) AS (
    SELECT g, 0::BIGINT, pos, leaf, n FROM leaves
    UNION ALL
    SELECT g, any_value(lvl) + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY g, pos // 2),
subroots AS (
    SELECT g, digest AS subroot, lvl AS height, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE n = 1),
tops(lvl, pos, digest, n) AS (
    SELECT 0::BIGINT, pos, subroot, n FROM subroots
    UNION ALL
    SELECT any_value(lvl) + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
    FROM tops WHERE n > 1 GROUP BY pos // 2),
steps AS (
    SELECT l.nr, x.lvl, x.digest, x.pos < (l.pos >> x.lvl) AS is_left
    FROM leaves l JOIN nodes x ON x.g = l.g AND x.pos = xor(l.pos >> x.lvl, 1)
    UNION ALL
    SELECT l.nr, s.height + x.lvl, x.digest, x.pos < (s.pos >> x.lvl)
    FROM leaves l JOIN subroots s ON s.g = l.g JOIN tops x ON x.pos = xor(s.pos >> x.lvl, 1)),
climbs AS (
    SELECT l.nr, s.height + (SELECT max(lvl) FROM tops) AS height FROM leaves l JOIN subroots s USING (g)),
fold(nr, lvl, own) AS (
    SELECT nr, 0::BIGINT, coalesce(tampered, leaf) FROM leaves
    UNION ALL
    SELECT f.nr, f.lvl + 1, sha256(CASE WHEN s.is_left THEN s.digest ELSE '' END || f.own
                                   || CASE WHEN s.is_left THEN '' ELSE coalesce(s.digest, '') END)
    FROM fold f JOIN climbs c ON c.nr = f.nr LEFT JOIN steps s ON s.nr = f.nr AND s.lvl = f.lvl WHERE f.lvl < c.height),
proofs AS (
    SELECT l.nr, sha256(coalesce(string_agg(s.digest, '' ORDER BY s.lvl), '')) AS proof_sha256
    FROM leaves l LEFT JOIN steps s USING (nr) GROUP BY l.nr)
SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, p.proof_sha256, f.own AS folded_root, f.own = r.digest AS verified
FROM leaves l JOIN subroots s USING (g) JOIN proofs p USING (nr) JOIN climbs c USING (nr)
JOIN fold f ON f.nr = l.nr AND f.lvl = c.height JOIN tops r ON r.n = 1
"""

ORACLES["op12_secret_scan"] = r"""
WITH patterns(rank, kind, pattern, grp, least) AS (VALUES
    (0, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    (1, 'access', 'AKIA[A-Z0-9]{16,}', 0, 20), (2, 'hex', '[0-9a-f]{24,}', 0, 24), (3, 'random', '[A-Za-z0-9+/_=-]{16,}', 0, 16)),
d AS (SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS text FROM documents),
m AS (
    SELECT nr, text, rank, kind, least, grp, regexp_extract_all(text, pattern) AS matches,
           regexp_split_to_array(text, pattern) AS pieces, pattern
    FROM d, patterns),
e AS (
    SELECT nr, rank, kind, least, unnest(matches) AS match, unnest(range(1, len(matches) + 1)) AS i, pieces, matches, grp, pattern
    FROM m),
s AS (
    SELECT nr, rank, kind, least, match, CASE WHEN grp = 2 THEN regexp_extract(match, pattern, 2) ELSE match END AS value,
           sum(length(pieces[i]) + length(match)) OVER (PARTITION BY nr, rank ORDER BY i) AS stop
    FROM e),
spans AS (
    SELECT nr, rank, kind, value, (stop - length(match))::BIGINT AS start, stop::BIGINT AS stop
    FROM s WHERE length(value) >= least),
base AS (SELECT * FROM spans WHERE rank < 3),
runs AS (
    SELECT * FROM spans r WHERE rank = 3
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.nr = r.nr AND b.start < r.stop AND r.start < b.stop)),
labelled AS (
    SELECT DISTINCT value, true AS random FROM base WHERE length(value) >= 16
    UNION ALL SELECT DISTINCT value, false FROM runs),
pairs AS (SELECT random, value, unnest(range(1, length(value))) AS i FROM labelled),
counted AS (
    SELECT random, ascii(substr(value, i, 1)) AS a, ascii(substr(value, i + 1, 1)) AS b, count(*) AS n FROM pairs GROUP BY ALL),
heads AS (SELECT random, a, sum(n)::BIGINT AS n FROM counted GROUP BY ALL),
tails AS (SELECT random, b, sum(n)::BIGINT AS n FROM counted GROUP BY ALL),
whole AS (SELECT (coalesce(sum(n) FILTER (random), 0))::BIGINT AS n1, (coalesce(sum(n) FILTER (NOT random), 0))::BIGINT AS n0 FROM counted),
judged AS (
    SELECT r.nr, r.start, r.stop, sum(floor(1000 * ln(
               ((coalesce(n1.n, 0) + 80 * ((coalesce(t1.n, 0) + 1)::DOUBLE / (whole.n1 + 80))) / (coalesce(h1.n, 0) + 80))
               / ((n0.n - 1 + 80 * (t0.n::DOUBLE / (whole.n0 - 1 + 80))) / (h0.n - 1 + 80))))) AS ratio
    FROM whole, (SELECT *, unnest(range(1, length(value))) AS i FROM runs) r
    LEFT JOIN tails t1 ON t1.random AND t1.b = ascii(substr(r.value, r.i + 1, 1))
    LEFT JOIN tails t0 ON NOT t0.random AND t0.b = ascii(substr(r.value, r.i + 1, 1))
    LEFT JOIN counted n1 ON n1.random AND n1.a = ascii(substr(r.value, r.i, 1)) AND n1.b = ascii(substr(r.value, r.i + 1, 1))
    LEFT JOIN counted n0 ON NOT n0.random AND n0.a = ascii(substr(r.value, r.i, 1)) AND n0.b = ascii(substr(r.value, r.i + 1, 1))
    LEFT JOIN heads h1 ON h1.random AND h1.a = ascii(substr(r.value, r.i, 1))
    LEFT JOIN heads h0 ON NOT h0.random AND h0.a = ascii(substr(r.value, r.i, 1))
    GROUP BY ALL),
every AS (
    SELECT nr, rank, kind, start, stop FROM base
    UNION ALL SELECT nr, 3, 'random', start, stop FROM judged
    WHERE ratio >= 6908 AND (SELECT count(DISTINCT random) FROM counted) = 2),
lists AS (
    SELECT nr, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
           count(*) FILTER (rank = 2) AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
    FROM every GROUP BY nr)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(l.base, '')) AS base_sha256, coalesce(l.spans, '') AS spans
FROM d LEFT JOIN lists l USING (nr)
"""

ORACLES["op13_ranked_search"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
t AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_total FROM d WHERE len(terms) > 0),
q AS (
    SELECT DISTINCT item_id, text, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
    FROM benchmark),
p AS (
    SELECT nr, term, count(*) AS tf FROM (SELECT nr, unnest(terms) AS term FROM d)
    WHERE term IN (SELECT term FROM q) GROUP BY nr, term),
w AS (
    SELECT term, floor(1000 * ln((2 * (SELECT n_docs FROM t) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM p GROUP BY term),
scored AS (
    SELECT q.item_id, q.text, p.nr, d.doc_id,
           sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 90 + (90 * len(d.terms) * t.n_docs) // t.n_total))))::BIGINT AS score
    FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (nr), t GROUP BY ALL),
ranked AS (
    SELECT item_id, (row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
