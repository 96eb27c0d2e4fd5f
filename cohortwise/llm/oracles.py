"""The same results in SQL, for the operators that SQL can express."""

# the exponent of a repetition limit has a closed form: (largest / smallest) ** (1 - a) = limit
_MIX = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens FROM documents
), totals AS (
    SELECT source, count(*) AS n, sum(tokens)::BIGINT AS source_tokens FROM sized GROUP BY source
), ends AS (
    SELECT sum(source_tokens)::DOUBLE AS everything, max(source_tokens)::DOUBLE AS hi,
        min(source_tokens) FILTER (source_tokens > 0)::DOUBLE AS lo FROM totals
), exponent AS (
    SELECT *, CASE WHEN hi <= 2 * lo THEN 0.0 ELSE 1 - ln(2) / ln(hi / lo) END AS a FROM ends
), planned AS (
    SELECT source, n, source_tokens,
        CASE WHEN source_tokens > 0 THEN round(pow(source_tokens / hi, a - 1), 6) ELSE 1.0 END AS epochs
    FROM totals, exponent
), passes AS (
    SELECT *, floor(epochs)::INT AS whole, round((epochs - floor(epochs)) * source_tokens)::BIGINT AS rest FROM planned
), copies AS (
    SELECT s.doc_id, s.source, s.tokens, p.source_tokens, p.whole, p.rest, unnest(range(1, p.whole + 1 + (p.rest > 0)::INT)) AS pass
    FROM sized s JOIN passes p ON s.source IS NOT DISTINCT FROM p.source
), placed AS (
    SELECT *, ('0x' || substr(md5(doc_id::VARCHAR || ':' || pass::VARCHAR), 1, 15))::BIGINT AS place FROM copies
), ran AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source, pass ORDER BY place, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM placed
), taken AS (
    SELECT * FROM ran WHERE pass <= whole OR before < rest
), spread AS (
    SELECT *, sum(tokens) OVER (PARTITION BY source)::DOUBLE AS own, greatest(1, ceil(sum(tokens) OVER () / 1000000.0)) AS blocks FROM taken
), blocked AS (
    SELECT *, least(floor(((pass - 1) * source_tokens + before)::DOUBLE / greatest(own, 1) * blocks), blocks - 1)::BIGINT AS block FROM spread
)
SELECT doc_id, source, tokens, pass::INT AS pass, block,
    row_number() OVER (PARTITION BY block ORDER BY
        ('0x' || substr(md5(doc_id::VARCHAR || ':' || block::VARCHAR || '.' || pass::VARCHAR), 1, 15))::BIGINT, doc_id, pass) - 1 AS position
FROM blocked
"""

_NEAR = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
        ELSE array_to_string(list_slice(w, i, i + 3), ' ') END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS h FROM shingles GROUP BY doc_id),
reps AS (SELECT h, min(doc_id) AS rep FROM sets GROUP BY h),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
    FROM shingles a JOIN shingles b USING (s)
    WHERE a.doc_id < b.doc_id AND a.doc_id IN (SELECT rep FROM reps) AND b.doc_id IN (SELECT rep FROM reps)
    GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * k >= 80 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, root) AS (
    SELECT rep, rep FROM reps
    UNION
    SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.id WHERE r.root < e.b
), roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id,
    coalesce(r.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes n USING (doc_id) LEFT JOIN sets s USING (doc_id)
LEFT JOIN reps p ON p.h = s.h LEFT JOIN roots r ON r.id = p.rep
"""

_SUBSTRINGS = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
), firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
cut AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (s) WHERE first < doc_id
), flat AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM flat ANTI JOIN cut USING (doc_id, i) GROUP BY doc_id
), lost AS (SELECT doc_id, count(*) AS n FROM cut GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_TOP_K = """
WITH rows AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a short ASCII string, bit by bit."""
    step = f"xor(c >> 1, xor(c & 1, (ascii(({text})[i // 8 + 1]) >> (i % 8)) & 1) * 3988292384)"
    steps = f"list_prepend(4294967295::BIGINT, range(8 * length({text})))"
    return f"xor(list_reduce({steps}, lambda c, i: {step}), 4294967295::BIGINT)"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    fields = [f"{c}::VARCHAR" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


_MANIFEST = rf"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, coalesce(':' || lang, '-') AS grp, {_leaf("text")} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(_LOWER)} END AS changed
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM leaves
), low(grp, level, pos, n, node) AS (
    SELECT grp, 0, pos, n, leaf FROM placed
    UNION ALL
    SELECT grp, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY grp, level, pos // 8, n
), tops AS (
    SELECT grp, node AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1
), high(level, pos, n, node) AS (
    SELECT 0, pos, n, subroot FROM tops
    UNION ALL
    SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // 8, n
), root AS (SELECT node AS root FROM high WHERE n = 1),
steps AS (
    SELECT p.grp, p.pos AS own, l.level, l.pos, l.node FROM placed p JOIN low l ON l.grp = p.grp AND l.n > 1 AND l.pos // 8 = (p.pos // (8 ** l.level)::BIGINT) // 8
    UNION ALL
    SELECT p.grp, p.pos, 1000 + h.level, h.pos, h.node FROM placed p JOIN tops t USING (grp) JOIN high h ON h.n > 1 AND h.pos // 8 = (t.pos // (8 ** h.level)::BIGINT) // 8
), sides AS (
    SELECT s.grp, s.own, s.level,
        coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos < m.me), '') AS l, coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos > m.me), '') AS r
    FROM steps s JOIN tops t USING (grp), LATERAL (SELECT CASE WHEN s.level < 1000 THEN s.own // (8 ** s.level)::BIGINT ELSE t.pos // (8 ** (s.level - 1000))::BIGINT END AS me) m
    GROUP BY s.grp, s.own, s.level
), paths AS (
    SELECT grp, own, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, list({{'l': l, 'r': r}} ORDER BY level) AS path FROM sides GROUP BY grp, own
), folds(grp, own, path, node, step) AS (
    SELECT p.grp, p.pos, path, coalesce(changed, leaf), 1 FROM placed p LEFT JOIN paths q ON q.grp = p.grp AND q.own = p.pos
    UNION ALL
    SELECT grp, own, path, sha256(path[step].l || node || path[step].r), step + 1 FROM folds WHERE step <= len(path)
)
SELECT p.doc_id, p.leaf, t.subroot, r.root, coalesce(q.proof, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = r.root AS verified
FROM placed p JOIN tops t USING (grp) CROSS JOIN root r LEFT JOIN paths q ON q.grp = p.grp AND q.own = p.pos
JOIN folds f ON f.grp = p.grp AND f.own = p.pos AND f.step = coalesce(len(f.path), 0) + 1
"""

_PREFIXES = rf"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), original AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY pos) AS t FROM turns GROUP BY conv_id
), shared AS (
    SELECT conv_id, t, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM original
), rebuilt AS (
    SELECT s.conv_id, list_concat(coalesce(list_slice(o.t, 1, s.h), []), list_slice(s.t, s.h + 1, len(s.t))) AS t
    FROM shared s LEFT JOIN original o ON o.conv_id = s.conv_id - s.conv_id % 20
), steps AS (
    SELECT conv_id, d, len(t) AS size, list_slice(t, 1, d) AS prefix, t[d].text AS last FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT prefix, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(len(regexp_extract_all(any_value(last), '[^\x20\x09-\x0D]+')), 0) AS words,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
    FROM steps GROUP BY prefix, d
), family AS (
    SELECT p.prefix, count(*) FILTER (c.depth = p.depth + 1) AS n_children, sum((c.n_convs - 1) * c.words)::BIGINT AS saved_tokens, list(c.prefix) AS below
    FROM nodes p JOIN nodes c ON c.depth >= p.depth AND list_slice(c.prefix, 1, p.depth) = p.prefix GROUP BY p.prefix
), leaves AS (
    SELECT f.prefix, count(*) FILTER (g.n_children = 0) AS n_leaves
    FROM (SELECT prefix, unnest(below) AS b FROM family) f JOIN family g ON g.prefix = f.b GROUP BY f.prefix
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, f.n_children, l.n_leaves, f.saved_tokens, n.ends_sha256
FROM nodes n JOIN family f ON f.prefix = n.prefix JOIN leaves l ON l.prefix = n.prefix
LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.prefix = list_slice(n.prefix, 1, n.depth - 1)
"""

ORACLES = {
    "op1_mix": _MIX, "op4_near_duplicates": _NEAR, "op7_substrings": _SUBSTRINGS, "op8_top_k": _TOP_K,
    "op11_prefix_trie": _PREFIXES, "op12_manifest": _MANIFEST,
}
