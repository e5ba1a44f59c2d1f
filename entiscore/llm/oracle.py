"""DuckDB SQL for the operators SQL can express."""

from __future__ import annotations

_WORDS = r"[x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"

LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents
), wins AS (
  SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS p FROM lines WHERE len(ls) >= 3
), named AS (
  SELECT doc_id, p, ls[p : p + 2] AS w FROM wins
  WHERE regexp_matches(ls[p] || ls[p + 1] || ls[p + 2], '[^\\x20\\x09-\\x0D]')
), later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS nth FROM named)
  WHERE nth > 1
), covered AS (
  SELECT DISTINCT doc_id, p + k AS p FROM later, (SELECT unnest([0, 1, 2]) AS k)
), gone AS (
  SELECT doc_id, list(p) AS ps FROM covered GROUP BY doc_id
), kept AS (
  SELECT l.doc_id, l.ls, coalesce(len(g.ps), 0) AS n_removed,
         CASE WHEN g.ps IS NULL THEN l.ls
              ELSE [l.ls[i] FOR i IN range(1, len(l.ls) + 1) IF NOT list_contains(g.ps, i)] END AS ks
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id
)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, n_removed::BIGINT AS n_removed,
       CASE WHEN ls IS NULL THEN NULL ELSE sha256(array_to_string(ks, chr(10))) END AS kept_sha256
FROM kept
"""

QUALITY_RULES = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM base
), wins AS (
  SELECT doc_id, p, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words
  WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), twice AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS n FROM wins WHERE w3 IS NOT NULL) WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), m AS (
  SELECT b.doc_id, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len([x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')])
          - len(list_distinct([x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')])))::BIGINT
           AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(text, '[^\p{{L}}]', '', 'g'))::BIGINT AS n_letters
  FROM base b LEFT JOIN repeats r ON b.doc_id = r.doc_id
), bits AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 10 * word_chars THEN 4 ELSE 0 END
    + CASE WHEN n_dup_lines > 0 AND 100 * n_dup_lines > 30 * (n_words // 5) THEN 8 ELSE 0 END
    + CASE WHEN 2 * n_upper > n_letters THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) THEN 32 ELSE 0 END
    + CASE WHEN n_words > 0 AND 2 * n_letters < word_chars THEN 64 ELSE 0 END)::BIGINT AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed, n_upper, n_letters FROM bits
"""

SUBSTRING_DEDUP = rf"""
WITH w AS (
  SELECT doc_id, {_WORDS} AS ws FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(ws) - 48)) AS p FROM w WHERE len(ws) >= 50
), win AS (
  SELECT a.doc_id, a.p, md5(array_to_string(w.ws[a.p : a.p + 49], ' ')) AS k FROM starts a JOIN w ON a.doc_id = w.doc_id
), late AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS first FROM win) WHERE doc_id > first
), gone AS (
  SELECT doc_id, list(DISTINCT q) AS qs FROM (SELECT doc_id, unnest(range(p, p + 50)) AS q FROM late) GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, w.ws, coalesce(len(g.qs), 0) AS n_removed, CASE WHEN g.qs IS NULL THEN w.ws ELSE
           [w.ws[i] FOR i IN range(1, len(w.ws) + 1) IF NOT list_contains(g.qs, i)] END AS ks
  FROM w LEFT JOIN gone g ON w.doc_id = g.doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(ks, ' ')) AS kept_sha256 FROM kept
"""

_JACCARD_EDGES = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(g) AS g FROM (
    SELECT doc_id, unnest([array_to_string(ws[i : i + 3], ' ') FOR i IN range(1, greatest(len(ws) - 2, 2))]) AS g
    FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link
)"""

JACCARD_JOIN = _JACCARD_EDGES + r""", reach(a, b) AS (
  SELECT DISTINCT a, a FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a
), least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(l.c, w.doc_id) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least l ON w.doc_id = l.a
"""

JACCARD_LINKS = _JACCARD_EDGES + r""", links AS (SELECT a, count(*) AS m FROM edge GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(l.m, 0)::BIGINT AS n_links
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN links l ON w.doc_id = l.a
"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2))::INT AS cell FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source
), w AS (
  SELECT *, ([5, 2, 1])[(nth % 3 + 1)::INT] AS w, 2 * source_size AS cap,
         sum(source_size) OVER ()::DOUBLE * 150 / 100 AS total FROM src
), lv AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, nth
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / sum(w) OVER (ORDER BY cap / w, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lv FROM w
), t AS (
  SELECT source, source_size, cap::DOUBLE AS cap, w, max(CASE WHEN cap > lv * w THEN lv END) OVER () AS best FROM lv
), targets AS (
  SELECT source, source_size, CASE WHEN best IS NULL THEN cap ELSE least(cap, best * w) END AS target FROM t
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS e,
         ('0x' || substr(md5('mix:' || coalesce(d.source, '')), 1, 4))::INT / 65536.0::DOUBLE AS u,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.cell, d.doc_id NULLS FIRST) AS i
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, (floor(e * i + u) - floor(e * (i - 1) + u))::BIGINT AS copies FROM r
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""


# crc32 by half bytes; the table of 16 remainders follows from the polynomial 0xEDB88320
SPELLING_VARIANTS = r"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i::UBIGINT FROM (SELECT unnest(range(16)) AS i)
  UNION ALL SELECT i, k + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::UBIGINT ELSE 0 END) FROM bits WHERE k < 4
), tab AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 4
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), own AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x
  FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
), crc(doc_id, run, n, x, v, p) AS (
  SELECT doc_id, run, n, x, 4294967295::UBIGINT, 1 FROM own
  UNION ALL
  SELECT doc_id, run, n, x, xor(u >> 4, t[((xor(u, h) & 15) + 1)::BIGINT]), p + 2 FROM (
    SELECT doc_id, run, n, x, p, ('0x' || substr(x, p, 1))::UBIGINT AS h, t,
           xor(v >> 4, t[((xor(v, ('0x' || substr(x, p + 1, 1))::UBIGINT) & 15) + 1)::BIGINT]) AS u
    FROM crc, tab WHERE p < length(x))
), h AS (SELECT run, n, xor(v, 4294967295::UBIGINT) AS h FROM crc WHERE p > length(x)
), w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
              ELSE run END AS word, n FROM h
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), gone AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || '_' || substr(word, i + 2) AS k, substr(word, 1, i) || substr(word, i + 2) AS less
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b, b.n FROM gone a JOIN gone b ON a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gone a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM gone a JOIN words b ON a.less = b.word
), best AS (
  SELECT a, count(*)::BIGINT AS n_near, max(n) AS n FROM near GROUP BY a
), form AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
         CASE WHEN b.n >= 10 * w.n THEN (SELECT min(x.b) FROM near x WHERE x.a = w.word AND x.n = b.n) END AS form,
         CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.a
), steps(word, here, k) AS (
  SELECT word, word, 0 FROM form UNION ALL SELECT f.word, x.form, k + 1 FROM steps f JOIN form x ON f.here = x.word AND x.form IS NOT NULL
), root AS (SELECT word, arg_max(here, k) AS root FROM steps GROUP BY word)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.root FROM form f JOIN root r ON f.word = r.word
"""

EXACT_TOP_K = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

SOURCE_DIVERGENCE = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), tf AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n FROM t GROUP BY ALL
), kept AS MATERIALIZED (SELECT lang, term FROM tf GROUP BY ALL HAVING count(*) >= 10
), vs AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d
), c AS (SELECT lang, source, term, sum(n) AS n FROM tf JOIN kept USING (lang, term) GROUP BY ALL
), cell AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
  SELECT lang, source, term, n, sum(n) OVER (PARTITION BY lang, source) AS gn,
         sum(n) OVER (PARTITION BY lang, term) AS ln, sum(n) OVER (PARTITION BY lang) AS lt FROM cell
), p AS MATERIALIZED (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)::HUGEINT) // (gn + 2 * v) AS p,
         1 + (1000000000 * (ln + 2)::HUGEINT) // (lt + 2 * v) AS q FROM sums JOIN vs USING (lang)
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), own AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own) QUALIFY part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": LINE_DEDUP,
        "op3_substring_dedup": SUBSTRING_DEDUP,
        "op4_quality_rules": QUALITY_RULES,
        "op8_mixing": MIXING,
        "op10_jaccard_join": JACCARD_JOIN,
        "jaccard_links": JACCARD_LINKS,
        "op11_spelling_variants": SPELLING_VARIANTS,
        "op12_exact_top_k": EXACT_TOP_K,
        "op13_source_divergence": SOURCE_DIVERGENCE,
    }
