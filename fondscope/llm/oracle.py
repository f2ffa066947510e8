"""DuckDB SQL for the results of the operators that it can express: plain all-pairs versions, for small tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
#: The distinct five-word shingles of a list of words `w`; of fewer words, all of them as one.
_SHINGLES = "CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) END"

NGRAM_JOIN = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
sets AS (SELECT doc_id, {_SHINGLES} AS s FROM words),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id FROM sets s JOIN least l ON l.doc_id = s.doc_id
"""

LINE_DEDUP = f"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS k FROM split),
words AS (SELECT doc_id, k, {_WORDS.format("line")} AS w FROM lines),
sets AS (SELECT doc_id, k, list_sort({_SHINGLES}) AS s FROM words WHERE len(w) > 0),
classes AS (SELECT row_number() OVER () AS c, s, first FROM (SELECT s, min((doc_id, k)) AS first FROM sets GROUP BY s)),
each AS (SELECT c, first, len(s) AS n, unnest(s) AS x FROM classes),
late AS (
    SELECT DISTINCT a.c FROM each a JOIN each b ON a.x = b.x AND b.first < a.first
    GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
gone AS (
    SELECT s.doc_id, list(s.k) AS ks FROM sets s JOIN classes c ON c.s = s.s
    WHERE (s.doc_id, s.k) <> c.first OR c.c IN (SELECT c FROM late) GROUP BY s.doc_id)
SELECT t.doc_id,
    CASE WHEN g.ks IS NULL THEN t.text ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(t.ls) + 1), lambda k: NOT list_contains(g.ks, k)), lambda k: t.ls[k]), chr(10)), '') END AS text,
    CAST(coalesce(len(t.ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(g.ks), 0) AS BIGINT) AS n_removed
FROM split t LEFT JOIN gone g ON g.doc_id = t.doc_id
"""

TOP_K = f"""
WITH words AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE doc_id IS NOT NULL),
sizes AS (SELECT doc_id, len(w) AS size, avg(len(w)) OVER () AS average, count(*) OVER () AS n FROM words),
terms AS (SELECT doc_id, x, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS x FROM words) GROUP BY doc_id, x),
idf AS (SELECT x, ln(1 + ((SELECT max(n) FROM sizes) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM terms GROUP BY x),
scores AS (
    SELECT q.doc_id AS query_id, d.doc_id, round(sum(q.tf * i.idf * d.tf * 2.2::DOUBLE / (d.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * s.size / s.average))), 6) AS score
    FROM terms q JOIN terms d ON d.x = q.x JOIN idf i ON i.x = q.x JOIN sizes s ON s.doc_id = d.doc_id
    WHERE q.doc_id % 20 = 0 GROUP BY q.doc_id, d.doc_id)
SELECT query_id, doc_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INT) AS rank, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
each AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda k: array_to_string(w[k:k + m - 1], ' '))) AS phrase FROM words, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE len(w) >= m),
counts AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f FROM (SELECT lang, m, phrase, count(*) AS f FROM each GROUP BY ALL) WHERE f >= 30),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
longer AS (
    SELECT lang, phrase, max(f) AS f FROM (
        SELECT lang, f, unnest(flatten(list_transform(range(2, m), lambda j: list_transform(range(1, m - j + 2), lambda k: array_to_string(w[k:k + j - 1], ' '))))) AS phrase FROM counts WHERE m >= 3)
    GROUP BY ALL),
kept AS (SELECT c.* FROM counts c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase WHERE c.m >= 2 AND (g.f IS NULL OR 100::HUGEINT * g.f < 80::HUGEINT * c.f)),
cuts AS (SELECT lang, phrase, w, m, f AS a, unnest(range(1, m)) AS k FROM kept),
scores AS (
    SELECT x.lang, x.phrase, x.a, x.k, b.f AS l, c.f AS r, CAST(2000000::HUGEINT * x.a // (b.f + c.f) AS BIGINT) AS score
    FROM cuts x JOIN counts b ON b.lang = x.lang AND b.phrase = array_to_string(x.w[1:x.k], ' ') JOIN counts c ON c.lang = x.lang AND c.phrase = array_to_string(x.w[x.k + 1:x.m], ' ')),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM best JOIN totals USING (lang) QUALIFY rank <= 2000
"""


def _rounds(k: int = 40, rounds: int = 5) -> str:
    """k-means over all pairs of vectors and centroids, a few tables for each round."""
    parts = [
        "v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS k, x AS c FROM (SELECT x, sha256('2:' || CAST(vec_id AS VARCHAR)) AS h FROM v WHERE vec_id IS NOT NULL ORDER BY h LIMIT {k}))",
    ]
    for t in range(rounds + 1):
        parts.append(f"d{t} AS (SELECT vec_id, x, k, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{t})")
        parts.append(f"a{t} AS (SELECT vec_id, any_value(x) AS x, arg_min(k, (d, k)) AS k, min(d) AS d FROM d{t} GROUP BY vec_id)")
        if t < rounds:
            parts.append(f"s{t} AS (SELECT k, i, sum(e) AS s, count(*) AS n FROM (SELECT k, unnest(x) AS e, unnest(range(1, 65)) AS i FROM a{t}) GROUP BY k, i)")
            parts.append(f"m{t} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{t} GROUP BY k)")
            parts.append(f"c{t + 1} AS (SELECT c{t}.k, coalesce(m{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{t} ON m{t}.k = c{t}.k)")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(a.k AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.k = a.k"""


SQL = {"op11_centroid_clustering": _rounds(), "op13_phrase_collocations": COLLOCATIONS, "op5_ngram_jaccard_join": NGRAM_JOIN, "op7_exact_topk_search": TOP_K, "op9_line_dedup": LINE_DEDUP}
