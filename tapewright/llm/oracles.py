"""The queries that SQL can express, as DuckDB SQL."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = (
    r"coalesce(regexp_extract_all("
    + LOWER
    + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []::VARCHAR[])"
)

def _units(x: str) -> str:
    return f"CAST(round(ln({x}) * 1048576) AS BIGINT)"


LM_SCORES = f"""
WITH doc AS (
    SELECT row_number() OVER () AS text_id, doc_id, {WORDS.format("text")} AS ws FROM documents
), place AS (
    SELECT text_id, CASE WHEN i = 1 THEN '' ELSE ws[i - 1] END AS v, ws[i] AS w
    FROM (SELECT text_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM doc)
), own_pair AS (
    SELECT text_id, v, w, count(*) AS n FROM place GROUP BY ALL
), own_word AS (
    SELECT text_id, w, count(*) AS n FROM place GROUP BY ALL
    UNION ALL SELECT text_id, '', 1 FROM doc WHERE len(ws) > 0
), all_pair AS (
    SELECT v, w, sum(n) AS n FROM own_pair GROUP BY ALL
), all_word AS (
    SELECT w, sum(n) AS n FROM own_word GROUP BY ALL
), scored AS (
    SELECT text_id, sum(p.n * CASE
        WHEN ap.n > p.n THEN {_units("ap.n - p.n")} - {_units("av.n - ov.n")}
        ELSE {_units("0.4")} - {_units("greatest((SELECT count(*) FROM place) - len(doc.ws), 1)")}
             + CASE WHEN aw.n > ow.n THEN {_units("aw.n - ow.n")} ELSE {_units("0.5")} END
        END) AS units
    FROM own_pair AS p JOIN doc USING (text_id)
    JOIN all_pair AS ap ON ap.v = p.v AND ap.w = p.w
    JOIN all_word AS av ON av.w = p.v
    JOIN own_word AS ov ON ov.text_id = p.text_id AND ov.w = p.v
    JOIN all_word AS aw ON aw.w = p.w
    JOIN own_word AS ow ON ow.text_id = p.text_id AND ow.w = p.w
    GROUP BY text_id
)
SELECT doc_id, CAST(sum(len(ws)) AS BIGINT) AS n_words,
       CASE WHEN sum(len(ws)) > 0
            THEN CAST(sum(units) AS DOUBLE) / (1048576.0::DOUBLE * sum(len(ws))) END AS score
FROM doc LEFT JOIN scored USING (text_id) WHERE doc_id IS NOT NULL GROUP BY doc_id
"""

DECONTAMINATION = f"""
WITH item AS (
    SELECT item_id, {WORDS.format("text")} AS ws FROM benchmark
), pattern AS (
    SELECT DISTINCT item_id, least(13, len(ws)) AS n,
           array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS pat
    FROM (SELECT item_id, ws, unnest(range(1, greatest(2, len(ws) - 11))) AS i
          FROM item WHERE len(ws) > 0)
), doc AS (
    SELECT doc_id, {WORDS.format("text")} AS ws FROM documents
), place AS (
    SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM doc
), found AS (
    SELECT doc_id, i, size.n, item_id
    FROM place CROSS JOIN (SELECT DISTINCT n FROM pattern) AS size
    JOIN pattern ON pattern.n = size.n AND i + size.n - 1 <= len(ws)
                AND pat = array_to_string(ws[i:i + size.n - 1], ' ')
), hit AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM found GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

URL_FILTER = f"""
WITH rules(verdict, rule_host, rule_path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
           ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0
           THEN regexp_extract(url[strpos(url, '://') + 3:], '^[^?#]*') ELSE '' END AS r
    FROM pages
), part AS (
    SELECT page_id, {LOWER.format("regexp_extract(r, '^[^/]*')")} AS host,
           CASE WHEN strpos(r, '/') > 0 THEN r[strpos(r, '/'):] ELSE '' END AS path
    FROM rest
)
SELECT page_id, host, path,
       arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(arg_max(verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM part LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""


JACCARD = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")},
           '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i
          FROM doc WHERE len(ws) > 0)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), overlap AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
    FROM shingle AS a JOIN shingle AS b ON a.g = b.g AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
), link AS (
    SELECT x, y FROM overlap
    JOIN size AS s ON s.doc_id = x JOIN size AS t ON t.doc_id = y
    WHERE 100 * n_both >= 75 * (s.n + t.n - n_both)
), near AS (
    SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach(doc_id, seen) AS (
    SELECT DISTINCT x, x FROM near
    UNION
    SELECT reach.doc_id, near.y FROM reach JOIN near ON near.x = reach.seen
)
SELECT doc.doc_id, coalesce(size.n, 0) AS n_shingles,
       coalesce((SELECT min(seen) FROM reach WHERE reach.doc_id = doc.doc_id), doc.doc_id)
           AS component_id
FROM doc LEFT JOIN size USING (doc_id)
"""


_WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0"


def _assignment(round_: int) -> str:
    """The distances to the centroids of a round, and each vector's nearest."""
    return f"""far{round_} AS (
    SELECT row_id, c, sum((comp.x - m.x) * (comp.x - m.x)) AS distance
    FROM comp JOIN mean{round_} AS m USING (i) GROUP BY row_id, c
), own{round_} AS (
    SELECT row_id, arg_min(c, (distance, c)) AS c, min(distance) AS distance
    FROM far{round_} GROUP BY row_id
)"""


def _update(round_: int) -> str:
    """The means of a round's clusters, rounded down; an empty cluster stays."""
    return f"""mean{round_ + 1} AS (
    SELECT c, i, coalesce((total - ((total % n) + n) % n) // n, m.x) AS x
    FROM mean{round_} AS m LEFT JOIN (
        SELECT c, i, sum(x) AS total, count(*) AS n
        FROM comp JOIN own{round_} USING (row_id) GROUP BY c, i
    ) USING (c, i)
)"""


CENTROID_CLUSTERS = f"""
WITH kept AS (
    SELECT row_number() OVER () AS row_id, vec_id,
           list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS HUGEINT)) AS x
    FROM embeddings WHERE {_WHOLE} AND len(embedding) = 64
), comp AS (
    SELECT row_id, unnest(range(1, 65)) AS i, unnest(x) AS x FROM kept
), mean0 AS (
    SELECT c, i, x FROM comp JOIN (
        SELECT row_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM kept
        WHERE vec_id IS NOT NULL QUALIFY c < 16
    ) USING (row_id)
), {", ".join(f"{_assignment(r)}, {_update(r)}" for r in range(3))}, {_assignment(3)}, named AS (
    SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
    FROM mean3 GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM own3 JOIN kept USING (row_id) JOIN named USING (c)
"""

HARD_NEGATIVES = f"""
WITH kept AS (
    SELECT DISTINCT vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
    FROM embeddings
    WHERE {_WHOLE} AND len(embedding) > 0 AND label IS NOT NULL AND vec_id IS NOT NULL
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
    FROM kept AS a JOIN kept AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
), positive AS (
    SELECT anchor_id, vec_id, score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER)
           AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive AS p JOIN scored AS n USING (anchor_id)
WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_lm_scores": LM_SCORES,
        "op3_decontamination": DECONTAMINATION,
        "op4_url_filter": URL_FILTER,
        "op6_jaccard_join": JACCARD,
        "op12_centroid_clusters": CENTROID_CLUSTERS,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
