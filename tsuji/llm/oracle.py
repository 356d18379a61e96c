"""DuckDB SQL of those training-data queries that SQL can express.

The others rest on brute-force tests: learned models (1, 3, 9), a shuffle by Spark's hash (2), a
tokenizer (5, 13), an HTML parser (6), an approximate search (8), checksums of ids (11), and the pipeline
made of them.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# all pairs that share a shingle, then the closure of the links
PARTENUM = rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') words FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + 4], ' ') END s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) c FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id x, b.doc_id y, count(*) c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common.c >= 80 * (p.c + q.c - common.c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id a, doc_id b FROM w UNION SELECT reach.a, edge.y FROM reach JOIN edge ON edge.x = reach.b)
SELECT doc_id, coalesce(n.c, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM reach WHERE a = w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)"""

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') html, sha1(coalesce(html, '')) h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) holder FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
    (1 + ((('0x' || substr(h, (1 + 10 * (i // 8))::BIGINT, 10))::BIGINT >> (35 - 5 * (i % 8))::BIGINT) & 31))::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM g"""

VORONOI = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT score
  FROM (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 100 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) rank FROM s) WHERE rank <= 10"""

# every order's steps straight from the documents' failure masks
FILTER_AUDIT = r"""WITH t AS (
  SELECT doc_id, coalesce(source, '') part, coalesce(text, '') x,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
lab AS (SELECT doc_id, max((quality = 1)::INT) good, max((toxic = 1)::INT) toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) good, coalesce(toxic, 0) toxic,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x))::INT
    + 8 * regexp_matches(x, '[#$%&*|]')::INT
    + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY x), false)::INT mask
  FROM t LEFT JOIN lab ON lab.doc_id = t.doc_id),
m AS (SELECT part, mask, count(*) n, sum(good) good, sum(toxic) toxic FROM f GROUP BY ALL),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) x, unnest([1, 2, 4, 8, 16]) v),
o AS (SELECT p.x || q.x || r.x || s.x || u.x filter_order, [p.v, q.v, r.v, s.v, u.v] vs
  FROM b p, b q, b r, b s, b u WHERE p.v + q.v + r.v + s.v + u.v = 31 AND p.v | q.v | r.v | s.v | u.v = 31),
st AS (SELECT filter_order, step, vs[step] own, coalesce(list_sum(vs[1:step - 1]), 0)::INT earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) step)),
g AS (SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (mask & (earlier | own) = 0), 0) kept,
    coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & own > 0), 0) removed,
    coalesce(sum(n) FILTER (mask & earlier > 0 AND mask & own > 0), 0) redundant,
    coalesce(sum(n) FILTER (mask = own), 0) unique_fails,
    coalesce(sum(good) FILTER (mask & earlier = 0 AND mask & own > 0), 0) good_lost,
    coalesce(sum(toxic) FILTER (mask & earlier = 0 AND mask & own > 0), 0) toxic_lost
  FROM m, st GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM g"""

ORACLES: dict[str, str] = {
    "op4_partenum": PARTENUM,
    "op7_warc": WARC,
    "op10_voronoi": VORONOI,
    "op12_filter_audit": FILTER_AUDIT,
}
