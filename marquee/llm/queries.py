"""One thin query for each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import warc
from .collocations import collocations
from .decontaminate import contaminated
from .fingerprint import edit_likeness
from .frames import table
from .htmltext import extract
from .langid import predict
from .neardup import NearDup, near_duplicates
from .pieces import encode
from .suffixes import without_repeats
from .tokenfile import round_trip
from .toxicity import toxicity
from .trie import rebuilt_trie
from .urls import Rule, filter_urls

#: DuckDB SQL of the queries that SQL can express; the others learn, tokenize,
#: sketch or align, and tests/llm holds them against brute force.
SQL: dict[str, str] = {
    "op11_trie": """
WITH t AS (
  SELECT conv_id AS c, COALESCE(role, '') AS role, COALESCE(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')) AS rn
  FROM conversations WHERE conv_id IS NOT NULL),
o AS MATERIALIZED (SELECT c, list({'r': role, 't': text} ORDER BY rn) AS ts FROM t GROUP BY c),
k AS (SELECT c, ts, xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: ascii(s)::BIGINT),
        lambda crc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
          lambda v, z: xor(v >> 1, 3988292384 * (v & 1)) + z, xor(crc, b)), 4294967295::BIGINT),
        4294967295::BIGINT) % 6 AS h FROM o),
r AS MATERIALIZED (SELECT k.c, CASE WHEN b.c IS NULL THEN k.ts[k.h + 1:]
                   ELSE list_concat(b.ts[1:k.h], k.ts[k.h + 1:]) END AS ts
                   FROM k LEFT JOIN o b ON b.c = k.c - k.c % 100),
m AS (SELECT c, len(ts) AS size, depth, ts[1:depth] AS path
      FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS depth FROM r)),
n AS MATERIALIZED (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs,
         sha256(COALESCE(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = depth), '')) AS ends_sha256
  FROM m GROUP BY path, depth),
kids AS MATERIALIZED (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
u AS (SELECT n.path, n.depth, kids.path IS NULL AS leaf,
             CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.path[n.depth].t) END AS saved
      FROM n LEFT JOIN kids ON n.path = kids.path),
s AS (SELECT path[1:up] AS path, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM u) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, COALESCE(kids.n_children, 0) AS n_children,
       s.n_leaves, s.saved_tokens, n.ends_sha256
FROM n JOIN s ON s.path = n.path LEFT JOIN kids ON kids.path = n.path
LEFT JOIN n p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]""",
    "op12_suffixes": """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, encode(COALESCE(text, '')) AS b FROM documents),
s AS (SELECT row, p, md5(b[p + 1:p + 400]) AS h
      FROM (SELECT row, b, unnest(range(0, octet_length(b) - 399)) AS p FROM d)),
r AS (SELECT row, p FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
g AS (SELECT row, p, sum(CASE WHEN p > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY p) AS island
      FROM (SELECT row, p, lag(p) OVER (PARTITION BY row ORDER BY p) AS before FROM r)),
i AS MATERIALIZED (SELECT row, min(p) AS lo, max(p) + 400 AS hi FROM g GROUP BY row, island),
k AS (SELECT i.row, lo, substr(hex(b), CAST(2 * after + 1 AS BIGINT), CAST(2 * (lo - after) AS BIGINT)) AS piece,
             last, hex(b) AS x, hi
      FROM (SELECT *, COALESCE(lag(hi) OVER (PARTITION BY row ORDER BY lo), 0) AS after,
                   lead(lo) OVER (PARTITION BY row ORDER BY lo) IS NULL AS last FROM i) i JOIN d ON d.row = i.row),
t AS (SELECT row, CAST(sum(hi - lo) AS BIGINT) AS n_removed, count(*) AS n_spans FROM i GROUP BY row),
z AS (SELECT row, sha256(unhex(string_agg(piece || CASE WHEN last THEN substr(x, CAST(2 * hi + 1 AS BIGINT)) ELSE '' END,
                                          '' ORDER BY lo))) AS kept FROM k GROUP BY row)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, COALESCE(n_removed, 0) AS n_removed,
       COALESCE(n_spans, 0) AS n_spans, COALESCE(kept, sha256(b)) AS kept_sha256
FROM d LEFT JOIN t ON t.row = d.row LEFT JOIN z ON z.row = d.row""",
    "op13_collocations": r"""
WITH p AS (
  SELECT COALESCE(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
         translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM documents),
u AS (SELECT lang, unnest(ws) AS w FROM p),
f1 AS MATERIALIZED (SELECT lang, w, count(*) AS f FROM u GROUP BY lang, w),
f2 AS MATERIALIZED (SELECT lang, g[1] AS x, g[2] AS y, count(*) AS f FROM
  (SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i:i + 1])) AS g FROM p) GROUP BY ALL),
f3 AS MATERIALIZED (SELECT lang, g[1] AS x, g[2] AS y, g[3] AS z, count(*) AS f FROM
  (SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])) AS g FROM p)
  GROUP BY ALL HAVING count(*) >= 10),
longer AS (SELECT lang, x, y, max(f) AS f FROM (
  SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, 1 AS k, f2.f AS a, l.f AS l, r.f AS r
  FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.w = f2.x JOIN f1 r ON r.lang = f2.lang AND r.w = f2.y
  LEFT JOIN longer g ON g.lang = f2.lang AND g.x = f2.x AND g.y = f2.y
  WHERE f2.f >= 10 AND (g.f IS NULL OR 100 * g.f < 50 * f2.f)
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, 1, f3.f, l.f, r.f
  FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.w = f3.x
  JOIN f2 r ON r.lang = f3.lang AND r.x = f3.y AND r.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, 2, f3.f, l.f, r.f
  FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.x = f3.x AND l.y = f3.y
  JOIN f1 r ON r.lang = f3.lang AND r.w = f3.z),
scored AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       (SELECT CAST(sum(f) AS BIGINT) FROM f1 WHERE f1.lang = ranked.lang) AS n, score
FROM ranked WHERE rank <= 2000""",
    "op5_warc": """
WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha256(p.h) AS payload_digest,
       CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to, TRUE AS intact
FROM p LEFT JOIN f ON p.h = f.h""",
    "op8_neardup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct(list_transform(range(1, len(ws) - 2),
                                               lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM w),
e AS MATERIALIZED (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS MATERIALIZED (SELECT p.a, p.b FROM p JOIN s t ON p.a = t.doc_id JOIN s u ON p.b = u.doc_id
      WHERE 100 * p.c >= 80 * (len(t.sh) + len(u.sh) - p.c)),
r AS (SELECT doc_id, doc_id AS seen FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.seen = l.a)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM s JOIN (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id) m ON s.doc_id = m.doc_id""",
}


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearDup(shingle=4))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


#: The rules of the registered query.
URL_RULES = [Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"),
             Rule("com/fr/", "allow"), Rule("com/de/", "block")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
