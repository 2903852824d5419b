"""The catalogue binding of :mod:`marquee.sources.star`, as DuckDB SQL.

The SQL states its own constants. Each table is a CTE over the driver's pre-registered views. ``with_catalogue``
prefixes a query with exactly the CTEs it needs (and their dependencies).
"""

from __future__ import annotations

import re

_VOCAB = """['Drama', 'Comedy', 'Romance', 'Thriller', 'Documentary', 'Action', 'Horror', 'Sci-Fi',
  'Family', 'Crime', 'Adventure', 'Animation', 'Biography', 'Fantasy', 'Film-Noir', 'Game-Show',
  'History', 'Music', 'Musical', 'Mystery', 'News', 'Reality-TV', 'Short', 'Sport', 'Talk-Show',
  'War', 'Western']"""


def _genre(i: str) -> str:
    return f"({_VOCAB})[(({i}) % 27) + 1]"


_P = "CAST(FLOOR(o.o_totalprice) AS BIGINT)"
_CATEGORY = """CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'actor' WHEN 'AO' THEN 'actress'
    WHEN 'NF' THEN 'director' WHEN 'NO' THEN 'writer' WHEN 'RF' THEN 'producer' WHEN 'RO' THEN 'actor' END"""
_YEAR = """CASE WHEN o.o_orderkey % 37 <> 0
       THEN CAST(1990 + (o.o_orderkey // 10) % 36 AS INTEGER) END"""
_BORN = "CASE WHEN pt.p_partkey % 9 <> 0 THEN CAST(1930 + pt.p_size AS INTEGER) END"

CTES: dict[str, str] = {
    "basics": f"""
SELECT 'tt' || CAST(o.o_orderkey AS VARCHAR) AS tconst,
  CASE WHEN o.o_orderkey % 10 < 5 THEN 'movie' WHEN o.o_orderkey % 10 = 5 THEN 'tvSeries'
       WHEN o.o_orderkey % 10 IN (6, 7) THEN 'tvEpisode' WHEN o.o_orderkey % 10 = 8 THEN 'videoGame'
       ELSE 'short' END AS "titleType",
  c.c_mktsegment || ' ' || CAST(o.o_custkey AS VARCHAR) AS "primaryTitle",
  o.o_orderpriority || ' ' || CAST(o.o_custkey AS VARCHAR) AS "originalTitle",
  (o.o_orderkey % 20 = 0) AS "isAdult",
  {_YEAR} AS "startYear",
  CASE WHEN o.o_orderkey % 10 = 5 AND o.o_orderstatus = 'F'
       THEN {_YEAR} + CAST({_P} % 10 AS INTEGER) END AS "endYear",
  CASE WHEN o.o_orderkey % 11 <> 0 THEN CAST(20 + {_P} % 200 AS INTEGER) END AS "runtimeMinutes",
  CASE WHEN o.o_orderkey % 13 <> 0 THEN
    ([{_genre('o.o_custkey')},
      {_genre('o.o_custkey + 1 + (o.o_orderkey // 10) % 4')},
      {_genre('o.o_custkey + 5 + (o.o_orderkey // 10) % 4')}])[1:CAST(1 + (o.o_orderkey // 7) % 3 AS INTEGER)]
  END AS genres
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "ratings": """
SELECT 'tt' || CAST(l_orderkey AS VARCHAR) AS tconst,
  CAST(10 + s % 91 AS DOUBLE) / 10.0 AS "averageRating",
  CAST((s * 7919) % 20000 AS INTEGER) AS "numVotes"
FROM (SELECT l_orderkey, CAST(SUM(CAST(FLOOR(l_extendedprice) AS BIGINT)) AS BIGINT) AS s
      FROM lineitem GROUP BY l_orderkey) x""",
    "principals": f"""
SELECT 'tt' || CAST(l_orderkey AS VARCHAR) AS tconst,
  CAST(l_linenumber AS INTEGER) AS ordering,
  'nm' || CAST(l_partkey AS VARCHAR) AS nconst,
  {_CATEGORY} AS category,
  CASE WHEN {_CATEGORY} IN ('writer', 'producer')
       THEN 'line ' || CAST(l_linenumber AS VARCHAR) END AS job,
  CASE WHEN {_CATEGORY} IN ('actor', 'actress')
       THEN '["Role ' || CAST(l_suppkey AS VARCHAR) || '"]' END AS characters
FROM lineitem""",
    "crew": """
SELECT tconst,
  CASE WHEN count(*) FILTER (WHERE category = 'director') > 0 THEN
    list_sort(list_distinct(list(nconst) FILTER (WHERE category = 'director'))) END AS directors,
  CASE WHEN count(*) FILTER (WHERE category = 'writer') > 0 THEN
    list_sort(list_distinct(list(nconst) FILTER (WHERE category = 'writer'))) END AS writers
FROM principals GROUP BY tconst""",
    "name": f"""
SELECT 'nm' || CAST(pt.p_partkey AS VARCHAR) AS nconst,
  CASE WHEN pt.p_partkey % 2 = 0 THEN pt.p_name ELSE pt.p_name || ' ' || pt.p_brand END AS "primaryName",
  {_BORN} AS "birthYear",
  CASE WHEN pt.p_size < 20
       THEN {_BORN} + CAST(60 + CAST(FLOOR(pt.p_retailprice) AS BIGINT) % 30 AS INTEGER) END AS "deathYear",
  CASE WHEN pt.p_partkey % 7 <> 0 THEN [lower(pt.p_type), lower(pt.p_brand)] END AS "primaryProfession",
  kn.known AS "knownForTitles"
FROM part pt LEFT JOIN (
  SELECT l_partkey, list_sort(list_distinct(list('tt' || CAST(l_orderkey AS VARCHAR)))) AS known
  FROM lineitem
  WHERE l_quantity >= 46 AND l_returnflag || l_linestatus IN ('AF', 'AO', 'RO')
  GROUP BY l_partkey) kn ON kn.l_partkey = pt.p_partkey""",
    "akas": """
SELECT 'tt' || CAST(l.l_orderkey AS VARCHAR) AS "titleId",
  CAST(l.l_linenumber AS INTEGER) AS ordering,
  'aka ' || s.s_name AS title,
  CASE WHEN l.l_linenumber = 7 THEN NULL WHEN n.n_nationkey = 15 THEN 'UA'
       ELSE n.n_name END AS region,
  CASE r.r_name WHEN 'EUROPE' THEN 'uk' WHEN 'ASIA' THEN 'ja' WHEN 'AMERICA' THEN 'en'
                WHEN 'MIDDLE EAST' THEN 'und' END AS language,
  CASE l.l_returnflag WHEN 'A' THEN ['alternative'] WHEN 'N' THEN ['dvd', 'festival'] END AS types,
  CASE WHEN l.l_linestatus = 'F' THEN [lower(n.n_name) || ' title', 'literal'] END AS attributes,
  (l.l_linenumber = 1) AS "isOriginalTitle"
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "episode": """
SELECT 'tt' || CAST(o.o_orderkey AS VARCHAR) AS tconst,
  'tt' || CAST((o.o_orderkey // 200) * 200 + 5 AS VARCHAR) AS "parentTconst",
  CASE WHEN o.o_orderkey % 17 <> 0 THEN CAST(1 + (o.o_orderkey // 10) % 4 AS INTEGER) END AS "seasonNumber",
  CAST((o.o_orderkey % 200) // 40 + 1 AS INTEGER) AS "episodeNumber"
FROM orders o WHERE o.o_orderkey % 10 IN (6, 7)""",
}

DEPENDS = {"crew": ("principals",)}
ORDER = ("principals", "basics", "ratings", "crew", "name", "akas", "episode")
_WORD = re.compile(r"\b(basics|ratings|principals|crew|name|akas|episode)\b")


def tables_used(sql: str) -> set[str]:
    """Catalogue tables referenced by a query body (word match on FROM/JOIN)."""
    found = set()
    for m in re.finditer(r"\b(?:FROM|JOIN)\s+(\w+)", sql, flags=re.IGNORECASE):
        if m.group(1) in CTES:
            found.add(m.group(1))
    return found


def with_catalogue(body: str, tables: set[str] | None = None) -> str:
    """Prefix ``body`` with the catalogue CTEs it reads."""
    need = set(tables if tables is not None else tables_used(body))
    for t in list(need):
        need.update(DEPENDS.get(t, ()))
    ctes = [f"{t} AS ({CTES[t]}\n)" for t in ORDER if t in need]
    body = body.strip()
    if body.upper().startswith("WITH "):
        body = body[5:]
        return "WITH " + ",\n".join(ctes + [body]) if ctes else "WITH " + body
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
