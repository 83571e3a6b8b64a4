"""Building blocks for the oracle SQL: the fixture views as common table expressions."""

from __future__ import annotations

_B_COLUMNS = """author_steamid, appid, author_num_games_owned, author_num_reviews, author_playtime_forever,
 author_playtime_last_two_weeks, author_playtime_at_review, author_last_played, review, voted_up"""
_B_TAIL = """votes_funny, weighted_vote_score, comment_count, written_during_early_access, language, timestamp_created"""

REVIEWS = f"""b AS (
SELECT CASE WHEN l.l_orderkey % 2003 = 0 THEN NULL ELSE o.o_custkey END AS author_steamid,
 CAST(l.l_partkey AS INT) AS appid,
 CAST(l.l_suppkey % 50 AS INT) AS author_num_games_owned,
 CAST(CASE WHEN l.l_orderkey % 1499 = 0 THEN 0 ELSE l.l_linenumber END AS INT) AS author_num_reviews,
 CAST(l.l_quantity * 60 AS INT) AS author_playtime_forever,
 CAST(CASE WHEN l.l_orderkey % 500 = 0 THEN 17800 + l.l_linenumber * 400 WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0 END AS INT) AS author_playtime_last_two_weeks,
 CAST(l.l_quantity * 60 + CASE WHEN l.l_orderkey % 101 = 0 THEN 5 ELSE -l.l_linenumber END AS INT) AS author_playtime_at_review,
 CAST(epoch(l.l_shipdate) AS BIGINT) + (l.l_orderkey % 40) * 86400 AS author_last_played,
 CASE WHEN l.l_orderkey % 331 = 0 THEN NULL ELSE l.l_returnflag || ' ' || l.l_linestatus || ' ' || o.o_orderpriority END AS review,
 l.l_returnflag <> 'R' AS voted_up,
 CAST(ROUND(l.l_tax * 100) AS INT) AS votes_up,
 CAST(CASE WHEN l.l_orderkey % 1201 = 0 THEN 4294967295 WHEN l.l_orderkey % 1213 = 0 THEN 4294967290 WHEN l.l_orderkey % 1217 = 0 THEN -1 WHEN l.l_linenumber = 7 THEN l.l_suppkey ELSE 0 END AS BIGINT) AS votes_funny,
 CAST(CASE WHEN l.l_orderkey % 1009 = 0 THEN 1.5 ELSE ROUND(l.l_discount * 100) / 16 END AS FLOAT) AS weighted_vote_score,
 CAST(CASE WHEN l.l_linenumber = 7 THEN l.l_quantity ELSE 0 END AS INT) AS comment_count,
 l.l_linestatus = 'F' AS written_during_early_access,
 CASE o.o_custkey % 3 WHEN 0 THEN 'english' WHEN 1 THEN 'schinese' ELSE 'french' END AS language,
 CAST(epoch(l.l_shipdate) AS BIGINT) AS timestamp_created,
 CAST(epoch(l.l_shipdate) AS BIGINT) + CASE WHEN l.l_orderkey % 777 = 0 THEN -86400 ELSE l.l_linenumber * 3600 END AS timestamp_updated,
 l.l_orderkey AS k
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
), reviews AS (
SELECT {_B_COLUMNS}, votes_up, {_B_TAIL}, timestamp_updated FROM b
UNION ALL SELECT {_B_COLUMNS}, votes_up, {_B_TAIL}, timestamp_updated FROM b WHERE k % 301 = 0
UNION ALL SELECT {_B_COLUMNS}, votes_up + 1, {_B_TAIL}, timestamp_updated + 7200 FROM b WHERE k % 401 = 0
)"""

# Parsed arrays and maps are built straight from the part columns, not by parsing text, so that
# the oracle does not depend on any parser.
GAMES = """g AS (
SELECT CAST(p_partkey AS INT) AS appid,
 CASE WHEN p_partkey % 977 = 0 THEN NULL WHEN p_partkey % 991 = 0 THEN '  ' ELSE p_name END AS name,
 CASE WHEN p_partkey % 499 = 0 THEN NULL ELSE CAST(2000 + p_partkey % 26 AS VARCHAR) || '-0' || CAST(1 + p_partkey % 9 AS VARCHAR) || '-1' || CAST(p_partkey % 10 AS VARCHAR) END AS release_date,
 CAST(p_retailprice AS DOUBLE) AS price,
 CASE WHEN p_partkey % 97 = 0 THEN '[]' ELSE '[''' || p_type || ''', ''' || p_brand || ''']' END AS genres,
 CASE WHEN p_partkey % 97 = 0 THEN '[]' WHEN p_partkey % 41 = 0 THEN '{"Beat ''em up": ' || CAST(p_size AS VARCHAR) || ', ''' || p_type || ''': 1}' ELSE '{''' || split_part(p_name, ' ', 1) || ''': ' || CAST(p_size AS VARCHAR) || ', ''' || split_part(p_name, ' ', 2) || ''': ' || CAST(p_partkey % 30 AS VARCHAR) || ', ''' || p_type || ''': 1}' END AS tags,
 CAST(p_partkey * 37 % 5003 AS INT) AS peak_ccu,
 '0 - 20000' AS estimated_owners,
 CAST(p_size * 60 AS INT) AS average_playtime_forever,
 CAST(p_partkey % 101 AS INT) AS pct_pos_total,
 CAST(p_partkey * 7 % 10007 AS INT) AS num_reviews_total,
 CASE WHEN p_partkey % 97 = 0 THEN [] ELSE [p_type, p_brand] END AS genres_array,
 CASE WHEN p_partkey % 97 = 0 THEN [] WHEN p_partkey % 41 = 0 THEN ['Beat ''em up', p_type]
  ELSE [split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), p_type] END AS tag_names,
 CASE WHEN p_partkey % 97 = 0 THEN [] WHEN p_partkey % 41 = 0 THEN [CAST(p_size AS INT), 1]
  ELSE [CAST(p_size AS INT), CAST(p_partkey % 30 AS INT), 1] END AS tag_weights
FROM part
), games AS (SELECT *, CAST(release_date AS DATE) AS release_dt FROM g),
game_genres AS (SELECT appid, average_playtime_forever, unnest(genres_array) AS genre FROM games),
game_tags AS (SELECT appid, average_playtime_forever, unnest(tag_names) AS tag, unnest(tag_weights) AS weight FROM games)"""


def with_reviews(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([REVIEWS, *ctes]) + "\n" + body


def with_games(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([GAMES, *ctes]) + "\n" + body


def with_both(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([REVIEWS, GAMES, *ctes]) + "\n" + body


def per_column(columns: list[str], template: str) -> str:
    """UNION ALL of one SELECT per column; ``{c}`` in the template is the column name."""
    return "\nUNION ALL ".join(template.replace("{c}", column) for column in columns)
