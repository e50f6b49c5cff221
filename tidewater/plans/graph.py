"""K1 follow-graph queries."""

from __future__ import annotations

from tidewater.operators import graphstats as G
from tidewater.plans.fixtures import FOLLOW_GRAPH_SQL, follow_graph
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables

_W = "WITH " + FOLLOW_GRAPH_SQL


@query("follow_counts", _W + """,
counts AS (SELECT user_id, count(*) AS n FROM edges GROUP BY user_id)
SELECT u.user_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT user_id FROM users) u LEFT JOIN counts c USING (user_id)
""")
def follow_counts(spark, d):
    users, edges = follow_graph(Tables(spark, d))
    return G.follow_counts(users, edges)


@query("follower_counts", _W + """
SELECT followed AS user_id, CAST(count(*) AS BIGINT) AS n FROM edges GROUP BY followed
""")
def follower_counts(spark, d):
    users, edges = follow_graph(Tables(spark, d))
    return G.follower_counts(users, edges)


@query("follower_counts_with_zero", _W + """
SELECT user_id, CAST(sum(w) AS BIGINT) AS n FROM (
  SELECT followed AS user_id, 1 AS w FROM edges
  UNION ALL SELECT user_id, 0 AS w FROM users) GROUP BY user_id
""")
def follower_counts_with_zero(spark, d):
    users, edges = follow_graph(Tables(spark, d))
    return G.follower_counts(users, edges, include_zero=True)


_SUMMARY = """
SELECT
  CAST((SELECT user_id FROM c ORDER BY n DESC, user_id LIMIT 1) AS BIGINT) AS max_id,
  CAST(max(n) AS BIGINT) AS max_n,
  round(avg(CAST(n AS DOUBLE)), 6) AS avg_n,
  CAST(count(*) FILTER (WHERE n = 0) AS BIGINT) AS n_zero,
  CAST((SELECT user_id FROM c ORDER BY n ASC, user_id LIMIT 1) AS BIGINT) AS min_id,
  CAST(min(n) AS BIGINT) AS min_n
FROM c
"""


@query("follows_summary", _W + """,
cnt AS (SELECT user_id, count(*) AS n FROM edges GROUP BY user_id),
c AS (SELECT u.user_id, coalesce(cnt.n, 0) AS n FROM users u LEFT JOIN cnt USING (user_id))
""" + _SUMMARY)
def follows_summary(spark, d):
    users, edges = follow_graph(Tables(spark, d))
    return G.degree_summary(G.follow_counts(users, edges))


@query("followers_summary", _W + """,
c AS (SELECT user_id, sum(w) AS n FROM (
  SELECT followed AS user_id, 1 AS w FROM edges
  UNION ALL SELECT user_id, 0 AS w FROM users) GROUP BY user_id)
""" + _SUMMARY)
def followers_summary(spark, d):
    users, edges = follow_graph(Tables(spark, d))
    return G.degree_summary(G.follower_counts(users, edges, include_zero=True))


@query("follows_report", _W + """,
cnt AS (SELECT user_id, count(*) AS n FROM edges GROUP BY user_id),
c AS (SELECT u.user_id, coalesce(cnt.n, 0) AS n FROM users u LEFT JOIN cnt USING (user_id)),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n_users, CAST(max(n) AS DOUBLE) AS max_n,
             round(avg(CAST(n AS DOUBLE)), 6) AS avg_n,
             CAST(count(*) FILTER (WHERE n = 0) AS DOUBLE) AS n_zero FROM c)
SELECT 'n_users' AS metric, n_users AS value FROM s
UNION ALL SELECT 'max_n', max_n FROM s
UNION ALL SELECT 'avg_n', avg_n FROM s
UNION ALL SELECT 'n_zero', n_zero FROM s
""")
def follows_report(spark, d):
    users, edges = follow_graph(Tables(spark, d))
    return G.follows_report(users, edges)


@query("followers_mean_by_lines", _W + """
SELECT round(CAST((SELECT count(*) FROM edges) AS DOUBLE) / (SELECT count(*) FROM users), 6) AS mean_followers
""")
def followers_mean_by_lines(spark, d):
    users, edges = follow_graph(Tables(spark, d))
    return G.mean_followers(users, edges, "lines")


@query("followers_mean_by_ids", _W + """
SELECT round(CAST((SELECT count(*) FROM edges) AS DOUBLE) /
             (SELECT count(*) FROM (SELECT user_id FROM users UNION SELECT followed FROM edges)), 6) AS mean_followers
""")
def followers_mean_by_ids(spark, d):
    users, edges = follow_graph(Tables(spark, d))
    return G.mean_followers(users, edges, "ids")
