"""K2 SSH auth-log queries."""

from __future__ import annotations

from tidewater.operators import authlog as A
from tidewater.plans.fixtures import AUTH_SQL, auth_log
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables

_W = "WITH " + AUTH_SQL


def _auth(spark, d):
    return A.auth_events(auth_log(Tables(spark, d)))


_PER_USER = """
per_user AS (
  SELECT user,
    CAST(sum(weight) AS BIGINT) AS n_all,
    CAST(sum(CASE WHEN accepted THEN weight ELSE 0 END) AS BIGINT) AS n_accepted,
    CAST(sum(CASE WHEN failed THEN weight ELSE 0 END) AS BIGINT) AS n_failed,
    CAST(sum(CASE WHEN invalid THEN weight ELSE 0 END) AS BIGINT) AS n_invalid
  FROM auth GROUP BY user)
"""


@query("auth_attempts_by_user", _W + "," + _PER_USER + "SELECT * FROM per_user")
def auth_attempts_by_user(spark, d):
    return A.attempts_by_user(_auth(spark, d))


@query("auth_top_users", _W + "," + _PER_USER + """
SELECT population, user, n FROM (
  SELECT 'all' AS population, user, n_all AS n, row_number() OVER (ORDER BY n_all DESC, user) AS r FROM per_user WHERE n_all > 0
  UNION ALL SELECT 'accepted', user, n_accepted, row_number() OVER (ORDER BY n_accepted DESC, user) FROM per_user WHERE n_accepted > 0
  UNION ALL SELECT 'failed', user, n_failed, row_number() OVER (ORDER BY n_failed DESC, user) FROM per_user WHERE n_failed > 0
  UNION ALL SELECT 'invalid', user, n_invalid, row_number() OVER (ORDER BY n_invalid DESC, user) FROM per_user WHERE n_invalid > 0
) WHERE r = 1
""")
def auth_top_users(spark, d):
    return A.top_users(_auth(spark, d))


_RATES = """
rates AS (SELECT user, n_all, n_accepted, round(CAST(n_accepted AS DOUBLE) / n_all, 6) AS rate
          FROM per_user WHERE n_accepted > 0)
"""


@query("auth_success_rates", _W + "," + _PER_USER + "," + _RATES + "SELECT * FROM rates")
def auth_success_rates(spark, d):
    return A.success_rates(_auth(spark, d))


@query("auth_best_success_users", _W + "," + _PER_USER + "," + _RATES + """
SELECT user, rate FROM rates WHERE rate = (SELECT max(rate) FROM rates)
""")
def auth_best_success_users(spark, d):
    return A.best_success_users(_auth(spark, d))


@query("auth_failed_by_ip", _W + """
SELECT ip, CAST(sum(weight) AS BIGINT) AS n FROM auth WHERE failed GROUP BY ip
""")
def auth_failed_by_ip(spark, d):
    return A.failed_by_ip(_auth(spark, d))


@query("auth_top_ips", _W + """
SELECT ip, CAST(sum(weight) AS BIGINT) AS n FROM auth WHERE failed GROUP BY ip
ORDER BY n DESC, ip ASC NULLS FIRST LIMIT 3
""")
def auth_top_ips(spark, d):
    return A.top_ips(_auth(spark, d), 3)


@query("auth_top_invalid_users", _W + """
SELECT user, CAST(sum(weight) AS BIGINT) AS n FROM auth WHERE invalid GROUP BY user
ORDER BY n DESC, user ASC NULLS FIRST LIMIT 10
""")
def auth_top_invalid_users(spark, d):
    return A.top_invalid_users(_auth(spark, d), 10)


@query("auth_attempts_by_day", _W + """
SELECT month, day, CAST(sum(weight) AS BIGINT) AS n FROM auth GROUP BY month, day
""")
def auth_attempts_by_day(spark, d):
    return A.attempts_by_day(_auth(spark, d))


@query("auth_busiest_quietest_day", _W + """,
days AS (SELECT month, day, CAST(sum(weight) AS BIGINT) AS n FROM auth GROUP BY month, day)
SELECT * FROM (SELECT 'busiest' AS which, month, day, n FROM days ORDER BY n DESC, month, day LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'quietest' AS which, month, day, n FROM days ORDER BY n ASC, month, day LIMIT 1)
""")
def auth_busiest_quietest_day(spark, d):
    return A.busiest_quietest_day(_auth(spark, d))


@query("auth_line_counts", _W + """
SELECT CAST(sum(weight) AS BIGINT) AS n_password,
  CAST(sum(CASE WHEN accepted THEN weight ELSE 0 END) AS BIGINT) AS n_accepted,
  CAST(sum(CASE WHEN failed THEN weight ELSE 0 END) AS BIGINT) AS n_failed,
  CAST(sum(CASE WHEN invalid THEN weight ELSE 0 END) AS BIGINT) AS n_invalid,
  CAST(count(*) AS BIGINT) AS n_lines
FROM auth
""")
def auth_line_counts(spark, d):
    return A.line_counts(_auth(spark, d))


@query("auth_first_version_counts", _W + """
SELECT CASE WHEN user LIKE 'svc-%' OR etype = 'purchase' THEN NULL ELSE user END AS user,
  CAST(sum(CASE WHEN accepted THEN 1 ELSE 0 END) AS BIGINT) AS n_accepted,
  CAST(sum(CASE WHEN failed THEN weight ELSE 0 END) AS BIGINT) AS n_failed
FROM auth GROUP BY 1
""")
def auth_first_version_counts(spark, d):
    return A.partial_counts_first_version(auth_log(Tables(spark, d)))


@query("auth_expanded_attempts", _W + """
SELECT CAST(sum(weight) AS BIGINT) AS n_attempts, CAST(count(DISTINCT user) AS BIGINT) AS n_users FROM auth
""")
def auth_expanded_attempts(spark, d):
    """Repeated messages expanded into one row per attempt."""
    from pyspark.sql import functions as F
    x = A.expand_repeats(_auth(spark, d))
    return x.agg(F.count(F.lit(1)).cast("bigint").alias("n_attempts"),
                 F.countDistinct("user").cast("bigint").alias("n_users"))
