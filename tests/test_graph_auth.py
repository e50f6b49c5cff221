from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import authlog as A
from tidewater.operators import graphstats as G


def _graph(spark):
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "user_id bigint")
    edges = spark.createDataFrame([(1, 2), (1, 3), (3, 2), (4, 5)], "user_id bigint, followed bigint")
    return users, edges


def test_follow_counts_and_summary(spark):
    users, edges = _graph(spark)
    fc = G.follow_counts(users, edges)
    assert rows(fc) == [(1, 2), (2, 0), (3, 1), (4, 1)]
    s = G.degree_summary(fc).first()
    assert (s.max_id, s.max_n, s.n_zero, s.min_id, s.min_n) == (1, 2, 1, 2, 0)
    assert abs(s.avg_n - 1.0) < 1e-9


def test_followers_zero_seed_and_ties(spark):
    users, edges = _graph(spark)
    assert rows(G.follower_counts(users, edges)) == [(2, 2), (3, 1), (5, 1)]
    z = G.follower_counts(users, edges, include_zero=True)
    assert rows(z) == [(1, 0), (2, 2), (3, 1), (4, 0), (5, 1)]
    s = G.degree_summary(z).first()
    assert (s.max_id, s.n_zero, s.min_id) == (2, 2, 1)  # ties → smallest key
    assert abs(s.avg_n - 4 / 5) < 1e-9  # denominator: all distinct ids


LINES = [
    "Jan  4 10:00:00 h sshd[1]: Failed password for root from 1.2.3.4 port 22 ssh2",
    "Jan  4 10:00:01 h sshd[1]: message repeated 3 times: [ Failed password for root from 1.2.3.4 port 22 ssh2]",
    "Jan  4 10:00:02 h sshd[1]: Failed password for invalid user admin from 5.6.7.8 port 22 ssh2",
    "Jan  5 10:00:03 h sshd[1]: Accepted password for alice from 9.9.9.9 port 22 ssh2",
    "Jan  5 10:00:04 h sshd[1]: Failed password for alice from 9.9.9.9 port 22 ssh2",
    "Jan  5 10:00:05 h sshd[1]: Accepted password for bob from 9.9.9.9 port 22 ssh2",
    "Jan  5 10:00:06 h sshd[1]: password check failed; no user word here",
    "Jan  6 10:00:07 h sshd[1]: Connection closed by 1.1.1.1 [preauth]",
]


def _auth(spark):
    return A.auth_events(spark.createDataFrame([(x,) for x in LINES], "line string"))


def test_parse_and_weights(spark):
    auth = _auth(spark)
    got = {(r.user, r.weight, r.ip) for r in auth.collect()}
    assert ("root", 3, "1.2.3.4") in got and ("admin", 1, "5.6.7.8") in got
    assert (None, 1, None) in got  # no "for": null user kept as its own group (D4)
    per = {r.user: (r.n_all, r.n_accepted, r.n_failed, r.n_invalid) for r in A.attempts_by_user(auth).collect()}
    assert per["root"] == (4, 0, 4, 0)
    assert per["admin"] == (1, 0, 1, 1)
    assert per["alice"] == (2, 1, 1, 0)


def test_rates_tops_days(spark):
    auth = _auth(spark)
    best = rows(A.best_success_users(auth))
    assert best == [("bob", 1.0)]
    assert rows(A.top_ips(auth, 1)) == [("1.2.3.4", 4)]
    assert rows(A.top_invalid_users(auth, 10)) == [("admin", 1)]
    tops = {r.population: (r.user, r.n) for r in A.top_users(auth).collect()}
    assert tops["all"] == ("root", 4) and tops["accepted"] == ("alice", 1)  # tie → smallest name
    days = {r.which: (r.day, r.n) for r in A.busiest_quietest_day(auth).collect()}
    assert days == {"busiest": ("4", 5), "quietest": ("5", 4)}


def test_expand_repeats_matches_weights(spark):
    auth = _auth(spark)
    assert A.expand_repeats(auth).count() == auth.agg(F.sum("weight")).first()[0]


def test_mean_followers_denominators(spark):
    users, edges = _graph(spark)  # 4 listed users, 4 edges, followed-only id 5
    assert G.mean_followers(users, edges, "lines").first().mean_followers == 1.0
    assert G.mean_followers(users, edges, "ids").first().mean_followers == 0.8
