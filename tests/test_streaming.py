from tests.conftest import rows
from tests.test_graph_auth import LINES
from tidewater.operators import authlog as A
from tidewater.streaming import authlog_stream as S


def test_stream_counts_equal_batch(spark, tmp_path):
    src = tmp_path / "logs"
    src.mkdir()
    half = len(LINES) // 2
    (src / "a.log").write_text("\n".join(LINES[:half]) + "\n")
    (src / "b.log").write_text("\n".join(LINES[half:]) + "\n")
    lines = S.read_log_stream(spark, str(src), max_files_per_trigger=1)
    q = S.run_to_table(S.attempts_by_user_stream(lines), "auth_stream_users", str(tmp_path / "ckpt"))
    try:
        got = rows(spark.table("auth_stream_users"))
    finally:
        q.stop()
    batch = A.attempts_by_user(A.auth_events(spark.createDataFrame([(x,) for x in LINES], "line string")))
    assert got == rows(batch)


def test_stream_days_with_watermark(spark, tmp_path):
    src = tmp_path / "logs2"
    src.mkdir()
    (src / "a.log").write_text("\n".join(LINES) + "\n")
    lines = S.read_log_stream(spark, str(src))
    q = S.run_to_table(S.attempts_by_day_stream(lines, 2024), "auth_stream_days", str(tmp_path / "ckpt2"),
                       mode="complete")
    try:
        got = sorted((r.day_start.day, r.n) for r in spark.table("auth_stream_days").collect())
    finally:
        q.stop()
    assert got == [(4, 5), (5, 4)]
