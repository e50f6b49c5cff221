"""Intermediate data: where it goes, when it is replaced, and what runs to plan."""

import glob

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidewater import session as S
from tidewater.plans.registry import all_queries


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), {}


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(_Session(master))


def test_materialized_tables_follow_their_input(spark, tmp_path):
    path = str(tmp_path / "in")
    read = lambda: S.materialize(spark.read.schema("a bigint, b bigint").parquet(path), "follow", ["b"], "a")
    spark.range(1000).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b")).write.parquet(path)
    first = read()
    assert first.count() == 1000 and read().inputFiles() == first.inputFiles()
    files = [f.removeprefix("file://") for f in first.inputFiles()]
    assert len(files) <= 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.range(10).select(F.col("id").alias("a"), F.lit(0).cast("bigint").alias("b")).write.mode("overwrite").parquet(path)
    assert read().count() == 10
    assert not glob.glob(files[0])  # the old table is gone


def test_spread_runs_no_job(spark):
    def jobs():
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("spread"))

    spark.sparkContext.setJobGroup("spread", "")
    try:
        left = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        S.spread(left.join(left, "k"))
        assert jobs() == 0
        # most queries only build a plan; these write intermediates or iterate
        planned = [n for n, q in all_queries().items() if q.family in ("graph", "auth", "annotate", "corpus", "sketch")]
        for name in planned:
            all_queries()[name].fn(spark, SF001)
        assert jobs() == 0, planned
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_schemes_of_stores():
    from tidewater.session import arrow_uri
    assert [arrow_uri(u) for u in ("s3a://b/k", "s3n://b/k", "s3://b/s3a://k", "hdfs://h/p", "file:///p", "/p")] == [
        "s3://b/k", "s3://b/k", "s3://b/s3a://k", "hdfs://h/p", "file:///p", "/p"]


def test_signature_of_partitioned_files(spark, tmp_path):
    """Folders whose names hold escaped characters are found."""
    from pyspark.sql import functions as F

    from tidewater.session import input_signature
    spark.range(4).withColumn("p", F.concat(F.lit("a:b "), F.col("id") % 2)).write.partitionBy("p").parquet(str(tmp_path / "t"))
    assert len(input_signature(spark.read.parquet(str(tmp_path / "t")))) == 64
