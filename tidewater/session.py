"""Session helpers: building a session for tests/bench and the shared checkpoint
folder.

Library code never creates its own session; every operator takes DataFrames
and returns DataFrames. These helpers exist for the entry points (tests,
bench, registry) and for the few operators that must cut lineage.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidewater") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller's session is
    used as-is; nothing here is required by the operators."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting has to point at shared storage: without it an
    executor would write to its own disk, where no other one finds the files.
    Only a ``local`` master gets a fresh scratch folder when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidewater-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint
    folder and reading it back: a reliable, columnar checkpoint that
    survives executor loss (never a local checkpoint)."""
    import uuid

    spark = df.sparkSession
    path = shared_path(spark, f"lineage/{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table under the shared checkpoint
    folder (never a machine-local temp folder)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def _hadoop_path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, uri: str) -> None:
    """Delete an intermediate table that no plan reads any more."""
    path, fs = _hadoop_path(spark, uri)
    fs.delete(path, True)


def input_signature(df: DataFrame) -> str:
    """Names, lengths and times of the files that ``df`` reads."""
    spark, h = df.sparkSession, hashlib.sha256()
    for uri in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))  # files are listed as encoded URIs
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        status = fs.getFileStatus(path)
        h.update(f"{uri} {status.getLen()} {status.getModificationTime()}\n".encode())
    return h.hexdigest()


_MATERIALIZED: dict[tuple[str, str], tuple[str, str]] = {}


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, salt_by: str | None = None,
                signature: str | None = None) -> DataFrame:
    """Write ``df`` under the shared folder and read it back (cuts lineage;
    survives executor loss; enables partition pruning). A second call with the
    same name reads what is there while the input files are unchanged, and
    replaces it otherwise. ``signature`` stands for the input files where the
    caller knows it, as for tables derived from another written one.

    Before ``partition_by`` the rows are dealt out by those columns and a salt
    of ``salt_by``, so a value's rows lie in as many files as there are shuffle
    partitions at most, and a frequent value in several tasks."""
    spark = df.sparkSession
    key, now = (spark.sparkContext.applicationId, name), signature or input_signature(df)
    path, before = _MATERIALIZED.get(key, (None, None))
    if before != now:
        if path is not None:
            delete_path(spark, path)
        path = shared_path(spark, f"{name}-{now[:12]}")
        if partition_by:
            salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            salt = [F.pmod(F.xxhash64(salt_by), F.lit(salts))] if salt_by else []
            df.repartition(*partition_by, *salt).write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        else:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        _MATERIALIZED[key] = (path, now)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``tidewater`` importable in Python workers (UDF-backed operators
    pickle functions by module reference). Zips the package once per
    application and registers it with ``addPyFile``; a no-op afterwards."""
    import zipfile

    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    # the driver's file server hands the zip to the executors; remote folders can't be opened by zipfile
    target = os.path.join(base, "pkg") if "://" not in base else tempfile.mkdtemp(prefix="tidewater-pkg-")
    os.makedirs(target, exist_ok=True)
    path = os.path.join(target, f"tidewater-{sc.applicationId}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


#: Estimated bytes for each task under which a scan is dealt out anew.
SPREAD_BYTES = 8 << 20


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Deal out a small input before CPU-heavy work on its rows: its files may
    be fewer than the cores. Judged by the plan's size estimate alone, so no
    job runs; an input of over ``SPREAD_BYTES`` for each core is left as it is,
    as the scan's own splits keep the cores busy."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(target) if size < target * SPREAD_BYTES else df


def arrow_uri(uri: str) -> str:
    """A Hadoop URI as ``pyarrow.fs`` names the same store (``s3a`` and ``s3n``
    are ``s3`` there; other schemes are the same or not known to it)."""
    return re.sub(r"^s3[an]://", "s3://", uri)


def shared_file(uri: str):
    """A file of the shared folder, opened for random access in a task."""
    import pyarrow.fs as pafs

    if "://" in uri and not uri.startswith("file://"):
        fs, path = pafs.FileSystem.from_uri(arrow_uri(uri))
    else:
        fs, path = pafs.LocalFileSystem(), re.sub(r"^file:(//)?", "", uri)
    return fs.open_input_file(path)
