"""Session settings and the shared folder that survives executor loss."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Sizes are left to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where that costs the following aggregate one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starloom") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
    )
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A local master may fall back to a
    temporary folder; on a cluster a missing setting is an error, because a folder on one
    machine is lost with that machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="starloom-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared folder; never reused, so a reader is never overwritten."""
    return f"{shared_dir(spark)}/scratch/{label}-{uuid.uuid4().hex}"


_owners: ContextVar[tuple["Scratch", ...]] = ContextVar("owners", default=())


def materialize(df: DataFrame, label: str, outlives: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a columnar copy that survives executors, keeps column pruning and
    gives the next plan true sizes for its broadcast decisions. Inside ``owned_copies`` the copy goes at the end of the block, or of
    the one ``outlives`` blocks further out; elsewhere it stays for the session, as lazy results may still read it.
    """
    owners = _owners.get()
    if len(owners) > outlives:
        return owners[-1 - outlives].keep(df, label)
    return _stored(df, scratch_path(df.sparkSession, label))


@contextmanager
def owned_copies(spark: SparkSession) -> Iterator["Scratch"]:
    """Intermediate copies made inside are removed at the end: for code that has used its results by then.

        with owned_copies(spark):
            rows = rfm_segments(dw).collect()
    """
    scratch = Scratch(spark)
    token = _owners.set((*_owners.get(), scratch))
    try:
        yield scratch
    finally:
        _owners.reset(token)
        scratch.clear()


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate copies of one job, removed together when it is over."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        return _stored(df, path)

    def clear(self) -> None:
        while self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
