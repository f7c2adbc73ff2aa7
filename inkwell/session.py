"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "inkwell", cpus: str | int = "*",
                  shuffle_partitions: int | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench.  On a cluster, use the
    session the platform hands you; nothing here is required."""
    parts = shuffle_partitions or (int(cpus) * 2 if str(cpus).isdigit() else 16)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins.  Only in local mode, where
    driver and executors are one process, may it be unset: then one is created
    under the system temp folder.  On a cluster that folder would be a
    different one on each machine, so a missing setting is an error."""
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="inkwell-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint dir (never a
    machine-local temp folder on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """Parquet table by name, as its files are now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df):
    """Cut lineage of a DataFrame reused by several branches of a plan:
    reliable ``checkpoint()`` into the shared checkpoint folder (survives
    executor loss, unlike a local checkpoint or a cache)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_table(df, name: str):
    """Write ``df`` as Parquet below the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``inkwell`` importable in Python workers (``mapInPandas`` and
    pandas UDF tasks) the way ``--py-files`` does: zip the package once per
    application into the shared checkpoint folder and ``addPyFile`` it.
    A no-op when the package is already installed on the workers' path."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil
    from urllib.parse import urlparse
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = ensure_checkpoint_dir(spark)
    if urlparse(base).scheme not in ("", "file"):
        # a remote checkpoint folder (hdfs://, s3a://, ...): build the archive
        # on the driver; addPyFile distributes it like --py-files does
        base = tempfile.mkdtemp(prefix="inkwell-pyfiles-")
    base = base[len("file:"):] if base.startswith("file:") else base
    target = os.path.join(base, f"pyfiles-{app}")
    archive = target + ".zip"
    if not os.path.exists(archive):
        shutil.make_archive(target, "zip", root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(app)
