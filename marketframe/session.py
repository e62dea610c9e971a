"""Session helpers: a local session for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "marketframe") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MF_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset.

    On a cluster the setting names a shared folder (HDFS/object store). Only local
    sessions (tests, bench) fall back to a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before checkpointing")
        current = tempfile.mkdtemp(prefix="mf-ckpt-")
        # our own scratch folder of a local session goes when the process ends
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint(df, eager: bool = True):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send the package to the workers, once per application, so that Python steps run
    there wherever the job was started. Workers that have it installed get the same code."""
    import zipfile
    from pathlib import Path

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="mf-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "marketframe.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/marketframe-{name}-{uuid.uuid4().hex[:12]}"
