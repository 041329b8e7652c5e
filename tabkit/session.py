"""Session helpers: building a local session for tests and benches, and the shared
scratch folder for files that jobs write (always under ``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import io
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_spark(cpus: int | str | None = None, app: str = "tabkit") -> SparkSession:
    """Local session used by tests and ``bench.py``; a cluster passes its own session."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Only on
    a local master, where driver and executors are one process, may it be unset: a
    temporary folder is made then.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="tabkit-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for written tables, inside the shared checkpoint folder. The folder is
    removed when this session's process ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    root = f"{base}/tabkit-scratch-{spark.sparkContext.applicationId}"
    if root not in _SCRATCH:
        _SCRATCH.add(root)
        atexit.register(_remove, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


_SCRATCH: set = set()


def _remove(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is None:  # stopped before
        return
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, as ``--py-files`` would, once per context."""
    context = spark.sparkContext
    if any(name.startswith("tabkit-py-") for name in context._python_includes):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "tabkit")):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    path = f"{scratch_path(spark, 'package')}/tabkit-py-{uuid.uuid4().hex}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data.getvalue()))
    out.close()
    context.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str):
    """Scan one of the parquet test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
