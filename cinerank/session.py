"""Session construction and shared-folder helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on. Expressions themselves are
# written time-zone independent; UTC only pins what `show()` prints.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "cinerank",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster `master` stays None so the launcher decides; tests and the
    bench pass `local[N]`.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by `spark.checkpoint.dir`.

    Only when the session names none and the master is local (tests) a
    private temporary folder is created and registered.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="cinerank-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{shared_dir(spark)}/cinerank/{name}-{uuid.uuid4().hex[:12]}"


# A written table of more rows is never broadcast by the size of its files:
# sorted rows of repeated values take a byte or two there, a hundred in memory.
BROADCAST_ROWS = 200_000


def materialize(df, name: str):
    """Write `df` as Parquet under the shared folder and read it back.

    Cuts the lineage (the table survives executor loss and is computed
    exactly once) and gives the optimizer real size statistics for the
    consumers' join planning; a table of more than BROADCAST_ROWS rows asks
    for sort-merge joins, as the size of its files says too little.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return sized(df.sparkSession.read.parquet(path))


def sized(written):
    """A written table, which asks for sort-merge joins if it has many rows."""
    return written.hint("merge") if written.count() > BROADCAST_ROWS else written


def release_unused(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files and cached blocks of data that nobody
    refers to any more (a model that was evaluated). It does so when the
    driver's JVM collects garbage, by itself every 30 minutes at the latest."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def exists_local(path: str) -> bool:
    return is_local_path(path) and os.path.exists(local_fs_path(path))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `cinerank` importable in executor Python workers (once per
    application), like `spark-submit --py-files`. Needed by the operators
    that run Pandas functions (`applyInPandas`, keyed state).

    Only done when the shared folder is on a file system this process can
    write directly (local runs, tests). On a cluster with a remote shared
    folder the deployment ships the package (`--py-files` or installed).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    base = shared_dir(spark)
    if not is_local_path(base):
        _SHIPPED.add(app)
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    folder = f"{local_fs_path(base)}/cinerank-pyfiles"
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, f"cinerank-{app}-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(app)
