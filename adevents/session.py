"""Session set-up and the shared scratch folder.

Everything the library writes (event stores, summary tables, CSV parts,
stream checkpoints) goes below ``spark.checkpoint.dir`` -- the folder a
cluster shares between driver and executors.  Only when that setting is
absent (a laptop, a test) does the library pick a private temporary folder
and register it as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Calendar buckets (day, hour, minute, week) are defined in UTC.
SESSION_TIME_ZONE = "UTC"


def get_session(master: str = "local[*]", app: str = "adevents", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", SESSION_TIME_ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # coalesce to the advisory size (not to the core count): the setting
        # Spark recommends for shared clusters
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every entry point needs (idempotent)."""
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_TIME_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``adevents`` importable in every Python worker (once per app).

    Python-side pieces (the zip data source, the part writers, the header
    sniffer) run in executor processes; the package is zipped into the
    shared checkpoint folder and registered with ``addPyFile``.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    with _SHIP_LOCK:
        if app not in _SHIPPED:
            _ship(spark)
            _SHIPPED.add(app)


def _ship(spark: SparkSession) -> None:
    import io
    import zipfile
    from pathlib import Path

    import pyarrow as pa

    from adevents.sources.files import open_filesystem

    sc = spark.sparkContext
    package = Path(__file__).resolve().parent
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        for f in sorted(package.rglob("*.py")):
            zf.write(f, str(Path(package.name) / f.relative_to(package)))
    folder = scratch_path(spark, "pyfiles")
    try:
        filesystem, inner = open_filesystem(folder)
    except pa.ArrowInvalid:  # a store that Arrow can't write: the workers need the package installed
        return
    filesystem.create_dir(inner, recursive=True)
    with filesystem.open_output_stream(f"{inner}/adevents.zip") as out:
        out.write(buf.getvalue())
    sc.addPyFile(f"{folder}/adevents.zip")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created privately only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # SparkContext appends a per-application UUID folder; use its parent.
        return current.rsplit("/", 1)[0]
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="adevents-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    name = "-".join(parts + (uuid.uuid4().hex[:12],))
    return _join(root, "adevents", spark.sparkContext.applicationId, name)


def _join(root: str, *parts: str) -> str:
    if "://" in root or root.startswith("file:"):
        return "/".join([root.rstrip("/"), *parts])
    return os.path.join(root, *parts)
