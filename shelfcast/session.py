"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "shelfcast",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """Session with the settings the jobs rely on.

    On a cluster leave ``master``, ``shuffle_partitions`` and ``driver_memory`` unset: they come from
    the submit command. AQE merges small shuffle partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only where the session names none and runs on this machine alone (tests, local runs) a local
    folder is made and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shelfcast-")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def ship_package(spark: SparkSession) -> str:
    """Send this package to executors that do not have it installed; returns the archive's path.

    Not needed where the package is installed on every node or given by ``--py-files``.
    """
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="shelfcast-ship-"), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    spark.sparkContext.addPyFile(str(archive))
    return str(archive)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
