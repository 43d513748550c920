"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "ledgerline", **conf: str) -> SparkSession:
    """Return a session; the defaults only apply to a local master that is named here, never to a submitted cluster job."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    local = (master or "").startswith("local") and not (master or "").startswith("local-cluster")
    for key, value in {**(LOCAL_DEFAULTS if local else {}), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The folder named by ``spark.checkpoint.dir`` wins.  Only when nothing is
    configured and the master is local a fresh folder under the system temp
    directory is created; on a cluster that is an error, because executors
    do not share such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured and not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # noqa: BLE001 - core confs may be read-only; the context setting below is what counts
            pass
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application.

    The archive is only staged on the driver; Spark itself serves it to the executors.
    """
    sc = spark.sparkContext
    if getattr(sc, "_ledgerline_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerline-package-"), "ledgerline.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._ledgerline_shipped = True
