"""Session start-up, configuration presets and the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job of this package is happy with.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # heavy work per row: small splits, so that all cores take part without moving rows
    "spark.sql.files.maxPartitionBytes": "32m",
}

#: Fixed values for training: every executor registered before the first step,
#: none released or duplicated, one BLAS thread per task slot.
TRAINING_CONF = {
    "spark.scheduler.minRegisteredResourcesRatio": "1.0",
    "spark.dynamicAllocation.enabled": "false",
    "spark.speculation": "false",
    "spark.shuffle.reduceLocality.enabled": "false",
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.OMP_WAIT_POLICY": "passive",
}


def get_session(
    app: str = "gradmill",
    conf: dict[str, str] | None = None,
    master: str | None = None,
    training: bool = False,
) -> SparkSession:
    """Return the running session, or start one with the presets and ``conf``."""
    settings = {**BASE_CONF, **(TRAINING_CONF if training else {}), **(conf or {})}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``.

    Only in a local session, whose executors are the driver, it is set to a
    temporary folder if it is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="gradmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a running session."""
    sc = spark.sparkContext
    if getattr(sc, "_gradmill_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="gradmill-code-")
    archive = shutil.make_archive(
        f"{folder}/gradmill", "zip", os.path.dirname(root), os.path.basename(root)
    )
    sc.addPyFile(archive)
    sc._gradmill_shipped = True
