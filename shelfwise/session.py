"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def _local_root(spark: SparkSession) -> str:
    """A temporary folder of this application, removed when Python ends."""
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = root = tempfile.mkdtemp(prefix="shelfwise-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return _local_roots[application]


def scratch_dir(spark: SparkSession) -> str:
    """A new directory below the shared folder `spark.checkpoint.dir` names.

    A local session without that setting uses a temporary folder of its own,
    since its executors run on this machine; any other session needs the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster[...] has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root(spark)
    return f"{root.rstrip('/')}/shelfwise-{uuid.uuid4().hex}"
