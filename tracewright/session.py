"""Session helpers.

Library operators never create or configure a session; they take the one they
are given. ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins (broadcast only when the
# runtime size is under the threshold, otherwise sort-merge), splits skewed
# shuffle partitions and coalesces small ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tracewright") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is set by the deployment and is only read here. When it
    is unset (local tests) a fresh scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local one cannot be used "
                               "on a cluster")
        d = tempfile.mkdtemp(prefix="tw-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # sessions without a driver-side context (Spark Connect)
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
