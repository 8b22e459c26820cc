"""SparkSession helpers.

The library never creates a session on its own inside an operator; callers
pass one in.  ``build_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session we build uses.  AQE broadcasts a side that turns out
# small, coalesces small shuffle partitions and splits skewed ones where both
# sides of a join are exchanges and its kind allows it.  The right side of an
# anti join can't be split: the operators reduce it before the shuffle instead.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # lists of keys up to this length are looked up in Parquet's Bloom filters one by one
    "spark.sql.parquet.pushdown.inFilterThreshold": "500",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "lakevault",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    On a cluster the directory is named by the cluster (``spark.checkpoint.dir``,
    a shared file system).  Only a local/test session without one gets a
    scratch folder, so lineage-cutting writes never land on an executor's
    local disk in production.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        refuse_local_folder(spark, conf_dir)
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared checkpoint folder"
        )
    local_dir = tempfile.mkdtemp(prefix="lakevault-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(local_dir)
    return local_dir


def refuse_local_folder(spark: SparkSession, path: str) -> None:
    """Raise if several machines would each write to a temporary folder of their own."""
    local = path.startswith(("file:", "/")) and path.split(":", 1)[-1].lstrip("/").startswith(("tmp/", "var/tmp/"))
    if local and spark.sparkContext.master.startswith(("yarn", "k8s", "mesos")):
        raise RuntimeError(f"spark.checkpoint.dir is {path}: on a cluster it must be a folder that all machines share")
