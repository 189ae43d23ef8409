"""Session settings for local runs (tests, bench) and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings a cluster job should run with; tests and bench use the same ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast only below a measured size; the static
    # threshold stays at its default so no estimate alone decides.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cardwatch") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g"))
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The folder for intermediate tables, on storage that all executors share.

    ``folder`` if given; else the session's ``spark.checkpoint.dir``. Only a
    local session without either gets a folder of this machine.
    """
    sc = spark.sparkContext
    if folder:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(folder)
        return folder
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir (or pass work_dir): a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="cardwatch-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current
