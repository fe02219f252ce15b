"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(app: str = "silsila", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.silsila.spread", str(os.cpu_count() if cores == "*" else cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; a folder of our own only in local mode without one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a shared folder")
        folder = tempfile.mkdtemp(prefix="silsila-checkpoint-")
    sc.setCheckpointDir(folder)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows to the reliable checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
