"""Session construction and lineage-cut helpers.

On a cluster the session comes from the launcher; ``build_session`` is for
tests, the bench and local runs.  Everything here reads settings from the
live session first and only fills in what is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; applied only where the session has no value.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tabforge", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder there.  Only a local session, where
    all tasks are in this process, gets a scratch folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        current = tempfile.mkdtemp(prefix="tabforge-ckpt-")
        try:   # record it for later readers; some deployments reject runtime core confs
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # noqa: BLE001
            pass
    spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used before iterative ML and before actions whose result drives the
    rest of a plan, so a lost executor recomputes from the checkpoint and
    not from the raw scan.  Never a local checkpoint: those die with the
    executor that holds them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


_written: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet under the shared folder and read
    back, so several readers of it share one computation, pinning no
    executor memory, and a lost executor recomputes nothing.  The table
    stays as long as frames that read it may be used; ``release`` removes
    it."""
    path = shared_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession) -> int:
    """Remove all tables that ``written`` has stored so far, once no frame
    built on them is needed any more; returns their number."""
    n = 0
    while _written:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))
    return n
