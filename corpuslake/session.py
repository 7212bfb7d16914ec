"""Session construction and the shared lineage-cutting helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Session defaults; a value given at submit time (cluster config) wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "corpuslake") -> SparkSession:
    """A session with AQE on, UI off, UTC and Arrow enabled.

    On a cluster the master, the shuffle partition count and the checkpoint
    directory come from the submit configuration and are left alone; only
    what is unset (local tests, the benchmark) is filled in here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    given = spark.sparkContext.getConf()
    for k, v in _DEFAULTS.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local master without one (tests) gets a scratch folder; executors
    of a cluster would each write to their own disk, so there it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="corpuslake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (for sinks, stream state)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: data written to the shared folder, lineage dropped.

    Survives executor loss, unlike a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`scratch_path` that nothing reads any more."""
    if not path.startswith(ensure_checkpoint_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"not in the checkpoint folder: {path}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Like :func:`cut_lineage`, but the result carries statistics from the
    written files instead of the original plan's estimate, which matters in
    loops that join a table with itself round after round.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
