"""Session helper for local use; on a cluster the caller brings its own session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches on this machine."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("folioforge")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names in spark.checkpoint.dir.

    Only where that setting is absent (tests, a laptop) a folder of this
    machine is set; on a cluster the setting is a must, as a machine-local
    folder would be lost with its executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="folioforge-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: tables written by `stored` in this process, that `clean_stored` removes
_WRITTEN: list[str] = []


def clean_stored(spark: SparkSession) -> int:
    """Remove the tables that `stored` has written, once no result that reads them is needed any more; their number."""
    done = 0
    while _WRITTEN:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        done += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return done


def stored(df: DataFrame) -> DataFrame:
    """df as a written table in the shared folder: columnar, compressed, and read again by any number of consumers."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/folioforge-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
