"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every transform here relies on. Memory, the checkpoint folder and the least
# number of partitions belong to the cluster and are not set here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles begin with many partitions, and adaptive execution puts small ones
    # together: a task's rows stay as many when the tables grow.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2048",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Shuffle files go when their statement ends, not when the driver collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM does not compile methods beyond 8000 bytes of bytecode. The wide
    # aggregates and rule expressions would pass that as one generated method;
    # with this limit they are generated in pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, removed when the
    application ends.

    Without ``spark.checkpoint.dir`` a temporary folder is made if all tasks run in
    the driver's own process; on a cluster, where executors would not share it, that
    is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="staylens-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def cut_lineage(df):
    """Write ``df`` to the shared folder and read it back, so that it is
    computed once and survives lost executors."""
    path = work_dir(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
