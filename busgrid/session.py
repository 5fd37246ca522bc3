"""Session settings the jobs are written for."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks broadcast sides by measured size, merges small shuffle
# partitions and splits skewed join partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for written intermediates, the session's ``spark.checkpoint.dir``.

    A session on one machine without that setting, as in a test, gets a folder of its own;
    a cluster without it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and re.match(r"local($|\[)", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="busgrid-"))
        folder = context.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{folder.rstrip('/')}/busgrid"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """Writes rows that several later steps need to the shared folder and reads them back.

    This cuts the lineage: a lost executor costs a read, and the steps before run once.
    """
    spark = rows.sparkSession
    folder = work_folder(spark, name)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def clean_up(spark: SparkSession) -> None:
    """Removes all written intermediates of this shared folder.

    For the end of a job: no frame made from them can be read afterwards.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
