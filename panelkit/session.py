"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Settings for wide tables.

    Dozens of cleaning expressions compile into one Java method larger than the
    JVM optimises (8000 bytes of bytecode); beyond that size Spark then splits them.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. On a cluster, bring your own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelkit")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only where the session names none and runs on one machine (local tests) is a temporary folder made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="panelkit-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for one written table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows written to the shared folder, and where: they are computed once and outlive an executor."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def drop_written(spark: SparkSession, path: str) -> None:
    """Removes what written() left at ``path``, once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
