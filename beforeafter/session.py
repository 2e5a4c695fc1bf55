"""Session helpers.

Operators never create a session; they take DataFrames.  These helpers are
for tests, the bench and the checkpoint directory lookup.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("beforeafter")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites of every column cost more than the columns
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Uses the context's directory if set, else ``spark.checkpoint.dir`` from the
    session conf.  Only when neither is set (local tests) a scratch folder is
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared (HDFS/S3) folder")
        conf_dir = tempfile.mkdtemp(prefix="beforeafter-ckpt-")  # local master only, as in tests
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where a plan must see the same rows twice (range partitioning is
    sampled, so a recomputation after executor loss could otherwise move rows
    between ranges).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path below the shared checkpoint folder, deleted when the driver's
    JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialize(df: DataFrame, tag: str = "stage", by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a parquet table under the shared checkpoint folder,
    partitioned by the columns ``by`` if given, and read it back: lineage is cut
    and the data survives executor loss, with columnar files instead of
    serialised rows."""
    path = scratch_path(df.sparkSession, tag)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task gets of a shuffle made by ``spread``.
ROWS_PER_TASK = 100_000


def spread(df: DataFrame, rows: int, *cols: str) -> DataFrame:
    """``df`` shuffled by ``cols`` into tasks of about ``ROWS_PER_TASK`` of its ``rows``
    rows, for steps that hold a task's rows in memory: more rows make more tasks, not
    larger ones, whatever the number of shuffle partitions and the merging of small
    ones.  Rows that fit one task are left to Spark's choice."""
    if rows <= ROWS_PER_TASK:
        return df.repartition(*cols)
    return df.repartition(max(-(-rows // ROWS_PER_TASK), df.sparkSession.sparkContext.defaultParallelism), *cols)
