"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "lodgeworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a temporary folder of its own; on a cluster a missing
    setting is an error, because a machine-local folder would not survive a lost executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodgeworks-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is ever written twice to it."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "stage", file_rows: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a frame feeds several jobs: the later jobs read only the columns they need, the
    lineage ends at the files, and a lost executor costs a re-read instead of a re-computation.
    ``file_rows`` bounds the rows of a file, where rows are so long that a reader should not hold many.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame from ``staged`` that nothing reads any more."""
    spark, files = df.sparkSession, df.inputFiles()
    if not files:
        return
    folder = files[0].rsplit("/", 1)[0]
    if not re.search(r"-[0-9a-f]{32}$", folder):
        raise ValueError(f"{folder} was not written by staged")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local one on a cluster)."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
