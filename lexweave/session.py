"""Session factory and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lexweave", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings every operator assumes: UTC, AQE with skew handling, Arrow batches.

    Anything the cluster already set (through spark-defaults or submit options) stays as it is unless named in ``conf``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k: str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Where the session names none, a temporary folder serves a local master. On a cluster that is an error: executors would write to
    folders of their own machines, which the others can't see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    jvm = spark.sparkContext._jsc.sc()
    if named:
        if jvm.getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if jvm.getCheckpointDir().isEmpty():
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexweave-"))
    return jvm.getCheckpointDir().get()


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/lexweave-{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, folder: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def cut_lineage(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Writes the frame to the shared folder and reads it back, so a lost executor costs no recomputation.

    ``by`` writes one folder per value of these columns, so that readers of some values skip the rest. What an application writes
    stays until it ends, or until ``clear_shared``.
    """
    spark = df.sparkSession
    folder = _own_folder(spark)
    files, whole = _file_system(spark, folder)
    files.deleteOnExit(whole)
    path = f"{folder}/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return back.select(*(f"`{c}`" for c in df.columns))


def clear_shared(spark: SparkSession) -> None:
    """Deletes all that ``cut_lineage`` wrote in this application. Frames read back from there can't be used any more."""
    files, whole = _file_system(spark, _own_folder(spark))
    files.delete(whole, True)
