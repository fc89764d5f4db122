"""A shared folder for checkpoints and for tables that cut lineage."""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def _filesystem(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`. A session on one machine that names
    none gets one in Java's folder for temporary files; a cluster must name its own."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {SETTING} to a folder that all executors of {master} share")
        java = spark._jvm.java.lang.System.getProperty("java.io.tmpdir")
        folder = f"{java.rstrip('/')}/tradepath-{spark.sparkContext.applicationId}"
        _remove_at_exit(spark, folder)
        spark.conf.set(SETTING, folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    filesystem, place = _filesystem(spark, folder)
    if not filesystem.exists(place):
        filesystem.mkdirs(place)
        filesystem.deleteOnExit(place)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the application's folder that nothing else uses."""
    return f"{own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def own_folder(spark: SparkSession) -> str:
    """The folder of this application below the shared one, which goes when it ends."""
    own = f"{shared_folder(spark)}/tradepath/{spark.sparkContext.applicationId}"
    _remove_at_exit(spark, own)
    return own


def remove(spark: SparkSession, path: str) -> None:
    """Delete a working copy, wherever Spark wrote it."""
    filesystem, place = _filesystem(spark, path)
    filesystem.delete(place, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as parquet and read it back, so that later plans start from the files
    and survive the loss of executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
