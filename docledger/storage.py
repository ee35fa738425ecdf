"""The shared folder and tables written there, to cut lineages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver see; one of our own only where none is set and all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="docledger-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _tables(spark: SparkSession) -> str:
    """This application's folder in the shared folder."""
    return f"{shared_dir(spark)}/docledger/{spark.sparkContext.applicationId}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder as Parquet and read that back.

    A lost executor then costs only the tasks that ran on it, never the stages before.
    """
    spark = df.sparkSession
    path = f"{_tables(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_in_buckets(df: DataFrame, label: str, column: str, buckets: int) -> DataFrame:
    """As `written`, in buckets by a column: what meets these rows by that column comes to them, and they aren't shuffled."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, column).option("path", f"{_tables(spark)}/{name}").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"drop table {name}")  # the name alone: the files lie outside the warehouse and stay
    return out


def save_bytes(spark: SparkSession, content: bytes, name: str) -> str:
    """Write one small file into a new folder of the shared folder, through its own file system; its path."""
    path = f"{_tables(spark)}/{uuid.uuid4().hex}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return path


def remove_written(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder: DataFrames of its operators can't be read after that."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_tables(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
