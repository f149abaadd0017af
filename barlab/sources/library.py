"""A table published in versions: readers see the old one or the new one, never half of one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"


def publish(df: DataFrame, folder: str) -> str:
    """Write ``df`` as a new version below ``folder`` and make it the current one; returns the version.

    The version's files lie in a folder of their own. Only when they are complete, a file that names the version replaces the pointer by one
    atomic rename, so a writer that dies before leaves readers with the version they had. Of two writers at
    a time the last rename counts. Old versions stay readable by name.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.parquet(f"{folder}/versions/{version}")
    _point(spark, folder, version)
    return version


def _point(spark: SparkSession, folder: str, version: str) -> None:
    fs = spark._jvm.org.apache.hadoop.fs
    fresh, pointer = fs.Path(f"{folder}/.{POINTER}-{version}"), fs.Path(f"{folder}/{POINTER}")
    out = fresh.getFileSystem(spark._jsc.hadoopConfiguration()).create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, pointer, overwrite)


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The version that readers get now; None if none was ever published."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.text(f"{folder}/{POINTER}").first()["value"]


def read_library(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """The current version of the table, or the one named. A reader that has begun stays with its version."""
    version = version or current_version(spark, folder)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(f"{folder}/versions/{version}").withColumn("version", F.lit(version))
