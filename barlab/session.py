"""Session settings the operators rely on, and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "barlab") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="barlab-"))
    return sc.getCheckpointDir()


#: Paths of the tables staged so far, for :func:`staged_tables`.
_staged: list[str] = []


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was staged inside.

    Results of operators read staged tables, so write them out before the scope ends.
    """
    before = len(_staged)
    try:
        yield
    finally:
        for path in _staged[before:]:
            held = spark._jvm.org.apache.hadoop.fs.Path(path)
            held.getFileSystem(spark._jsc.hadoopConfiguration()).delete(held, True)
        del _staged[before:]


def stage(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Used where a result feeds several consumers, or where a row's physical
    position becomes data: the table survives lost executors and is not
    recomputed. Also used for the small side of a join with a large table: its
    size is then known before the plan is made, and if it can be broadcast the
    large table is not shuffled first. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/barlab/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)
