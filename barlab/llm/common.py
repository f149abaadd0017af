"""What the corpus operators share: rows' texts, row keys, checked broadcasts, Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The largest table, in rows, that carries a broadcast hint. The callers' rows have
#: at most a few dozen bytes, so this is some 30 MB at most.
BROADCAST_ROWS = 500_000
#: Characters of text that a Python task works on at a time.
SLICE_CHARS = 2_000_000


#: Bytes that Spark hands to a Python task at a time, unless the session has its own setting; a longer row goes alone.
BATCH_BYTES = 4 << 20
DEFAULT_BATCH_BYTES = 64 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the session ready for Python tasks.

    Sends this package's modules to the executors, once per application, and bounds Arrow batches by bytes: by rows
    alone, a batch of long texts is held several times over, in the JVM and in Python.
    """
    sc = spark.sparkContext
    if spark.conf.get(BATCH_SETTING) == f"{DEFAULT_BATCH_BYTES}b":
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="barlab-")) / f"{top.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for module in sorted(top.rglob("*.py")):
            z.write(module, module.relative_to(top.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def row_keys(text: Column) -> list[Column]:
    """128 bits that tell texts apart: two hashes with different seeds."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")]


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows that it has at most ``rows`` rows.

    ``df`` is a staged table, so counting it reads file footers. A larger table
    is returned as it is, and Spark joins it by a shuffle.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``chars`` bytes of text; one row at least."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(text)).nbytes
        if sizes <= chars:
            if batch.num_rows:
                yield batch
            continue
        lengths = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(batch.schema.get_field_index(text))]
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > chars:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)
