"""Tables fed to streaming queries in batches, as they would have arrived."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.session import shared_folder


def replay(arrivals: DataFrame, batch: str, outputs: Mapping[str, Callable[[DataFrame], DataFrame]]) -> dict[str, DataFrame]:
    """What streaming queries make of ``arrivals``, one table per output.

    The rows of each value of ``batch``, in ascending order, are appended to a folder and taken in before the next ones; the watermark
    moves after every batch. ``outputs`` turn the stream of rows (without ``batch``) into streams that append. Source, state
    and results lie in the shared folder, so a query that is started again goes on where it was. The driver knows the
    numbers of the batches only.
    """
    spark = arrivals.sparkSession
    home = f"{shared_folder(spark)}/barlab/replay-{uuid.uuid4().hex}"
    rows = arrivals.drop(batch)
    numbers = sorted(r[0] for r in arrivals.select(batch).distinct().collect())

    def run(name: str):
        source = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        return (
            outputs[name](source).writeStream.outputMode("append").format("parquet").option("path", f"{home}/out/{name}")
            .option("checkpointLocation", f"{home}/state/{name}").trigger(availableNow=True).start()
        )

    for number in numbers:
        arrivals.filter(F.col(batch) == number).drop(batch).write.mode("append").parquet(f"{home}/in")
        for query in [run(name) for name in outputs]:
            query.awaitTermination()
    found = {}
    for name, made in outputs.items():
        schema = made(spark.readStream.schema(rows.schema).parquet(f"{home}/in")).schema if numbers else made(rows).schema
        found[name] = spark.read.schema(schema).parquet(f"{home}/out/{name}") if numbers else spark.createDataFrame([], schema)
    return found
