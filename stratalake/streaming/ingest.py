"""Capture as a stream: the checkpoint remembers which files were read."""

import json

from pyspark.sql import DataFrame

from stratalake.sources.landing import envelope
from stratalake.sources.shared import read_file
from stratalake.sources.store import Warehouse


def ingest_new_files(payloads: DataFrame, warehouse: Warehouse, checkpoint: str) -> None:
    """Put the payloads of a stream's new files into ``raw.records``, then stop.

    ``payloads`` is a landing function over ``spark.readStream``. Of a key that arrives again
    the payload of the later file stays, in whatever order, batches and runs the files come: the
    time of its file is stored with each record. Called again with the same
    folders, it goes on where it stopped; a batch that is run again after a failure counts once.
    """
    spark = warehouse.spark

    def write(batch: DataFrame, number: int) -> None:
        # the id of the stream: a new checkpoint in the same place is another stream
        stream = json.loads(read_file(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        warehouse.upsert("raw.records", batch, seq="seq", newer=True, stream=(stream, number))

    query = (
        envelope(payloads, "seq")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
