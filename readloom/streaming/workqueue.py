"""The queue of chunks as a stream: JSON rows in a folder, processed once each, with replies."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources.store import Store

MESSAGE = "obj_name string, pool string"


def push(chunks: DataFrame, queue: str, pool: str = "") -> None:
    """Chunk references (path) as messages; files appear in the folder whole."""
    chunks.select(F.to_json(F.struct(F.col("path").alias("obj_name"), F.lit(pool).alias("pool"))).alias("value")).write.mode("append").text(queue)


def messages(spark: SparkSession, queue: str, files_per_batch: int | None = None) -> DataFrame:
    """obj_name, pool as they come; files_per_batch holds back the rest."""
    reader = spark.readStream.schema("value string").format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(queue).select(F.from_json("value", MESSAGE).alias("m")).select("m.*")


def process(queue: DataFrame, work: Callable[[DataFrame], DataFrame], done: str, checkpoint: str, forever: bool = False, every: str = "1 second", name: str | None = None) -> StreamingQuery:
    """Each chunk's `work` result under `done`, in a folder for each batch, which a repeated batch overwrites.

    With the checkpoint a restart goes on where it stopped; each chunk is processed, and shows in the
    results, once. Unless forever, the query ends when the queue is empty.
    """

    def batch(found: DataFrame, number: int) -> None:
        work(found).write.mode("overwrite").parquet(f"{done}/batch={number}")

    writer = (queue.writeStream.queryName(name) if name else queue.writeStream).foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if forever else writer.trigger(availableNow=True)).start()


def completed(spark: SparkSession, done: str) -> DataFrame:
    """All results so far, with the batch of each."""
    return spark.read.parquet(done)


class DepthLog(StreamingQueryListener):
    """Writes time, batch, messages and rows a second of each batch, as the batch ends, into a folder of CSV files, one a batch.

    Nothing is held but the numbers of the last batches, however long a query runs; a batch that is repeated after a
    restart has the same file. `name`: only queries of that name; others of the session are left out.
    """

    def __init__(self, folder: str, name: str | None = None, store: dict[str, str] | None = None):
        self.store, self.name, self.last, self.came = Store(folder, store), name, {}, threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if self.name is None or p.name == self.name:
            row = f"{p.timestamp},{p.batchId},{p.numInputRows},{p.inputRowsPerSecond or 0}"
            self.store.write(f"{p.id}-{p.batchId:012d}.csv", f"time,batch,messages,per_second\n{row}\n".encode())
            with self.came:
                self.last[str(p.id)] = p.batchId
                self.came.notify_all()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the last batch of a query has its row; Spark tells listeners of it some time after."""
        last, until = query.lastProgress, time.monotonic() + seconds
        with self.came:
            while last and self.last.get(str(query.id), -1) < last["batchId"]:
                if not self.came.wait(max(0.0, until - time.monotonic())):
                    raise TimeoutError("the last batch was not reported")


@contextmanager
def logged_depths(spark: SparkSession, folder: str, name: str | None = None, store: dict[str, str] | None = None) -> Iterator[DepthLog]:
    """A `DepthLog` of the queries that run within the block."""
    log = DepthLog(folder, name, store)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def depths(spark: SparkSession, folder: str) -> DataFrame:
    """time, batch, messages, per_second of a depth log."""
    return spark.read.csv(folder, header=True, schema="time timestamp, batch long, messages long, per_second double")
