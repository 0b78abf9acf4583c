"""Text files in compressed blocks (BGZF) as a data source, format("blocklines"), that reads one file in many tasks.

A task has a range of the compressed bytes. It looks for the first block that begins there, and reads
lines from the first line end on, so what comes before belongs to the task before; it goes on behind its range until
the line that has begun is whole. Paths are folders or files that all executors mount, or in stores that Arrow opens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import bam
from .store import Store

SPLIT = 32 << 20
#: A block's first bytes, and those after its time and system, up to its size.
_MAGIC, _EXTRA, _HEAD = b"\x1f\x8b\x08\x04", b"\x06\x00BC\x02\x00", 18
_LARGEST = 1 << 16
SCHEMA = "file long, name string, split long, at long, value string"


class BlockError(ValueError):
    pass


def _size(raw: bytes, at: int) -> int:
    """The length of the block at a place, 0 if there is none."""
    head = raw[at : at + _HEAD]
    return int.from_bytes(head[16:18], "little") + 1 if len(head) == _HEAD and head[:4] == _MAGIC and head[10:16] == _EXTRA else 0


def first_block(raw: bytes, whole: bool) -> int:
    """Where in some bytes of a file the first block begins, -1 if nowhere. A block counts if another follows it, or, where the bytes are all to the end of the file, the end."""
    at = raw.find(_MAGIC)
    while at >= 0:
        size = _size(raw, at)
        if size and (_size(raw, at + size) or whole and at + size == len(raw)):
            return at
        at = raw.find(_MAGIC, at + 1)
    return -1


@dataclass
class Range(InputPartition):
    name: str
    split: int
    begin: int
    end: int
    length: int


#: Tasks that read a path at most; of more ranges some that follow each other go to one task.
TASKS = 1024


@dataclass
class Bundle(InputPartition):
    """Ranges that are read one after the other."""

    parts: list[Range]


class BlockReader(DataSourceReader):
    def __init__(self, store: Store, only: str | None, split: int):
        self.store, self.only, self.split = store, only, split

    def partitions(self):
        store, out = self.store, []
        for name in [self.only] if self.only else sorted(store.names()):
            if not name.startswith((".", "_")):
                length = store.length(name)
                out += [Range(name, k, begin, min(begin + self.split, length), length) for k, begin in enumerate(range(0, length, self.split))]
        size = -(-len(out) // TASKS) or 1
        return [Bundle(out[k : k + size]) for k in range(0, len(out), size)]

    def data(self, f, part: Range) -> Iterator[tuple[bool, bytes]]:
        """The unpacked blocks from the first that begins in a range on, each with whether it begins there."""
        f.seek(part.begin)
        want = min(part.length - part.begin, part.end - part.begin + 3 * _LARGEST)
        raw = f.read(min(want, 4 * _LARGEST))
        at = 0 if part.begin == 0 else first_block(raw, part.begin + len(raw) == part.length)
        if at < 0:
            if len(raw) > 2 * _LARGEST:
                raise BlockError(f"{part.name} has no compressed blocks behind {part.begin}")
            return
        place = part.begin + at
        raw = raw[at:]
        while place < part.length:
            if len(raw) < _LARGEST and place + len(raw) < part.length:
                raw += f.read(16 * _LARGEST)
            size = _size(raw, 0)
            if not size or size > len(raw):
                raise BlockError(f"{part.name} has a broken block at {place}")
            yield place < part.end, bam.unblocked(raw[:size])
            raw, place = raw[size:], place + size

    def lines(self, f, part: Range) -> Iterator[bytes]:
        """Runs of whole lines that begin in a range: behind its first line end, up to the one that is begun, or could be, at its end."""
        held, skip = b"", part.begin > 0
        for inside, data in self.data(f, part):
            if skip:
                end = data.find(b"\n")
                if not inside:
                    return  # no line begins in this range
                if end < 0:
                    continue
                skip, data = False, data[end + 1 :]
            if not inside:
                end = data.find(b"\n")
                if end < 0:
                    held += data
                    continue
                yield held + data[: end + 1]
                return
            end = data.rfind(b"\n") + 1
            if end:
                yield held + data[:end]
            held = held + data[end:] if not end else data[end:]
        if held:
            yield held

    def read(self, partition):
        for part in partition.parts:
            yield from self.rows(part)

    def rows(self, partition: Range) -> Iterator[pa.RecordBatch]:
        at = 0
        with self.store.open(partition.name) as f:
            for data in self.lines(f, partition):
                values = (data[:-1] if data.endswith(b"\n") else data).split(b"\n")
                n = len(values)
                columns = [np.zeros(n, np.int64), pa.array([partition.name] * n), np.full(n, partition.split), np.arange(at, at + n), pa.array(values, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c) if not isinstance(c, pa.Array) else c for c in columns], names=["file", "name", "split", "at", "value"])
                at += n


class BlockLines(DataSource):
    @classmethod
    def name(cls):
        return "blocklines"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        options = {k.removeprefix("store."): v for k, v in self.options.items() if k.startswith("store.")}
        store, only = Store(self.options["path"], options), None
        if not store.is_folder():
            folder, _, only = self.options["path"].rpartition("/")
            store = Store(folder, options)
        return BlockReader(store, only, int(self.options.get("split", SPLIT)))


def lines(spark: SparkSession, path: str, split: int = SPLIT, store: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """value, file and line of the files of a path, and file, name and n lines of each; as those of plain text in `text`."""
    spark.dataSource.register(BlockLines)
    rows = spark.read.format("blocklines").option("split", split).options(**{f"store.{k}": v for k, v in (store or {}).items()}).load(path).withColumn("file", F.xxhash64("name"))
    counts = rows.groupBy("file", "split").agg(F.min("name").alias("name"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = rows.join(F.broadcast(counts.select("file", "split", before.alias("before"))), ["file", "split"])
    return joined.select("value", "file", (F.col("before") + F.col("at")).alias("line")), counts.groupBy("file").agg(F.min("name").alias("name"), F.sum("n").alias("n"))


def write_lines(rows: DataFrame, folder: str, store: dict[str, str] | None = None) -> int:
    """Lines (value), in the order of the partitions, as a file of blocks for each partition; gives the number of lines."""
    files = Store(folder, store)
    schema = pa.schema([("n", pa.int64())])

    def work(batches):
        from pyspark import TaskContext

        held, done, n = b"", [], 0
        for b in batches:
            held += b"".join(v + b"\n" for v in b.column("value").cast(pa.binary()).to_pylist())
            n += b.num_rows
            whole = len(held) // bam.BLOCK * bam.BLOCK
            done.append(bam.blocks(held[:whole]))
            held = held[whole:]
        files.write(f"part-{TaskContext.get().partitionId():05d}.gz", b"".join([*done, bam.blocks(held), bam.EOF_BLOCK]))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], schema=schema)

    return rows.select("value").mapInArrow(work, "n long").agg(F.sum("n")).first()[0] or 0

