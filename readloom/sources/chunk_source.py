"""Datasets of chunk files as a Spark data source, format("readchunks"), for batches and as a stream.

Reading: a partition for each chunk; option columns (comma-separated) opens only those
files; filters on ordinal drop chunks before they are opened. A chunk of alignments has the least and
the greatest place (ref_index, position) in the manifest, so filters on the place drop chunks too, and
inside a chunk that is sorted by place the rows are found by binary search. As a stream, the
chunks that the manifest has got since come as new rows. Writing: rows must come with ordinal and, for
several samples, in folders of their own; each task writes its chunks, and the manifest is
written once, on commit. A stream is written as chunks that the manifest gets with the number of
their batch, so a batch that is repeated counts once (option stream tells apart streams into one dataset). Paths are folders that all executors mount, or addresses of stores
that Arrow opens; options store.* configure the store. What only Spark opens is read with `read_chunks`.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from ..schema import ALIGNMENT
from . import chunk_format, messages, text
from .store import Store

MANIFEST = "metadata.json"


def _values(column: str, body: chunk_format.Body) -> pa.Array:
    if column == "aln":
        return messages.decode(body.data, body.begins, body.ends)
    return messages.strings(np.frombuffer(body.data, np.uint8), body.begins, body.ends)


def _chunk(column: str, values: pa.Array, name: str, first: int) -> bytes:
    """A chunk file; null is an empty record."""
    values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) and values.num_chunks > 1 else values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    if column == "aln":
        return chunk_format.encode_body(*messages.encode(values.cast(messages.ALIGNMENT)), name, first, chunk_format.STRUCTURED)
    raw = pc.fill_null(values.cast(pa.large_binary()), b"")
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = raw.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if raw.buffers()[2] else b""
    return chunk_format.encode_body(np.diff(ends), data, name, first, chunk_format.TEXT)


Place = tuple[int, int]


def zone(values: pa.Array) -> dict | None:
    """The least and the greatest place of alignments, and whether all rows have one and lie in that order; None without any."""
    values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
    there = values.is_valid()
    kept = values.filter(there)
    if not len(kept):
        return None
    ref, position = (pc.fill_null(pc.struct_field(kept, ["position", c]), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ref_index", "position"))
    order = np.lexsort((position, ref))
    in_order = (ref[1:] > ref[:-1]) | (ref[1:] == ref[:-1]) & (position[1:] >= position[:-1])
    low, high = ([int(ref[i]), int(position[i])] for i in (order[0], order[-1]))
    return {"low": low, "high": high, "sorted": bool(in_order.all()) and len(kept) == len(values)}


def bound(body: chunk_format.Body, place: Place, after: bool = False) -> int:
    """How many of the alignments of a sorted chunk lie before a place, or up to it; some twenty messages are read."""
    low, high = 0, len(body.begins)
    while low < high:
        middle = (low + high) // 2
        ref, position = messages.places(body.data, body.begins[middle : middle + 1], body.ends[middle : middle + 1])
        here = int(ref[0]), int(position[0])
        low, high = (middle + 1, high) if here < place or after and here == place else (low, middle)
    return low


def _type(column: str) -> str:
    return ALIGNMENT if column == "aln" else "string"


def _manifest(store: Store) -> dict:
    return json.loads(store.read(MANIFEST))


def _dense(ordinals: list[int], first: int) -> None:
    if ordinals != list(range(first, first + len(ordinals))):
        raise ValueError("the ordinals of a chunk must be dense and in order")


@dataclass
class ChunkPartition(InputPartition):
    """A chunk; of a sorted one only the rows from place `low` to place `high` are wanted."""

    path: str
    first: int
    last: int
    low: Place | None = None
    high: Place | None = None


#: Tasks that read a dataset at most; of more chunks some that follow each other go to one task.
TASKS = 1024


@dataclass
class Bundle(InputPartition):
    """Chunks that are read one after the other."""

    parts: list[ChunkPartition]


def bundled(parts: list[ChunkPartition]) -> list[Bundle]:
    size = -(-len(parts) // TASKS) or 1
    return [Bundle(parts[k : k + size]) for k in range(0, len(parts), size)]


@dataclass
class Bounds:
    """Closed bounds of a number, which filters narrow."""

    low: int | None = None
    high: int | None = None

    def narrow(self, f) -> None:
        if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
            low = f.value + isinstance(f, GreaterThan)
            self.low = low if self.low is None else max(self.low, low)
        if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
            high = f.value - isinstance(f, LessThan)
            self.high = high if self.high is None else min(self.high, high)


_FAR = 1 << 63
_BOUNDED = {("ordinal",): "ordinal", ("aln", "position", "ref_index"): "ref", ("aln", "position", "position"): "position"}


class ChunkReader(DataSourceReader):
    def __init__(self, store: Store, columns: list[str]):
        self.store, self.columns = store, columns
        self.bounds = {name: Bounds() for name in _BOUNDED.values()}

    def pushFilters(self, filters):
        for f in filters:
            name = _BOUNDED.get(tuple(getattr(f, "attribute", ())))
            if name and isinstance(getattr(f, "value", None), int):
                self.bounds[name].narrow(f)
            yield f  # only chunks, and parts of sorted ones, are dropped here; Spark filters the rows

    def records(self) -> list[dict]:
        return sorted(_manifest(self.store)["records"], key=lambda r: r["first"])

    def places(self) -> tuple[Place, Place] | None:
        """The least and the greatest place that the filters leave."""
        ref, position = self.bounds["ref"], self.bounds["position"]
        if ref.low is None and ref.high is None:
            return None
        one = ref.low is not None and ref.low == ref.high  # positions follow each other on one contig only
        low = -_FAR if ref.low is None else ref.low, position.low if one and position.low is not None else -_FAR
        return low, (_FAR if ref.high is None else ref.high, position.high if one and position.high is not None else _FAR)

    def partitions(self):
        own, places, out = self.bounds["ordinal"], self.places(), []
        for r in self.records():
            if own.low is not None and r["last"] <= own.low or own.high is not None and r["first"] > own.high:
                continue
            found = r.get("zone")
            if not (places and found):
                out.append(ChunkPartition(r["path"], r["first"], r["last"]))
            elif tuple(found["high"]) >= places[0] and tuple(found["low"]) <= places[1]:
                out.append(ChunkPartition(r["path"], r["first"], r["last"], *(places if found["sorted"] else ())))
        return bundled(out)

    def body(self, partition: ChunkPartition, column: str) -> chunk_format.Body:
        body, n = chunk_format.decode_body(self.store.read(f"{partition.path}.{column}")), partition.last - partition.first
        if len(body.begins) != n:
            raise chunk_format.FormatError(f"{partition.path}.{column} has {len(body.begins)} records, the manifest {n}")
        return body

    def read(self, partition):
        for part in partition.parts:
            yield from self.chunk(part)

    def chunk(self, partition: ChunkPartition) -> Iterator[pa.RecordBatch]:
        low, high = 0, partition.last - partition.first
        if partition.low is not None:
            found = self.body(partition, "aln")
            low, high = bound(found, partition.low), bound(found, partition.high, after=True)
        columns = [_values(c, self.body(partition, c).part(low, high)) for c in self.columns] if low < high else []
        if low < high:
            yield pa.RecordBatch.from_arrays([pa.array(range(partition.first + low, partition.first + high), pa.int64()), *columns], names=["ordinal", *self.columns])


class ChunkStream(DataSourceStreamReader):
    """The chunks of a dataset that grows. The offset is the number of the newest chunk that was read, in the order in which the manifest got them.

    Chunks have their number in the manifest, or else their place in its list; so chunks may come before
    others by ordinal. A dataset that was overwritten is another one, at which the stream stops.
    """

    def __init__(self, store: Store, columns: list[str]):
        self.reader = ChunkReader(store, columns)

    def initialOffset(self):
        return {"made": _manifest(self.reader.store).get("made", ""), "number": 0}

    def latestOffset(self):
        found = _manifest(self.reader.store)
        return {"made": found.get("made", ""), "number": max((n for n, _ in _numbered(found)), default=0)}

    def partitions(self, start, end):
        if start["made"] != end["made"]:
            raise ValueError("the dataset was overwritten; its stream must begin anew")
        wanted = [r for n, r in _numbered(_manifest(self.reader.store)) if start["number"] < n <= end["number"]]
        return bundled([ChunkPartition(r["path"], r["first"], r["last"]) for r in sorted(wanted, key=lambda r: r["first"])])

    def read(self, partition):
        return self.reader.read(partition)

    def commit(self, end):
        pass


def _numbered(manifest: dict) -> list[tuple[int, dict]]:
    """The chunks of a manifest with their numbers, from 1."""
    return [(r.get("number", k + 1), r) for k, r in enumerate(manifest["records"])]


@dataclass
class Written(WriterCommitMessage):
    records: list[dict] = field(default_factory=list)


class ChunkWriter(DataSourceArrowWriter):
    def __init__(self, store: Store, name: str, columns: list[str], overwrite: bool, size: int):
        self.store, self.name, self.columns, self.size = store, name, columns, size
        self.old: set[str] = set()
        if store.exists(MANIFEST):
            if not overwrite:
                raise FileExistsError(f"{store.folder} holds a dataset")
            found = _manifest(store)
            self.old = {f"{r['path']}.{c}" for r in found["records"] for c in found["columns"]}

    def write(self, iterator):
        made, held, now = [], [], None
        for rows in iterator:  # by ordinal
            ordinals = rows.column("ordinal").to_numpy()
            at = 0
            while at < rows.num_rows:
                k = int(ordinals[at]) // self.size
                to = int(ordinals.searchsorted((k + 1) * self.size))
                if to <= at:
                    raise ValueError("the ordinals of a chunk must be dense and in order")
                if held and k != now:
                    made.append(self._put(held))
                    held = []
                held.append(rows.slice(at, to - at))
                at, now = to, k
        if held:
            made.append(self._put(held))
        return Written(made)

    def _put(self, batches):
        rows = pa.Table.from_batches(batches)
        ordinals = rows.column("ordinal").to_pylist()
        first = ordinals[0]
        _dense(ordinals, first)
        path = f"{self.name}_{first}"
        return _put_chunk(self.store, self.columns, rows, self.name, first, path)  # a repeated task writes the same

    def commit(self, messages):
        records = sorted((r for m in messages if m for r in m.records), key=lambda r: r["first"])
        _check_apart(records)
        found = {"name": self.name, "version": 1, "made": uuid.uuid4().hex, "columns": self.columns, "records": records}
        self.store.write(MANIFEST, json.dumps(found).encode())
        for name in (self.old & self.store.names()) - {f"{r['path']}.{c}" for r in records for c in self.columns}:
            self.store.delete(name)

    def abort(self, messages):
        _delete(self.store, messages, self.columns)


def _put_chunk(store: Store, columns: list[str], rows: pa.Table, name: str, first: int, path: str) -> dict:
    """The files of a chunk, and what the manifest has of it."""
    for c in columns:
        store.write(f"{path}.{c}", _chunk(c, rows.column(c), name, first))
    own = {"first": first, "last": first + rows.num_rows, "path": path}
    return own | ({"zone": zone(rows.column("aln"))} if "aln" in columns else {})


def _check_apart(records: list[dict]) -> None:
    """Chunks, by first, must not share ordinals."""
    if any(a["last"] > b["first"] for a, b in zip(records, records[1:], strict=False)):
        raise ValueError("chunks overlap; the rows of a chunk must come to one task")


def _delete(store: Store, messages, columns: list[str]) -> None:
    here = store.names() if messages else set()
    for name in here & {f"{r['path']}.{c}" for m in messages if m for r in m.records for c in columns}:
        store.delete(name)


class ChunkStreamWriter(DataSourceStreamArrowWriter):
    """A stream's rows as chunks of runs of ordinals, of one task each. The manifest gets a batch's chunks at once, with its number; a batch that it has already is not taken again."""

    def __init__(self, store: Store, name: str, columns: list[str], size: int, stream: str):
        self.store, self.name, self.columns, self.size, self.stream = store, name, columns, size, stream

    def write(self, iterator):
        batches = list(iterator)  # what a task has of one batch of the stream
        rows = pa.Table.from_batches(batches).sort_by("ordinal").combine_chunks() if batches else None
        if not rows or not rows.num_rows:
            return Written()
        ordinals = rows.column("ordinal").to_numpy()
        if (ordinals[1:] == ordinals[:-1]).any():
            raise ValueError("an ordinal comes twice")
        cut = np.flatnonzero((np.diff(ordinals) != 1) | (ordinals[1:] // self.size != ordinals[:-1] // self.size)) + 1
        made, attempt = [], uuid.uuid4().hex[:8]
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(ordinals)], strict=True):
            first = int(ordinals[a])
            made.append(_put_chunk(self.store, self.columns, rows.slice(a, b - a), self.name, first, f"{self.name}_{first}-{attempt}"))
        return Written(made)

    def commit(self, messages, batchId):
        found = _manifest(self.store) if self.store.exists(MANIFEST) else {"name": self.name, "version": 1, "made": uuid.uuid4().hex, "columns": self.columns, "records": []}
        if found["columns"] != self.columns:
            raise ValueError(f"the dataset has the columns {found['columns']}")
        if found.get("batches", {}).get(self.stream, -1) >= batchId:  # the commit came through, but Spark did not learn of it
            _delete(self.store, messages, self.columns)
            return
        last = max((n for n, _ in _numbered(found)), default=0)
        new = sorted((r for m in messages if m for r in m.records), key=lambda r: r["first"])
        records = [r | {"number": n} for n, r in _numbered(found)] + [r | {"number": last + k + 1, "batch": batchId} for k, r in enumerate(new)]
        _check_apart(sorted(records, key=lambda r: r["first"]))
        found |= {"records": records, "batches": found.get("batches", {}) | {self.stream: batchId}}
        self.store.write(MANIFEST, json.dumps(found).encode())

    def abort(self, messages, batchId):
        _delete(self.store, messages, self.columns)


class ChunkSource(DataSource):
    @classmethod
    def name(cls):
        return "readchunks"

    def _store(self) -> Store:
        return Store(self.options["path"], {k.removeprefix("store."): v for k, v in self.options.items() if k.startswith("store.")})

    def _columns(self) -> list[str]:
        have = _manifest(self._store())["columns"]
        wanted = [c.strip() for c in self.options.get("columns", ",".join(have)).split(",")]
        if missing := [c for c in wanted if c not in have]:
            raise ValueError(f"the dataset has no column {missing[0]}")
        return wanted

    def schema(self):
        return ", ".join(["ordinal bigint", *(f"{c} {_type(c)}" for c in self._columns())])

    def reader(self, schema):
        return ChunkReader(self._store(), [f.name for f in schema.fields if f.name != "ordinal"])

    def streamReader(self, schema):
        return ChunkStream(self._store(), [f.name for f in schema.fields if f.name != "ordinal"])

    def streamWriter(self, schema, overwrite):
        if overwrite:
            raise ValueError("a stream is appended to a dataset")
        store = self._store()
        return ChunkStreamWriter(store, self.options.get("dataset", store.folder.rpartition("/")[2]), [f.name for f in schema.fields if f.name != "ordinal"], int(self.options.get("chunk", 100_000)), self.options.get("stream", ""))

    def writer(self, schema, overwrite):
        store = self._store()
        return ChunkWriter(store, self.options.get("dataset", store.folder.rpartition("/")[2]), [f.name for f in schema.fields if f.name != "ordinal"], overwrite, int(self.options.get("chunk", 100_000)))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # the reader drops chunks by filters
    spark.dataSource.register(ChunkSource)


def _options(store: dict[str, str] | None) -> dict[str, str]:
    return {f"store.{k}": v for k, v in (store or {}).items()}


def write(rows: DataFrame, folder: str, name: str, chunk: int = 100_000, mode: str = "append", store: dict[str, str] | None = None) -> None:
    """Rows with dense ordinals as a dataset: dealt by chunk, so that no chunk is split between tasks.

    mode overwrite replaces a dataset and deletes the files of its chunks that aren't written again.
    """
    if chunk <= 0:
        raise ValueError("the chunk size must be positive")
    register(rows.sparkSession)
    dealt = rows.repartition(F.floor(F.col("ordinal") / chunk)).sortWithinPartitions("ordinal")
    dealt.write.format("readchunks").options(dataset=name, chunk=chunk, **_options(store)).mode(mode).save(folder)


def append_column(spark: SparkSession, folder: str, rows: DataFrame, column: str, ref_genome: list[tuple[str, int]] | None = None, store: dict[str, str] | None = None) -> None:
    """Chunk files of one more column for a dataset, from rows(ordinal, column); the manifest is replaced last.

    Fails, and leaves the manifest as it is, unless there is a row for each ordinal of the dataset.
    Rows find their chunk by an equi-join with stretches of ordinals, two of a chunk at most.
    """
    files = Store(folder, store)
    found = _manifest(files)
    name, records = found["name"], [(r["first"], r["last"], r["path"]) for r in found["records"]]
    size = max([b - a for a, b, _ in records], default=1) or 1
    chunks = spark.createDataFrame(records, "first bigint, last bigint, path string").where("last > first")
    bins = chunks.withColumn("bin", F.explode(F.array_distinct(F.array(F.floor(F.col("first") / size), F.floor((F.col("last") - 1) / size)))))
    placed = rows.select("ordinal", column).withColumn("bin", F.floor(F.col("ordinal") / size)).join(bins, "bin").where("ordinal >= first and ordinal < last").drop("bin")

    def put(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("ordinal")
        first, last = table.column("first")[0].as_py(), table.column("last")[0].as_py()
        ordinals = table.column("ordinal").to_pylist()
        _dense(ordinals, first)
        if len(ordinals) != last - first:
            raise ValueError("a chunk's rows are not complete")
        files.write(f"{key[0].as_py()}.{column}", _chunk(column, table.column(column), name, first))
        shown = json.dumps(zone(table.column(column))) if column == "aln" else None
        return pa.table({"path": pa.array([key[0].as_py()]), "n": pa.array([len(ordinals)], pa.int64()), "zone": pa.array([shown], pa.string())})

    made = placed.groupBy("path").applyInArrow(put, "path string, n long, zone string").collect()  # a row a chunk, as in the manifest
    if sum(r.n for r in made) != sum(b - a for a, b, _ in records):
        raise ValueError("there are not rows for all chunks of the dataset")
    update_manifest(folder, column, ref_genome, store, {r.path: json.loads(r.zone) for r in made} if column == "aln" else None)


def update_manifest(folder: str, column: str | None = None, ref_genome: list[tuple[str, int]] | None = None, store: dict[str, str] | None = None, zones: dict[str, dict | None] | None = None) -> None:
    """Add a column to a dataset's manifest, once, and replace its reference (contigs as name and length), or its chunks' zones by path."""
    files = Store(folder, store)
    found = _manifest(files)
    if column and column not in found["columns"]:
        found["columns"].append(column)
    if ref_genome is not None:
        found["ref_genome"] = [{"name": n, "length": size} for n, size in ref_genome]
    if zones is not None:
        found["records"] = [r | {"zone": zones.get(r["path"])} for r in found["records"]]
    files.write(MANIFEST, json.dumps(found).encode())


def load(spark: SparkSession, folder: str, columns: list[str] | None = None, store: dict[str, str] | None = None) -> DataFrame:
    register(spark)
    reader = spark.read.format("readchunks").options(**_options(store))
    return (reader.option("columns", ",".join(columns)) if columns else reader).load(folder)


#: A place that more chunks may hold is looked up by a join with their rows, and rows of a chunk that are wanted by one task.
CROWDED, SHARE = 8, 10_000


class Zones:
    """The zones of a dataset's chunks, by their least places."""

    def __init__(self, records: list[dict]):
        self.records = sorted((r for r in records if r.get("zone")), key=lambda r: r["zone"]["low"])
        self.lows, self.highs = ([tuple(r["zone"][k]) for r in self.records] for k in ("low", "high"))
        self.ends = sorted(self.highs)
        self.tops = list(accumulate(self.highs, max))

    def n(self, place: Place) -> int:
        """How many chunks may hold a place."""
        return bisect_right(self.lows, place) - bisect_left(self.ends, place)

    def holding(self, place: Place) -> list[int]:
        return [k for k in range(bisect_left(self.tops, place), bisect_right(self.lows, place)) if self.highs[k] >= place]

    def crowded(self) -> list[int]:
        """Chunks with a place that more than `CROWDED` chunks may hold; the number is greatest where some zone begins."""
        many = [p for p in dict.fromkeys(self.lows) if self.n(p) > CROWDED]
        # a crowded stretch goes from such a place up to the next end of a zone
        return [k for k, (low, high) in enumerate(zip(self.lows, self.highs, strict=True)) if self.n(low) > CROWDED or bisect_right(many, high) > bisect_left(many, low)]


def look_up(spark: SparkSession, folder: str, wanted: DataFrame, columns: list[str] | None = None, store: dict[str, str] | None = None) -> DataFrame:
    """Rows of a dataset at wanted places: all columns of `wanted`, ordinal, and the dataset's columns (none may clash).

    wanted: ref_index and position, and with a column meta only rows with that text count; equal wanted rows get
    their rows each. Only chunks whose zone has the place are opened, each once for a share of 10,000 rows that
    are wanted of it; in a sorted chunk few places are found by binary search, many, and those of others, after all its places are read.
    Places that more than `CROWDED` chunks may hold (as those of unmapped reads) are met by a join: these chunks are opened once.
    """
    files = Store(folder, store)
    found = _manifest(files)
    columns = columns or found["columns"]
    if missing := [c for c in [*columns, "aln"] if c not in found["columns"]]:
        raise ValueError(f"the dataset has no column {missing[0]}")
    names, by_meta = wanted.columns, "meta" in wanted.columns
    shown = [c for c in columns if not (by_meta and c == "meta")]
    zones, reader = Zones(found["records"]), ChunkReader(files, columns)
    needed = {*shown, "aln"} | ({"meta"} if by_meta else set())
    place = "struct<" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in wanted.schema.fields) + ">"
    row = F.struct(*(F.col(c) for c in names)).alias("asked")

    def opened(k: int) -> dict[str, chunk_format.Body]:
        r = zones.records[k]
        own = ChunkPartition(r["path"], r["first"], r["last"])
        return {c: reader.body(own, c) for c in needed}

    def part(bodies, rows: np.ndarray) -> list[pa.Array]:
        of = [chunk_format.Body(b.first, b.last, b.name, b.kind, b.data, b.begins[rows], b.ends[rows]) for b in (bodies[c] for c in shown)]
        return [_values(c, p) for c, p in zip(shown, of, strict=True)]

    def chunks_of(batches):
        """The chunks that each wanted row is looked up in; -1 for those that are met by the join."""
        for b in batches:
            at, chunk = [], []
            for i, here in enumerate(zip(b.column("ref_index").to_pylist(), b.column("position").to_pylist(), strict=True)):
                if None not in here:
                    mine = [-1] if zones.n(here) > CROWDED else zones.holding(here)
                    at += [i] * len(mine)
                    chunk += mine
            yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int32()), b.column("asked").take(pa.array(at, pa.int64()))], names=["chunk", "asked"])

    def looked_up(batches) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            chunk, asked = b.column("chunk").to_numpy(), b.column("asked")
            edge = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1], True]) if len(chunk) else np.zeros(1, np.int64)
            for low, high in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if chunk[low] != now:
                    now = int(chunk[low])
                    r, bodies, places = zones.records[now], opened(now), None
                own = asked.slice(low, high - low)
                by_place: dict[Place, list[int]] = {}
                for i, here in enumerate(zip(pc.struct_field(own, "ref_index").to_pylist(), pc.struct_field(own, "position").to_pylist(), strict=True)):
                    by_place.setdefault(here, []).append(i)
                if places is None and not (r["zone"]["sorted"] and len(by_place) * 32 < r["last"] - r["first"]):
                    places = rows_of(bodies["aln"])
                texts = pc.struct_field(own, "meta").to_pylist() if by_meta else None
                at, rows = [], []
                for here, mine in by_place.items():
                    hits = places.get(here, ()) if places is not None else range(bound(bodies["aln"], here), bound(bodies["aln"], here, after=True))
                    if by_meta:
                        of_text: dict[str, list[int]] = {}
                        for h in hits:
                            of_text.setdefault(bodies["meta"].record(h), []).append(h)
                    for i in mine:
                        of = hits if not by_meta else of_text.get(texts[i].encode(), ()) if texts[i] is not None else ()
                        at += [i] * len(of)
                        rows += of
                if at:
                    taken, rows = own.take(pa.array(at)), np.array(rows)
                    yield pa.RecordBatch.from_arrays([*(pc.struct_field(taken, c) for c in names), pa.array(r["first"] + rows), *part(bodies, rows)], names=[*names, "ordinal", *shown])

    def rows_of(body: chunk_format.Body) -> dict[Place, list[int]]:
        """The rows of a chunk by their places."""
        ref, position = messages.places(body.data, body.begins, body.ends)
        out: dict[Place, list[int]] = {}
        for h in np.flatnonzero(body.begins < body.ends).tolist():
            out.setdefault((int(ref[h]), int(position[h])), []).append(h)
        return out

    def crowd(batches):
        """The rows at crowded places."""
        for b in batches:
            for k in b.column("id").to_pylist():
                bodies, r = opened(k), zones.records[k]
                kept = [(h, here) for here, rows in rows_of(bodies["aln"]).items() if zones.n(here) > CROWDED for h in rows]
                if kept:
                    rows = np.array([h for h, _ in kept])
                    meta = [messages.strings(np.frombuffer(bodies["meta"].data, np.uint8), bodies["meta"].begins[rows], bodies["meta"].ends[rows])] if by_meta else []
                    yield pa.RecordBatch.from_arrays([*(pa.array([here[j] for _, here in kept], pa.int64()) for j in (0, 1)), *meta, pa.array(r["first"] + rows), *part(bodies, rows)], names=[*keys, "ordinal", *shown])

    own_columns = ", ".join(["ordinal bigint", *(f"{c} {_type(c)}" for c in shown)])
    out = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields), own_columns])
    keys = ["of_ref", "of_position", *(["of_meta"] if by_meta else [])]
    dealt = wanted.select(F.col("ref_index").cast("long"), F.col("position").cast("long"), row).mapInArrow(chunks_of, f"chunk int, asked {place}")
    single = dealt.where("chunk >= 0")
    many = single.groupBy("chunk").agg(F.ceil(F.count("*") / SHARE).alias("shares")).where("shares > 1")  # a row a chunk at most
    shares = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("shares")), F.lit(0))
    placed = single.join(F.broadcast(many), "chunk", "left").withColumn("share", shares).repartition("chunk", "share").sortWithinPartitions("chunk", "share")
    looked = placed.select("chunk", "asked").mapInArrow(looked_up, out)
    crowded = zones.crowded()
    if not crowded:
        return looked
    # the chunks' numbers, a task for some 16 of them
    chunks = spark.createDataFrame([(k,) for k in crowded], "id int").repartition(-(-len(crowded) // 16), "id")
    theirs = chunks.mapInArrow(crowd, ", ".join(["of_ref bigint, of_position bigint", *(["of_meta string"] if by_meta else []), own_columns]))
    asked = dealt.where("chunk < 0").select("asked")
    same = [F.col(f"asked.{c}") == F.col(k) for c, k in zip(["ref_index", "position", "meta"], keys, strict=False)]
    met = asked.join(theirs, reduce(lambda x, y: x & y, same))
    return looked.unionByName(met.select(*(F.col(f"asked.{c}").alias(c) for c in names), "ordinal", *shown))


def load_list(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All rows of the datasets whose manifests a JSON list names, with `dataset`, the name in the manifest."""
    parts = []
    for manifest in text.dataset_list(spark, path):
        folder = manifest.removesuffix(f"/{MANIFEST}")
        parts.append(load(spark, folder, columns).withColumn("dataset", F.lit(_manifest(Store(folder))["name"])))
    if not parts:
        raise ValueError(f"{path} names no dataset")
    return reduce(DataFrame.unionByName, parts)


def read_chunks(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """ordinal and columns of a dataset in any store that Spark reads: the chunks that the manifest names, whose files meet in one task."""
    named = text.manifest(spark, f"{folder}/{MANIFEST}")
    chunks = named.select(F.explode("records").alias("r")).select(F.col("r.path").alias("chunk"), F.col("r.first").alias("first"), (F.col("r.last") - F.col("r.first")).alias("n"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join([*columns, "none"]) + "}").load(folder)
    files = files.select(F.regexp_extract("path", r"([^/]*)\.([^./]*)$", 1).alias("chunk"), F.regexp_extract("path", r"\.([^./]*)$", 1).alias("column"), "content")

    def rows(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = {r["column"]: chunk_format.decode_body(r["content"]) for r in table.to_pylist() if r["column"] is not None}
        if missing := [c for c in columns if c not in found]:
            raise chunk_format.FormatError(f"chunk {key[0]} has no column {missing[0]}")
        first, n = table.column("first")[0].as_py(), table.column("n")[0].as_py()
        if any(len(found[c].begins) != n for c in columns):
            raise chunk_format.FormatError(f"chunk {key[0]} has not the records of the manifest")
        return pa.Table.from_arrays([pa.array(range(first, first + n), pa.int64()), *(_values(c, found[c]) for c in columns)], names=["ordinal", *columns])

    return chunks.join(files, "chunk", "left").groupBy("chunk").applyInArrow(rows, ", ".join(["ordinal bigint", *(f"{c} {_type(c)}" for c in columns)]))


def write_samples(assigned: DataFrame, folder: str, chunk: int = 100_000) -> list[tuple[str, str]]:
    """A dataset for each sample of demultiplexed reads (sample, ordinal, base, qual, meta), numbered anew.

    Returns name and folder of each. There is a pass for each sample over the numbered reads,
    which are laid down by sample first.
    """
    from ..operators.chunking import numbered

    spark, laid = assigned.sparkSession, f"{folder}/.by-sample"
    rows = numbered(assigned.where("sample is not null").select("sample", "ordinal", "base", "qual", "meta"))
    rows.write.mode("overwrite").partitionBy("sample").parquet(laid)
    by_sample = spark.read.schema(rows.schema).parquet(laid)
    names = sorted(r.sample for r in by_sample.select("sample").distinct().collect())
    for name in names:
        own = by_sample.where(F.col("sample") == name).select(F.col("row").alias("ordinal"), "base", "qual", "meta")
        write(own, f"{folder}/{name}", name, chunk)
    return [(name, f"{folder}/{name}") for name in names]
