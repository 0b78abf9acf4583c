"""What the text operators share: whole-batch tokenising with numpy, n-gram hashes, staged tables.

Texts are handled as one byte buffer per slice of about `SLICE_BYTES`; a single longer
text forms a slice of its own, so memory is bounded by the longest text. All classes of
bytes used here treat every byte of a multi-byte UTF-8 sequence alike, so working on
bytes equals working on code points.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are turned into arrays at once.
SLICE_BYTES = 1 << 20
#: Rows that are turned into arrays at once.
SLICE_ROWS = 2048

U64 = np.uint64

#: Bytes of words made of letters, digits and everything outside ASCII, in lower-cased text.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
#: Bytes of words between white space (space and \t to \r).
NONSPACE = np.ones(256, bool)
NONSPACE[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables; a folder of our own only where none is set and all runs in one process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found, master = spark.sparkContext._jsc.sc().getCheckpointDir(), spark.sparkContext.master
        if not found.isDefined() and master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = found.get() if found.isDefined() else f"file://{tempfile.mkdtemp(prefix='checkpoint-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path


#: Folders of `staging` blocks that are open, the innermost last.
_OPEN: list[str] = []


def _staging(spark: SparkSession) -> str:
    return "/".join([f"{checkpoint_dir(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}", *_OPEN])


def drop_staged(spark: SparkSession) -> None:
    """Delete the staged tables of this application, or of the open `staging` block; frames that were made of them can't be read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_staging(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted at its end, so results must be written before."""
    _OPEN.append(f"block-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        drop_staged(spark)
        _OPEN.pop()


def staged(df: DataFrame, name: str, row_group: int = 16 << 20) -> DataFrame:
    """`df` written to the shared folder and read back: cuts lineage, and survives the loss of executors."""
    return staged_at(df, name, row_group)[0]


def staged_at(df: DataFrame, name: str, row_group: int = 16 << 20) -> tuple[DataFrame, str]:
    """As `staged`, with the table's whole address, by which `stored` reads it."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{_staging(spark)}/{name}-{uuid.uuid4().hex}")
    path = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    df.write.option("parquet.block.size", row_group).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _store(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(f"file://{address[5:]}" if address.startswith("file:/") and not address.startswith("file://") else address)


def reachable(address: str) -> bool:
    """Whether `stored` can read a table: in a mounted folder, or in a store that Arrow knows."""
    try:
        from pyarrow.fs import FileType

        store, path = _store(address)
        return store.get_file_info(path).type != FileType.NotFound
    except (pa.ArrowException, OSError):
        return False


def stored(address: str, columns: list[str], rows: int) -> Iterator[pa.RecordBatch]:
    """A staged table, read by a worker without Spark, so many rows at a time."""
    from pyarrow import dataset

    store, path = _store(address)
    yield from dataset.dataset(path, filesystem=store, format="parquet").to_batches(columns=columns, batch_size=rows, batch_readahead=0, fragment_readahead=0, use_threads=False)
    pa.default_memory_pool().release_unused()


#: What this worker has loaded for one run, by name.
_LOADED: dict[str, object] = {}


def loaded(run: str, name: str, load: Callable[[], object]) -> object:
    """What `load` gives, once for each worker and run; what was loaded for another run is given up first."""
    if _LOADED.get("run") != run:
        _LOADED.clear()
        _LOADED["run"] = run
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows and their texts as bytes (null: empty), about `limit` bytes of text at a time."""
    for batch in batches:
        texts = batch.column(column)
        if not pa.types.is_binary(texts.type):
            texts = texts.cast(pa.large_binary())
        texts = pc.fill_null(texts, b"")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at, n = 0, batch.num_rows
        while at < n:
            before = ends[at - 1] if at else 0
            to = min(n, at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, before + limit, side="right"))))
            yield batch.slice(at, to - at), texts.slice(at, to - at).to_pylist()
            at = to


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = n + n // 4
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, U64), np.full(size, b, U64)])) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_IN_GRAM = Powers(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (finaliser of SplitMix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


#: Bytes of a word that are mixed in eight at a time; a longer word is hashed by the xxhash library.
LONG_WORD = 512


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: eight bytes after the other are mixed in, so the hash is no sum in which the parts of a span could cancel out."""
    size = (end - start).astype(np.int64)
    order = np.argsort(-size, kind="stable")
    size, at = size[order], start[order].astype(np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    h = size.astype(U64) * U64(0x9E3779B97F4A7C15)
    long = int(np.searchsorted(-size, -LONG_WORD, side="left"))
    for k in range(0, int(size[long]) if long < len(size) else 0, 8):
        on = slice(long, int(np.searchsorted(-size, -k, side="left")))  # those longer than k
        missing = (np.clip(8 - (size[on] - k), 0, 7) * 8).astype(U64)
        h[on] = mixed(h[on] ^ (eight[at[on] + k] << missing >> missing)) + U64(0xD1B54A32D192ED03)
    if long:
        import xxhash

        raw = data.tobytes()
        h[:long] = [xxhash.xxh64_intdigest(raw[a : a + n]) for a, n in zip(at[:long].tolist(), size[:long].tolist(), strict=True)]
    out = np.empty_like(h)
    out[order] = mixed(h)
    return out


class Words:
    """The words of some texts: byte places `start`/`end` in `data`; text i has words `first[i]` to `first[i + 1]`."""

    def __init__(self, texts: list[bytes], kind: np.ndarray = NONSPACE, lower: bool = False):
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        if lower:
            self.data = LOWER[self.data]
        inside = kind[self.data]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        self.start, self.end = edge[::2], edge[1::2]
        begin = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
        self.first = np.searchsorted(self.start, begin)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words' bytes."""
        return byte_hashes(self.data, self.start, self.end)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n items; len(h) - n + 1 of them (whatever text they lie in)."""
    if len(h) < n:
        return np.empty(0, U64)
    up, down = _IN_GRAM.get(len(h) + 1)
    total = np.zeros(len(h) + 1, U64)
    np.cumsum(h * up[:-1], out=total[1:])
    return mixed((total[n:] - total[:-n]) * down[: len(h) - n + 1])


_PRIME = U64((1 << 61) - 1)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x >> U64(61)) + (x & _PRIME)
    return np.where(x >= _PRIME, x - _PRIME, x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1 of numbers below it, by halves of 30 and 31 bits."""
    a_high, a_low, b_high, b_low = a >> U64(31), a & U64(0x7FFFFFFF), b >> U64(31), b & U64(0x7FFFFFFF)
    middle = a_low * b_high + a_high * b_low
    return _reduced((a_high * b_high << U64(1)) + (middle >> U64(30)) + ((middle & U64(0x3FFFFFFF)) << U64(31)) + a_low * b_low)


class PrimePowers:
    """Powers of a number and of its inverse modulo 2**61 - 1, as far as asked for."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, int(_PRIME))
        self.kept = [np.ones(1, U64)] * 2

    def get(self, n: int) -> list[np.ndarray]:
        while len(self.kept[0]) < n:
            size = len(self.kept[0])
            self.kept = [np.concatenate([k, _product(k, np.full(size, pow(b, size, int(_PRIME)), U64))]) for k, b in zip(self.kept, self.bases, strict=True)]
        return [k[:n] for k in self.kept]


_IN_SPAN = PrimePowers(0x0D6E8FEB86659FD9)


def span_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs of items from start to end (exclusive): sums modulo a prime, in which no pattern of items cancels out for certain, however long."""
    up, down = _IN_SPAN.get(len(h) + 1)
    part = _product(_reduced(h), up[:-1])
    low, high = np.zeros(len(h) + 1, U64), np.zeros(len(h) + 1, U64)
    np.cumsum(part & U64(0x3FFFFFFF), out=low[1:])
    np.cumsum(part >> U64(30), out=high[1:])
    total = _reduced(_product(_reduced(high), np.full(len(high), 1 << 30, U64)) + _reduced(low))
    return mixed(_product(_reduced(total[end] + _PRIME - total[start]), down[start]) + (end - start).astype(U64))


def gram_places(first: np.ndarray, n: int) -> np.ndarray:
    """Which runs of n items lie within one text: their places, ascending."""
    total = int(first[-1])
    if total < n:
        return np.empty(0, np.int64)
    inside = np.ones(total - n + 1, bool)
    for k in first[1:-1]:
        inside[max(0, k - n + 1) : k] = False
    return np.flatnonzero(inside)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, schema.types, strict=True)], schema=schema)


BLOCK_BYTES = 8 << 20
BLOCK = pa.schema([("block_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("packed", pa.binary())])
_ZSTD = pa.Codec("zstd", compression_level=3)
#: Bits of a block_id for the blocks of one partition.
PARTITION_BLOCKS = 12


def _block(number: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    return batch(BLOCK, [number], [ids], [[len(t) for t in texts]], [_ZSTD.compress(b"".join(texts), asbytes=True)])


def blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A staged table of blocks of about `BLOCK_BYTES` of text: block_id, doc_ids, sizes and packed texts (null: empty).

    Once written the blocks are fixed, whatever is computed again later. Texts are packed by
    zstd, so a join of blocks shuffles half their bytes; `block_texts` unpacks them. A
    block_id is below 2**32, for up to a million partitions of 32 GB or 200 million rows each.
    """

    def pack(batches):
        from pyspark import TaskContext

        begin = TaskContext.get().partitionId() << PARTITION_BLOCKS
        made, ids, texts, size = begin, [], [], 0
        for rows, raw in slices(batches):
            if made >> PARTITION_BLOCKS != begin >> PARTITION_BLOCKS or begin >> 32:
                raise ValueError("too many blocks in a partition, or too many partitions; repartition the documents")
            ids += rows.column("doc_id").to_pylist()
            texts += raw
            size += sum(map(len, raw))
            if size >= BLOCK_BYTES or len(ids) >= 50_000:
                yield _block(made, ids, texts)
                made, ids, texts, size = made + 1, [], [], 0
        if ids:
            yield _block(made, ids, texts)

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("binary").alias("text"))
    return staged(rows.mapInArrow(pack, "block_id long, doc_ids array<long>, sizes array<long>, packed binary"), "blocks")


def block_texts(rows: pa.RecordBatch, i: int) -> list[bytes]:
    """The texts of a block."""
    ends = np.cumsum(rows.column("sizes")[i].as_py(), dtype=np.int64).tolist()
    raw = _ZSTD.decompress(rows.column("packed")[i].as_py(), ends[-1] if ends else 0, asbytes=True) if ends and ends[-1] else b""
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def block_slices(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a block in slices of about `SLICE_BYTES`, each with the place of its first."""
    at, part, size = 0, [], 0
    for k, t in enumerate(texts):
        part.append(t)
        size += len(t)
        if size >= SLICE_BYTES or len(part) >= SLICE_ROWS:
            yield at, part
            at, part, size = k + 1, [], 0
    if part:
        yield at, part


_P1, _P2, _P3, _P4, _P5 = (U64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rot(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many byte spans of `data` at once; long spans go to the xxhash library one by one."""
    import xxhash

    seed64 = U64(seed)
    size = (end - start).astype(np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    four = np.ndarray(len(padded) - 3, "<u4", padded, strides=(1,))
    h = np.full(len(start), seed64 + _P5, U64)
    at = start.astype(np.int64).copy()
    left = size.copy()
    lane = lambda acc, x: _rot(acc + x * _P2, 31) * _P1
    with np.errstate(over="ignore"):
        wide = np.flatnonzero((size >= 32) & (size <= 1024))
        if len(wide):
            v = [np.full(len(wide), U64((seed + k) % (1 << 64)), U64) for k in (int(_P1) + int(_P2), int(_P2), 0, -int(_P1))]
            rounds = size[wide] // 32
            for k in range(int(rounds.max())):
                on = np.flatnonzero(rounds > k)
                place = at[wide[on]] + 32 * k
                for j in range(4):
                    v[j][on] = lane(v[j][on], eight[place + 8 * j])
            got = _rot(v[0], 1) + _rot(v[1], 7) + _rot(v[2], 12) + _rot(v[3], 18)
            for j in range(4):
                got = (got ^ lane(np.zeros_like(v[j]), v[j])) * _P1 + _P4
            h[wide] = got
            at[wide] += rounds * 32
            left[wide] -= rounds * 32
        h += size.astype(U64)
        short = size <= 1024
        for _ in range(3):
            on = np.flatnonzero((left >= 8) & short)
            if not len(on):
                break
            h[on] = _rot(h[on] ^ lane(np.zeros(len(on), U64), eight[at[on]]), 27) * _P1 + _P4
            at[on] += 8
            left[on] -= 8
        on = np.flatnonzero((left >= 4) & short)
        h[on] = _rot(h[on] ^ four[at[on]].astype(U64) * _P1, 23) * _P2 + _P3
        at[on] += 4
        left[on] -= 4
        for _ in range(3):
            on = np.flatnonzero((left > 0) & short)
            if not len(on):
                break
            h[on] = _rot(h[on] ^ padded[at[on]].astype(U64) * _P5, 11) * _P1
            at[on] += 1
            left[on] -= 1
        h = (h ^ (h >> U64(33))) * _P2
        h = (h ^ (h >> U64(29))) * _P3
        h = h ^ (h >> U64(32))
    raw = data.tobytes() if not short.all() else b""
    for i in np.flatnonzero(~short):
        h[i] = xxhash.xxh64_intdigest(raw[start[i] : end[i]], seed)
    return h
