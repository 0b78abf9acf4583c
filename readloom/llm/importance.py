"""Resampling of documents towards a target distribution, by importance of their hashed n-grams.

A document's weight is the sum of its features' gains, read from an array with one gain for each
bucket of feature hashes. Gumbel noise that follows from the doc_id makes the highest scores a
draw without replacement. Tasks write their eligible documents as sorted runs; keys that are
sampled at even steps of every run cut the order into ranges, and each range's pieces of runs are
merged by a tournament tree. Ranges are counted first, so a merge knows its first rank,
ranges behind the last draw are never merged, and the last merge stops at the exact draw.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Words, batch, slices, staged

BUCKETS, LONGEST, MIN_WORDS, SHARE, SEED = 10_000, 3, 20, 5, 42
#: Documents of a sorted run, steps between sampled keys, sampled keys at most (but one a run), and sampled keys of a range.
RUN_ROWS, STEP, SAMPLED, RANGE_SAMPLES = 1 << 16, 1 << 11, 100_000, 16

U32 = np.uint32
_CRC = np.arange(256, dtype=U32)
for _ in range(8):
    _CRC = np.where(_CRC & U32(1), _CRC >> U32(1) ^ U32(0xEDB88320), _CRC >> U32(1))
_SPACE = int(_CRC[0x20])


def _moved(state: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRC states after so many zero bytes as the table [4, 256] stands for."""
    return table[0][state & U32(255)] ^ table[1][state >> U32(8) & U32(255)] ^ table[2][state >> U32(16) & U32(255)] ^ table[3][state >> U32(24)]


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables of 0 to 63 zero bytes, as [63, 4, 256], and of 64, 128, 256, ... zero bytes."""
    now = np.arange(256, dtype=U32)[None, :] << (8 * np.arange(4, dtype=U32))[:, None]
    few = []
    for _ in range(64):
        few.append(now)
        now = _CRC[now & U32(255)] ^ now >> U32(8)
    many = [now]
    for _ in range(26):
        many.append(_moved(many[-1], many[-1]))
    return np.stack(few), many


_FEW, _MANY = _tables()


def shifted(state: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC states after n zero bytes each."""
    few = (n & 63).astype(np.int64)
    out = _FEW[few, 0, state & U32(255)] ^ _FEW[few, 1, state >> U32(8) & U32(255)] ^ _FEW[few, 2, state >> U32(16) & U32(255)] ^ _FEW[few, 3, state >> U32(24)]
    for k, table in enumerate(_MANY):
        on = np.flatnonzero(n >> (6 + k) & 1)
        if len(on):
            out[on] = _moved(out[on], table)
    return out


def plain_states(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC states of byte spans that begin at state 0; spans of more than 256 bytes one by one."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    out = np.zeros(len(start), U32)
    long = int(np.searchsorted(-size[order], -256, side="left"))
    for i in order[:long].tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]], 0xFFFFFFFF) ^ 0xFFFFFFFF
    order = order[long:]
    begin, sizes, state = start[order], size[order], np.zeros(len(order), U32)
    for k in range(int(sizes[0]) if len(sizes) else 0):
        m = int(np.searchsorted(-sizes, -k, side="left"))  # those longer than k
        state[:m] = _CRC[(state[:m] ^ data[begin[:m] + k]) & U32(255)] ^ state[:m] >> U32(8)
    out[order] = state
    return out


def features(texts: list[bytes], buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for n = 1 to `longest` the buckets of its runs of n words with the text of each.

    A run's CRC follows from that of the run without its last word, and that word's own.
    """
    w = Words(texts, WORD, lower=True)
    size, owner = (w.end - w.start).astype(np.int64), w.owner()
    plain = plain_states(w.data, w.start, w.end)
    after_space = shifted(np.full(len(size), _SPACE, U32), size) ^ plain
    state, out = shifted(np.full(len(size), 0xFFFFFFFF, U32), size) ^ plain, []
    for n in range(1, longest + 1):
        if n > 1:
            state = shifted(state[:-1], size[n - 1 :] + 1) ^ after_space[n - 1 :] if len(state) else state
        inside = owner[: len(state)] == owner[n - 1 : n - 1 + len(state)]
        out.append(((~state[inside] % U32(buckets)).astype(np.int64), owner[: len(state)][inside]))
    return w.counts, out


def bucket_counts(rows: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket: tasks sum theirs, and one number a bucket comes to the driver."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def work(batches):
        total = np.zeros(buckets, np.int64)
        for _, texts in slices(batches):
            for found, _ in features(texts, buckets)[1]:
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield batch(schema, some.astype(np.int32), total[some])

    out = np.zeros(buckets, np.int64)
    for r in rows.select(F.col(text).alias("text")).mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A gain for each bucket: a thousand times the logarithm of its smoothed likelihood in the target against the source, rounded down."""
    s, t, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(float(b + 1) * float(s + n) / (float(a + 1) * float(t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document in thousandths, from its doc_id (null: an empty one)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_RUN = pa.schema([("run", pa.int64()), ("eligible", pa.bool_()), *((c, pa.list_(pa.int64())) for c in ("doc_ids", "n_features", "weights", "scores"))])
_RUN_DDL = "run long, eligible boolean, doc_ids array<long>, n_features array<long>, weights array<long>, scores array<long>"
_KEY = ("low", "absent", "doc_id", "n_features", "run", "at")
_KEY_DDL = "low long, absent long, doc_id long, n_features long, run long, at long"
_OUT = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_features", "weight", "score", "rank")])
_OUT_DDL = "doc_id long, n_features long, weight long, score long, rank long"


def runs(docs: DataFrame, gain: np.ndarray, min_words: int = MIN_WORDS, seed: int = SEED, run_rows: int = RUN_ROWS) -> DataFrame:
    """Runs of documents with features, weights and scores: eligible ones from the highest score on, the others as they came."""

    def work(batches):
        from pyspark import TaskContext

        made, held, n = TaskContext.get().partitionId() << 32, [], 0

        def put():
            nonlocal made, held, n
            ids = pa.concat_arrays([h[0] for h in held])
            words, count, weight = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3))
            score = weight + np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
            able = words >= min_words
            absent, number = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            order = np.lexsort((count, number, absent, -score))
            for eligible in (True, False):
                mine = order[able[order] == eligible]
                if len(mine):
                    yield batch(_RUN, [made], [eligible], pa.array([ids.take(pa.array(mine)).to_pylist()], _RUN.types[2]), [count[mine]], [weight[mine]], [score[mine]])
                    made += 1
            held, n = [], 0

        for rows, texts in slices(batches):
            words, found = features(texts, len(gain))
            weight, count = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for bucket, owner in found:
                np.add.at(weight, owner, gain[bucket])
                count += np.bincount(owner, minlength=len(texts))
            ids = rows.column("doc_id")
            held.append((ids, words, count, weight))
            n += len(texts)
            if n >= run_rows:
                yield from put()
        if n:
            yield from put()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return staged(rows.mapInArrow(work, _RUN_DDL), "runs")


def _keys(rows: pa.RecordBatch, i: int) -> np.ndarray:
    """The sort keys of run i, one column a row: -score, whether doc_id is absent, doc_id, n_features, run, place."""
    ids = rows.column("doc_ids")[i].values
    n = len(ids)
    parts = -rows.column("scores")[i].values.to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy(), rows.column("n_features")[i].values.to_numpy(), np.full(n, rows.column("run")[i].as_py()), np.arange(n)
    return np.stack(parts)


def _places(bounds: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How many of the sorted keys come before each of the sorted bounds."""
    both = np.concatenate([keys, bounds], axis=1)
    new = np.r_[np.zeros(keys.shape[1], np.int64), -np.ones(bounds.shape[1], np.int64)]  # a bound comes before the key that it equals
    order = np.lexsort((new, *both[::-1]))
    is_key = order < keys.shape[1]
    return np.cumsum(is_key)[~is_key]


class Tournament:
    """The rows of sorted runs in order: a tree whose root is the run with the least head, replayed from its leaf after each row."""

    def __init__(self, pieces: list[np.ndarray]):
        self.pieces, self.at = pieces, [0] * len(pieces)
        self.size = 1 << max(0, len(pieces) - 1).bit_length()
        self.heads = [self._head(k) for k in range(len(pieces))] + [None] * (self.size - len(pieces))
        self.tree = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            self._play(node)

    def _head(self, k: int) -> tuple | None:
        at = self.at[k]
        return tuple(self.pieces[k][:, at].tolist()) if at < self.pieces[k].shape[1] else None

    def _play(self, node: int) -> None:
        a, b = self.tree[2 * node], self.tree[2 * node + 1]
        x, y = self.heads[a], self.heads[b]
        self.tree[node] = a if y is None or x is not None and x <= y else b

    def take(self, n: int) -> Iterator[tuple[int, int]]:
        """Run and place of the next n rows."""
        for _ in range(n):
            k = self.tree[1]
            yield k, self.at[k]
            self.at[k] += 1
            self.heads[k] = self._head(k)
            node = (self.size + k) >> 1
            while node:
                self._play(node)
                node >>= 1


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED, run_rows: int = RUN_ROWS, step: int = STEP) -> DataFrame:
    """doc_id, n_features, weight, score, rank: every document of `docs`, and the rank of those drawn (others: null).

    Of the N documents with `min_words` words or more, floor(share * N / 100) with the highest scores
    are drawn; ties go to the smaller doc_id, none last, then to fewer features; rows alike in
    all of these get ranks of their own. Null and empty texts have no features and weight 0, and are
    not drawn unless min_words is 0. Repeated doc_ids have the same noise. An empty
    target makes all gains those of an even target; no documents give no rows.
    The driver gets a count for each bucket, sampled keys (at most `SAMPLED` and one a run) and a count for each range.
    """
    gain = gains(bucket_counts(docs, buckets=buckets), bucket_counts(target, buckets=buckets))
    scored = runs(docs, gain, min_words, seed, run_rows)
    able = scored.where("eligible")
    total = able.agg(F.sum(F.size("scores"))).first()[0] or 0
    drawn = share * total // 100
    step = max(step, -(-total // SAMPLED))
    key_schema = pa.schema([(c, pa.int64()) for c in _KEY])

    def sampled(batches):
        for rows in batches:
            for i in range(rows.num_rows):
                keys = _keys(rows, i)
                yield batch(key_schema, *keys[:, step // 2 :: step])

    found = sorted(tuple(r) for r in able.drop("weights", "eligible").mapInArrow(sampled, _KEY_DDL).collect())
    bounds = np.array(found[RANGE_SAMPLES::RANGE_SAMPLES], np.int64).reshape(-1, len(_KEY)).T
    count_schema = pa.schema([("range", pa.int64()), ("n", pa.int64())])

    def counted(batches):
        counts = np.zeros(bounds.shape[1] + 1, np.int64)
        for rows in batches:
            for i in range(rows.num_rows):
                keys = _keys(rows, i)
                counts += np.diff(_places(bounds, keys), prepend=0, append=keys.shape[1])
        yield batch(count_schema, np.arange(len(counts)), counts)

    sizes = dict(able.drop("weights", "eligible").mapInArrow(counted, "range long, n long").groupBy("range").agg(F.sum("n")).collect())
    first = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(bounds.shape[1] + 1)])])
    merged = int(np.searchsorted(first[:-1], drawn, side="left"))  # ranges that begin before the draw is full
    piece = pa.schema([("range", pa.int64()), *_RUN])

    def pieces(batches):
        for rows in batches:
            for i in range(rows.num_rows):
                keys = _keys(rows, i)
                edges = np.r_[0, _places(bounds, keys), keys.shape[1]]
                for k in range(merged):
                    a, b = int(edges[k]), int(edges[k + 1])
                    if a < b:
                        parts = [pa.ListArray.from_arrays([0, b - a], rows.column(c)[i].values.slice(a, b - a)) for c in _RUN.names[2:]]
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), rows.column("run").slice(i, 1), rows.column("eligible").slice(i, 1), *parts], schema=piece)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        k = key[0].as_py()
        rows = table.combine_chunks().to_batches()[0]
        ids, n_features, weight, score = (rows.column(c).values for c in _RUN.names[2:])
        begin = np.concatenate([[0], np.cumsum(np.diff(rows.column("scores").offsets.to_numpy()))])
        draws = int(min(first[k + 1], drawn) - first[k])
        order = np.array([begin[run] + at for run, at in Tournament([_keys(rows, i) for i in range(rows.num_rows)]).take(draws)], np.int64)
        rank = np.zeros(len(score), np.int64)
        rank[order] = first[k] + 1 + np.arange(draws)
        return pa.Table.from_arrays([ids, n_features, weight, score, pa.array(rank, pa.int64(), mask=rank == 0)], schema=_OUT)

    def others(batches):
        for rows in batches:
            for i in range(rows.num_rows):
                at = int(np.r_[_places(bounds, keys := _keys(rows, i)), keys.shape[1]][merged - 1]) if rows.column("eligible")[i].as_py() and merged else 0
                parts = [rows.column(c)[i].values.slice(at) for c in _RUN.names[2:]]
                yield pa.RecordBatch.from_arrays([*parts, pa.nulls(len(parts[0]), pa.int64())], schema=_OUT)

    ranked = able.mapInArrow(pieces, f"range long, {_RUN_DDL}").groupBy("range").applyInArrow(merge, _OUT_DDL)
    return ranked.unionByName(scored.mapInArrow(others, _OUT_DDL)) if merged else scored.mapInArrow(others, _OUT_DDL)
