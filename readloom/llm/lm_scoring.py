"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

A count is quantised to a level, and the n-gram is put into the filter once for each level
from 1 on; reading a count means probing levels until one is missing. Unigrams and bigrams
have a filter each, made of parts of equal size by the leading bits of the n-gram's hash, so
parts are built apart and a probe stays in one part. A filter has `BITS` bits for an entry,
however many there are; no n-gram is left out.

A filter of up to `filter_bytes` is broadcast: every worker loads it once, from the shared folder
(through the driver only if that is a store which Arrow can't open). A larger one, which no worker
could hold, stays a table: the distinct n-grams of each block of texts are sent to the ranges of parts that
hold them, probed there, and their levels come back to the block. Both ways probe the same
bits, so scores don't depend on which is taken; the texts are read a fixed number of times
at every size.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pandas import factorize
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NONSPACE, U64, Words, batch, block_slices, block_texts, blocks, grams, loaded, mixed, reachable, signed, slices, staged, staged_at, stored

#: Least counts of the levels 1 to 62.
LEVELS = np.array([1, 2, 3, *(round(4 * 2 ** (k / 2)) for k in range(59))], np.int64)
#: What a level stands for: the middle of its counts.
MEANS = np.concatenate([[0.0], (LEVELS[:-1] + LEVELS[1:] - 1) / 2, [float(LEVELS[-1])]])
PARTS, MOST_PARTS, HASHES, BITS = 1 << 12, 1 << 20, 4, 10
#: Tokens for which the bigram filter has a part.
PART_TOKENS = 1 << 20
#: Bytes of a filter that is broadcast; of a larger one a task holds so many at once.
FILTER_BYTES, RANGE_BYTES = 96 << 20, 16 << 20
#: Distinct tokens of which filter and exact counts are broadcast (16 bytes each); more are asked for.
MOST_BROADCAST = 6_000_000
#: Bytes of text whose n-grams are counted before they are shuffled.
COUNTED_BYTES = 8 << 20
END = mixed(np.array([0x5EED], U64))[0]

_PAIR = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of some texts, and where each text begins (and the last ends).

    Tokens are the words between white space, A-Z lower-cased, then one end for each text.
    """
    w = Words(texts, NONSPACE, lower=True)
    return np.insert(w.hashes(), w.first[1:], END), w.first + np.arange(len(w.first))


def _counted(units, grams_of) -> Iterator[pa.RecordBatch]:
    """Counts of grams_of(tokens, begins, known) over the training texts of some units (ids, texts, known)."""
    keys, size = [], 0

    def flush():
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        for at in range(0, len(key), 50_000):
            yield batch(_PAIR, signed(key[at : at + 50_000]), n[at : at + 50_000])

    for ids, texts, known in units:
        texts = [t for i, t in zip(ids, texts, strict=True) if not held_out(i)]
        if texts:
            keys.append(grams_of(*tokens(texts), known))
            size += sum(map(len, texts)) + len(texts)
        if size >= COUNTED_BYTES:
            yield from flush()
            keys, size = [], 0
    if keys:
        yield from flush()


def _part(parts: int):
    """The part of `key`, as a column."""
    return F.shiftrightunsigned("key", 65 - parts.bit_length()).cast("int")


def _summed(counted: DataFrame, parts: int = PARTS) -> DataFrame:
    """key, n with the sum for each key; keys of a part of the filter lie in one partition, part by part."""
    rows = counted.select(_part(parts).alias("part"), "key", "n").repartition("part")
    return rows.groupBy("part", "key").agg(F.sum("n").alias("n")).sortWithinPartitions("part").select("key", "n")


def bigrams(seq: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pairs of neighbours within a text, and the place of each pair's second token."""
    inside = np.ones(len(seq), bool)
    inside[first[:-1]] = False
    second = np.flatnonzero(inside)
    return grams(seq, 2)[second - 1] if len(second) else np.empty(0, U64), second


class Filter:
    """A log-frequency Bloom filter with `size` bits (full bytes) a part, or the parts from `low` to `high` of one."""

    def __init__(self, size: int, low: int = 0, high: int | None = None, parts: int = PARTS):
        self.size, self.low, self.high, self.shift = size, low, parts if high is None else high, U64(65 - parts.bit_length())
        self.bits = np.zeros((self.high - low) * size // 8, np.uint8)

    def places(self, key: np.ndarray, level: np.ndarray) -> Iterator[np.ndarray]:
        h = mixed(key + level.astype(U64) * U64(0x9E3779B97F4A7C15))
        step = (h >> U64(32)) | U64(1)
        base = ((key >> self.shift) - U64(self.low)) * U64(self.size)
        for k in range(HASHES):
            yield base + (h + U64(k) * step) % U64(self.size)

    def add(self, key: np.ndarray, count: np.ndarray) -> None:
        levels = np.searchsorted(LEVELS, count, side="right")
        key = np.repeat(key, levels)
        level = np.arange(len(key)) - np.repeat(np.cumsum(levels) - levels, levels) + 1
        for place in self.places(key, level):
            np.bitwise_or.at(self.bits, (place >> U64(3)).astype(np.int64), (1 << (place & U64(7))).astype(np.uint8))

    def put(self, part: int, bits: bytes) -> None:
        """Take over bits of a part."""
        width = self.size // 8
        self.bits[(part - self.low) * width : (part - self.low + 1) * width] |= np.frombuffer(bits, np.uint8)

    def level(self, key: np.ndarray) -> np.ndarray:
        """The level of each n-gram of the parts: probed from 1 until one is missing (0: not there)."""
        out, on = np.zeros(len(key), np.int64), np.arange(len(key))
        while len(on) and out[on[0]] < len(LEVELS):
            there = np.ones(len(on), bool)
            for place in self.places(key[on], out[on] + 1):
                there &= (self.bits[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8) & 1).astype(bool)
            on = on[there]
            out[on] += 1
        return out


_PART = pa.schema([("part", pa.int32()), ("bits", pa.binary())])


class FilterTable:
    """The filter of counts(key long, n long; part by part within a partition) as a staged table of rows (part, bits).

    A part that lies in several tasks has a row for each.
    """

    def __init__(self, counts: DataFrame, parts: int = PARTS):
        histogram = counts.groupBy(_level("n").alias("level")).agg(F.count("*")).collect()  # at most 62 rows
        entries = sum(int(level) * n for level, n in histogram)
        self.parts, self.size = parts, 8 * max(8, math.ceil(entries * BITS / parts / 8))
        size = self.size

        def work(batches):
            made = None
            for rows in batches:
                key, n = rows.column("key").to_numpy().view(U64), rows.column("n").to_numpy()
                part = (key >> U64(65 - parts.bit_length())).astype(np.int64)
                begin = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, np.int64)
                for a, b in zip(begin, np.append(begin[1:], len(part)), strict=False):
                    if made is None or made.low != part[a]:
                        if made is not None:
                            yield batch(_PART, [made.low], [made.bits.tobytes()])
                        made = Filter(size, int(part[a]), int(part[a]) + 1, parts)
                    made.add(key[a:b], n[a:b])
            if made is not None:
                yield batch(_PART, [made.low], [made.bits.tobytes()])

        self.rows, self.address = staged_at(counts.mapInArrow(work, "part int, bits binary"), "filter")

    @property
    def bytes(self) -> int:
        return self.parts * self.size // 8

    def load(self, run: str) -> Callable[[], Filter]:
        """What gives a worker the whole filter."""
        address, size, parts = self.address, self.size, self.parts
        if reachable(address):
            return lambda: loaded(run, address, lambda: loaded_filter(address, size, parts))
        shared = self.rows.sparkSession.sparkContext.broadcast(self.collected())
        return lambda: shared.value

    def collected(self) -> Filter:
        """The whole filter on the driver, an eighth at a time."""
        out, step = Filter(self.size, parts=self.parts), max(1, self.parts // 8)
        for at in range(0, self.parts, step):
            for part, bits in self.rows.where(F.col("part").between(at, at + step - 1)).collect():
                out.put(part, bits)
        return out

    def answers(self, asked: DataFrame, counts: DataFrame | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
        """block_id, levels array<binary>, counts array<binary>: answers to asked(block_id long, keys binary: unsigned, ascending).

        Levels are a byte a key, counts (if `counts` are given) eight; the arrays have them in the
        order of the keys. Filter and keys meet by ranges of parts, and the filter comes first, so a
        task holds one range of about `range_bytes`, and reads the keys as they come.
        """
        parts, size = self.parts, self.size
        each = max(1, min(parts, range_bytes * 8 // size))
        ddl, schema = "at int, kind int, part int, block_id long, keys binary, ns binary", pa.schema([("at", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("block_id", pa.int64()), ("keys", pa.binary()), ("ns", pa.binary())])
        answer = pa.schema([("block_id", pa.int64()), ("at", pa.int32()), ("levels", pa.binary()), ("counts", pa.binary())])

        def cut(key: np.ndarray) -> Iterator[tuple[int, int, int]]:
            """Range, begin and end of stretches of keys, one after the other, that lie in a range."""
            at = (key >> U64(65 - parts.bit_length())).astype(np.int64) // each
            begin = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, np.int64)
            yield from zip(at[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(at)], strict=False)

        def exact(batches):
            for rows in batches:
                key, n = rows.column("key").to_numpy(), rows.column("n").to_numpy()
                for at, a, b in cut(key.view(U64)):
                    yield batch(schema, [at], [1], [None], [None], [key[a:b].tobytes()], [n[a:b].tobytes()])

        def dealt(batches):
            for rows in batches:
                for block, keys in zip(rows.column("block_id").to_pylist(), rows.column("keys").to_pylist(), strict=True):
                    key = np.frombuffer(keys, U64)
                    found = [(at, 2, None, block, key[a:b].tobytes(), None) for at, a, b in cut(key)]
                    if found:
                        yield batch(schema, *zip(*found, strict=True))

        def probed(batches):
            now, have = None, []
            for rows in batches:
                for at, kind, part, block, keys, ns in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    if at != now:
                        now, have, table = at, [], None
                        own = Filter(size, at * each, min(parts, (at + 1) * each), parts)
                    if kind == 0:
                        own.put(part, keys)
                    elif kind == 1:
                        have.append((np.frombuffer(keys, U64), np.frombuffer(ns, np.int64)))
                    else:
                        key, n = np.frombuffer(keys, U64), b""
                        if have and table is None:
                            table = Known(*map(np.concatenate, zip(*have, strict=True)))
                        if counts is not None:
                            n = (table.of(key) if table else np.zeros(len(key), np.int64)).tobytes()
                        yield batch(answer, [block], [at], [own.level(key).astype(np.uint8).tobytes()], [n])

        counts_given, counts = counts, True if counts is not None else None  # the frame itself must not go to the workers
        rows = self.rows.select(F.floor(F.col("part") / each).cast("int").alias("at"), F.lit(0).alias("kind"), "part", F.lit(None).cast("long").alias("block_id"), F.col("bits").alias("keys"), F.lit(None).cast("binary").alias("ns"))
        rows = rows.unionByName(asked.select("block_id", "keys").mapInArrow(dealt, ddl))
        if counts_given is not None:
            rows = rows.unionByName(counts_given.mapInArrow(exact, ddl))
        found = rows.repartition("at").sortWithinPartitions("at", "kind").mapInArrow(probed, "block_id long, at int, levels binary, counts binary")
        found = found.groupBy("block_id").agg(F.sort_array(F.collect_list(F.struct("at", "levels", "counts"))).alias("x"))  # of a block's keys
        return found.select("block_id", F.col("x.levels").alias("levels"), F.col("x.counts").alias("counts"))


class Known:
    """Values of keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.values = values[order]
        self.keys = keys[order]

    def of(self, key: np.ndarray) -> np.ndarray:
        """The value of each key (0: not there)."""
        if not len(self.keys):
            return np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], 0).astype(np.int64)


def loaded_filter(address: str, size: int, parts: int) -> Filter:
    """A filter from the shared folder."""
    out = Filter(size, parts=parts)
    for rows in stored(address, ["part", "bits"], 128):
        for part, bits in zip(rows.column("part").to_pylist(), rows.column("bits").to_pylist(), strict=True):
            out.put(part, bits)
    return out


def loaded_counts(address: str, n_types: int, n_all: int) -> Known:
    """Exact counts of so many types and tokens from the shared folder."""
    keys, n, at = np.empty(n_types, U64), np.empty(n_types, np.uint32 if n_all < 1 << 32 else np.int64), 0
    for b in stored(address, ["key", "n"], 1 << 14):
        keys[at : at + b.num_rows], n[at : at + b.num_rows] = b.column("key").to_numpy().view(U64), b.column("n").to_numpy()
        at += b.num_rows
    return Known(keys, n)


def _level(column: str):
    """The level of a count, as a column."""
    over = [F.when(F.col(column) >= int(x), 1).otherwise(0) for x in LEVELS]
    out = over[0]
    for x in over[1:]:
        out = out + x
    return out


_ASKED = pa.schema([("block_id", pa.int64()), ("keys", pa.binary())])
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_SCORED_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def pairs(seq: np.ndarray, first: np.ndarray, level: Callable) -> np.ndarray:
    """Hashes of the pairs of neighbours; the level of a pair's first word is in the lowest six bits."""
    h, second = bigrams(seq, first)
    back, distinct = factorize(seq)
    return (h & ~U64(63)) | level(distinct)[back][second - 1].astype(U64)


def _slices_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, part in block_slices(texts):
        yield tokens(part)


def _distinct(found: Iterator[np.ndarray]) -> np.ndarray:
    """The distinct keys of all slices of a block, ascending."""
    return np.unique(np.concatenate([np.empty(0, U64), *map(np.unique, found)]))


def _joined(rows: pa.RecordBatch, column: str, i: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(column)[i].as_py() or []), kind).astype(np.int64)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES, most_broadcast: int = MOST_BROADCAST, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from the rows whose crc32(doc_id as text) mod 5 is not 1 (no doc_id: the empty text).
    score: sum over tokens of log10 of l * c(vw) / c(v) + (1 - l) * p(w), counts and p as the
    filters have them; l is the share of training pairs that occur twice or more, among
    those whose first word v has the same level. base_score has exact unigram counts. Null texts are empty:
    one token. Without training rows all probabilities are those of no count.

    Up to `most_broadcast` distinct tokens and filters of up to `filter_bytes` are broadcast; beyond,
    blocks of texts ask the tables. The results are the same. Rows that are alike score alike; an
    empty table gives none; a text of any length is read as a whole.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    whole, run = None, uuid.uuid4().hex  # the texts in blocks, if tables are asked

    def of_docs(batches):
        for part, texts in slices(batches):
            yield part.column("doc_id").to_pylist(), texts, None

    ones, address = staged_at(_summed(rows.mapInArrow(lambda b: _counted(of_docs(b), lambda seq, first, known: seq), "key long, n long")), "unigrams")
    n_types, n_all = ones.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    table = FilterTable(ones)
    unigram = exact = None
    if n_types <= most_broadcast and table.bytes <= filter_bytes:
        unigram = table.load(run)
        if reachable(address):
            exact = lambda: loaded(run, address, lambda: loaded_counts(address, n_types, n_all))
        else:
            found = ones.toArrow()
            shared = spark.sparkContext.broadcast(Known(found.column("key").to_numpy().view(U64), found.column("n").to_numpy()))
            exact = lambda: shared.value
    else:
        whole = blocks(docs, doc_id, text)

        def words_of(batches):
            for b in batches:
                for i, block in enumerate(b.column("block_id").to_pylist()):
                    yield batch(_ASKED, [block], [_distinct(seq for seq, _ in _slices_of(block_texts(b, i))).tobytes()])

        told = staged(table.answers(whole.mapInArrow(words_of, "block_id long, keys binary"), ones, range_bytes), "unigrams-told")
        whole = whole.join(told.withColumnRenamed("levels", "word_levels").withColumnRenamed("counts", "word_counts"), "block_id", "left")

    def of_blocks(batches, of_pairs: bool = False):
        """Slices of blocks (ids, texts, known): known has the answers to a block's words, and to its pairs."""
        for b in batches:
            for i in range(b.num_rows):
                ids, texts = b.column("doc_ids")[i].as_py(), block_texts(b, i)
                known = {}
                if unigram is None:
                    words = _distinct(seq for seq, _ in _slices_of(texts))
                    known = {"level": Known(words, _joined(b, "word_levels", i, np.uint8)).of, "count": Known(words, _joined(b, "word_counts", i, np.int64)).of}
                if of_pairs:
                    own = _distinct(pairs(*x, level_of(known)) for x in _slices_of(texts))
                    known["pair"] = Known(own, _joined(b, "pair_levels", i, np.uint8)).of
                for at, part in block_slices(texts):
                    yield ids[at : at + len(part)], part, known

    def level_of(known):
        return known["level"] if unigram is None else unigram().level

    def count_of(known):
        if unigram is None:
            return known["count"]

        def of(key):
            order, out = np.argsort(key), np.empty(len(key), np.int64)
            out[order] = exact().of(key[order])  # ascending keys are found faster
            return out

        return of

    units, source = (of_docs, rows) if unigram is not None else (of_blocks, whole)
    parts = PARTS
    while parts < MOST_PARTS and parts * PART_TOKENS < n_all:
        parts *= 2
    twos = staged(_summed(source.mapInArrow(lambda b: _counted(units(b), lambda seq, first, known: pairs(seq, first, level_of(known))), "key long, n long"), parts), "bigrams")
    share = np.full(64, 0.01)
    for level, known, every in twos.groupBy(F.col("key").bitwiseAND(63).alias("level")).agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)), F.sum("n")).collect():
        share[level] = min(0.99, max(0.01, known / every))
    table = FilterTable(twos, parts)
    bigram = None
    if table.bytes <= filter_bytes:
        bigram = table.load(run)
    else:
        whole = blocks(docs, doc_id, text) if whole is None else whole

        def pairs_of(batches):
            for b in batches:
                for i in range(b.num_rows):
                    one = b.slice(i, 1)
                    known = next((k for _, _, k in of_blocks([one])), {})
                    yield batch(_ASKED, b.column("block_id").slice(i, 1), [_distinct(pairs(*x, level_of(known)) for x in _slices_of(block_texts(one, 0))).tobytes()])

        told = table.answers(whole.mapInArrow(pairs_of, "block_id long, keys binary"), None, range_bytes).select("block_id", F.col("levels").alias("pair_levels"))
        units, source = (lambda b: of_blocks(b, True)), whole.join(told, "block_id", "left")

    def scored(batches):
        for ids, texts, known in units(batches):
            seq, first = tokens(texts)
            back, distinct = factorize(seq)
            level, c = level_of(known)(distinct), count_of(known)(distinct)
            alone = (MEANS[level] + 0.5) / (n_all + 0.5 * (n_types + 1))
            h, second = bigrams(seq, first)
            v = level[back[second - 1]]
            kind, kinds = factorize((h & ~U64(63)) | v.astype(U64))
            both = MEANS[(known["pair"] if bigram is None else bigram().level)(kinds)][kind]
            weight = np.where(v > 0, share[v], 0.0)
            logs = np.zeros(len(seq))
            logs[second] = np.log10(weight * np.minimum(1.0, both / np.maximum(MEANS[v], 1.0)) + (1 - weight) * alone[back[second]])
            logs[first[:-1]] = np.log10(alone[back[first[:-1]]])  # tokens without one before them
            sums = [np.add.reduceat(x, first[:-1]) for x in ((c > 0)[back].astype(np.int64), np.log10((c + 0.5) / (n_all + 0.5 * (n_types + 1)))[back], logs)]
            yield batch(_SCORED, ids, [held_out(i) for i in ids], np.diff(first), *sums)

    out = source.mapInArrow(scored, _SCORED_DDL)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")
