"""Links between two tokenizers' ids, counted over the corpus in dense matrices that are striped by id.

A text is encoded by both tokenizers; byte offsets at which tokens of both end cut it into groups, and
every pair of tokens in a group is a link. Both tokenizers end a token wherever a space
follows something else than white space, so a text falls into segments there, whose tokens and links
don't depend on their neighbours; a worker encodes each distinct segment once.

Id pairs go to stripes by side-A id modulo the number of stripes. Tasks send each stripe its pairs
with the documents of a block that hold them; a stripe adds them up in a dense matrix of its
A ids against all B ids, whose row maxima are the best counts. Links are then scored where
their stripe's matrix is, and summed up by block.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, PARTITION_BLOCKS, slices, staged
from .packing import WHITE, byte_values, encoder, vocabulary_file

STRIPES = 128
#: Blocks whose counts, or links, of a stripe go to one task.
COUNT_BLOCKS, LINK_BLOCKS = 4096, 1024
#: Documents of a block at most, and segments that a worker keeps.
BLOCK_DOCS, KEPT = 1 << 16, 300_000
#: Pairs of a group that are listed one by one; of larger groups distinct ids are paired.
PLAIN_PAIRS = 4096
#: Characters that the side-B library is given at once, if the text has a place to cut it.
CUT = 1 << 16

_GLUE = re.compile(f"[{WHITE}] ")
_WHITE = set(re.findall(f"[{WHITE}]", "".join(map(chr, range(0x3100)))))
_ZSTD = pa.Codec("zstd", compression_level=3)


def piece_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.encoder = encoder(a_path, added=False)
        with open(a_path, encoding="utf-8") as f:
            vocabulary, byte = json.load(f)["model"]["vocab"], byte_values()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("pieces of side B go on after a space, so texts can't be cut there")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = [np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes)]

    def b_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts, each of which stands after a space; long ones in parts. The library gives an empty text nothing, but here it is the space."""
        space = [self.b.piece_to_id("▁")]
        encode = lambda found: [ids if t else space for t, ids in zip(found, self.b.encode(found, num_threads=1), strict=True)]
        if all(len(t) <= CUT for t in texts):
            return encode(texts)
        return [[i for ids in encode(parts(t, CUT)) for i in ids] for t in texts]


def parts(text: str, least: int) -> list[str]:
    """A text cut before spaces that follow other characters, each part of at least so many characters; the space itself is left out."""
    out, at = [], 0
    while len(text) - at > least:
        found = re.compile(r"(?<=[^ ]) ").search(text, at + least)
        if not found:
            break
        out.append(text[at : found.start()])
        at = found.end()
    return [*out, text[at:]]


@lru_cache(maxsize=2)
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def segments(text: str) -> list[str]:
    """The segments of a text, each without the space that it begins with (the first has one put before it)."""
    pieces = text.split(" ")
    if not (_GLUE.search(text) or text[:1] == " "):
        return pieces
    out, glue = [], False
    for p in pieces:
        if glue:
            out[-1] += f" {p}"
        else:
            out.append(p)
        glue = not p or p[-1] in _WHITE
    return out


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, laid byte by byte of the same worth and compressed."""
    raw = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _unpacked(raw: bytes, *shapes: tuple[str, int]) -> list[np.ndarray]:
    data, out, at = np.frombuffer(_ZSTD.decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True), np.uint8), [], 0
    for kind, n in shapes:
        wide = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * wide].reshape(wide, n).T).view(kind).ravel())
        at += n * wide
    return out


def _spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... n[i] numbers for each i, one after the other."""
    to = np.cumsum(n)
    return np.repeat(begin - (to - n), n) + np.arange(int(to[-1]) if len(to) else 0)


class Segments:
    """Distinct segments that a worker has met: sums of each, the text of its groups, and its links as pairs with their number."""

    def __init__(self, both: Pair):
        self.both, self.width = both, len(both.b_bytes)
        self.decimal = [f"{i}{s}" for i in range(max(len(both.a_bytes), len(both.b_bytes))) for s in (",", "|", ";", "")]
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {}
        self.shown: list[str] = []
        self.valid = np.empty(0, bool)
        self.sums = np.empty((0, 4), np.int64)  # A ids, B ids, groups, links
        self.begin, self.pairs, self.times = np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def numbers(self, found: list[str]) -> np.ndarray:
        """The places of segments; those that are new are encoded when `encode` is called."""
        index = self.index
        return np.fromiter((index.setdefault(s, len(index)) for s in found), np.int64, len(found))

    def encode(self) -> None:
        """Encode the segments that have come since."""
        new = list(self.index)[len(self.shown) :]
        if not new:
            return
        both = self.both
        a, b = [both.encoder.ids(f" {s}").tolist() for s in new], both.b_ids(new)
        for k, s in enumerate(new):
            raw = f" {s}".encode()
            if b"".join(map(both.a_bytes.__getitem__, a[k])) != raw or b"".join(map(both.b_bytes.__getitem__, b[k])) != raw:
                a[k], b[k] = [], []
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        a, b = (np.array([i for x in side for i in x], np.int64) for side in (a, b))
        end_a, end_b = np.cumsum(both.sizes[0][a]), np.cumsum(both.sizes[1][b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        size_a, size_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        owner = np.repeat(np.arange(len(new)), n_a)[np.cumsum(size_a) - 1] if len(common) else np.empty(0, np.int64)
        groups, links = np.bincount(owner, minlength=len(new)), np.zeros(len(new), np.int64)
        np.add.at(links, owner, size_a * size_b)
        # groups as text: ids in the order of group, side and place, each with what stands after it
        ids, group, side = np.concatenate([a, b]), np.concatenate([group_a, group_b]), np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, group))
        after = np.zeros(len(ids), np.int64)
        after[np.cumsum(size_a + size_b) - size_b - 1] = 1
        after[np.cumsum(size_a + size_b) - 1] = 2
        tokens = np.cumsum(n_a + n_b)
        after[tokens[(n_a + n_b) > 0] - 1] = 3
        text, at = list(map(self.decimal.__getitem__, (ids[order] * 4 + after).tolist())), 0
        for k in tokens.tolist():
            self.shown.append("".join(text[at:k]))
            at = k
        # links: all pairs of small groups; of large ones pairs of distinct ids, with how often they stand there
        plain = size_a * size_b <= PLAIN_PAIRS
        mine = plain[group_a]
        times = size_b[group_a[mine]]
        left, right = np.repeat(a[mine], times), b[_spread((np.cumsum(size_b) - size_b)[group_a[mine]], times)]
        keys, holder, many = [left * self.width + right], [np.repeat(owner[group_a[mine]], times)], [np.ones(len(left), np.int64)]
        for g in np.flatnonzero(~plain).tolist():
            x, y = (np.unique(t[slice(*np.searchsorted(of, [g, g + 1]))], return_counts=True) for t, of in ((a, group_a), (b, group_b)))
            keys.append((x[0][:, None] * self.width + y[0]).ravel())
            many.append((x[1][:, None] * y[1]).ravel())
            holder.append(np.full(len(keys[-1]), owner[g]))
        keys, holder, many = np.concatenate(keys), np.concatenate(holder), np.concatenate(many)
        order = np.lexsort((keys, holder))
        keys, holder, many = keys[order], holder[order], many[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (holder[1:] != holder[:-1])]) if len(keys) else np.empty(0, np.int64)
        self.pairs = np.concatenate([self.pairs, keys[first]])
        self.times = np.concatenate([self.times, np.add.reduceat(many, first) if len(first) else many])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.bincount(holder[first], minlength=len(new)))])
        self.valid = np.concatenate([self.valid, n_a > 0])
        self.sums = np.concatenate([self.sums, np.stack([n_a, n_b, groups, links], axis=1)])


_PART = pa.schema([("block", pa.int64()), ("stripe", pa.int32()), ("pairs", pa.int32()), ("links", pa.int32()), ("counted", pa.binary()), ("linked", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("sums", pa.list_(pa.int64())), ("shas", pa.list_(pa.string()))])
_PART_DDL = "block long, stripe int, pairs int, links int, counted binary, linked binary, doc_ids array<long>, sums array<long>, shas array<string>"


class Block:
    """Documents whose links are handed out together."""

    def __init__(self, number: int, known: Segments, stripes: int):
        self.number, self.known, self.stripes = number, known, stripes
        self.ids, self.found, self.size = [], [], 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = ""
        self.ids.append(doc_id)
        self.found.append(self.known.numbers(segments(text)) if text else np.empty(0, np.int64))
        self.size += len(raw)

    def rows(self):
        """A row with the documents' own figures, then one for each stripe that has links of them."""
        known, n = self.known, len(self.ids)
        known.encode()
        ok = [len(f) > 0 and bool(known.valid[f].all()) for f in self.found]
        shas = [hashlib.sha256(";".join(map(known.shown.__getitem__, f.tolist())).encode()).hexdigest() if o else "" for f, o in zip(self.found, ok, strict=True)]
        found = [f if o else f[:0] for f, o in zip(self.found, ok, strict=True)]
        doc, segment = np.repeat(np.arange(n), [len(f) for f in found]), np.concatenate([*found, np.empty(0, np.int64)])
        sums = np.zeros((n, 4), np.int64)
        np.add.at(sums, doc, known.sums[segment])
        empty = [None] * 3
        yield [[self.number], [-1], [0], [0], [None], [None], [self.ids], [sums.ravel().tolist()], [shas]]
        once, times = np.unique(doc * len(known.shown) + segment, return_counts=True)
        doc, segment = np.divmod(once, max(1, len(known.shown)))
        held = known.begin[segment + 1] - known.begin[segment]
        at = _spread(known.begin[segment], held)
        a, b = np.divmod(known.pairs[at], known.width)
        height = -(-len(known.both.a_bytes) // self.stripes)
        key = (((a % self.stripes) * height + a // self.stripes) * known.width + b) << 16 | np.repeat(doc, held)
        order = np.argsort(key)
        key, times = key[order], (known.times[at] * np.repeat(times, held))[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        times, key = np.add.reduceat(times, first) if len(first) else times, key[first]
        pair, doc = key >> 16, key & 0xFFFF
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.empty(0, np.int64)
        docs_of = np.diff(first, append=len(pair))
        pair = pair[first]
        edge = np.searchsorted(pair, np.arange(self.stripes + 1) * height * known.width)
        link_edge = np.r_[first, len(doc)]
        for s in np.flatnonzero(np.diff(edge)).tolist():
            p = slice(edge[s], edge[s + 1])
            e = slice(link_edge[edge[s]], link_edge[edge[s + 1]])
            keys = np.diff(pair[p] - s * height * known.width, prepend=0).astype("<u4")
            counted = _packed(keys, docs_of[p].astype("<u4"))
            linked = _packed(np.diff(doc[e], prepend=0).astype("<u2"), times[e].astype("<u8"))
            yield [[self.number], [s], [p.stop - p.start], [int(e.stop - e.start)], [counted], [linked], *([x] for x in empty)]


def encoded(docs: DataFrame, a_path: str, b_path: str, stripes: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Staged blocks: a row with the documents' ids, sums and digests (stripe -1), and a row for each stripe.

    counted: pairs of the stripe and how many documents of the block hold each; linked: these documents, pair by pair, and how often each has the pair.
    """

    def work(batches):
        from pyspark import TaskContext

        begin = TaskContext.get().partitionId() << PARTITION_BLOCKS
        known = Segments(_pair(a_path, b_path))
        made = Block(begin, known, stripes)
        for rows, texts in slices(batches):
            for doc_id, raw in zip(rows.column("doc_id").to_pylist(), texts, strict=True):
                made.add(doc_id, raw)
                if made.size >= block_bytes or len(made.ids) == BLOCK_DOCS:
                    yield from map(record, made.rows())
                    if made.number + 1 >> PARTITION_BLOCKS != begin >> PARTITION_BLOCKS:
                        raise ValueError("too many blocks in a partition; repartition the documents")
                    made = Block(made.number + 1, known, stripes)
                    if len(known.shown) > KEPT:
                        known.clear()
        if made.ids:
            yield from map(record, made.rows())

    def record(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PART.types, strict=True)], schema=_PART)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return staged(rows.mapInArrow(work, _PART_DDL), "token-links")


_SUM = pa.schema([("stripe", pa.int32()), ("pairs", pa.int32()), ("counted", pa.binary())])


def summed(counts: DataFrame, keys: list[str], cells: int) -> DataFrame:
    """stripe, pairs, counted: the counts of each of `keys` (stripe first), added up in a dense matrix of `cells` cells."""

    def work(batches):
        block, now = None, None

        def put():
            some = np.flatnonzero(block)
            kept = _packed(np.diff(some, prepend=0).astype("<u4"), block[some].astype("<u8"))
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([len(some)], pa.int32()), pa.array([kept], pa.binary())], schema=_SUM)

        for rows in batches:
            for key, n, raw, wide in zip(zip(*(rows.column(k).to_pylist() for k in keys), strict=True), rows.column("pairs").to_pylist(), rows.column("counted"), rows.column("wide").to_pylist(), strict=True):
                if key != now:
                    if now:
                        yield put()
                    now, block = key, np.zeros(cells, np.int64)
                at, many = _unpacked(raw.as_py(), ("<u4", n), ("<u8" if wide else "<u4", n))
                np.add.at(block, np.cumsum(at, dtype=np.int64), many.astype(np.int64))
        if now:
            yield put()

    return counts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(work, "stripe int, pairs int, counted binary")


_SCORED = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("scored", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])
_OUT_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, stripes: int = STRIPES, count_blocks: int = COUNT_BLOCKS, link_blocks: int = LINK_BLOCKS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of `docs`.

    A null or empty text, one that is no UTF-8, and one whose joined tokens of a side differ from a space and the
    text, have no tokens: zeros, and '' for the digest. Special tokens' strings are plain text.
    Each row counts as a document of its own, also if doc_ids repeat or are null. No ties arise but
    counts that equal a row's maximum, which are all best. No documents give no rows. Counts of
    a stripe's blocks are added up in parts of `count_blocks`, and links are scored in parts of `link_blocks`,
    so no task's work grows with the corpus but by one row a part. A single group's distinct ids and a
    single text are held by one task.
    """
    a_path, b_path = a_path or vocabulary_file(), b_path or piece_file()
    both = _pair(a_path, b_path)
    width, height = len(both.b_bytes), -(-len(both.a_bytes) // stripes)
    made = encoded(docs, a_path, b_path, stripes, block_bytes)
    blocks = made.where("stripe = -1").count()
    links = made.where("stripe >= 0").select("block", "stripe", "pairs", "links", "counted", "linked")
    hashed = F.xxhash64("block")
    counts = links.select("stripe", "pairs", "counted", F.lit(False).alias("wide"), F.pmod(hashed, F.lit(-(-blocks // count_blocks) or 1)).alias("part"))
    if blocks > count_blocks:
        counts = summed(counts, ["stripe", "part"], height * width).withColumn("wide", F.lit(True))
    sums = staged(summed(counts, ["stripe"], height * width), "token-counts")
    shares = -(-blocks // link_blocks) or 1
    nothing = F.lit(None).cast("binary")
    left = sums.select("stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))).alias("part"), F.lit(-1).cast("long").alias("block"), "pairs", F.lit(0).alias("links"), "counted", nothing.alias("linked"))
    right = links.select("stripe", F.pmod(hashed, F.lit(shares)).alias("part"), "block", "pairs", "links", "counted", "linked")
    placed = left.unionByName(right).repartition("stripe", "part").sortWithinPartitions("stripe", "part", "block")

    def score(batches):
        block = best = None
        for rows in batches:
            columns = (rows.column(c) for c in ("block", "pairs", "links", "counted", "linked"))
            for number, n, m, counted, linked in zip(*columns, strict=True):
                number, n, m = number.as_py(), n.as_py(), m.as_py()
                if number < 0:  # the stripe's matrix comes before its links
                    at, many = _unpacked(counted.as_py(), ("<u4", n), ("<u8", n))
                    block = np.zeros(height * width, np.int64)
                    block[np.cumsum(at, dtype=np.int64)] = many
                    best = block.reshape(height, width).max(axis=1)
                    continue
                at, docs_of = _unpacked(counted.as_py(), ("<u4", n), ("<u4", n))
                doc, times = _unpacked(linked.as_py(), ("<u2", m), ("<u8", m))
                at, doc, times = np.cumsum(at, dtype=np.int64), np.cumsum(doc, dtype=np.uint16).astype(np.int64), times.astype(np.int64)
                count = block[at]
                is_best = np.repeat(count == best[at // width], docs_of)
                sums = np.zeros((int(doc.max()) + 1, 2), np.int64)
                np.add.at(sums[:, 0], doc, times * is_best)
                np.add.at(sums[:, 1], doc, times * np.repeat(count, docs_of))
                some = np.flatnonzero(sums[:, 1])
                kept = _packed(np.diff(some, prepend=0).astype("<u2"), sums[some, 0].astype("<u8"), sums[some, 1].astype("<u8"))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([len(some)], pa.int32()), pa.array([kept], pa.binary())], schema=_SCORED)

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = table.filter(pa.compute.is_valid(table.column("doc_ids"))).to_batches()[0]
        ids, shas = own.column("doc_ids")[0].values, own.column("shas")[0].values
        sums = own.column("sums")[0].values.to_numpy().reshape(-1, 4)
        total = np.zeros((len(ids), 2), np.int64)
        for n, raw in zip(table.column("n").to_pylist(), table.column("scored").to_pylist(), strict=True):
            if raw is not None:
                doc, found, count = _unpacked(raw, ("<u2", n), ("<u8", n), ("<u8", n))
                total[np.cumsum(doc, dtype=np.int64)] += np.stack([found.astype(np.int64), count.astype(np.int64)], axis=1)
        return pa.Table.from_arrays([ids, *(pa.array(c) for c in sums.T), *(pa.array(c) for c in total.T), shas], schema=_OUT)

    scored = placed.mapInArrow(score, "block long, n int, scored binary")
    own = made.where("stripe = -1").select("block", F.lit(0).alias("n"), nothing.alias("scored"), "doc_ids", "sums", "shas")
    given = scored.select("*", F.lit(None).cast("array<long>").alias("doc_ids"), F.lit(None).cast("array<long>").alias("sums"), F.lit(None).cast("array<string>").alias("shas"))
    return own.unionByName(given).groupBy("block").applyInArrow(finish, _OUT_DDL)
