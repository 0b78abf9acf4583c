"""SimHash near-dedup of texts: who meets is compared by whole sets of five-word shingles.

Texts of the same shingles form a node. A node has as keys the ball of its SimHash (as in
`simhash`), and `BANDS` keys made of `ROWS` least values of its shingles: a likeness of 0.8
is some ten differing bits, out of reach for a ball of 64-bit patterns, while two such nodes
have no band in common once in 13,000 times. Whoever meets at a key is a candidate only
if sizes allow a likeness of 0.8, and so do bitmaps of the shingles (their differing bits
are at most as many as the differing shingles); candidates are compared by whole sets, so
both filters and the keys change no verdict on a pair. A few smallest nodes of each key are
compared with all others there, until no key has two nodes that were not; who is near a
smaller node leaves, so a large group costs a few comparisons a member.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NONSPACE, U64, Words, batch, gram_places, grams, mixed, signed, slices, span_hashes, staged
from .simhash import ball, simhash

SHINGLE, BANDS, ROWS, RADIUS = 5, 24, 5, 2
#: Near copies share at least NEAR[0] / NEAR[1] of their shingles.
NEAR = (4, 5)
#: Smallest nodes of a key that are compared with the others in the first round, and how many times as many in each next one.
FIRST, GROWTH = 4, 4
#: Numbers of 64 bits in a bitmap.
BITMAP = 16
_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, (2, BANDS * ROWS), dtype=U64) * U64(2) + U64(1)

_SKETCH = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("node", pa.int64()), ("fingerprint", pa.int64()), ("bands", pa.list_(pa.int64()))])
_SET = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("bitmap", pa.list_(pa.int64())), ("shingles", pa.binary())])
_PAIR = pa.schema([("node", pa.int64())])


def shingles(texts: list[bytes], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of some texts, repeats included, text by text, and how many each text has.

    Shingles of `shingle` words between white space, A-Z lower-cased; fewer words form one shingle.
    """
    w = Words(texts, NONSPACE, lower=True)
    h = w.hashes()
    places, owner = gram_places(w.first, shingle), w.owner()
    few = np.flatnonzero((w.counts > 0) & (w.counts < shingle))
    found = np.concatenate([grams(h, shingle)[places], span_hashes(h, w.first[few], w.first[few + 1])])
    owner = np.concatenate([owner[places], few])
    return found[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(texts))


def sketch(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The node of each text (0: no words), and its keys, a row of `BANDS`."""
    h, n = shingles(texts)
    node, keys = np.zeros(len(texts), U64), np.zeros((len(texts), BANDS), U64)
    some = np.flatnonzero(n)
    if len(some):
        first = (np.cumsum(n) - n)[some]
        node[some] = mixed(np.add.reduceat(mixed(h), first) + n[some].astype(U64))
        for b in range(BANDS):
            key = np.full(len(some), U64(b), U64)
            for k in range(b * ROWS, (b + 1) * ROWS):
                key = mixed(key * U64(0x9E3779B97F4A7C15) + np.minimum.reduceat(h * _FACTORS[0, k] + _FACTORS[1, k], first))
            keys[some, b] = key
    return node, keys


def bitmap(distinct: np.ndarray) -> np.ndarray:
    """For each of `BITMAP` * 64 places whether an odd number of the shingles falls there, as 64-bit numbers."""
    odd = np.bincount((distinct >> U64(64 - (BITMAP * 64 - 1).bit_length())).astype(np.int64), minlength=BITMAP * 64) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets (sorted, without repeats) are as alike as `NEAR` says."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return NEAR[1] * both >= NEAR[0] * (len(a) + len(b) - both)


def _may_be_near() -> Column:
    """Whether sizes and bitmaps allow a likeness of `NEAR`: with d differing shingles it is (all - d) / (all + d)."""
    size, other = F.col("size"), F.col("low_size")
    differ = reduce(add, [F.bit_count(F.get("bitmap", F.lit(k)).bitwiseXOR(F.get("low_bitmap", F.lit(k)))) for k in range(BITMAP)])
    return (F.least(size, other) * NEAR[1] >= F.greatest(size, other) * NEAR[0]) & (differ * sum(NEAR) <= (size + other) * (NEAR[1] - NEAR[0]))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, keeper_id, keeper_hash, stays of every row (doc_id long, text_hash long, text): the smallest row of its node, and whether the node stays.

    Rows are ordered by doc_id (none last) and text_hash. Null and empty texts, and those of
    spaces, are one node, which stays. A node that leaves is near a smaller one, which stays or
    is itself near a smaller one; of two near nodes that meet at a key one leaves.
    """

    def sketched(batches):
        for rows, texts in slices(batches):
            node, keys = sketch(texts)
            yield batch(_SKETCH, rows.column("doc_id"), rows.column("text_hash"), signed(node), signed(simhash(texts, SHINGLE)), [k if x else [] for x, k in zip(node, signed(keys), strict=True)])

    def sets(batches):
        for rows, texts in slices(batches):
            h, n = shingles(texts)
            own = [np.unique(x) for x in np.split(h, np.cumsum(n)[:-1])]
            yield batch(_SET, rows.column("node"), [len(x) for x in own], [bitmap(x) for x in own], [x.tobytes() for x in own])

    def compared(batches):
        for rows in batches:
            own, other = (rows.column(c) for c in ("shingles", "low_shingles"))
            ok = [near(np.frombuffer(a.as_buffer(), U64), np.frombuffer(b.as_buffer(), U64)) for a, b in zip(own, other, strict=True)]
            yield batch(_PAIR, rows.column("node").filter(pa.array(ok, pa.bool_())))

    found = staged(docs.select("doc_id", "text_hash", "text").mapInArrow(sketched, "doc_id long, text_hash long, node long, fingerprint long, bands array<long>"), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("text_hash").alias("text_hash"))
    nodes = staged(found.groupBy("node").agg(F.min(order).alias("low"), F.min(F.struct("fingerprint", "bands")).alias("s")).select("node", "low", "s.fingerprint", "s.bands"), "nodes")
    patterns = F.transform(ball(F.col("fingerprint"), RADIUS // 2), lambda v: F.xxhash64(F.lit("ball"), v))
    keys = nodes.where(F.size("bands") > 0).select("node", F.explode(F.concat("bands", patterns)).alias("key"))
    shared = lambda m: m.join(m.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "key")
    met = staged(shared(keys), "met")
    wanted = met.select("node").distinct().join(nodes.select("node", "low"), "node").select("node", F.col("low.doc_id").alias("d"), F.col("low.text_hash").alias("t"))
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(F.col("d")) & (docs["text_hash"] == F.col("t"))).select("node", "text")
    full = staged(texts.mapInArrow(sets, "node long, size long, bitmap array<long>, shingles binary").dropDuplicates(["node"]), "sets")
    members = staged(met.join(nodes.select("node", "low"), "node").join(full.select("node", "size", "bitmap"), "node"), "members")
    gone, most = None, FIRST
    while not members.isEmpty():
        rank = F.row_number().over(Window.partitionBy("key").orderBy("low", "node"))
        low = staged(members.withColumn("rank", rank).where(F.col("rank") <= most).select("key", *[F.col(c).alias(f"low_{c}") for c in ("node", "low", "size", "bitmap")]), "low")
        earlier = (F.col("low_low") < F.col("low")) | (F.col("low_low") == F.col("low")) & (F.col("low_node") < F.col("node"))
        pairs = members.join(low, (members["key"] == low["key"]) & earlier & _may_be_near()).select("node", "low_node").distinct()
        pairs = pairs.join(full, "node").join(full.select(F.col("node").alias("low_node"), F.col("shingles").alias("low_shingles")), "low_node")
        left = staged(pairs.select("node", "shingles", "low_shingles").mapInArrow(compared, "node long").distinct(), "near")
        gone = left if gone is None else gone.unionByName(left)
        rest = members.join(low, (members["key"] == low["key"]) & (members["node"] == low["low_node"]), "left_anti").join(left, "node", "left_anti")
        members, most = staged(shared(rest), "members"), most * GROWTH
    stays = nodes.select("node", "low") if gone is None else nodes.select("node", "low").join(gone, "node", "left_anti")
    named = nodes.select("node").join(stays, "node", "left").select("node", F.col("low.doc_id").alias("keeper_id"), F.col("low.text_hash").alias("keeper_hash"), F.col("low").isNotNull().alias("stays"))
    return found.select("doc_id", "text_hash", "node").join(named, "node").select("doc_id", "text_hash", "keeper_id", "keeper_hash", "stays")
