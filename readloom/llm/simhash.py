"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within an even radius r share at least one bit pattern within r / 2 of
both. Every distinct fingerprint emits all its patterns within r / 2, the patterns are
shuffled, and whatever meets at a pattern is linked to the smallest fingerprint there:
all of them lie within r of each other, so a star has the same components as all pairs.
At most as many distinct fingerprints meet at a pattern as the ball has patterns (65 for
r = 2), whatever the data; copies are folded into one fingerprint first.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NONSPACE, U64, Words, batch, slices, staged, xxh64

_FINGER = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())])
#: A byte's bits, lowest first, as eight byte lanes of a 64-bit number.
_LANES = np.array([sum((b >> k & 1) << 8 * k for k in range(8)) for b in range(256)], U64)


def simhash(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set if more than half of the shingles' XXH64 have it set.

    A-Z are lower-cased; shingles of `shingle` words between white space, repeats included,
    joined by a space; fewer words form one shingle; no words give zero.
    """
    w = Words(texts, NONSPACE, lower=True)
    keep = NONSPACE[w.data]
    data = w.data.copy()
    data[w.end] = 0x20  # there is a separator after every word
    keep[w.end] = True
    place = np.cumsum(keep) - 1
    data, start, end = data[keep], place[w.start], place[w.end]
    # the shingles of each text, in order
    n = np.where(w.counts >= shingle, w.counts - shingle + 1, np.minimum(w.counts, 1))
    to = np.cumsum(n)
    owner = np.repeat(np.arange(len(n)), n)
    head = w.first[:-1][owner] + np.arange(int(n.sum())) - (to - n)[owner]
    h = xxh64(data, start[head], end[np.minimum(head + shingle, w.first[1:][owner]) - 1])
    out = np.zeros(len(texts), U64)
    some = np.flatnonzero(n)
    if len(some):
        lanes = _LANES[h.view(np.uint8).reshape(-1, 8)]
        # byte lanes hold sums of up to 255 shingles, so texts are summed in runs of 255
        runs = -(-n[some] // 255)
        run_owner = np.repeat(np.arange(len(some)), runs)
        first_run = np.cumsum(runs) - runs
        at = (to - n)[some][run_owner] + 255 * (np.arange(int(runs.sum())) - first_run[run_owner])
        sums = np.add.reduceat(lanes, at, axis=0).view(np.uint8).reshape(len(at), 64).astype(np.int64)
        counts = np.add.reduceat(sums, first_run, axis=0)
        bits = np.packbits(2 * counts > n[some][:, None], axis=1, bitorder="little")
        out[some] = np.ascontiguousarray(bits).view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint long: the SimHash of every whole text (null: empty). One row per row."""

    def work(batches):
        for rows, texts in slices(batches):
            yield batch(_FINGER, rows.column("doc_id"), simhash(texts, shingle).view(np.int64))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, "doc_id long, fingerprint long")


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root for the nodes of `edges` (a long, b long): root is the smallest node reachable.

    Alternating large and small stars until nothing changes; each round is a staged table.
    No group is gathered: minima are pre-aggregated, then joined back, where Spark splits hot keys.
    """
    e = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*").where("a <> b").distinct()
        e = staged(small, "edges")
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            break
        seen = now
    roots = e.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def ball(fingerprint: Column, radius: int) -> Column:
    """All bit patterns within `radius` of a 64-bit fingerprint, as an array."""
    masks = [sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(64), n)]
    return F.transform(F.lit([m - (1 << 64) if m >> 63 else m for m in masks]), lambda m: fingerprint.bitwiseXOR(m))


def near_groups(found: DataFrame, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint, component_id of `fingerprints()` rows, linked at `radius` or fewer differing bits (even).

    component_id is the smallest doc_id reachable; null doc_ids are linked but never a
    component_id unless a component has no other. Repeated rows are kept. An empty table
    gives an empty table.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    found = staged(found, "fingerprints")
    nodes = found.groupBy("fingerprint").agg(F.min("doc_id").alias("low_id"))
    variants = nodes.repartition("fingerprint").select("fingerprint", F.explode(ball(F.col("fingerprint"), radius // 2)).alias("variant"))
    low = F.min("fingerprint").over(Window.partitionBy("variant"))
    pairs = variants.withColumn("b", low).where((F.col("fingerprint") != F.col("b")) & (F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("b"))) <= radius))
    roots = connected_components(pairs.select(F.col("fingerprint").alias("a"), "b"))
    named = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select("fingerprint", "low_id", F.coalesce("root", "fingerprint").alias("root"))
    least = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    groups = named.join(least, "root").select("fingerprint", "component_id")
    return found.join(groups, "fingerprint").select("doc_id", "fingerprint", "component_id")
