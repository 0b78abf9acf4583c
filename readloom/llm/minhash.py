"""One-permutation MinHash with optimal densification and packed low-order bits.

All shingle hashes of a text are binned once; each bin keeps its smallest hash. An empty
bin takes the value of a bin that is found by a hash of (bin, attempt), the same for all
texts, until one that was not empty is met. Of each bin the lowest eight bits are kept;
two unequal values agree in them by chance once in 256, which the likeness corrects for.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NONSPACE, U64, Words, batch, gram_places, grams, mixed, slices, span_hashes

BINS, SHINGLE = 256, 5
_NONE = U64(0xFFFFFFFFFFFFFFFF)
#: Docs of a bucket, and buckets at most: what one task reads in order, and the size of the table of bounds.
BUCKET_ROWS, MOST_BUCKETS = 4000, 1 << 16
LEAST = -(1 << 63)


def signatures(texts: list[bytes], bins: int = BINS, shingle: int = SHINGLE) -> np.ndarray:
    """A row of `bins` bytes for each text: the low bits of each bin's least shingle hash; all zero without words.

    Shingles of `shingle` words between white space, A-Z lower-cased; fewer words form one shingle.
    """
    w = Words(texts, NONSPACE, lower=True)
    h = w.hashes()
    places, owner = gram_places(w.first, shingle), w.owner()
    few = np.flatnonzero((w.counts > 0) & (w.counts < shingle))
    h = np.concatenate([grams(h, shingle)[places], span_hashes(h, w.first[few], w.first[few + 1])])
    owner = np.concatenate([owner[places], few])
    least = np.full(len(texts) * bins, _NONE, U64)
    np.minimum.at(least, owner * bins + (h % U64(bins)).astype(np.int64), mixed(h))
    full = least != _NONE
    texts_full = np.zeros(len(texts), bool)
    texts_full[owner] = True
    out = least.copy()
    todo = np.flatnonzero(~full & np.repeat(texts_full, bins))
    attempt = 0
    while len(todo):
        attempt += 1
        cell = todo % bins
        source = todo - cell + (mixed((cell + attempt * bins).astype(U64)) % U64(bins)).astype(np.int64)
        hit = full[source]
        out[todo[hit]] = least[source[hit]]
        todo = todo[~hit]
    out[np.repeat(~texts_full, bins)] = 0
    return (out & U64(0xFF)).astype(np.uint8).reshape(len(texts), bins)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1, corrected for agreement by chance."""
    chance = 1 / 256
    return np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bins: int = BINS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint binary of every whole text (null: empty); equal texts have equal ones."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.binary())])

    def work(batches):
        for rows, texts in slices(batches):
            yield batch(schema, rows.column("doc_id"), [s.tobytes() for s in signatures(texts, bins, shingle)])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, "doc_id long, fingerprint binary")


_PAIRED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _bucket(at_k: np.ndarray, at_h: np.ndarray, k: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The last of the sorted bounds (at_k, at_h) that is not above each (k, h)."""
    low, high = np.searchsorted(at_k, k), np.searchsorted(at_k, k, side="right")
    out = high - 1
    split = np.flatnonzero(high - low > 1)
    for x in np.unique(k[split]):
        mine = split[k[split] == x]
        a, b = int(low[mine[0]]), int(high[mine[0]])
        out[mine] = a + np.searchsorted(at_h[a:b], h[mine], side="right") - 1
    return out


def _bounds(rows: DataFrame) -> list[tuple[int, int]]:
    """Sorted (k, hash of the text) that begin ranges of about `BUCKET_ROWS` of rows (k long, text).

    Ranges of k begin at approximate quantiles, with a hash of `LEAST`: before all rows of k.
    A range far above the usual size begins with a k that many rows have, which is cut by
    hash evenly; what is above that k forms a range of its own.
    """
    n, least = rows.agg(F.count("*"), F.min("k")).first()
    wanted = max(1, min(MOST_BUCKETS, -(-n // BUCKET_ROWS)))
    if wanted == 1:
        return [(least or 0, LEAST)]
    # doubles cannot hold all ids: take the least id at or above each bound
    table = np.array(sorted({int(x) for x in rows.approxQuantile("k", [i / wanted for i in range(1, wanted)], 1 / (8 * wanted))} | {least}), np.int64)
    rough = F.pandas_udf(lambda k: pd.Series(np.searchsorted(table, k.to_numpy(), side="right") - 1), "long")
    found = sorted(rows.groupBy(rough("k").alias("r")).agg(F.min("k").alias("k"), F.count("*").alias("n")).select("k", "n").collect())
    usual = -(-n // wanted)
    low = np.array([k for k, _ in found], np.int64)
    pieces = np.array([-(-m // usual) if m > 4 * usual else 0 for _, m in found], np.int64)
    out = [(int(k), LEAST) for k, m in zip(low, pieces, strict=True) if not m]
    if pieces.any():

        @F.pandas_udf("long")
        def piece(k, h):
            """-1: not cut; a range's pieces by hash, then what is above its first k."""
            r = np.searchsorted(low, k.to_numpy(), side="right") - 1
            m = pieces[r]
            cut = ((h.to_numpy().view(U64) ^ U64(1 << 63)) >> U64(32)) * m.astype(U64) >> U64(32)
            inside = np.where(low[r] == k.to_numpy(), cut.astype(np.int64), m)
            return pd.Series(np.where(m > 0, r << 32 | inside, -1))

        parts = rows.select("k", F.xxhash64("text").alias("h")).withColumn("piece", piece("k", "h")).where("piece >= 0")
        first = {int(k) for k, m in zip(low, pieces, strict=True) if m}
        out += [(k, h if k in first else LEAST) for k, h in parts.groupBy("piece").agg(F.min(F.struct("k", "h")).alias("x")).select("x.*").collect()]
    return sorted(out)


def compared_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's fingerprint against that of its edited text and of the next document, by ascending doc_id.

    The edited text has its last floor(n / 2) code points replaced by the first as many of
    the next document's; bytes that are no UTF-8 count as U+FFFD there. Rows without doc_id come first; rows of one doc_id are ordered by
    a hash of their text; the last row's next is the first row (a single row's: itself).

    One shuffle of the texts: rows are dealt to ranges of (doc_id, hash), whose bounds occur
    (at most twice `MOST_BUCKETS`), and read in order. The rows at a bound are also sent to
    the range before it, where they close the last pair. So a doc_id of a third of all rows
    is split by hash; only rows that are alike in doc_id and text lie together.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST))
    rows = docs.select(key.alias("k"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds = np.array(_bounds(rows), np.int64)
    at_k, at_h, last = bounds[:, 0], bounds[:, 1], len(bounds) - 1

    @F.pandas_udf("array<long>")
    def dealt(k, h):
        k, h = k.to_numpy(), h.to_numpy()
        bucket = _bucket(at_k, at_h, k, h)
        at_bound = (at_k[bucket] == k) & ((at_h[bucket] == LEAST) | (at_h[bucket] == h))
        return pd.Series([[b, (b - 1) if b else last] if x else [b] for b, x in zip(bucket.tolist(), at_bound.tolist(), strict=True)])

    spread = rows.withColumn("h", F.xxhash64("text")).select("*", F.posexplode(dealt("k", "h")).alias("follows", "bucket"))
    wrap = ((F.col("follows") == 1) & (F.col("bucket") == last)).cast("int")  # the first row follows the last
    ordered = spread.withColumn("wrap", wrap).repartition("bucket").sortWithinPartitions("bucket", "wrap", "k", "h")

    def work(batches):
        held: list = []
        for part, texts in slices(batches):
            held += zip(part.column("bucket").to_pylist(), part.column("follows").to_pylist(), part.column("doc_id").to_pylist(), texts, strict=True)
            if len(held) > 1:
                yield from compared(held)
                held = held[-1:]

    def compared(held):
        pairs = [i for i in range(len(held) - 1) if not held[i][1]]
        raw = [x[3] for x in held]
        text = [x.decode("utf-8", "replace") for x in raw]
        sizes = [len(text[i]) for i in pairs]
        edited = [(text[i][: n - n // 2] + text[i + 1][: n // 2]).encode() for i, n in zip(pairs, sizes, strict=True)]
        at = np.array(pairs, np.int64)
        own, new = signatures(raw), signatures(edited)
        shown = [own[i].tobytes().hex() for i in pairs]
        yield batch(_PAIRED, [held[i][2] for i in pairs], sizes, [hashlib.sha256(t).hexdigest() for t in edited], shown, [s.tobytes().hex() for s in new], likeness(own[at], new), likeness(own[at], own[at + 1]))

    return ordered.select("bucket", "follows", "doc_id", "text").mapInArrow(work, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
