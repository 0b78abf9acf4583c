"""Reads to places in a reference of any size: minimizer index, chains of anchors, alignment with affine gaps.

The index holds the minimizers of the contigs, each k-mer whose hash is the least of some window of
w k-mers, on either strand; it is a table by hash, so reads meet it in an equi-join, and a
stored index is bucketed, so only the reads move. Anchors of a read on one strand of a contig are
chained where they are colinear, chains are aligned within a band of diagonals over tiles of
the contigs, and both ends of a read may be clipped. Minimizers with many places are looked up
only for reads that the others don't place, or by less anchors and not without
an edit, by the rarest that such a read has.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement
from ..session import staged
from .align import TILE, tiles, unmapped

K, WINDOW = 15, 10
#: Places of a minimizer that is looked up for all reads, minimizers with more places that a read without others is looked up by,
#: chains of a read that are aligned, and diagonals at each side of a chain's.
RARE, RESCUE, CANDIDATES, BAND = 64, 4, 32, 12
#: Anchors before one that a chain may go on from, and the share of the best chain's score that others need.
BEFORE, NEAR = 12, 0.5
#: N a read may have, its least length, and the least score as a share of the best one possible.
MOST_N, MIN_LENGTH, LEAST = 2, 50, 0.4
MOST_QUALITY, PER_POINT, TIED = 60, 6, 3

_CODE = np.full(256, -1, np.int64)
_CODE[list(b"ACGT")] = np.arange(4)
_U64 = np.uint64
_NONE = np.int32(-(1 << 28))
_OPS = "MID"


@dataclass(frozen=True)
class Scoring:
    """Points of a match, and the cost of a mismatch, of a gap (open and extend for its first base), and of clipping an end."""

    match: int = 1
    mismatch: int = 4
    gap_open: int = 6
    gap_extend: int = 1
    clip: int = 5


@dataclass(frozen=True)
class Index:
    """places(hash, ref_index, place, reverse, frequent) and tiles of a reference; frequent(hash, n) has the minimizers with more than `rare` places."""

    places: DataFrame
    tiles: DataFrame
    frequent: DataFrame
    k: int
    window: int
    tile: int
    overlap: int


def _sides_shuffled(rows: DataFrame) -> DataFrame:
    """Rows that no join broadcasts: what tasks make of a file has no size that Spark knows, and it takes the small file's for it."""
    return rows.hint("merge")


def _hashed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits."""
    x = (x ^ (x >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def minimizers(text: bytes, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and strand (True: that of the reverse complement) of the minimizers of a sequence; windows with other letters than A, C, G, T have none.

    Of equal hashes in a window all are taken, so a sequence and its reverse complement have the same.
    """
    code = _CODE[np.frombuffer(text, np.uint8)]
    n = len(code) - k + 1
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    ahead, back = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(k):
        part = code[j : j + n]
        ahead = ahead * 4 + part
        back += (3 - part) << 2 * j
    bad = np.concatenate([[0], np.cumsum(code < 0)])
    fine = bad[k:] == bad[:-k]
    reverse = back < ahead
    h = _hashed(np.where(reverse, back, ahead).view(_U64))
    least = np.lib.stride_tricks.sliding_window_view(h, window).min(axis=1)
    whole = np.lib.stride_tricks.sliding_window_view(fine, window).all(axis=1)
    chosen = np.zeros(n, bool)
    for j in range(window):
        chosen[j : j + len(least)] |= whole & (h[j : j + len(least)] == least)
    at = np.flatnonzero(chosen)
    return at, h[at].view(np.int64), reverse[at]


_PLACE = pa.schema([("hash", pa.int64()), ("ref_index", pa.int32()), ("place", pa.int64()), ("reverse", pa.bool_())])


def index(contigs: DataFrame, k: int = K, window: int = WINDOW, rare: int = RARE, tile: int = TILE, overlap: int = 1024) -> Index:
    """The index of contigs(ref_index, name, sequence). overlap: bases that tiles share, which bounds the length of reads."""
    if not 0 < k <= 31 or k % 2 == 0:
        raise ValueError("k must be odd and at most 31")
    if overlap < window + k:
        raise ValueError("tiles must overlap by a window of k-mers")
    cut = tiles(contigs, overlap, tile)

    def found(batches):
        for rows in batches:
            for ref, number, start, sequence in zip(*(rows.column(c).to_pylist() for c in ("ref_index", "tile", "start", "sequence")), strict=True):
                at, h, reverse = minimizers(sequence.encode("ascii", "replace"), k, window)
                at = at + start
                own = (at >= number * tile) & (at < (number + 1) * tile)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((h[own], np.full(int(own.sum()), ref), at[own], reverse[own]), _PLACE.types, strict=True)], schema=_PLACE)

    places = cut.mapInArrow(found, "hash long, ref_index int, place long, reverse boolean")
    frequent = places.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > rare)
    marked = places.join(_sides_shuffled(frequent.select("hash", F.lit(True).alias("frequent"))), "hash", "left").withColumn("frequent", F.coalesce("frequent", F.lit(False)))
    return Index(marked, cut, frequent, k, window, tile, overlap)


def write_index(made: Index, name: str, buckets: int = 200) -> None:
    """An index as tables of the catalog, `name`_places and so on, in buckets of the columns that it is joined by."""
    for part, keys in (("places", ["hash"]), ("tiles", ["ref_index", "tile"]), ("frequent", ["hash"])):
        rows = getattr(made, part)
        rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"{name}_{part}")
    spark = made.places.sparkSession
    spark.createDataFrame([(made.k, made.window, made.tile, made.overlap)], "k int, window int, tile int, overlap int").coalesce(1).write.saveAsTable(f"{name}_parameters")


def read_index(spark: SparkSession, name: str) -> Index:
    p = spark.table(f"{name}_parameters").first()
    return Index(*(spark.table(f"{name}_{part}") for part in ("places", "tiles", "frequent")), p.k, p.window, p.tile, p.overlap)


_SEED = pa.schema([("ordinal", pa.int64()), ("length", pa.int32()), ("at", pa.int32()), ("hash", pa.int64()), ("reverse", pa.bool_())])


def seeds(reads: DataFrame, k: int, window: int) -> DataFrame:
    """The minimizers of reads(ordinal, base): ordinal, length, at, hash, reverse."""

    def found(batches):
        for rows in batches:
            texts = [t.encode("ascii", "replace") for t in rows.column("base").to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            at, h, reverse = minimizers(b"\n".join(texts), k, window)  # no window goes over a line end
            begin = np.concatenate([[0], np.cumsum(sizes + 1)])
            row = np.searchsorted(begin, at, side="right") - 1
            columns = rows.column("ordinal").take(pa.array(row)), sizes[row], at - begin[row], h, reverse
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, _SEED.types, strict=True)], schema=_SEED)

    return reads.select("ordinal", "base").mapInArrow(found, "ordinal long, length int, at int, hash long, reverse boolean")


def anchors(found: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """Where a read's minimizers stand: ordinal, reverse, ref_index, place, at (from the begin of the read as it lies on the strand), length."""
    other = places.select("hash", "ref_index", "place", F.col("reverse").alias("turned"))
    reverse = F.col("reverse") != F.col("turned")
    return found.join(_sides_shuffled(other), "hash").select("ordinal", reverse.alias("reverse"), "ref_index", "place", F.when(reverse, F.col("length") - k - F.col("at")).otherwise(F.col("at")).alias("at"), "length")


_CHAIN = pa.schema([("ordinal", pa.int64()), ("reverse", pa.bool_()), ("ref_index", pa.int32()), ("begin", pa.int64()), ("score", pa.int32()), ("anchors", pa.int32()), ("chains", pa.int32())])
_CHAIN_DDL = "ordinal long, reverse boolean, ref_index int, begin long, score int, anchors int, chains int"


def chained(group: np.ndarray, place: np.ndarray, at: np.ndarray, reach: np.ndarray, k: int, band: int, sc: Scoring) -> tuple[np.ndarray, np.ndarray]:
    """The best score of a chain that ends at each anchor, and the anchor where that chain begins. Anchors are sorted by group and place.

    Chains go on within a group to one of the `BEFORE` anchors before, no farther than reach bases, in the
    order of the read, and by diagonals that differ by up to `band`, which costs a gap of as many bases.
    """
    n = len(place)
    score, first = np.full(n, k * sc.match, np.int64), np.arange(n)
    if not n:
        return score, first
    cut = np.r_[True, (group[1:] != group[:-1]) | (place[1:] - place[:-1] > reach[1:])]
    begin = np.flatnonzero(cut)
    size = np.diff(begin, append=n)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    for rank in range(1, int(size[0])):  # the anchors of this rank in all groups at once
        i = begin[: int(np.searchsorted(-size, -rank, side="left"))] + rank
        best, start = score[i], first[i]
        for back in range(1, min(rank, BEFORE) + 1):
            j = i - back
            dx, dy = at[i] - at[j], place[i] - place[j]
            drift = np.abs(dx - dy)
            may = (dx > 0) & (dy > 0) & (dy <= reach[i]) & (drift <= band)
            new = np.where(may, score[j] + np.minimum(np.minimum(dx, dy), k) * sc.match - np.where(drift > 0, sc.gap_open + drift * sc.gap_extend, 0), -1)
            better = new > best
            best, start = np.where(better, new, best), np.where(better, first[j], start)
        score[i], first[i] = best, start
    return score, first


def chains(found: DataFrame, k: int, band: int = BAND, candidates: int = CANDIDATES, sc: Scoring = Scoring()) -> DataFrame:
    """The best chains of each read's anchors: ordinal, reverse, ref_index, begin (of the read), score, anchors, and how many chains the read has that come near the best."""

    def work(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            b = pa.Table.from_batches([*held, b]).combine_chunks().to_batches()[0] if held else b
            ordinals = b.column("ordinal").to_numpy()
            last = int(np.searchsorted(ordinals, ordinals[-1]))  # the last read may go on in the next batch
            if last:
                yield best(b.slice(0, last))
            held = [b.slice(last)]
        if held:
            yield best(held[0])

    def best(b: pa.RecordBatch) -> pa.RecordBatch:
        ordinal, reverse, ref, place, at, length = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ordinal", "reverse", "ref_index", "place", "at", "length"))
        new = np.r_[True, (ordinal[1:] != ordinal[:-1]) | (reverse[1:] != reverse[:-1]) | (ref[1:] != ref[:-1])]
        score, first = chained(np.cumsum(new), place, at, length + band, k, band, sc)
        order = np.lexsort((-score, first))
        head = order[np.r_[True, first[order][1:] != first[order][:-1]]]  # the best end of each begin
        begin, score = first[head], score[head]
        n = np.bincount(first, minlength=len(first))[begin]
        row = ordinal[begin]
        order = np.lexsort((reverse[begin], place[begin], ref[begin], -score, row))
        begin, score, n, row = begin[order], score[order], n[order], row[order]
        start = np.searchsorted(row, row)
        near = score >= NEAR * score[start]
        begin, score, n, row = begin[near], score[near], n[near], row[near]
        start, end = np.searchsorted(row, row), np.searchsorted(row, row, side="right")
        keep = np.arange(len(row)) - start < candidates
        columns = row[keep], reverse[begin][keep].astype(bool), ref[begin][keep], (place - at)[begin][keep], score[keep], n[keep], (end - start)[keep]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CHAIN.types, strict=True)], schema=_CHAIN)

    keys = ["ordinal", "reverse", "ref_index", "place", "at"]
    return found.repartition("ordinal").sortWithinPartitions(*keys).mapInArrow(work, _CHAIN_DDL)


@dataclass
class Aligned:
    """Alignments of reads: score, first and last base that is not clipped, place of the first in the window, and the operations from last to first (-1: none)."""

    score: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    ops: np.ndarray


def affine(reads: np.ndarray, windows: np.ndarray, band: int, sc: Scoring = Scoring()) -> Aligned:
    """The best alignment of each read (rows of bytes) in its window, which is longer by 2 * band, on the diagonals 0 to 2 * band.

    A row of all reads at once, with a state each for a match, an insertion and a deletion; deletions
    along a row are a running maximum. Zero bytes of a window are no bases. An alignment begins and
    ends with a match or mismatch. Of equals it prefers to clip less at the end, then the first
    diagonal; from the end on a match before an insertion, that before a deletion, that before a clip.
    """
    n, size = reads.shape
    width = 2 * band + 1
    m, ins, dele = (np.full((n, width), _NONE, np.int32) for _ in range(3))
    way, longer_ins, longer_del = np.zeros((size, n, width), np.int8), np.zeros((size, n, width), bool), np.zeros((size, n, width), bool)
    ramp = (np.arange(width) * sc.gap_extend).astype(np.int32)
    best, last, diagonal = np.full(n, _NONE, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    each = np.arange(n)
    for i in range(size):
        base, other = reads[:, i : i + 1], windows[:, i : i + width]
        points = np.where((base == other) & (base != 78), np.int32(sc.match), np.int32(-sc.mismatch))
        points[other == 0] = _NONE
        from_, kind = m, np.ones((n, width), np.int8)
        for k, state in ((2, ins), (3, dele)):
            kind[state > from_] = k
            from_ = np.maximum(from_, state)
        start = np.int32(0 if i == 0 else -sc.clip)
        kind[from_ < start] = 0
        new = np.maximum(np.maximum(from_, start) + points, _NONE)
        opened, gone_on = m[:, 1:] - (sc.gap_open + sc.gap_extend), ins[:, 1:] - sc.gap_extend
        longer_ins[i, :, :-1] = gone_on > opened
        ins = np.full((n, width), _NONE, np.int32)
        ins[:, :-1] = np.maximum(np.maximum(opened, gone_on), _NONE)
        run = np.maximum.accumulate(new + ramp, axis=1)
        dele = np.full((n, width), _NONE, np.int32)
        dele[:, 1:] = np.maximum(run[:, :-1] - ramp[1:] - sc.gap_open, _NONE)
        longer_del[i, :, 1:] = dele[:, :-1] - sc.gap_extend > new[:, :-1] - sc.gap_open - sc.gap_extend
        way[i], m = kind, new
        d = new.argmax(axis=1)
        end = new[each, d] - (0 if i == size - 1 else sc.clip)
        better = end >= best
        best, last, diagonal = np.where(better, end, best), np.where(better, i, last), np.where(better, d, diagonal)
    i, d, state, on = last.copy(), diagonal.copy(), np.zeros(n, np.int8), best > _NONE // 2
    first, place, columns = np.zeros(n, np.int64), np.zeros(n, np.int64), []
    while on.any():
        columns.append(np.where(on, state, -1).astype(np.int8))
        w, gi, gd = way[i, each, d], longer_ins[i, each, d], longer_del[i, each, d]
        is_m, is_i, is_d = on & (state == 0), on & (state == 1), on & (state == 2)
        first[is_m], place[is_m] = i[is_m], (i + d)[is_m]
        done = is_m & (w == 0)
        state = np.where(is_m, np.maximum(w - 1, 0), np.where(is_i, np.where(gi, 1, 0), np.where(is_d, np.where(gd, 2, 0), state))).astype(np.int8)
        i, d = i - (is_m & ~done) - is_i, d + is_i - is_d
        on &= ~done
    return Aligned(best, first, last, place, np.stack(columns, axis=1) if columns else np.full((n, 1), -1, np.int8))


def cigars(found: Aligned, size: int) -> list[str]:
    """The CIGARs of alignments; only those with gaps are put together from runs."""
    plain = (found.ops <= 0).all(axis=1)
    spans = (found.ops >= 0).sum(axis=1)
    out = []
    for k, (a, b) in enumerate(zip(found.first.tolist(), found.last.tolist(), strict=True)):
        if plain[k]:
            body = f"{spans[k]}M"
        else:
            ops = found.ops[k][found.ops[k] >= 0][::-1]
            edge = np.r_[np.flatnonzero(np.r_[True, ops[1:] != ops[:-1]]), len(ops)]
            body = "".join(f"{y - x}{_OPS[ops[x]]}" for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))
        out.append((f"{a}S" if a else "") + body + (f"{size - 1 - b}S" if b < size - 1 else ""))
    return out


_HIT = pa.schema([("ordinal", pa.int64()), ("reverse", pa.bool_()), ("ref_index", pa.int32()), ("name", pa.string()), ("position", pa.int64()), ("score", pa.int32()), ("cigar", pa.string()), ("length", pa.int32()), ("anchors", pa.int32()), ("chains", pa.int32())])
_HIT_DDL = "ordinal long, reverse boolean, ref_index int, name string, position long, score int, cigar string, length int, anchors int, chains int"


def verified(candidates: DataFrame, band: int = BAND, sc: Scoring = Scoring(), least: float = LEAST) -> DataFrame:
    """Alignments of candidates(ordinal, reverse, s, ref_index, name, begin, anchors, chains, lead, window) that reach the least score.

    window: the reference from begin - band on, without its first `lead` bases, which the contig does not have.
    A read that lies on its diagonal with no mismatch, or one that costs less than any gap or clip, needs no more.
    """
    cheap = sc.mismatch <= sc.clip and sc.match + sc.mismatch <= sc.gap_open + sc.gap_extend

    def work(batches):
        for rows in batches:
            ordinal, reverse, s, ref, name, begin, held, many, lead, window = (rows.column(c).to_pylist() for c in ("ordinal", "reverse", "s", "ref_index", "name", "begin", "anchors", "chains", "lead", "window"))
            sizes, out = np.array([len(x) for x in s]), []
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                for at in range(0, len(mine), 2048):
                    part = mine[at : at + 2048].tolist()
                    wide = size + 2 * band
                    reads = np.frombuffer("".join(s[k] for k in part).encode("ascii", "replace"), np.uint8).reshape(len(part), size)
                    around = np.frombuffer(b"".join((b"\0" * lead[k] + window[k].encode("ascii", "replace")).ljust(wide, b"\0")[:wide] for k in part), np.uint8).reshape(len(part), wide)
                    own = around[:, band : band + size]
                    wrong = ((reads != own) | (reads == 78)).sum(axis=1)
                    direct = (wrong <= cheap) & (own != 0).all(axis=1)
                    points = size * sc.match - wrong * (sc.match + sc.mismatch)
                    found = [(part[k], begin[part[k]], int(points[k]), f"{size}M") for k in np.flatnonzero(direct).tolist()]
                    rest = np.flatnonzero(~direct)
                    if len(rest):
                        a = affine(reads[rest], around[rest], band, sc)
                        found += [(part[r], begin[part[r]] - band + p, x, c) for r, p, x, c in zip(rest.tolist(), a.place.tolist(), a.score.tolist(), cigars(a, size), strict=True)]
                    out += [(ordinal[k], reverse[k], ref[k], name[k], p, x, c, size, held[k], many[k]) for k, p, x, c in found if x >= least * size * sc.match]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _HIT.types, strict=True)], schema=_HIT)

    return candidates.mapInArrow(work, _HIT_DDL)


def _hits(reads: DataFrame, found: DataFrame, made: Index, band: int, candidates: int, sc: Scoring, least: float) -> DataFrame:
    """Alignments of reads with these anchors."""
    best = chains(found, made.k, band, candidates, sc)
    joined = best.join(_sides_shuffled(reads.select("ordinal", "base")), "ordinal").withColumn("s", F.when(F.col("reverse"), reverse_complement(F.col("base"))).otherwise(F.col("base")))
    begin = F.col("begin") - band
    window = F.substring("sequence", (F.greatest(begin, F.lit(0)) - F.col("start") + 1).cast("int"), (F.length("s") + 2 * band + F.least(begin, F.lit(0))).cast("int"))
    placed = joined.withColumn("tile", F.floor(F.greatest("begin", F.lit(0)) / made.tile))
    windows = placed.join(_sides_shuffled(made.tiles.select("ref_index", "tile", "name", "start", "sequence")), ["ref_index", "tile"]).select("ordinal", "reverse", "s", "ref_index", "name", "begin", "anchors", "chains", F.greatest(-begin, F.lit(0)).alias("lead"), window.alias("window"))
    return verified(windows, band, sc, least)


def map_reads(reads: DataFrame, made: Index, band: int = BAND, candidates: int = CANDIDATES, sc: Scoring = Scoring(), min_length: int = MIN_LENGTH, most_n: int = MOST_N, least: float = LEAST) -> DataFrame:
    """Reads (ordinal, base, ...) with `aln`, `score` and `chains`: the place with the best score on either strand.

    Reads that are shorter than min_length or have more than most_n N, and those without a place, are
    unmapped as in `align.align`, with a null score; null reads too. Ties go to the first contig, place and
    strand. A read without ambiguity of a window of k-mers is always met by the index. chains: how many
    chains came near the best; the `candidates` best of them were aligned. The mapping quality
    follows from the points between the best score and the second (of another place; at least the
    least score): 6 for each, 60 at most, and 3 for ties and where more chains came near than were aligned.
    """
    usable = (F.length("base") >= min_length) & (F.length("base") - F.length(F.replace("base", F.lit("N"), F.lit(""))) <= most_n)
    able = reads.where(usable).select("ordinal", F.upper("base").alias("base"))
    longest = able.agg(F.max(F.length("base"))).first()[0] or 0
    if longest + 2 * band > made.overlap:
        raise ValueError(f"reads of {longest} bases need tiles that overlap by more than {made.overlap} bases")
    own = seeds(able, made.k, made.window)
    rare = _hits(able, anchors(own, made.places.where(~F.col("frequent")), made.k), made, band, candidates, sc, least)
    if made.frequent.isEmpty():
        hits = rare
    else:
        rare = staged(rare, "hits")  # asked twice
        best = rare.groupBy("ordinal").agg(F.max(F.struct("score", "anchors")).alias("best"))
        met = own.join(_sides_shuffled(made.frequent), "hash")
        left = met.withColumn("many", F.count("*").over(Window.partitionBy("ordinal"))).join(_sides_shuffled(best), "ordinal", "left")
        left = left.where("best is null").unionByName(left.where((F.col("best.score") < F.col("length") * sc.match) & (F.col("many") > F.col("best.anchors"))))
        rank = F.row_number().over(Window.partitionBy("ordinal").orderBy("n", "hash", "at"))
        rarest = left.withColumn("rank", rank).where(F.col("rank") <= RESCUE).select("ordinal", "length", "at", "hash", "reverse")
        hits = rare.unionByName(_hits(able, anchors(rarest, made.places.where("frequent"), made.k), made, band, candidates, sc, least))
    key = F.struct((-F.col("score")).alias("cost"), "ref_index", "position", "reverse", "name", "cigar", "length", "chains")
    per_read = hits.drop("anchors").distinct().groupBy("ordinal").agg(F.sort_array(F.collect_list(key)).alias("x"))  # `candidates` at most
    top = F.col("x")[0]
    elsewhere = F.filter("x", lambda y: (y["ref_index"] != top["ref_index"]) | (y["reverse"] != top["reverse"]) | (F.abs(y["position"] - top["position"]) >= top["length"]))
    score, second = -top["cost"], F.coalesce(-F.get(elsewhere, F.lit(0))["cost"], F.lit(0))
    floor_ = F.ceil(least * top["length"] * sc.match)
    quality = F.when((second == score) | (top["chains"] > candidates), TIED).otherwise(F.least(F.lit(MOST_QUALITY), PER_POINT * (score - F.greatest(second, floor_)) + TIED)).cast("int")
    chosen = per_read.select("ordinal", _aligned(top, quality).alias("aln"), score.alias("score"), top["chains"].alias("chains"))
    return reads.join(_sides_shuffled(chosen), "ordinal", "left").withColumn("aln", F.coalesce("aln", unmapped()))


def _aligned(top: Column, quality: Column) -> Column:
    place = lambda position, ref, contig: F.struct(position.cast("long").alias("position"), ref.cast("int").alias("ref_index"), contig.alias("contig"))
    nowhere = place(F.lit(-1), F.lit(-1), F.lit(""))
    return F.struct(F.when(top["reverse"], 16).otherwise(0).alias("flag"), quality.alias("mapping_quality"), place(top["position"], top["ref_index"], top["name"]).alias("position"), nowhere.alias("next_position"), F.lit(0).cast("long").alias("template_length"), top["cigar"].alias("cigar"))

