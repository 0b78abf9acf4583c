"""Reads to places in a reference, by exact seeds and checked edits. Not equal to any aligner's scoring.

Contigs are cut into overlapping tiles, so no row holds a contig and no key stands for one:
seeds are made tile by tile and joined by their code, candidates meet the tile they lie in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import clamp_mapq, reverse_complement
from ..session import staged

SEED, MISMATCHES, MIN_LENGTH = 12, 2, 50
#: Bases of a tile without what it shares with its neighbours.
TILE = 16_384

_TILE = pa.schema([("ref_index", pa.int32()), ("name", pa.string()), ("length", pa.int64()), ("tile", pa.int64()), ("start", pa.int64()), ("sequence", pa.string())])
_PLACE = pa.schema([("seed", pa.int64()), ("ref_index", pa.int32()), ("place", pa.int64())])
_FOUND = pa.schema([("ordinal", pa.int64()), ("reverse", pa.bool_()), ("ref_index", pa.int32()), ("name", pa.string()), ("position", pa.int64()), ("n", pa.int32()), ("gapped", pa.bool_()), ("cigar", pa.string())])
_CODE = np.full(256, -1, np.int64)
_CODE[list(b"ACGT")] = np.arange(4)
MATCH, INSERT, DELETE = 0, 1, 2


def tiles(contigs: DataFrame, overlap: int, size: int = TILE) -> DataFrame:
    """ref_index, name, length, tile, start, sequence: tile k has the bases from k * size on, and `overlap` more at each side."""

    def cut(batches):
        for rows in batches:
            for index, name, sequence in zip(*(rows.column(c).to_pylist() for c in ("ref_index", "name", "sequence")), strict=True):
                for k in range(-(-len(sequence) // size)):
                    start = max(0, k * size - overlap)
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((index, name, len(sequence), k, start, sequence[start : (k + 1) * size + overlap]), _TILE.types, strict=True)], schema=_TILE)

    return contigs.select("ref_index", "name", "sequence").mapInArrow(cut, "ref_index int, name string, length long, tile long, start long, sequence string").repartition("ref_index", "tile")


def seed_code(seed: Column) -> Column:
    """A number for a seed of A, C, G and T; null for others."""
    return F.when(seed.rlike("^[ACGT]+$"), F.conv(F.translate(seed, "ACGT", "0123"), 4, 10).cast("long"))


def seed_places(cut: DataFrame, seed: int = SEED, size: int = TILE, max_hits: int | None = None) -> DataFrame:
    """seed, ref_index, place of the seeds of tiles that have `max_hits` places at most (None: all)."""

    def places(batches):
        for rows in batches:
            for index, tile, start, sequence in zip(*(rows.column(c).to_pylist() for c in ("ref_index", "tile", "start", "sequence")), strict=True):
                code = _CODE[np.frombuffer(sequence.encode("ascii", "replace"), np.uint8)[tile * size - start : (tile + 1) * size - start + seed - 1]]
                if len(code) < seed:
                    continue
                windows = np.lib.stride_tricks.sliding_window_view(code, seed)
                good = np.flatnonzero((windows >= 0).all(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(windows[good] @ (4 ** np.arange(seed - 1, -1, -1))), pa.array(np.full(len(good), index, np.int32)), pa.array(good + tile * size)], schema=_PLACE)

    found = cut.mapInArrow(places, "seed long, ref_index int, place long")
    if max_hits is None:
        return found
    frequent = found.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") > max_hits).select("seed")
    return found.join(frequent, "seed", "left_anti")


def gapped(reads: np.ndarray, windows: np.ndarray, edits: int) -> tuple[np.ndarray, list[list[tuple[int, int]]], np.ndarray]:
    """Fewest edits of each read (rows of bytes) against its window, which is longer by 2 * edits; operations; where it begins in the window.

    A band of diagonals, of all reads at once; begin and end in the window are free. Of equals a
    match is taken before an insertion, that before a deletion, and the earliest diagonal.
    """
    n, size = reads.shape
    width = 2 * edits + 1
    cost = np.zeros((n, width), np.int32)
    ways = np.zeros((size, n, width), np.int8)
    for i in range(size):
        step = cost + (reads[:, i : i + 1] != windows[:, i : i + width])
        way = np.zeros((n, width), np.int8)
        better = cost[:, 1:] + 1 < step[:, :-1]  # the read's base is inserted
        way[:, :-1][better], step[:, :-1][better] = INSERT, (cost[:, 1:] + 1)[better]
        for d in range(1, width):  # the window's base is deleted
            better = step[:, d - 1] + 1 < step[:, d]
            way[better, d], step[better, d] = DELETE, step[better, d - 1] + 1
        cost, ways[i] = step, way
    end = cost.argmin(axis=1)
    best, found, begin = cost[np.arange(n), end], [], np.zeros(n, np.int64)
    for k in range(n):
        i, d, ops = size - 1, int(end[k]), []
        while best[k] <= edits and i >= 0:
            way = int(ways[i, k, d])
            if ops and ops[-1][0] == way:
                ops[-1] = (way, ops[-1][1] + 1)
            else:
                ops.append((way, 1))
            i, d = (i - 1, d) if way == MATCH else (i - 1, d + 1) if way == INSERT else (i, d - 1)
        found.append(ops[::-1])
        begin[k] = d
    return best, found, begin


def clipped(ops: list[tuple[int, int]], position: int) -> tuple[str, int]:
    """The CIGAR of an alignment, and its place: bases before the contig's begin are soft-clipped, and so is a leading insertion."""
    clip, ops = 0, list(ops)
    while ops and (position < 0 or ops[0][0] != MATCH):
        op, n = ops.pop(0)
        take = n if op != MATCH else min(n, -position)
        clip += take if op != DELETE else 0
        position += take if op != INSERT else 0
        if op == MATCH and n > take:
            ops.insert(0, (op, n - take))
    return (f"{clip}S" if clip else "") + "".join(f"{n}{'MID'[op]}" for op, n in ops), position


def checked(candidates: DataFrame, mismatches: int, gaps: bool) -> DataFrame:
    """Candidates (ordinal, reverse, s, ref_index, name, length, position, lead, window) within so many edits.

    window: the reference from position - mismatches on, without its first `lead` bases, which the contig does not have.
    Compared base by base first; what fails, with gaps. Bases beyond a contig count as edits;
    an alignment that goes beyond the end is given up.
    """
    ddl = "ordinal long, reverse boolean, ref_index int, name string, position long, n int, gapped boolean, cigar string"

    def work(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            ordinal, reverse, s, index, name, length, position, lead, window = (rows.column(c).to_pylist() for c in ("ordinal", "reverse", "s", "ref_index", "name", "length", "position", "lead", "window"))
            sizes, out = np.array([len(x) for x in s]), []
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                for at in range(0, len(mine), 4096):
                    part = mine[at : at + 4096]
                    wide = size + 2 * mismatches
                    reads = np.frombuffer("".join(s[k] for k in part).encode("ascii", "replace"), np.uint8).reshape(len(part), size)
                    around = np.frombuffer(b"".join((b"\0" * lead[k] + window[k].encode("ascii", "replace")).ljust(wide, b"\0") for k in part), np.uint8).reshape(len(part), wide)
                    n = (reads != around[:, mismatches : mismatches + size]).sum(axis=1)
                    ok = np.flatnonzero(n <= mismatches)
                    found = [(part[k], int(n[k]), False, [(MATCH, size)], position[part[k]]) for k in ok.tolist()]
                    rest = np.flatnonzero(n > mismatches)
                    if gaps and len(rest):
                        best, ops, begin = gapped(reads[rest], around[rest], mismatches)
                        found += [(part[r], int(b), any(op != MATCH for op, _ in o), o, position[part[r]] - mismatches + int(d)) for r, b, o, d in zip(rest.tolist(), best, ops, begin, strict=True) if b <= mismatches]
                    for k, edits, with_gaps, o, place in found:
                        text, place = clipped(o, place)
                        span = sum(int(m) for op, m in o if op != INSERT)
                        if "M" in text and place + span <= length[k] + max(0, -position[k]):
                            out.append((ordinal[k], reverse[k], index[k], name[k], place, edits, with_gaps, text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _FOUND.types, strict=True)], schema=_FOUND)

    return candidates.mapInArrow(work, ddl)


_KEY = pa.schema([("ordinal", pa.int64()), ("s", pa.string()), ("at", pa.int32()), ("hash", pa.int64()), ("turned", pa.bool_())])
_WORD = pa.schema([("hash", pa.int64()), ("ref_index", pa.int32()), ("place", pa.int64()), ("reverse", pa.bool_())])
#: Bases of a window whose least word is looked up to find a read as it is, and the least length of such a word, if reads are that long.
WHOLE, WORD = 32, 15


def whole(reads: DataFrame, cut: DataFrame, shortest: int, size: int = TILE) -> DataFrame:
    """ordinal, reverse, ref_index, name, position: all places at which reads (ordinal, base; of A, C, G and T, at least `shortest` bases) stand in tiles as they are.

    Of the words of a read's first window the one with the least hash is looked up among the words of the contigs that are least in some window: these
    are few and long, so little is found that isn't such a place, in references of any size. Equal to its place's, the read has the same least word.
    """
    from .mapping import minimizers

    window = min(shortest, WHOLE)
    k = max(min(window, WORD), window - WHOLE // 2 + 1)
    k -= k % 2 == 0  # a word that is its own reverse complement would have no strand

    def keys(batches):
        for rows in batches:
            texts = [t[:window].encode() for t in rows.column("base").to_pylist()]
            at, h, reverse = minimizers(b"\n".join(texts), k, window - k + 1)
            row, first = np.unique(at // (window + 1), return_index=True)
            columns = at[first] % (window + 1), h[first], reverse[first]
            yield pa.RecordBatch.from_arrays([*(rows.column(c).take(pa.array(row)) for c in ("ordinal", "base")), *(pa.array(c, t) for c, t in zip(columns, _KEY.types[2:], strict=True))], schema=_KEY)

    def words(batches):
        for rows in batches:
            for index, number, start, sequence in zip(*(rows.column(c).to_pylist() for c in ("ref_index", "tile", "start", "sequence")), strict=True):
                at, h, reverse = minimizers(sequence.encode("ascii", "replace"), k, window - k + 1)
                at = at + start
                own = (at >= number * size) & (at < (number + 1) * size)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((h[own], np.full(int(own.sum()), index), at[own], reverse[own]), _WORD.types, strict=True)], schema=_WORD)

    asked = reads.select("ordinal", F.col("base").cast("string").alias("base")).mapInArrow(keys, "ordinal long, s string, at int, hash long, turned boolean")
    met = asked.join(cut.mapInArrow(words, "hash long, ref_index int, place long, reverse boolean").hint("merge"), "hash")
    reverse = F.col("reverse") != F.col("turned")
    begin = F.col("place") - F.when(reverse, F.length("s") - k - F.col("at")).otherwise(F.col("at"))
    placed = met.select("ordinal", F.when(reverse, reverse_complement(F.col("s"))).otherwise(F.col("s")).alias("s"), reverse.alias("reverse"), "ref_index", begin.alias("position")).where("position >= 0")
    same = F.substring("sequence", (F.col("position") - F.col("start") + 1).cast("int"), F.length("s")) == F.col("s")
    placed = placed.withColumn("tile", F.floor(F.col("position") / size))
    return placed.join(cut.select("ref_index", "tile", "name", "start", "sequence").hint("merge"), ["ref_index", "tile"]).where(same).select("ordinal", "reverse", "ref_index", "name", "position")


def _searched(able: DataFrame, cut: DataFrame, seed: int, mismatches: int, gaps: bool, max_hits: int | None, tile: int) -> DataFrame:
    """The alignments of reads within so many edits, by the places of their seeds."""
    strands = able.select("ordinal", F.explode(F.array(F.struct(F.lit(False).alias("reverse"), F.col("base").alias("s")), F.struct(F.lit(True).alias("reverse"), reverse_complement(F.col("base")).alias("s")))).alias("x")).select("ordinal", "x.*")
    tries = F.sequence(F.lit(0), F.least(F.lit(mismatches), F.floor(F.length("s") / seed).cast("int") - 1))
    seeds = strands.select("ordinal", "reverse", "s", F.explode(tries).alias("k")).select("*", seed_code(F.substring("s", F.col("k") * seed + 1, F.lit(seed))).alias("seed")).where("seed is not null")
    met = seeds.join(seed_places(cut, seed, tile, max_hits).hint("merge"), "seed").select("ordinal", "reverse", "s", "ref_index", (F.col("place") - F.col("k") * seed).alias("position")).distinct()
    met = met.withColumn("tile", F.floor(F.greatest("position", F.lit(0)) / tile))
    begin = F.col("position") - mismatches
    window = F.substring("sequence", (F.greatest(begin, F.lit(0)) - F.col("start") + 1).cast("int"), (F.length("s") + 2 * mismatches + F.least(begin, F.lit(0))).cast("int"))
    candidates = met.join(cut.hint("merge"), ["ref_index", "tile"]).select("ordinal", "reverse", "s", "ref_index", "name", "length", "position", F.greatest(-begin, F.lit(0)).alias("lead"), window.alias("window"))
    return checked(candidates, mismatches, gaps).distinct()  # neighbouring candidates may give one alignment


def align(reads: DataFrame, contigs: DataFrame, seed: int = SEED, mismatches: int = MISMATCHES, min_length: int = MIN_LENGTH, gaps: bool = True, max_hits: int | None = None, tile: int = TILE) -> DataFrame:
    """Reads (ordinal, base, ...) with `aln`: the place with the fewest edits, of either strand.

    A read with up to `mismatches` edits (differing, inserted or, with `gaps`, missing bases)
    has an exact seed among its first mismatches + 1, if it is long enough for them (max_hits: and if
    the seed has no more places). For genomes whose seeds stand in many places there is `mapping`. Reads that are shorter than min_length or have more N than `mismatches`
    are unmapped, as are reads without a place: contig '*', ref_index -1, position 0, flag 4.
    Ties go to alignments without gaps, then to the first contig and place. Reads that stand in a contig as they are
    have no better place, so they are looked up first, by longer words, and the others by their seeds.
    """
    usable = (F.length("base") >= max(min_length, seed)) & (F.length("base") - F.length(F.replace("base", F.lit("N"), F.lit(""))) <= mismatches)
    able = reads.where(usable).select("ordinal", "base")
    shortest, longest = (n or 0 for n in able.agg(F.min(F.length("base")), F.max(F.length("base"))).first())
    cut = tiles(contigs, longest + 2 * mismatches + 1, tile)
    if max_hits is None and longest:
        asked = able.where(F.col("base").rlike("^[ACGT]+$"))
        first = staged(able.join(whole(asked, cut, shortest, tile).hint("merge"), "ordinal", "left"), "whole")  # asked twice
        as_is = first.where("position is not null").select("ordinal", "reverse", "ref_index", "name", "position", F.lit(0).alias("n"), F.lit(False).alias("gapped"), F.concat(F.length("base").cast("string"), F.lit("M")).alias("cigar")).distinct()
        rest = first.where("position is null").select("ordinal", "base")
        found = as_is if rest.isEmpty() else as_is.unionByName(_searched(rest, cut, seed, mismatches, gaps, max_hits, tile))
    else:
        found = _searched(able, cut, seed, mismatches, gaps, max_hits, tile)
    alike = found.groupBy("ordinal", "n").agg(F.count("*").alias("ties"), F.min(F.struct("gapped", "ref_index", "position", "reverse", "name", "cigar")).alias("x"))
    best = alike.groupBy("ordinal").agg(F.min(F.struct("n", "x", "ties")).alias("y")).select("ordinal", "y.n", "y.ties", "y.x.*")
    place = lambda position, index, contig: F.struct(position.cast("long").alias("position"), index.cast("int").alias("ref_index"), contig.alias("contig"))
    nowhere = place(F.lit(-1), F.lit(-1), F.lit(""))
    quality = clamp_mapq(F.when(F.col("ties") > 1, 3).otherwise(60 - 10 * F.col("n")), F.lit(True))
    chosen = best.select("ordinal", F.struct(F.when(F.col("reverse"), 16).otherwise(0).alias("flag"), quality.alias("mapping_quality"), place(F.col("position"), F.col("ref_index"), F.col("name")).alias("position"), nowhere.alias("next_position"), F.lit(0).cast("long").alias("template_length"), F.col("cigar")).alias("aln"))
    return reads.join(chosen.hint("merge"), "ordinal", "left").withColumn("aln", F.coalesce("aln", unmapped()))


def unmapped() -> Column:
    """The alignment of a read without a place."""
    place = lambda position, contig: F.struct(F.lit(position).cast("long").alias("position"), F.lit(-1).alias("ref_index"), F.lit(contig).alias("contig"))
    return F.struct(F.lit(4).alias("flag"), F.lit(0).alias("mapping_quality"), place(0, "*").alias("position"), place(-1, "").alias("next_position"), F.lit(0).cast("long").alias("template_length"), F.lit("").alias("cigar"))
