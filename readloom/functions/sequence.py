"""Bases, qualities, names and alignment fields as column expressions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the chunk format: a base's code is its place here, END closes a sequence.
BASES, END_CODE, BASES_PER_WORD = "ACTGN", 7, 21


def reverse_complement(base: Column) -> Column:
    return F.reverse(F.translate(base, "ACGTN", "TGCAN"))


def phred(qual: Column) -> Column:
    """array<int>: quality scores from characters, '!' being 0."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def clamp_mapq(quality: Column, mapped: Column) -> Column:
    return F.when(mapped, F.least(F.greatest(quality, F.lit(0)), F.lit(70))).otherwise(0)


def read_name(meta: Column) -> Column:
    """What comes before the first space."""
    return F.substring_index(meta, " ", 1)


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two strings of one length; null if lengths differ."""
    places = F.when(F.length(a) > 0, F.sequence(F.lit(1), F.length(a))).otherwise(F.array().cast("array<int>"))
    return F.when(F.length(a) == F.length(b), F.aggregate(places, F.lit(0), lambda n, i: n + F.when(F.substring(a, i, 1) != F.substring(b, i, 1), 1).otherwise(0)))


_SHIFTS = 3 * np.arange(BASES_PER_WORD, dtype=np.uint64)
_LETTERS = np.frombuffer(BASES.encode(), np.uint8)
_CODES = np.zeros(256, np.uint8)
_CODES[_LETTERS] = np.arange(len(BASES))


def _runs(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(begins - before, lengths) + np.arange(int(lengths.sum()))


def _begins(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _packed(bases: pa.Array) -> pa.Array:
    """Words of texts that have letters of BASES only, a batch at once."""
    there = np.asarray(bases.is_valid())
    ends = np.frombuffer(bases.buffers()[1], np.int64 if pa.types.is_large_string(bases.type) else np.int32)[bases.offset : bases.offset + len(bases) + 1].astype(np.int64)
    lengths, data = np.where(there, np.diff(ends), 0), np.frombuffer(bases.buffers()[2] or b"", np.uint8)
    first = _begins(np.where(there, lengths // BASES_PER_WORD + 1, 0))
    codes, cell = np.zeros(first[-1] * BASES_PER_WORD, np.uint8), first[:-1] * BASES_PER_WORD
    codes[_runs(cell, lengths)] = _CODES[data[_runs(ends[:-1], lengths)]]
    codes[(cell + lengths)[there]] = END_CODE
    words = (codes.reshape(-1, BASES_PER_WORD).astype(np.uint64) << _SHIFTS).sum(axis=1, dtype=np.uint64).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(words), mask=pa.array(~there))


def _unpacked(words: pa.Array) -> pa.Array:
    """The texts of packed words, a batch at once."""
    if words.values.null_count:
        words = pa.array([None if row is None else [w for w in row if w is not None] for row in words.to_pylist()], pa.list_(pa.int64()))
    there, ends = np.asarray(words.is_valid()), np.asarray(words.offsets).astype(np.int64)
    codes = (np.asarray(words.values).astype(np.uint64)[:, None] >> _SHIFTS & np.uint64(7)).astype(np.uint8).ravel()
    begin, limit = ends[:-1] * BASES_PER_WORD, ends[1:] * BASES_PER_WORD

    def first(found):
        """The first place of those found at or behind each begin."""
        at = np.flatnonzero(found)
        return np.append(at, len(codes))[np.searchsorted(at, begin)]

    end = first(codes == END_CODE)
    if (there & ((end >= limit) | (first((codes >= len(BASES)) & (codes != END_CODE)) < end))).any():
        raise ValueError("packed bases without an end or with an unused code")
    lengths = np.where(there, end - begin, 0)
    letters = np.append(_LETTERS, np.zeros(3, np.uint8))[codes[_runs(begin, lengths)]]
    return pa.Array.from_buffers(pa.string(), len(words), [pa.array(there).buffers()[1], pa.py_buffer(_begins(lengths).astype(np.int32)), pa.py_buffer(letters)])


def pack_bases(base: Column, lenient: bool = False) -> Column:
    """array<long>: 21 bases of three bits a word, closed by END; unknown letters fail, or are N if lenient.

    Case and line ends don't matter. A length that is a multiple of 21 has a word with END alone.
    """
    s, other = F.upper(F.replace(base, F.lit("\n"), F.lit(""))), f"[^{BASES}]"
    bad = F.raise_error(F.concat(F.lit("not a base: "), F.regexp_extract(s, other, 0))).cast("string")
    known = F.regexp_replace(s, other, "N") if lenient else F.when(s.rlike(other), bad).otherwise(s)
    return F.arrow_udf(_packed, T.ArrayType(T.LongType()))(known)


def unpack_bases(words: Column) -> Column:
    """The bases of packed words, up to END; a word without an end and unused codes fail."""
    return F.arrow_udf(_unpacked, T.StringType())(words)


def base_at(words: Column, place: Column) -> Column:
    """The base at a place (from 0) of packed words; null at END and beyond."""
    word = F.get(words, F.floor(place / BASES_PER_WORD).cast("int"))
    code = F.call_function("shiftright", word, (place % BASES_PER_WORD).cast("int") * 3).bitwiseAND(7)
    # END is the highest digit that is set in the last word
    length = (F.size(words) - 1) * BASES_PER_WORD + F.length(F.conv(F.element_at(words, -1).cast("string"), 10, 8)) - 1
    return F.when((place < length) & (code < len(BASES)), F.substring(F.lit(BASES), code.cast("int") + 1, 1))


def bam_bin(begin: Column, end: Column) -> Column:
    """The smallest BAM bin that holds [begin, end), by the formula of the SAM specification."""
    last, out = end - 1, F.lit(0)
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        out = F.when(F.shiftright(begin, shift) == F.shiftright(last, shift), F.lit(first) + F.shiftright(begin, shift)).otherwise(out)
    return out.cast("int")


def dataset_name(path: Column) -> Column:
    """The last part of a chunk path, without the ordinal behind the last underscore."""
    return F.regexp_extract(path, r"([^/]*?)(_\d+)?$", 1)


def path_base(path: Column) -> Column:
    """The folder of a path, with its slash; empty without one."""
    return F.regexp_extract(path, r"^(.*/)?", 1)


def base_codes(base: Column) -> Column:
    """A digit for each base: A, C, G, T are 0 to 3 in either case, - is 5, all else 4."""
    return F.regexp_replace(F.translate(F.upper(base), "ACGT-", "01235"), "[^01235]", "4")
