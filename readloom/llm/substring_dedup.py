"""Repeated passages by relative Lempel-Ziv parsing against all blocks of the corpus.

Every block of documents is a reference, and every document is factored against all of them:
from left to right a factor begins at the first window of `window` words that the index
knows from another place, and takes in one window after the other as long as their places
there follow each other too. A factor is kept with its length and its place in the reference;
what is not in a factor is literal. A factor is a window long at least, so its words are a
duplicate span. The index gives one place for each window, its smallest (for that one itself
its largest), so a factor ends where another place takes over; the windows that straddle two
factors are looked up one by one.

The index is built of anchors: in each window the smallest hash of `GRAM` words, which equal
windows share at the same offset. Consecutive windows with one anchor form a run (14 on
average). A run that occurs twice as a whole lies inside a factor, and one entry of the
index stands for all its windows. Where an anchor recurs in different runs a factor begins or
ends, and only there single windows are entered.

What is shuffled is one row for each distinct run of a block, and each distinct window of the
runs at a factor's edge, aggregated before the shuffle; a passage that a third of all documents
share costs one row a block. Texts are shuffled twice, packed, in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NONSPACE, Words, batch, block_slices, block_texts, blocks, gram_places, grams, mixed, signed, span_hashes, staged

WINDOW, GRAM = 35, 8


class Runs:
    """The windows of some texts and the runs of windows that share an anchor."""

    def __init__(self, texts: list[bytes], window: int, gram: int):
        self.words = Words(texts, NONSPACE)
        self.h = self.words.hashes()
        self.places = gram_places(self.words.first, window)
        self.window = window
        if not len(self.places):
            self.anchor = self.run = np.empty(0, np.uint64)
            self.begin = self.stop = np.empty(0, np.int64)
            return
        g = grams(self.h, gram)
        width = window - gram + 1
        best, size = np.arange(len(g)), 1
        while size < width:  # the leftmost least gram of ever longer stretches
            step = min(size, width - size)
            left, right = best[:-step], best[step:]
            best, size = np.where(g[left] <= g[right], left, right), size + step
        chosen = best[self.places]
        new = np.flatnonzero(np.diff(chosen, prepend=-1))
        self.begin, self.stop = new, np.append(new[1:], len(chosen))  # windows, as indices of places
        first, last = self.places[self.begin], self.places[self.stop - 1]
        self.anchor = g[chosen[new]]
        self.run = mixed(span_hashes(self.h, first, last + window) + (chosen[new] - first).astype(np.uint64))

    def windows(self, runs: np.ndarray) -> np.ndarray:
        """All windows of some runs, as indices of places."""
        n = self.stop[runs] - self.begin[runs]
        return np.repeat(self.begin[runs], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)

    def hashes(self, windows: np.ndarray) -> np.ndarray:
        return span_hashes(self.h, self.places[windows], self.places[windows] + self.window)


def _find(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    """The index of each key among the sorted keys, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _column(rows: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    value = rows.column(name)[i].values
    return np.empty(0, np.int64) if value is None else value.to_numpy(zero_copy_only=False).astype(np.int64)


def _distinct(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, an index of each, how often it occurs, its smallest and its largest place (given ascending)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    stop = np.append(begin[1:], len(key))[: len(begin)]
    return key[begin], order[begin], stop - begin, place[order[begin]], place[order[stop - 1]]


class Factors:
    """A parse of some texts: `n` windows from word `start` on follow those from a block's `word` on."""

    def __init__(self, windows: np.ndarray, places: np.ndarray, first: np.ndarray, source: np.ndarray):
        order = np.argsort(windows)
        at, source = places[windows[order]], source[order]
        text = np.searchsorted(first, at, side="right")
        follows = (np.diff(at) == 1) & (np.diff(source) == 1) & (text[1:] == text[:-1])
        begin = np.flatnonzero(np.append(True, ~follows)) if len(at) else np.empty(0, np.int64)
        self.n = np.diff(np.append(begin, len(at)))
        self.start, self.block, self.word = at[begin], source[begin] >> WORD_BITS, source[begin] & ((1 << WORD_BITS) - 1)


#: What is known of a run: it occurs elsewhere; its windows take part in the look-up.
COPIED, LOOKED_UP = 1, 2

#: A place is a block_id and a word of the block, in one number.
WORD_BITS = 31

_SHARED = pa.schema([("anchor", pa.int64()), ("run", pa.int64()), ("n", pa.int32()), ("place", pa.int64()), ("last", pa.int64())])
_WINDOWS = pa.schema([("win", pa.int64()), ("n", pa.int32()), ("place", pa.int64()), ("last", pa.int64())])
_FACTOR = pa.struct([("start", pa.int64()), ("words", pa.int64()), ("source_block", pa.int64()), ("source_word", pa.int64())])
_KEPT = pa.schema([("block_id", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.large_binary()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("factors", pa.list_(_FACTOR))])


def _rows(schema: pa.Schema, block: int, keys: tuple, n: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    """Distinct keys of a block by their smallest place; their largest is null where they occur once."""
    order, base = np.argsort(first), block << WORD_BITS
    return batch(schema, *(signed(k[order]) for k in keys), n[order], first[order] + base, pa.array(last[order] + base, mask=n[order] == 1))


def _placed(rows: DataFrame, key: str) -> DataFrame:
    """How often a key occurs in all blocks, and its smallest and largest place."""
    return rows.groupBy(key).agg(F.sum("n").alias("total"), F.min("place").alias("low"), F.max(F.coalesce("last", "place")).alias("high"))


def _block(place: str) -> Column:
    return F.shiftright(place, WORD_BITS)


def _gathered(rows: DataFrame, key: str, *more: str) -> DataFrame:
    """The keys of each block with where its occurrences are copied from, as arrays in the order of the keys; at most as many as a block has words.

    Copied from the smallest place (source); for that one itself from the largest (other).
    """
    own = F.when(_block("low") == F.col("block_id"), F.col("high"))
    x = rows.groupBy("block_id").agg(F.sort_array(F.collect_list(F.struct(key, F.col("low").alias("source"), own.alias("other"), *more))).alias("x"))
    return x.select("block_id", F.col(f"x.{key}").alias(f"{key}s"), *[F.col(f"x.{c}").alias(f"{key}_{c}s") for c in ("source", "other", *more)])


def _taken(rows: pa.RecordBatch, key: str, i: int, found: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The places from which the occurrences at some places are copied; `found` are indices of the arrays."""
    source = _column(rows, f"{key}_sources", i)[found]
    own = source == place
    if own.any():
        other = rows.column(f"{key}_others")[i].values.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        source = np.where(own, other[found], source)
    return source


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """block_id, doc_id, n_words, n_removed, kept string, spans array<struct<start, end>>, factors of every row.

    Words lie between white space. Each word is removed that a window of `window` words
    covers whose words also start anywhere else, in the same row or in another; spans are
    the removed words, from start to end (exclusive). factors array<struct<start, words,
    source_block, source_word>> are the copied stretches of the parse: words of the row from
    `start` on that also stand in a block from a word on, counted from the block's first;
    those of neighbours overlap in the windows that straddle them. Null texts have no
    words; rows that are repeated are copies of each other; null doc_ids are kept as they are;
    an empty table gives none. A text of any length is parsed as a whole.
    """
    whole = blocks(docs, doc_id, text)

    def runs_of(batches):
        for rows in batches:
            for i in range(rows.num_rows):
                found, base = [], 0
                for _, part in block_slices(block_texts(rows, i)):  # one is held at a time
                    r = Runs(part, window, gram)
                    found.append((r.run, r.anchor, r.places[r.begin] + base))
                    base += len(r.h)
                run, anchor, place = map(np.concatenate, zip(*found, strict=True))
                run, at, n, first, last = _distinct(run, place)
                yield _rows(_SHARED, rows.column("block_id")[i].as_py(), (anchor[at], run), n, first, last)

    found = staged(whole.mapInArrow(runs_of, "anchor long, run long, n int, place long, last long"), "runs")
    anchors = found.groupBy("anchor").agg(F.sum("n").alias("total"), F.min("run").alias("lo"), F.max("run").alias("hi")).where("total > 1")
    met = staged(found.join(anchors.select("anchor", (F.col("lo") != F.col("hi")).alias("differ")), "anchor").drop("anchor"), "met")
    copied = F.col("total") > 1
    asked = F.col("differ") & (~copied | (_block("low") == F.col("block_id")))
    known = met.select(_block("place").alias("block_id"), "run", "differ").join(_placed(met, "run"), "run")
    known = known.withColumn("what", copied.cast("int") * COPIED + asked.cast("int") * LOOKED_UP).where("what > 0")
    known = staged(_gathered(known, "run", "what"), "known")

    def windows_of(batches):
        for rows in batches:
            for i in range(rows.num_rows):
                runs, whats = _column(rows, "runs", i), _column(rows, "run_whats", i)
                runs = runs[(whats & LOOKED_UP) > 0]
                fresh, out, base = np.ones(len(runs), bool), [], 0
                for _, part in block_slices(block_texts(rows, i)):
                    r = Runs(part, window, gram)
                    ours, firsts = np.unique(_find(signed(r.run), runs), return_index=True)
                    firsts = firsts[(ours >= 0) & fresh[ours]]
                    fresh[ours[ours >= 0]] = False
                    at = r.windows(np.sort(firsts))
                    out.append((r.hashes(at), r.places[at] + base))
                    base += len(r.h)
                win, _, n, first, last = _distinct(*map(np.concatenate, zip(*out, strict=True)))
                yield _rows(_WINDOWS, rows.column("block_id")[i].as_py(), (win,), n, first, last)

    asking = known.where(F.exists("run_whats", lambda x: x >= LOOKED_UP)).select("block_id", "runs", "run_whats")
    seen = staged(whole.join(asking, "block_id").mapInArrow(windows_of, "win long, n int, place long, last long"), "windows")
    again = _placed(seen, "win").where("total > 1")
    twice = _gathered(seen.select(_block("place").alias("block_id"), "win").join(again, "win"), "win")

    def kept_of(batches):
        for rows in batches:
            for i in range(rows.num_rows):
                block, runs, whats, wins = rows.column("block_id")[i].as_py(), *(_column(rows, c, i) for c in ("runs", "run_whats", "wins"))
                ids, base = rows.column("doc_ids")[i].as_py(), block << WORD_BITS
                for at, part in block_slices(block_texts(rows, i)):
                    r = Runs(part, window, gram)
                    place = _find(signed(r.run), runs)
                    what = np.where(place >= 0, whats[place] if len(whats) else 0, 0)
                    inside = np.flatnonzero(what & COPIED)
                    begin, windows = r.places[r.begin[inside]], r.windows(inside)
                    shift = np.repeat(_taken(rows, "run", i, place[inside], begin + base) - begin, r.stop[inside] - r.begin[inside])
                    edges = r.windows(np.flatnonzero(what == LOOKED_UP))
                    there = _find(signed(r.hashes(edges)), wins)
                    edges, there = edges[there >= 0], there[there >= 0]
                    source = [shift + r.places[windows], _taken(rows, "win", i, there, r.places[edges] + base)]
                    first = r.words.first
                    parse = Factors(np.concatenate([windows, edges]), r.places, first, np.concatenate(source))
                    size = parse.n + window - 1
                    edge = np.zeros(int(first[-1]) + 1, np.int64)
                    np.add.at(edge, parse.start, 1)
                    np.add.at(edge, parse.start + size, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    lead = np.searchsorted(parse.start, first)
                    kept, starts, ends, removed, factors = [], [], [], [], []
                    for k, t in enumerate(part):
                        mine = gone[first[k] : first[k + 1]]
                        words = t.split()
                        if n := int(mine.sum()):
                            words = [words[j] for j in np.flatnonzero(~mine)]
                        steps = np.flatnonzero(np.diff(mine.view(np.int8), prepend=np.int8(0), append=np.int8(0))) if n else np.empty(0, np.int64)
                        own = slice(lead[k], lead[k + 1])
                        kept.append(b" ".join(words))
                        starts.append(steps[::2])
                        ends.append(steps[1::2])
                        removed.append(n)
                        factors.append([dict(zip(_FACTOR.names, x, strict=True)) for x in zip((parse.start[own] - first[k]).tolist(), size[own].tolist(), parse.block[own].tolist(), parse.word[own].tolist(), strict=True)] if n else [])
                    yield batch(_KEPT, np.full(len(part), block), ids[at : at + len(part)], r.words.counts, removed, kept, starts, ends, factors)
                    base += len(r.h)

    ddl = "block_id long, doc_id long, n_words long, n_removed long, kept binary, starts array<long>, ends array<long>, factors array<struct<start: long, words: long, source_block: long, source_word: long>>"
    out = whole.join(known, "block_id", "left").join(twice, "block_id", "left").mapInArrow(kept_of, ddl)
    return out.select("block_id", "doc_id", "n_words", "n_removed", F.decode("kept", "UTF-8").alias("kept"), F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")).alias("spans"), "factors")
