"""Packing of tokenised documents by minimum bin slack.

A document is cut every `CAPACITY` ids; full pieces are sequences of their own. What remains
is packed in groups of documents by length alone: the longest remaining length opens a
window, and a subset-sum table over the other remaining lengths, one bit for each sum,
finds the multiset that fills it closest to capacity. Walking the tables back gives how
often each length is used, and the pattern is repeated while the lengths last.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, slices, staged

CAPACITY, END_ID = 2048, 1
#: Documents that are packed together.
GROUP_DOCS = 20_000


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: White space of the splitting pattern, as ranges of characters.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space of more characters in a row is cut out and encoded by itself.
LONG_SPACE = 10_000
_RUN = re.compile(f"[{WHITE}]{{{LONG_SPACE},}}")


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}


class Encoder:
    """The tokenizer in a tokenizers JSON file of byte-level BPE, run by tiktoken, which gives the same ids at a quarter of the time.

    added: the file's added tokens are ids of their own where a text has them, as in tokenizers; else they are plain text.
    tiktoken's pattern fails on white space of some 600,000 characters in a row, so long white space is encoded without
    it, and whatever else it fails on goes to tokenizers itself.
    """

    def __init__(self, path: str, added: bool = True):
        import public_tokenizers
        import tiktoken

        self.path, self.added = path, added
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        byte = byte_values()
        special = {x["content"]: x["id"] for x in found["added_tokens"]}
        if added and any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] and found["normalizer"] for x in found["added_tokens"]):
            raise ValueError("added tokens that take more than their text")
        ranks = {bytes(byte[c] for c in t): i for t, i in found["model"]["vocab"].items() if t not in special}
        self.special = frozenset(special) if added else frozenset()
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special if added else {})

    @cached_property
    def plain(self):
        """The tokenizer as tokenizers loads it."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.encode_special_tokens = not self.added
        return out

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text."""
        if len(text) < LONG_SPACE or not (runs := [m.span() for m in _RUN.finditer(text)]):
            return self._ids(text)
        out, at = [], 0
        for a, b in runs:
            # the pattern leaves the last character to what follows, but not to the end or an added token
            b -= b < len(text) and not any(text.startswith(t, b) for t in self.special)
            out += [self._ids(text[at:a]), np.asarray(self.encoding._encode_single_piece(text[a:b]), "<u4")]
            at = b
        return np.concatenate([*out, self._ids(text[at:])])

    def _ids(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.encoding.encode_to_numpy(text, allowed_special=self.special, disallowed_special=()), "<u4")
        except ValueError:
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=4)
def encoder(path: str, added: bool = True) -> Encoder:
    return Encoder(path, added)


def fill(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Sequences as (times, lengths) that use each length n (below capacity) counts[n] times."""
    counts, out = counts.copy(), []
    lengths = [int(n) for n in np.flatnonzero(counts)[::-1]]
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        space = capacity - longest
        mask, reach, steps = (1 << (space + 1)) - 1, 1, []
        for n in lengths:
            if n > space:
                continue
            left, k = int(min(counts[n], space // n)), 1
            while left:  # n may be used up to `left` times: powers of two make all numbers
                k = min(k, left)
                steps.append((n, k, reach))
                reach |= reach << n * k & mask
                left, k = left - k, k * 2
            if reach >> space & 1:
                break
        total, used = reach.bit_length() - 1, {}
        for n, k, before in reversed(steps):
            if not before >> total & 1:
                used[n] = used.get(n, 0) + k
                total -= n * k
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(int(counts[n]) // k for n, k in used.items())
        for n, k in used.items():
            counts[n] -= times * k
        out.append((times, [n for n, k in sorted(used.items(), reverse=True) for _ in range(k)]))
        if any(not counts[n] for n in used):
            lengths = [n for n in lengths if counts[n]]
    return out


_DOC = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("doc_tokens", pa.int64()), ("crcs", pa.list_(pa.int64()))])
_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS, added: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: a row for each piece.

    Every row is a document of its own, even if doc_ids repeat or are null; a null or empty
    text is the end id alone, and an empty table gives no rows. Bytes that are no UTF-8 count as
    U+FFFD. added: the vocabulary's added tokens, such as <|endoftext|>, are found in the texts,
    which is what `add_special_tokens=False` leaves on; else they are plain text. Rows of one
    length are interchangeable: which of them fills a place follows from doc_id (none last), length
    and checksums. Only counts and checksums are staged and shuffled, no text or ids;
    groups are dealt by a hash of doc_id, checksums and row number, about `group_docs` rows
    each, so rows that are alike are spread too.
    """

    def cut(batches):
        from pyspark import TaskContext

        encode, row = encoder(vocabulary or vocabulary_file(), added), TaskContext.get().partitionId() << 40
        for rows, texts in slices(batches):
            sizes, crcs = [], []
            for t in texts:
                ids = np.append(encode.ids(t.decode("utf-8", "replace")), np.uint32(END_ID)).astype("<u4")
                sizes.append(len(ids))
                crcs.append([zlib.crc32(ids[at : at + capacity].tobytes()) for at in range(0, len(ids), capacity)])
            yield batch(_DOC, rows.column("doc_id"), row + np.arange(len(texts)), sizes, crcs)
            row += len(texts)

    def packed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, sizes, crcs = (table.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "crcs"))
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, sizes[i], crcs[i]))
        sequence, out, by_length = key[0].as_py() << 32, [], [[] for _ in range(capacity)]
        for i in order:
            full, rest = divmod(sizes[i], capacity)
            for k in range(full):
                out.append((ids[i], k * capacity, capacity, crcs[i][k], sizes[i], sequence, 0))
                sequence += 1
            by_length[rest].append((ids[i], full * capacity, rest, crcs[i][-1], sizes[i]))
        by_length[0] = []
        for times, lengths in fill(np.array([len(x) for x in by_length]), capacity):
            for _ in range(times):
                at = 0
                for n in lengths:
                    out.append((*by_length[n].pop(), sequence, at))
                    at += n
                sequence += 1
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECE.types, strict=True)], schema=_PIECE)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sizes = staged(rows.mapInArrow(cut, "doc_id long, row long, doc_tokens long, crcs array<long>"), "sizes")  # fixes the row numbers
    groups = max(1, -(-sizes.count() // group_docs))
    dealt = sizes.withColumn("pack", F.pmod(F.xxhash64("doc_id", "crcs", "row"), F.lit(groups))).drop("row")
    return dealt.groupBy("pack").applyInArrow(packed, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
