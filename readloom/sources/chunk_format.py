"""The chunked column format: chunk files, packed bases and alignment messages."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

# Fixed values of the format.
HEADER = struct.Struct("<BBBBHHQQ32s")
UNCOMPRESSED, BZIP2, GZIP = 0, 1, 2
TEXT, STRUCTURED, COMPACTED_BASES = 0, 1, 2
BASES, END, PER_WORD = "ACTGN", 7, 21


class FormatError(ValueError):
    pass


@dataclass
class Chunk:
    first: int
    last: int
    name: str
    kind: int
    records: list[bytes]


def pack(bases: str, lenient: bool = False) -> bytes:
    """Words of 21 three-bit bases, closed by END."""
    text = bases.upper().replace("\n", "")
    codes = np.array([BASES.find(c) for c in text] + [END], np.int64)
    if lenient:
        codes[codes < 0] = BASES.index("N")
    if (codes < 0).any():
        raise FormatError(f"not a base: {text[int(np.flatnonzero(codes < 0)[0])]!r}")
    words = np.zeros((len(text) // PER_WORD + 1, PER_WORD), np.uint64)
    words.ravel()[: len(codes)] = codes
    return (words << (3 * np.arange(PER_WORD, dtype=np.uint64))).sum(axis=1, dtype=np.uint64).astype("<u8").tobytes()


def unpack(raw: bytes) -> str:
    """The bases of packed words; unused codes and a missing END fail."""
    codes = (np.frombuffer(raw, "<u8")[:, None] >> (3 * np.arange(PER_WORD, dtype=np.uint64)) & np.uint64(7)).ravel()
    end = np.flatnonzero(codes == END)
    if not len(end):
        raise FormatError("packed bases without an end")
    codes = codes[: end[0]]
    if (codes >= len(BASES)).any():
        raise FormatError("packed bases with an unused code")
    return np.frombuffer(BASES.encode(), np.uint8)[codes.astype(np.int64)].tobytes().decode()


def encode(records: list[bytes], name: str, first: int, kind: int = TEXT, compression: int = GZIP) -> bytes:
    """A chunk file: header, then the lengths of the records and the records themselves."""
    return encode_body(np.array([len(r) for r in records], np.int64), b"".join(records), name, first, kind, compression)


def encode_body(lengths: np.ndarray, data: bytes, name: str, first: int, kind: int = TEXT, compression: int = GZIP) -> bytes:
    """A chunk file of records that lie one after the other."""
    body = lengths.astype("<u4").tobytes() + data
    if compression == GZIP:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        body = packer.compress(body) + packer.flush()
    elif compression != UNCOMPRESSED:
        raise FormatError("only gzip and no compression are written")
    return HEADER.pack(0, 1, kind, compression, HEADER.size, 0, first, first + len(lengths), name.encode()[:32]) + body


@dataclass
class Body:
    """A chunk file whose records are still in place: record i is data[begins[i] : ends[i]]."""

    first: int
    last: int
    name: str
    kind: int
    data: bytes
    begins: np.ndarray
    ends: np.ndarray

    def record(self, i: int) -> bytes:
        return self.data[self.begins[i] : self.ends[i]]

    def part(self, low: int, high: int) -> Body:
        """Records low to high (exclusive)."""
        return Body(self.first + low, self.first + high, self.name, self.kind, self.data, self.begins[low:high], self.ends[low:high])


def decode(raw: bytes, verify: bool = True) -> Chunk:
    """The records of a chunk file; packed bases are unpacked to text."""
    body = decode_body(raw, verify)
    return Chunk(body.first, body.last, body.name, body.kind, [body.data[a:b] for a, b in zip(body.begins.tolist(), body.ends.tolist(), strict=True)])


def decode_body(raw: bytes, verify: bool = True) -> Body:
    """A chunk file's records, not cut apart; packed bases are unpacked to text."""
    if len(raw) < HEADER.size:
        raise FormatError("a chunk file is shorter than its header")
    _, _, kind, compression, start, _, first, last, name = HEADER.unpack_from(raw)
    if kind not in (TEXT, STRUCTURED, COMPACTED_BASES):
        raise FormatError(f"unknown record type {kind}")
    if last < first:
        raise FormatError("a chunk ends before it begins")
    body = raw[start:]
    if compression == GZIP:
        try:
            body = zlib.decompress(body, 31)
        except zlib.error as e:
            raise FormatError(f"broken gzip data: {e}") from e
    elif compression != UNCOMPRESSED:
        raise FormatError(f"compression {compression} is not supported")
    n = last - first
    if len(body) < 4 * n:
        raise FormatError("a chunk is shorter than its index")
    ends = 4 * n + np.cumsum(np.frombuffer(body, "<u4", n).astype(np.int64))
    if verify and n and ends[-1] != len(body) or n and ends[-1] > len(body):
        raise FormatError("record lengths don't add up to the data")
    begins = np.concatenate([[4 * n], ends[:-1]]).astype(np.int64) if n else np.empty(0, np.int64)
    if kind == COMPACTED_BASES:
        records = [unpack(body[a:b]).encode() if a < b else b"" for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        body, ends = b"".join(records), np.cumsum([len(r) for r in records], dtype=np.int64)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if n else np.empty(0, np.int64)
    return Body(first, last, name.split(b"\0")[0].decode(), kind, body, begins, ends)


# Alignment messages (protocol buffers, proto3: what is absent is 0 or empty). Fixed field numbers.
_POSITION = ((1, "position", int), (2, "ref_index", int), (3, "contig", str))
_ALIGNMENT = ((1, "flag", int), (2, "mapping_quality", int), (3, "position", _POSITION), (4, "next_position", _POSITION), (5, "template_length", int), (6, "cigar", str))


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def encode_message(value: dict | None, fields=_ALIGNMENT) -> bytes:
    out = b""
    for number, name, kind in fields:
        x = (value or {}).get(name)
        if kind is int:
            out += _varint(number << 3) + _varint(x) if x else b""
        elif kind is str:
            out += _varint(number << 3 | 2) + _varint(len(x.encode())) + x.encode() if x else b""
        elif x is not None:
            inner = encode_message(x, kind)
            out += _varint(number << 3 | 2) + _varint(len(inner)) + inner
    return out


def decode_message(raw: bytes, fields=_ALIGNMENT) -> dict:
    known = {number: (name, kind) for number, name, kind in fields}
    out = {name: 0 if kind is int else "" if kind is str else decode_message(b"", kind) for _, name, kind in fields}
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            if at >= len(raw) or shift > 63:
                raise FormatError("a broken number in a message")
            b = raw[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(raw):
        tag = varint()
        name, kind = known.get(tag >> 3, (None, None))
        if tag & 7 == 0:
            n = varint() & ((1 << 64) - 1)
            if kind is int:
                out[name] = n - (1 << 64) if n >> 63 else n
        elif tag & 7 == 2:
            size = varint()
            part, at = raw[at : at + size], at + size
            if len(part) < size:
                raise FormatError("a message is cut off")
            if kind is str:
                out[name] = part.decode()
            elif kind not in (None, int):
                out[name] = decode_message(part, kind)
        elif tag & 7 in (1, 5):
            at += 8 if tag & 7 == 1 else 4
        else:
            raise FormatError("an unknown wire type in a message")
    return out
