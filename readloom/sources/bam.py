"""BAM export: records and compressed blocks are made by tasks, blocks are put together in order."""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cigar, sequence
from .messages import spread, strings

# Fixed values of the SAM/BAM specification.
NIBBLES = "=ACMGRSVTWYHKDBN"
EOF_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BLOCK = 60_000
#: A base's nibble as a hexadecimal digit (others: N), and a quality byte's score.
_DIGIT = b"".join(b"%x" % (NIBBLES.find(chr(b)) % 16) for b in range(256))
_SCORE = bytes((b - 33) % 256 for b in range(256))


def block(data: bytes) -> bytes:
    """A BGZF block of less than 64 KiB of data."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = len(body) + 26
    if size > 1 << 16:
        raise ValueError("a block is too large")
    return struct.pack("<4BI2BH2B2H", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, size - 1) + body + struct.pack("<2I", zlib.crc32(data), len(data))


def blocks(data: bytes) -> bytes:
    return b"".join(block(data[at : at + BLOCK]) for at in range(0, len(data), BLOCK))


def header(ref_genome: list[tuple[str, int]]) -> bytes:
    text = "@HD\tVN:1.4\tSO:unsorted\n" + "".join(f"@SQ\tSN:{name}\tLN:{size}\n" for name, size in ref_genome)
    out = b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(ref_genome))
    for name, size in ref_genome:
        out += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", size)
    return out


def record(r: dict) -> bytes:
    """A single record; `packed` makes those of a batch."""
    name = r["name"].encode()[:254] + b"\0"
    base = r["base"].upper().encode("ascii", "replace")
    packed = bytes.fromhex(base.translate(_DIGIT).decode() + "0" * (len(base) % 2))
    codes = r["codes"] or []
    if r["qual"] is not None and len(r["qual"]) != len(base):
        raise ValueError(f"bases and qualities of {r['name']} differ in length")
    scores = b"\xff" * len(base) if r["qual"] is None else r["qual"].encode("latin-1").translate(_SCORE)  # 0xff: none
    body = struct.pack("<iiBBHHHiiii", r["ref_index"], r["position"], len(name), r["mapping_quality"], r["bin"] & 0xFFFF, len(codes), r["flag"], len(base), r["next_index"], r["next_position"], r["template_length"])
    body += name + struct.pack(f"<{len(codes)}I", *codes) + packed + scores
    return struct.pack("<i", len(body)) + body


_FIXED = np.dtype([("size", "<i4"), ("ref_index", "<i4"), ("position", "<i4"), ("l_name", "u1"), ("mapping_quality", "u1"), ("bin", "<u2"), ("n_codes", "<u2"), ("flag", "<u2"), ("n", "<i4"), ("next_index", "<i4"), ("next_position", "<i4"), ("template_length", "<i4")])
_NIBBLE = np.array([NIBBLES.find(chr(b).upper()) % 16 for b in range(256)], np.uint8)
_LETTER = np.frombuffer(NIBBLES.encode(), np.uint8)


def _raw(column: pa.Array, encoding: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, one after the other, and the length of each; null is empty."""
    if not pc.all(pc.fill_null(pc.string_is_ascii(column), True)).as_py():
        column = pa.array([None if x is None else x.encode(encoding, "replace") for x in column.to_pylist()], pa.large_binary())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    return data[ends[0] : ends[-1]], np.diff(ends)


def packed(rows: pa.RecordBatch) -> bytes:
    """The records of `fields` rows, one after the other: all fixed parts at once, then all names, CIGARs, bases and scores, each put where its record has it."""
    n = rows.num_rows
    name, long_name = _raw(rows.column("name"), "utf-8")
    l_name = np.minimum(long_name, 254)
    base, size = _raw(rows.column("base"), "ascii")
    qual, scores = _raw(rows.column("qual"), "latin-1")
    has_qual = rows.column("qual").is_valid().to_numpy(zero_copy_only=False)
    if (wrong := np.flatnonzero(has_qual & (scores != size))).size:
        raise ValueError(f"bases and qualities of {rows.column('name')[int(wrong[0])]} differ in length")
    codes = rows.column("codes")
    n_codes = pc.fill_null(pc.list_value_length(codes), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    half = (size + 1) // 2
    whole = 36 + l_name + 1 + 4 * n_codes + half + size
    fixed = np.zeros(n, _FIXED)
    columns = {c: rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ref_index", "position", "mapping_quality", "flag", "next_index", "next_position", "template_length")}
    columns |= {"size": whole - 4, "l_name": l_name + 1, "bin": rows.column("bin").to_numpy(zero_copy_only=False).astype(np.int64) & 0xFFFF, "n_codes": n_codes, "n": size}
    for c, values in columns.items():
        limit = np.iinfo(_FIXED[c])
        if len(values) and (values.min() < limit.min or values.max() > limit.max):
            raise ValueError(f"a BAM record has no place for the {c} {values.max() if values.max() > limit.max else values.min()}")
        fixed[c] = values
    out = np.zeros(int(whole.sum()), np.uint8)
    at = np.cumsum(whole) - whole
    out[spread(at, np.full(n, 36))] = fixed.view(np.uint8)
    at = at + 36
    out[spread(at, l_name)] = name[spread(np.cumsum(long_name) - long_name, l_name)]
    at = at + l_name + 1
    out[spread(at, 4 * n_codes)] = codes.flatten().to_numpy(zero_copy_only=False).astype("<u4").view(np.uint8)
    at = at + 4 * n_codes
    nibble = _NIBBLE[base]
    if (size % 2).any():  # a record with an odd number of bases has a half byte more
        wide = np.zeros(int(2 * half.sum()), np.uint8)
        wide[spread(2 * (np.cumsum(half) - half), size)] = nibble
        nibble = wide
    out[spread(at, half)] = nibble[::2] << 4 | nibble[1::2]
    at = at + half
    score = qual - np.uint8(33)
    if not has_qual.all():
        score = np.full(int(size.sum()), 255, np.uint8)  # 0xff: none
        score[np.repeat(has_qual, size)] = qual - np.uint8(33)
    out[spread(at, size)] = score
    return out.tobytes()


_RECORD = pa.schema([("name", pa.string()), ("flag", pa.int32()), ("ref_index", pa.int32()), ("position", pa.int64()), ("mapping_quality", pa.int32()), ("bin", pa.int32()), ("cigar", pa.string()), ("next_index", pa.int32()), ("next_position", pa.int64()), ("template_length", pa.int64()), ("base", pa.string()), ("qual", pa.string())])
RECORD = "name string, flag int, ref_index int, position long, mapping_quality int, bin int, cigar string, next_index int, next_position long, template_length long, base string, qual string"


def unblocked(raw: bytes) -> bytes:
    """The data of BGZF blocks; a wrong checksum fails."""
    out, at = [], 0
    while at < len(raw):
        size = struct.unpack_from("<H", raw, at + 16)[0] + 1
        part = zlib.decompress(raw[at + 18 : at + size - 8], -15)
        if struct.unpack_from("<2I", raw, at + size - 8) != (zlib.crc32(part), len(part)):
            raise ValueError("a broken block")
        out.append(part)
        at += size
    return b"".join(out)


def records(data: bytes) -> pa.RecordBatch:
    """The records of unpacked BAM data without its header, as columns."""
    starts, at = [], 0
    while at < len(data):
        starts.append(at)
        at += int.from_bytes(data[at : at + 4], "little", signed=True) + 4
    raw, at = np.frombuffer(data, np.uint8), np.array(starts, np.int64)
    fixed = raw[spread(at, np.full(len(at), 36))].view(_FIXED)
    size, l_name, n_codes = (fixed[c].astype(np.int64) for c in ("n", "l_name", "n_codes"))
    name = at + 36
    code = name + l_name
    base = code + 4 * n_codes
    score = base + (size + 1) // 2
    known: dict[bytes, str] = {}

    def shown(part: bytes) -> str:
        if part not in known:
            known[part] = "".join(f"{c >> 4}{cigar.OPS[c & 15]}" for c in np.frombuffer(part, "<u4").tolist())
        return known[part]

    place, ends = spread(np.zeros(len(at), np.int64), size), np.cumsum(size)
    pair = raw[np.repeat(base, size) + place // 2]
    letters = _LETTER[np.where(place % 2 == 0, pair >> 4, pair & 15)]
    scores = raw[spread(score, size)]
    none = np.ones(len(at), bool)
    none[np.repeat(np.arange(len(at)), size)[scores != 255]] = False
    if (scores[~np.repeat(none, size)] >= 95).any():  # more than ASCII has letters for
        qual = pa.array([None if x and n else bytes((b + 33) % 256 for b in scores[e - n : e].tolist()).decode("latin-1") for x, n, e in zip(none.tolist(), size.tolist(), ends.tolist(), strict=True)], pa.string())
    else:
        qual = pc.if_else(pa.array(none & (size > 0)), pa.scalar(None, pa.string()), strings(np.where(scores == 255, 0, scores + np.uint8(33)).astype(np.uint8), ends - size, ends))
    cigars = pa.array([shown(data[a:b]) for a, b in zip(code.tolist(), base.tolist(), strict=True)], pa.string())
    numbers = {c: pa.array(fixed[c].astype(np.int64)).cast(t) for c, t in zip(_RECORD.names, _RECORD.types, strict=True) if c in _FIXED.names}
    columns = numbers | {"name": strings(raw, name, code - 1), "cigar": cigars, "base": strings(letters, ends - size, ends), "qual": qual}
    return pa.RecordBatch.from_arrays([columns[c] for c in _RECORD.names], schema=_RECORD)


def decoded(made: DataFrame) -> DataFrame:
    """The records of `parts`, read back."""

    def work(batches):
        for b in batches:
            for data in b.column("data").to_pylist():
                yield records(unblocked(data))

    return made.select("data").mapInArrow(work, RECORD)


def fields(rows: DataFrame) -> DataFrame:
    """What a record has, from rows(ordinal, base, qual, meta, aln); rows without alignment are left out.

    The bin of an unmapped read is that of its mate if that is mapped, else of (-1, 0).
    """
    a, p, m = F.col("aln"), F.col("aln.position"), F.col("aln.next_position")
    unmapped = a["flag"].bitwiseAND(4) != 0
    mate = (a["flag"].bitwiseAND(8) == 0) & (m["ref_index"] >= 0)
    begin = F.when(~unmapped, p["position"]).when(mate, m["position"]).otherwise(-1)
    end = F.when(~unmapped, p["position"] + cigar.reference_span(a["cigar"], F.length("base"))).when(mate, m["position"] + 1).otherwise(0)
    return rows.where("aln is not null").select("ordinal", sequence.read_name(F.col("meta")).alias("name"), "base", "qual", a["flag"].alias("flag"), a["mapping_quality"].alias("mapping_quality"), p["ref_index"].alias("ref_index"), F.when(p["ref_index"] < 0, -1).otherwise(p["position"]).alias("position"), m["ref_index"].alias("next_index"), m["position"].alias("next_position"), a["template_length"].alias("template_length"), cigar.bam_codes(a["cigar"]).alias("codes"), sequence.bam_bin(begin, end).alias("bin"))


def parts(rows: DataFrame) -> DataFrame:
    """ordinal (of the first record), data: runs of compressed blocks, by ordinal within and between partitions."""
    schema = pa.schema([("ordinal", pa.int64()), ("data", pa.binary())])

    def work(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                part = part.take(pa.array(range(part.num_rows)))  # lists of a slice keep their places
                yield pa.RecordBatch.from_arrays([part.column("ordinal").slice(0, 1), pa.array([blocks(packed(part))], pa.binary())], schema=schema)

    return fields(rows).orderBy("ordinal").mapInArrow(work, "ordinal long, data binary")


def write(rows: DataFrame, ref_genome: list[tuple[str, int]], path: str) -> None:
    """A BAM file on the driver's file system; one partition at a time passes through the driver."""
    with open(path, "wb") as f:
        f.write(blocks(header(ref_genome)))
        for r in parts(rows).toLocalIterator():
            f.write(r.data)
        f.write(EOF_BLOCK)


def write_parts(rows: DataFrame, ref_genome: list[tuple[str, int]], folder: str) -> int:
    """A new folder whose files, put together by name, are a BAM file; gives the number of bytes.

    Each task writes the blocks of its partition, so no record passes through the driver. The
    folder lies where all executors mount it; a task that is repeated writes the same file.
    """
    os.makedirs(folder)
    schema = pa.schema([("size", pa.int64())])

    def put(name: str, pieces) -> int:
        temporary = f"{folder}/.{name}.{os.getpid()}"
        with open(temporary, "wb") as f:
            size = sum(f.write(p) for p in pieces)
        os.replace(temporary, f"{folder}/{name}")
        return size

    def work(batches):
        from pyspark import TaskContext

        size = put(f"1-part-{TaskContext.get().partitionId():06d}", (p for b in batches for p in b.column("data").to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64())], schema=schema)

    size = put("0-header", [blocks(header(ref_genome))]) + put("2-end", [EOF_BLOCK])
    return size + (parts(rows).mapInArrow(work, "size long").agg(F.sum("size")).first()[0] or 0)
