import random
import struct
import time

import pyarrow as pa
import pytest
from readloom.functions import cigar
from readloom.sources import bam

SCHEMA = pa.schema([*((c, pa.string()) for c in ("name", "base", "qual")), *((c, pa.int64()) for c in ("flag", "mapping_quality", "ref_index", "position", "next_index", "next_position", "template_length", "bin")), ("codes", pa.list_(pa.int64()))])


def made(r, n):
    out = []
    for k in range(n):
        size = r.choice([0, 1, 2, 31, 32, 101])
        codes = [r.randrange(1, 200) << 4 | r.randrange(9) for _ in range(r.randint(0, 4))]
        out.append({"name": r.choice(["r", "read é", "n" * 300, ""]) + str(k), "base": "".join(r.choices("ACGTNacgtRYx*", k=size)), "qual": r.choice([None, "".join(chr(r.randint(33, 126)) for _ in range(size))]), "flag": r.randrange(4096), "mapping_quality": r.randrange(256), "ref_index": r.randrange(-1, 30), "position": r.randrange(-1, 1 << 31), "next_index": -1, "next_position": r.randrange(-1, 900), "template_length": r.randrange(-500, 500), "bin": r.randrange(-1, 40000), "codes": r.choice([codes, None])})
    return out


def test_columns_write_what_the_loop_writes():
    rows = made(random.Random(1), 600) + [{**made(random.Random(2), 1)[0], "base": "Aé字", "qual": "\\"[:1] * 2 + "ÿ"}]
    for part in (rows, rows[:1], rows[7:9], []):
        assert bam.packed(pa.RecordBatch.from_pylist(part, SCHEMA)) == b"".join(map(bam.record, part))


def plain_records(data):
    """Records read one by one."""
    out, at = [], 0
    while at < len(data):
        size, ref, pos, l_name, quality, bin_, n_codes, flag, n, next_ref, next_pos, length = struct.unpack_from("<iiiBBHHHiiii", data, at)
        p = at + 36
        name, p = data[p : p + l_name - 1].decode(), p + l_name
        codes, p = struct.unpack_from(f"<{n_codes}I", data, p), p + 4 * n_codes
        base, p = "".join(bam.NIBBLES[int(d, 16)] for d in data[p : p + (n + 1) // 2].hex()[:n]), p + (n + 1) // 2
        scores = data[p : p + n]
        qual = None if scores == b"\xff" * n and n else bytes((b + 33) % 256 for b in scores).decode("latin-1")
        out.append((name, flag, ref, pos, quality, bin_, "".join(f"{c >> 4}{cigar.OPS[c & 15]}" for c in codes), next_ref, next_pos, length, base, qual))
        at += size + 4
    return out


@pytest.mark.parametrize("odd", [False, True])
def test_columns_read_what_the_loop_reads(odd):
    rows = [x for x in made(random.Random(3), 500) if len(x["name"].encode()) < 254]
    if odd:
        rows[3] |= {"base": "ACG", "qual": "aÿÀ"}
    data = b"".join(map(bam.record, rows))
    assert [tuple(x.values()) for x in bam.records(data).to_pylist()] == plain_records(data)
    assert bam.records(b"").num_rows == 0


def test_what_has_no_place_fails():
    row = made(random.Random(5), 1)[0] | {"base": "AC", "qual": "II"}
    for change, text in (({"position": 1 << 31}, "position 2147483648"), ({"mapping_quality": 256}, "mapping_quality 256"), ({"flag": -1}, "flag -1"), ({"qual": "I"}, "differ in length")):
        with pytest.raises(ValueError, match=text):
            bam.packed(pa.RecordBatch.from_pylist([row | change], SCHEMA))


def test_rate():
    r = random.Random(4)
    rows = [x | {"base": "ACGT" * 25, "qual": "I" * 100, "codes": [100 << 4]} for x in made(r, 1)] * 20_000
    batch = pa.RecordBatch.from_pylist(rows, SCHEMA)
    began = time.time()
    plain = b"".join(map(bam.record, batch.to_pylist()))
    loop, began = time.time() - began, time.time()
    assert bam.packed(batch) == plain
    columns = time.time() - began
    print(f"{loop:.2f} s by the loop, {columns:.2f} s by columns")
    assert columns < loop
