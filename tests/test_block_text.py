import gzip
import random

import pytest
from readloom.sources import bam, block_text, text
from readloom.sources.store import Store


def blocked(data, r, largest=400):
    """Blocks of many lengths, among them empty ones."""
    out, at = b"", 0
    while at < len(data):
        n = r.choice([0, 1, 7, largest])
        out += bam.block(data[at : at + n])
        at += n
    return out + bam.EOF_BLOCK


def of_splits(raw, split, tmp_path):
    (tmp_path / "x").mkdir(exist_ok=True)
    (tmp_path / "x" / "f.gz").write_bytes(raw)
    reader = block_text.BlockReader(Store(f"{tmp_path}/x"), None, split)
    return [[v for b in reader.read(p) for v in b.column("value").to_pylist()] for p in reader.partitions()]


@pytest.mark.parametrize("tail", ["\n", "", "\n\n\n"])
def test_each_line_comes_once(tmp_path, tail):
    r = random.Random(3)
    lines = ["".join(r.choices("ACGT\x1f\x8b", k=r.choice([0, 1, 5, 50, 3000]))) for _ in range(300)]
    data = ("\n".join(lines) + tail).encode()
    raw = blocked(data, r)
    want = data.decode().split("\n")
    want = want[:-1] if want[-1] == "" else want
    for split in (100, 333, 5000, 1 << 20):
        found = of_splits(raw, split, tmp_path)
        assert [v for part in found for v in part] == want
        assert sum(map(bool, found)) > 20 or split > 333


def test_stored_blocks_inside_data_are_no_blocks(tmp_path):
    """The bytes of a block, kept as they are inside another one, are not taken for one."""
    import struct
    import zlib

    inner = bam.block(b"inner\n")
    packer = zlib.compressobj(0, zlib.DEFLATED, -15)
    data = b"a\n" + inner + b"\nb\n"
    body = packer.compress(data) + packer.flush()
    outer = struct.pack("<4BI2BH2B2H", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<2I", zlib.crc32(data), len(data))
    assert inner in outer
    raw = outer + bam.block(b"c\n") * 3 + bam.EOF_BLOCK
    assert block_text.first_block(raw[1:], True) == len(outer) - 1


def test_fastq_of_blocks(spark, tmp_path):
    r = random.Random(5)
    want = [(f"r{k}", "".join(r.choices("ACGT", k=60)), "I" * 60) for k in range(2000)]
    for name, part in (("1.gz", want[:1500]), ("2.gz", want[1500:])):
        (tmp_path / name).write_bytes(blocked(("".join(f"@{m}\n{b}\n+\n{q}\n" for m, b, q in part) + "@cut\n").encode(), r, 5000))
    found = text.fastq(spark, str(tmp_path), blocks=True, split=3000)
    assert sorted(tuple(x) for x in found.collect()) == [(k, *w) for k, w in enumerate(want)]
    one = text.fastq(spark, f"{tmp_path}/2.gz", blocks=True, split=3000)
    assert sorted(tuple(x) for x in one.collect()) == [(k, *w) for k, w in enumerate(want[1500:])]
    assert sorted(tuple(x) for x in text.fastq(spark, f"{tmp_path}/2.gz").collect()) == sorted(tuple(x) for x in one.collect())  # by one task
    assert block_text.lines(spark, f"{tmp_path}/1.gz", 3000)[0].rdd.getNumPartitions() > 10


def test_written_blocks_are_gzip(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("concat('line ', id, ' é') AS value").repartition(1).sortWithinPartitions("value")
    assert block_text.write_lines(rows, f"{tmp_path}/out") == 20_000
    raw = (tmp_path / "out" / "part-00000.gz").read_bytes()
    want = sorted(f"line {k} é" for k in range(20_000))
    assert gzip.decompress(raw).decode().split("\n")[:-1] == want
    got = block_text.lines(spark, f"{tmp_path}/out", 20_000)[0].orderBy("line").collect()
    assert [x.value for x in got] == want


def test_what_is_not_in_blocks_fails(spark, tmp_path):
    (tmp_path / "x.gz").write_bytes(gzip.compress(random.Random(1).randbytes(900_000)))
    with pytest.raises(Exception, match="block"):
        block_text.lines(spark, f"{tmp_path}/x.gz", 300_000)[0].collect()
    raw = blocked(b"abc\n" * 5000, random.Random(2), 5000)
    (tmp_path / "y.gz").write_bytes(raw[:-40] + bytes(12) + raw[-28:])
    with pytest.raises(Exception, match="broken|block"):
        block_text.lines(spark, f"{tmp_path}/y.gz")[0].collect()
