import gzip
import json
import random
import struct
import zlib

import pytest
from readloom.functions import sequence
from readloom.plans.queries import _with_aln
from readloom.plans.fixtures import Fixtures
from readloom.sources import bam, chunk_format, chunk_source, dump, text
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("ending", ["\n", "", "\r\n"])
@pytest.mark.parametrize("zipped", [False, True])
def test_fastq(spark, tmp_path, ending, zipped):
    records = [("r1 x", "ACGT", "@@I!"), ("r2", "NNA", "+++"), ("@r3", "", "")] + [(f"k{i}", "AC", "II") for i in range(500)]
    nl = "\r\n" if ending == "\r\n" else "\n"
    body = nl.join(f"@{m}{nl}{b}{nl}+{nl}{q}" for m, b, q in records) + ending + ("" if ending == "" else f"@cut{nl}AC{nl}")
    path = tmp_path / ("a.fq.gz" if zipped else "a.fq")
    path.write_bytes(gzip.compress(body.encode()) if zipped else body.encode())
    got = text.fastq(spark, str(path)).orderBy("ordinal").collect()
    assert [(r.ordinal, r.meta, r.base, r.qual) for r in got] == [(i, *r) for i, r in enumerate(records)]


def test_fastq_lengths_must_agree(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@a\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="differ in length"):
        text.fastq(spark, str(tmp_path / "a.fq")).collect()


def test_gtf(spark, tmp_path):
    rows = ["# head", 'c1\tsrc\texon\t5\t9\t.\t+\t0\tgene_id "G 1"; gene_name "N";', "", "# inside", 'c1\tsrc\tgene\t1\t90\t.\t-\t.\tgene_name "x"; gene_id "G2"', "c2\ts\texon\t7\t7\t.\t+\t.\tgene_id G3", 'c2\ts\texon\t7\t7\t.\t+\t.\tother "1"', 'c2\ts\texon\t3\t4\t.\t+\t.\tgene_id "G4"; gene_name "";']
    (tmp_path / "a.gtf").write_text("\n".join(rows))
    got = [tuple(r) for r in text.gtf(spark, str(tmp_path / "a.gtf")).orderBy("gene_id").collect()]
    assert got == [("c1", "src", "exon", 5, 9, ".", True, "0", "G 1", "N"), ("c1", "src", "gene", 1, 90, ".", False, ".", "G2", "x"), ("c2", "s", "exon", 7, 7, ".", True, ".", "G3", "G3"), ("c2", "s", "exon", 3, 4, ".", True, ".", "G4", "G4")]


def test_barcodes(spark, tmp_path):
    (tmp_path / "b.txt").write_text("Name\tB1\nT0A\tGTCAAG\nT0B\tATGTAA\n")
    rows, length = text.barcodes(spark, str(tmp_path / "b.txt"))
    assert length == 6 and sorted((r.name, r.b1) for r in rows.collect()) == [("T0A", "GTCAAG"), ("T0B", "ATGTAA")]
    (tmp_path / "d.txt").write_text("Name\tB1\nA\tGTC\nB\tATG\nC\tGTC\n\nD\tAAAA\n")
    rows, _ = text.barcodes(spark, str(tmp_path / "d.txt"))
    assert sorted((r.name, r.b1) for r in rows.collect()) == [("B", "ATG"), ("C", "GTC")]
    for bad in ("Name\tB2\nA\tAC\n", "Name\tB1\nA\tAC\nB\tACG\n", "Name\tB1\n"):
        (tmp_path / "c.txt").write_text(bad)
        with pytest.raises(ValueError):
            text.barcodes(spark, str(tmp_path / "c.txt"))


def test_lists_and_manifests(spark, tmp_path):
    text.write_dataset_list(spark, ["a/metadata.json", "b"], f"{tmp_path}/list")
    assert text.dataset_list(spark, f"{tmp_path}/list") == ["a/metadata.json", "b"]
    text.write_sample_index(spark.createDataFrame([("s", "p")], "name string, path string"), f"{tmp_path}/index")
    assert [tuple(r) for r in text.sample_index(spark, f"{tmp_path}/index").collect()] == [("s", "p")]
    (tmp_path / "m.json").write_text(json.dumps({"name": "d", "version": 1, "columns": ["base"], "records": [{"first": 5, "last": 7, "path": "d_5"}, {"first": 0, "last": 5, "path": "d_0"}]}))
    m = text.manifest(spark, f"{tmp_path}/m.json")
    assert [r.path for r in text.chunks(m).collect()] == ["d_0", "d_5"]
    twice = text.with_column(text.with_column(m, "aln", [("c", 9)]), "aln").first()
    assert twice["columns"] == ["base", "aln"] and twice.ref_genome[0].length == 9


@pytest.mark.parametrize("n", [0, 1, 20, 21, 22, 42, 100])
def test_packed_bases(spark, n):
    s = "".join(random.Random(n).choice("ACGTN") for _ in range(n))
    raw = chunk_format.pack(s.lower() + "\n")
    assert chunk_format.unpack(raw) == s and len(raw) == 8 * (n // 21 + 1)
    words = spark.createDataFrame([(s,)], "s string").select(sequence.pack_bases(F.col("s")).alias("w")).first().w
    assert struct.pack(f"<{len(words)}q", *words) == raw
    if n:
        assert spark.createDataFrame([(s,)], "s string").select(sequence.base_at(sequence.pack_bases(F.col("s")), F.lit(n - 1))).first()[0] == s[-1]


def test_bases_are_packed_and_unpacked_by_batches(spark):
    r = random.Random(4)
    rows = [(k, None if k % 7 == 3 else "".join(r.choices("ACGTN", k=r.choice([0, 1, 20, 21, 22, 42, r.randrange(300)])))) for k in range(500)]
    packed = spark.createDataFrame(rows, "k long, s string").repartition(3).withColumn("w", sequence.pack_bases(F.col("s")))
    back = packed.select("k", "w", sequence.unpack_bases(F.col("w")).alias("s"), sequence.unpack_bases(sequence.pack_bases(F.lower("s"))).alias("t"))
    got = back.orderBy("k").collect()
    assert [(x.k, x.s) for x in got] == rows and all(x.s == x.t for x in got)
    assert all((x.w is None) if x.s is None else struct.pack(f"<{len(x.w)}q", *x.w) == chunk_format.pack(x.s) for x in got)
    lines = back._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in lines  # no word is looked at by an expression of its own
    one = lambda *words: spark.createDataFrame([([0 | 7 << 3],), (None,), (list(words),)], "w array<long>").select(sequence.unpack_bases(F.col("w")).alias("s"))
    assert [x.s for x in one(0, None, 4 | 7 << 3).collect()] == ["A", None, "A" * 21 + "N"]
    for words in ((), (0,), (5 | 7 << 3,), (0, 6)):
        with pytest.raises(Exception, match="without an end or with an unused code"):
            one(*words).collect()


def test_bad_bases(spark):
    with pytest.raises(chunk_format.FormatError):
        chunk_format.pack("ACX")
    assert chunk_format.unpack(chunk_format.pack("ACX", lenient=True)) == "ACN"
    with pytest.raises(chunk_format.FormatError):
        chunk_format.unpack(struct.pack("<Q", 5))
    with pytest.raises(chunk_format.FormatError):
        chunk_format.unpack(struct.pack("<Q", 0))
    with pytest.raises(Exception, match="not a base"):
        spark.createDataFrame([("AX",)], "s string").select(sequence.pack_bases(F.col("s"))).collect()
    rows = spark.createDataFrame([("aX3\nT",), (None,)], "s string")
    found = [r.w for r in rows.select(sequence.pack_bases(F.col("s"), lenient=True).alias("w")).collect()]
    assert found == [[0 | 4 << 3 | 4 << 6 | 2 << 9 | 7 << 12], None]
    with pytest.raises(Exception, match="not a base"):
        spark.createDataFrame([("A3",)], "s string").select(sequence.pack_bases(F.col("s"))).collect()


def test_chunk_files():
    records = [b"ACGT", b"", b"x" * 1000]
    index = struct.pack("<3I", 4, 0, 1000)
    head = lambda kind, packed, n=3: struct.pack("<BBBBHHQQ32s", 0, 1, kind, packed, 56, 0, 7, 7 + n, b"name")
    plain = head(0, 0) + index + b"".join(records)
    assert chunk_format.encode(records, "name", 7, compression=chunk_format.UNCOMPRESSED) == plain
    assert chunk_format.decode(plain).records == records
    made = chunk_format.encode(records, "name", 7)
    assert zlib.decompress(made[56:], 31) == plain[56:]
    got = chunk_format.decode(made)
    assert (got.first, got.last, got.name, got.records) == (7, 10, "name", records)
    packed = [chunk_format.pack("ACG"), b"", chunk_format.pack("T" * 21)]
    body = struct.pack("<3I", *map(len, packed)) + b"".join(packed)
    assert chunk_format.decode(head(2, 0) + body).records == [b"ACG", b"", b"T" * 21]
    assert chunk_format.decode(head(1, 0, 0)).records == []
    for bad in (plain[:50], head(9, 0) + index, head(0, 1) + index, head(0, 2) + b"no gzip", plain[:-1], plain + b"x", head(0, 0)):
        with pytest.raises(chunk_format.FormatError):
            chunk_format.decode(bad)


def test_messages():
    place = {"position": -1, "ref_index": -1, "contig": "chr1"}
    m = {"flag": 16, "mapping_quality": 60, "position": {"position": 300, "ref_index": 0, "contig": "é"}, "next_position": place, "template_length": -(1 << 40), "cigar": "4M"}
    raw = chunk_format.encode_message(m)
    assert chunk_format.decode_message(raw) == m
    assert raw[:2] == b"\x08\x10" and b"\xff" * 9 + b"\x01" in raw  # field 1; a negative number has ten bytes
    assert chunk_format.decode_message(b"")["position"] == {"position": 0, "ref_index": 0, "contig": ""}
    assert chunk_format.decode_message(raw + b"\x7d\0\0\0\0")["cigar"] == "4M"  # unknown fields are passed over
    with pytest.raises(chunk_format.FormatError):
        chunk_format.decode_message(b"\x32\x09ab")


def test_dataset_source(spark, tmp_path):
    x, folder = Fixtures(spark, DATA), f"{tmp_path}/ds"
    rows = _with_aln(x)
    chunk_source.write(rows.select("ordinal", "base", "qual", "meta"), folder, "ds", 64)
    chunk_source.append_column(spark, folder, rows, "aln")
    want = {r.ordinal: r for r in rows.collect()}
    got = spark.read.format("readchunks").load(folder)
    assert {r.ordinal: r for r in got.select(*rows.columns).collect()} == want
    few = spark.read.format("readchunks").option("columns", "qual").load(folder).where("ordinal >= 100 and ordinal < 130")
    assert few.columns == ["ordinal", "qual"] and sorted(r.ordinal for r in few.collect()) == list(range(100, 130)) and few.rdd.getNumPartitions() == 2
    assert {r.ordinal: r for r in chunk_source.read_chunks(spark, folder, ["base", "qual", "meta", "aln"]).collect()} == want
    with pytest.raises(Exception, match="no column"):
        spark.read.format("readchunks").option("columns", "nope").load(folder).collect()
    with pytest.raises(Exception, match="holds a dataset"):
        chunk_source.write(rows.select("ordinal", "base"), folder, "ds", 64)
    with pytest.raises(ValueError):
        chunk_source.write(rows, folder, "ds", 0)
    assert [json.loads(r.value)["ordinal"] for r in dump.lines(got, 3, 3).collect()] == [3]


def test_bam(spark, tmp_path):
    rows = _with_aln(Fixtures(spark, DATA))
    bam.write(rows, [(f"chr{k}", 20000) for k in range(6)], f"{tmp_path}/a.bam")
    raw = (tmp_path / "a.bam").read_bytes()
    assert raw.endswith(bam.EOF_BLOCK)
    at, data = 0, b""
    while at < len(raw):  # every block by its own size
        size = struct.unpack_from("<H", raw, at + 16)[0] + 1
        part = zlib.decompress(raw[at + 18 : at + size - 8], -15)
        assert struct.unpack_from("<2I", raw, at + size - 8) == (zlib.crc32(part), len(part))
        data, at = data + part, at + size
    assert gzip.decompress(raw) == data and data[:4] == b"BAM\1"
    at = 8 + struct.unpack_from("<i", data, 4)[0]
    n, at = struct.unpack_from("<i", data, at)[0], at + 4
    names = []
    for _ in range(n):
        size = struct.unpack_from("<i", data, at)[0]
        names.append(data[at + 4 : at + 3 + size].decode())
        at += 8 + size
    assert names == [f"chr{k}" for k in range(6)]
    got = []
    while at < len(data):
        size = struct.unpack_from("<i", data, at)[0]
        ref, pos, l_name, mapq, bin_, n_cigar, flag, l_seq, *_ = struct.unpack_from("<iiBBHHHiiii", data, at + 4)
        p = at + 36
        name, p = data[p : p + l_name - 1].decode(), p + l_name
        codes, p = struct.unpack_from(f"<{n_cigar}I", data, p), p + 4 * n_cigar
        seq, p = "".join(bam.NIBBLES[b >> 4] + bam.NIBBLES[b & 15] for b in data[p : p + (l_seq + 1) // 2])[:l_seq], p + (l_seq + 1) // 2
        got.append((name, flag, ref, pos, mapq, "".join(f"{c >> 4}{'MIDNSHP=X'[c & 15]}" for c in codes), seq, "".join(chr(q + 33) for q in data[p : p + l_seq])))
        assert p + l_seq == at + 4 + size
        at += 4 + size
    want = [(r.meta.split(" ")[0], r.aln.flag, r.aln.position.ref_index, r.aln.position.position if r.aln.position.ref_index >= 0 else -1, r.aln.mapping_quality, r.aln.cigar, r.base, r.qual) for r in rows.orderBy("ordinal").collect() if r.aln]
    assert got == want


def test_bam_in_parts(spark, tmp_path):
    rows, contigs = _with_aln(Fixtures(spark, DATA)), [("chr0", 20000)]
    bam.write(rows, contigs, f"{tmp_path}/a.bam")
    size = bam.write_parts(rows, contigs, f"{tmp_path}/parts")
    files = sorted((tmp_path / "parts").iterdir())
    raw = b"".join(f.read_bytes() for f in files)
    assert len(raw) == size and raw.endswith(bam.EOF_BLOCK) and len(files) > 2
    assert gzip.decompress(raw) == gzip.decompress((tmp_path / "a.bam").read_bytes())
    with pytest.raises(FileExistsError):
        bam.write_parts(rows, contigs, f"{tmp_path}/parts")


def test_bam_bases_and_scores():
    read = {"name": "r", "base": "acgtnX", "qual": "!I~", "codes": None, "ref_index": 0, "position": 0, "mapping_quality": 0, "bin": 0, "flag": 0, "next_index": -1, "next_position": -1, "template_length": 0}
    with pytest.raises(ValueError, match="differ in length"):
        bam.record(read)
    assert bam.record(read | {"qual": "!I~!!!"}).endswith(b"r\0" + bytes([0x12, 0x48, 0xFF]) + bytes([0, 40, 93, 0, 0, 0]))
    none = bam.record(read | {"base": "A=C", "qual": None})
    assert none.endswith(b"r\0" + bytes([0x10, 0x20]) + b"\xff" * 3) and struct.unpack_from("<i", none)[0] == len(none) - 4
    back = bam.records(none + bam.record(read | {"qual": "!I~!!!"})).to_pylist()
    assert [(r["base"], r["qual"]) for r in back] == [("A=C", None), ("ACGTNN", "!I~!!!")]
