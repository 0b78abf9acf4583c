import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from readloom.operators import align, pairs


def edits(a, b):
    """Fewest edits of a against any part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def applied(read, cigar, contig, position):
    """Edits of an alignment, by its CIGAR."""
    import re

    at, n = 0, 0
    for size, op in re.findall(r"(\d+)([MIDS])", cigar):
        size = int(size)
        if op == "M":
            n += sum(a != b for a, b in zip(read[at : at + size], contig[position : position + size], strict=True))
        n += size if op in "ID" else 0
        at += size if op in "MIS" else 0
        position += size if op in "MD" else 0
    assert at == len(read)
    return n


def test_gapped_is_the_edit_distance():
    r = random.Random(4)
    reads, windows = [], []
    for _ in range(300):
        window = r.choices(b"ACGT", k=34)
        read = window[2:32]
        for _ in range(r.randint(0, 2)):
            k = r.randrange(len(read))
            r.choice([lambda: read.insert(k, r.choice(b"ACGT")), lambda: read.pop(k), lambda: read.__setitem__(k, r.choice(b"ACGT"))])()
        reads.append(bytes((read + r.choices(b"ACGT", k=4))[:30]))
        windows.append(bytes(window))
    to = lambda rows: np.array([list(x) for x in rows], np.uint8)
    best, ops, begin = align.gapped(to(reads), to(windows), 2)
    for a, b, n, o, d in zip(reads, windows, best.tolist(), ops, begin.tolist(), strict=True):
        want = edits(a, b)
        assert n >= want and (n == want or n > 2)
        if n <= 2:
            text = "".join(f"{m}{'MID'[op]}" for op, m in o)
            assert applied(a.decode(), text, b.decode(), d) == n


def test_reads_with_indels(spark):
    r = random.Random(1)
    contigs = ["".join(r.choices("ACGT", k=5000)) for _ in range(2)]
    rows, want = [], {}
    for k in range(150):
        c, p, n = r.randrange(2), r.randrange(4800), r.randint(60, 90)
        s = list(contigs[c][p : p + n])
        at = r.randrange(15, n - 15)
        kind = r.choice("IDM")
        if kind == "I":
            s.insert(at, r.choice("ACGT"))
        elif kind == "D":
            del s[at]
        back = r.random() < 0.5
        text = "".join(s)
        rows.append((k, text.translate(str.maketrans("ACGT", "TGCA"))[::-1] if back else text))
        want[k] = (c, p, back, kind, text)
    rows += [(150, contigs[0][-50:] + "ACGTACGTAC"), (151, "GT" + contigs[1][:60])]
    ref = spark.createDataFrame([(i, f"c{i}", s) for i, s in enumerate(contigs)], "ref_index int, name string, sequence string")
    reads = spark.createDataFrame(rows, "ordinal long, base string").repartition(3)
    got = {x.ordinal: x.aln for x in align.align(reads, ref, tile=1000).collect()}
    for k, (c, p, back, kind, text) in want.items():
        a = got[k]
        assert (a.position.ref_index, a.flag) == (c, 16 if back else 0) and abs(a.position.position - p) <= 2
        n = applied(text, a.cigar, contigs[c], a.position.position)
        assert n <= 2 and a.mapping_quality == 60 - 10 * n
        if kind != "M" and n == 1:
            assert kind in a.cigar
    assert got[150].flag == 4  # goes beyond the end of the contig
    assert (got[151].cigar, got[151].position.position) == ("2S60M", 0)
    plain = {x.ordinal: x.aln for x in align.align(reads, ref, gaps=False, tile=1000).collect()}
    assert not any("I" in a.cigar or "D" in a.cigar for a in plain.values())


def test_clipped():
    assert align.clipped([(0, 50)], -3) == ("3S47M", 0)
    assert align.clipped([(1, 2), (0, 48)], 7) == ("2S48M", 7)
    assert align.clipped([(0, 2), (2, 1), (0, 48)], -2) == ("2S48M", 1)
    assert align.clipped([(0, 50)], 9) == ("50M", 9)


def test_frequent_seeds_are_left_out(spark):
    ref = spark.createDataFrame([(0, "c", "A" * 500 + "ACGTTGCATGCCAGT" + "A" * 500)], "ref_index int, name string, sequence string")
    places = align.seed_places(align.tiles(ref, 20, 300), 12, 300, 50)
    assert places.where(F.col("seed") == 0).count() == 0 and places.count() > 0
    assert align.seed_places(align.tiles(ref, 20, 300), 12, 300, None).count() == 1015 - 11


def test_reads_without_a_mate_stay(spark):
    aln = align.unmapped()
    rows = spark.range(3).select(F.col("id").alias("ordinal"), F.lit("ACGT").alias("base"), F.when(F.col("id") != 1, aln).alias("aln"))
    got = {r.ordinal: r.aln for r in pairs.mated(rows).collect()}
    assert got[1] is None and got[0].flag == got[2].flag == 4


def test_lengths_of_pairs_count_clips(spark):
    place = lambda p: F.struct(F.lit(p).cast("long").alias("position"), F.lit(0).alias("ref_index"), F.lit("c").alias("contig"))
    aln = lambda flag, p, cigar: F.struct(F.lit(flag).alias("flag"), F.lit(9).alias("mapping_quality"), place(p).alias("position"), place(-1).alias("next_position"), F.lit(0).cast("long").alias("template_length"), F.lit(cigar).alias("cigar"))
    rows = spark.range(2).select(F.col("id").alias("ordinal"), F.lit("A" * 50).alias("base"), F.when(F.col("id") == 0, aln(0, 100, "5S45M")).otherwise(aln(16, 300, "40M10S")).alias("aln"))
    got = {r.ordinal: r.aln for r in pairs.mated(rows).collect()}
    assert [got[k].template_length for k in (0, 1)] == [255, -255]
    assert [got[k].flag for k in (0, 1)] == [1 + 2 + 32 + 64, 1 + 2 + 16 + 128]


@pytest.mark.parametrize("missing", ["a row", "a chunk"])
def test_append_needs_all_rows(spark, tmp_path, missing):
    from readloom.sources import chunk_source

    rows = spark.range(250).select(F.col("id").alias("ordinal"), F.lit("ACGT").alias("base"), F.lit("x").alias("note"))
    chunk_source.write(rows.select("ordinal", "base"), f"{tmp_path}/ds", "ds", 100)
    few = rows.where("ordinal <> 7" if missing == "a row" else "ordinal < 100 or ordinal >= 200")
    with pytest.raises(Exception, match="not complete|dense|not rows for all"):
        chunk_source.append_column(spark, f"{tmp_path}/ds", few, "note")
    assert chunk_source.load(spark, f"{tmp_path}/ds").columns == ["ordinal", "base"]
    chunk_source.append_column(spark, f"{tmp_path}/ds", rows, "note")
    assert chunk_source.load(spark, f"file://{tmp_path}/ds").count() == 250


def test_overwrite_leaves_no_old_chunks(spark, tmp_path):
    from readloom.sources import chunk_source
    from readloom.sources.store import Store

    rows = lambda n: spark.range(n).select(F.col("id").alias("ordinal"), F.lit("AC").alias("base"))
    chunk_source.write(rows(30), f"{tmp_path}/ds", "ds", 10)
    chunk_source.write(rows(10), f"{tmp_path}/ds", "ds", 10, "overwrite")
    assert chunk_source.read_chunks(spark, f"{tmp_path}/ds", ["base"]).count() == 10
    assert Store(f"{tmp_path}/ds").names() == {"ds_0.base", "metadata.json"}
    with pytest.raises(ValueError, match="no store options"):
        Store(f"{tmp_path}/ds", {"region": "x"})
    assert Store("s3://bucket/x", {"region": "eu-west-1"})._at("f")[1] == "bucket/x/f"


def test_a_repeat_before_a_read_is_no_second_place(spark):
    """A seed that is met two bases before its place leads to the same alignment by the search with gaps."""
    read = "TGTGTGTGTGTGCCGTTAGCACCTCGGTGAGC"
    contigs = spark.createDataFrame([(0, "c", "ACCAGCATTG" + read + "CATTACGA")], "ref_index int, name string, sequence string")
    found = align.align(spark.createDataFrame([(1, read)], "ordinal long, base string"), contigs, min_length=20).first().aln
    assert (found.position.position, found.mapping_quality, found.cigar) == (10, 60, "32M")


@pytest.mark.parametrize("least", [14, 20, 40])
def test_reads_as_they_are_have_the_same_places(spark, monkeypatch, least):
    """Looking up whole reads first changes no result; other reads are met by their seeds as before."""
    r = random.Random(least)
    turn = str.maketrans("ACGT", "TGCA")
    some = "".join(r.choices("ACGT", k=300))
    half = "".join(r.choices("ACGT", k=30))
    contigs = ["".join(r.choices("ACGT", k=700)) + some, some + "".join(r.choices("ACGTN", (9, 9, 9, 9, 1), k=600)) + some.translate(turn)[::-1], half + half.translate(turn)[::-1] + "AC" * 40 + "A" * 60, "ACGTACG"]
    rows = [half[-20:] + half.translate(turn)[::-1][:20], "AC" * 22, "A" * 41, contigs[0][:45], contigs[0][-45:], contigs[1][-60:], contigs[1][:43].translate(turn)[::-1], "G" * 50, "", "acgt" * 12]
    for _ in range(120):
        c = r.choice(contigs[:3])
        n = r.randint(least, 70)
        p = r.randrange(len(c) - n)
        s = c[p : p + n]
        if r.random() < 0.4:
            k = r.randrange(n)
            s = s[:k] + r.choice(["", "N", "A", "C", "GT"]) + s[k + 1 :]
        rows.append(s.translate(turn)[::-1] if r.random() < 0.5 else s)
    ref = spark.createDataFrame([(i, f"c{i}", s) for i, s in enumerate(contigs)], "ref_index int, name string, sequence string")
    reads = spark.createDataFrame([*enumerate(rows), (7, rows[7]), (5, rows[5]), (None, rows[3]), (500, None)], "ordinal long, base string").repartition(3)
    found = lambda **how: sorted(map(str, align.align(reads, ref, min_length=least, tile=150, **how).collect()))
    got = [found(), found(gaps=False), found(max_hits=9)]
    monkeypatch.setattr(align, "whole", lambda reads, *_: reads.where("false").selectExpr("ordinal", "false as reverse", "0 as ref_index", "'' as name", "0L as position"))
    assert got == [found(), found(gaps=False), found(max_hits=9)]


def test_reads_as_they_are_need_no_seeds(spark, monkeypatch):
    """Seeds of 12 bases stand in many places of a large reference, so the candidates of all reads grew with the square of the input."""
    r = random.Random(6)
    contig = "".join(r.choices("ACGT", k=3000))
    monkeypatch.setattr(align, "seed_places", lambda *_: pytest.fail("places of seeds were made"))
    reads = spark.createDataFrame([(k, contig[k * 30 : k * 30 + 32]) for k in range(90)], "ordinal long, base string")
    got = align.align(reads, spark.createDataFrame([(0, "c", contig)], "ref_index int, name string, sequence string"), min_length=20, tile=512).collect()
    assert sorted((x.ordinal, x.aln.position.position, x.aln.cigar, x.aln.mapping_quality) for x in got) == [(k, 30 * k, "32M", 60) for k in range(90)]
