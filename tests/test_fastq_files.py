import gzip

import pytest
from readloom.sources import text


def records(name, n):
    return [(f"{name} {k}", "ACGT"[: k % 4 + 1], "@III"[: k % 4 + 1]) for k in range(n)]


def lines(rows):
    return "".join(f"@{m}\n{b}\n+\n{q}\n" for m, b, q in rows)


@pytest.fixture
def small_splits(spark):
    for key, value in (("maxPartitionBytes", "64"), ("openCostInBytes", "1")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    yield spark
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def test_records_go_on_from_file_to_file(small_splits, tmp_path):
    spark, folder, want = small_splits, tmp_path / "a b%20", []
    folder.mkdir()
    for name, n, tail in (("a.fq", 5, "@cut\nAC\n+"), ("b é.fq", 40, ""), ("c.fq", 0, ""), ("d.fq.gz", 9, "@x\n"), ("e.fq", 3, "\n")):
        raw = (lines(records(name, n)) + tail).encode()
        (folder / name).write_bytes(gzip.compress(raw) if name.endswith("gz") else raw)
        want += records(name, n)
    assert text._lines(spark, str(folder))[0].rdd.getNumPartitions() > 10
    assert sorted(tuple(r) for r in text.fastq(spark, str(folder)).collect()) == [(k, *w) for k, w in enumerate(want)]
    assert sorted(tuple(r) for r in text.fastq(spark, f"{folder}/b*").collect()) == [(k, *w) for k, w in enumerate(records("b é.fq", 40))]


def test_contigs_go_on_from_file_to_file(small_splits, tmp_path):
    (tmp_path / "1.fa").write_text("note\n>a x\nAC\nGT\n>b\nacgt\n")
    (tmp_path / "2.fa").write_text(">c\n" + "ACGT\n" * 60 + ">d >e\nA\n")
    (tmp_path / "3.fa").write_text("")
    (tmp_path / "4.fa").write_text(">f\n\nN\n")
    got = [tuple(r) for r in text.fasta(small_splits, str(tmp_path)).orderBy("ref_index").collect()]
    want = [("a", "ACGT"), ("b", "ACGT"), ("c", "ACGT" * 60), ("d", "A"), ("f", "N")]
    assert got == [(k, n, len(s), s) for k, (n, s) in enumerate(want)]


def test_a_broken_record_is_named(spark, tmp_path):
    (tmp_path / "1.fq").write_text("@a\nAC\n+\nII\n")
    (tmp_path / "2.fq").write_text("@b\nAC\n+\nI\n")
    with pytest.raises(Exception, match="at record 1"):
        text.fastq(spark, str(tmp_path)).collect()
