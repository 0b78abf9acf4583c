import random

from pyspark.sql import functions as F
from readloom.functions import sequence
from readloom.operators import demux
from readloom.plans import workflow
from readloom.sources import chunk_source, text


def test_reads_to_counts(spark, tmp_path):
    r = random.Random(2)
    contigs = {f"c{k}": "".join(r.choices("ACGT", k=2000)) for k in range(2)}
    (tmp_path / "g.fa").write_text("".join(f">{n} made\n" + "\n".join(s[i : i + 70] for i in range(0, len(s), 70)).lower() + "\n" for n, s in contigs.items()))
    got = text.fasta(spark, f"{tmp_path}/g.fa").orderBy("ref_index").collect()
    assert [(x.ref_index, x.name, x.length, x.sequence) for x in got] == [(k, n, 2000, s) for k, (n, s) in enumerate(contigs.items())]
    exons = [("c0", 100, 200, "G1"), ("c0", 150, 300, "G2"), ("c1", 1000, 1010, "G1"), ("c1", 5, 6, "G3")]
    (tmp_path / "f.gtf").write_text("".join(f'{c}\tx\texon\t{a}\t{b}\t.\t+\t.\tgene_id "{g}";\n' for c, a, b, g in exons))
    (tmp_path / "b.txt").write_text("Name\tB1\nA\tAAAA\nB\tCCCC\nC\tGGGG\n")
    reads, codes, want = "", "", {}
    for k in range(80):
        name, p = r.choice(list(contigs)), r.randrange(1900)
        code = r.choice(["AAAA", "CCCC", "CCCT", "TTTT"])
        s = contigs[name][p : p + 60]
        reads += f"@r{k}\n{s}\n+\n{'I' * 60}\n"
        codes += f"@r{k}\n{code}TT\n+\nIIIIII\n"
        sample = {"A": "A", "C": "B"}.get(code[0])
        for c, a, b, g in exons if sample else []:
            if c == name and b >= p and a <= p + 60:
                want[g, sample] = want.get((g, sample), 0) + 1
    (tmp_path / "r.fq").write_text(reads)
    (tmp_path / "c.fq").write_text(codes)
    files = {"reads": "r.fq", "barcode_reads": "c.fq", "barcodes": "b.txt", "genome": "g.fa", "features": "f.gtf"}
    got = workflow.gene_counts(spark, **{k: f"{tmp_path}/{v}" for k, v in files.items()})
    assert {(x.gene_id, x.sample): x.n for x in got.collect()} == {(g, s): want.get((g, s), 0) for g in ("G1", "G2", "G3") for s in "ABC"}

    known, length = text.barcodes(spark, f"{tmp_path}/b.txt")
    assigned = demux.assign(demux.stitch(text.fastq(spark, f"{tmp_path}/r.fq"), text.fastq(spark, f"{tmp_path}/c.fq")), known, length)
    made = chunk_source.write_samples(assigned, f"{tmp_path}/samples", 10)
    assert [n for n, _ in made] == ["A", "B"]
    for name, folder in made:
        own = assigned.where(F.col("sample") == name).orderBy("ordinal").collect()
        back = spark.read.format("readchunks").load(folder).orderBy("ordinal").collect()
        assert [(x.ordinal, x.base, x.meta) for x in back] == [(k, x.base, x.meta) for k, x in enumerate(own)]


def test_base_codes(spark):
    assert spark.createDataFrame([("ACgtN-x",)], "s string").select(sequence.base_codes(F.col("s"))).first()[0] == "0123454"
