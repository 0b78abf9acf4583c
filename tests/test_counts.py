"""Counts of overlaps that are not listed, against pairs."""

import random

import pytest
from pyspark.sql import functions as F
from readloom.operators import genecount, overlap


def made(spark, seed, reads=400, exons=120, size=300, repeat=False):
    r = random.Random(seed)
    place = lambda: r.choice([r.randrange(-50, size), r.randrange(size), 7, None] if r.random() < 0.3 else [r.randrange(size)])
    spans = [(k // 2 if repeat and k % 3 == 0 else k if k % 50 else None, r.choice(["s1", "s2", None, "other"]), r.choice(["a", "b", None, "lone"]), place(), r.randrange(13) == 0, r.choice(["", "5M", "40M", "2S10M90N8M"])) for k in range(reads)]
    feats = [(r.choice(["a", "b", None]), r.choice(["exon", "exon", "gene"]), start, None if start is None or r.random() < 0.05 else start + r.randrange(-4, 30), r.choice(["g1", "g2", "g3", "", None]), "") for start in (place() for _ in range(exons))]
    return spark.createDataFrame(spans, "ordinal long, sample string, contig string, position long, is_empty boolean, cigar string"), spark.createDataFrame(feats, "contig string, type string, start long, stop long, gene_id string, gene_name string")


@pytest.mark.parametrize("how", [{}, {"coords": "strict"}, {"distinct_reads": True}, {"distinct_reads": True, "coords": "strict"}])
@pytest.mark.parametrize("repeat, bin_size", [(False, 1 << 16), (True, 16)])
def test_counts_equal_listed_pairs(spark, how, repeat, bin_size):
    alignments, features = made(spark, 3 + repeat, repeat=repeat, exons=40 if repeat else 120)
    rows = lambda **more: sorted(map(tuple, genecount.gene_counts(alignments, features, ["s1", "s2"], **how, **more).collect()))
    got = rows(bin_size=bin_size)
    assert got == rows(strategy="direct") and sum(n for *_, n in got) > 20
    plan = genecount.gene_counts(alignments, features, ["s1"], **how)._jdf.queryExecution().optimizedPlan().toString()
    assert how.get("distinct_reads") or "span_stop" not in "".join(line for line in plan.splitlines() if "Join" in line)  # no pairs of reads and exons


def test_span_counts_equal_listed_pairs(spark):
    alignments, features = made(spark, 5)
    spans = genecount.spans(alignments)
    want = overlap.overlap_join(spans, features, "direct").groupBy("ordinal", "contig", "span_start", "span_stop", "sample").agg(F.count("*").alias("n"))
    got = overlap.counts(spans, features, stretch=32).groupBy("ordinal", "contig", "span_start", "span_stop", "sample").agg(F.sum("n").alias("n"))
    assert sorted(map(repr, want.collect())) == sorted(map(repr, got.collect())) and want.count() > 50
    totals = genecount.run_totals(alignments, features).first()
    hits = genecount.hits(alignments, features, strategy="direct")
    assert (totals.hits, totals.reads_hit) == tuple(hits.agg(F.count("*"), F.count_distinct("ordinal")).first())


def test_a_read_that_crosses_gaps_counts_once(spark):
    exons = spark.createDataFrame([("a", "exon", s, s + 3, "g", "") for s in (0, 2, 10, 20, 40)], "contig string, type string, start long, stop long, gene_id string, gene_name string")
    reads = spark.createDataFrame([(1, "s", "a", 0, False, "50M"), (2, "s", "a", 4, False, "7M"), (3, "s", "a", 6, False, "2M"), (4, "s", "a", 0, False, "1M"), (4, "s", "a", 41, False, "1M")], "ordinal long, sample string, contig string, position long, is_empty boolean, cigar string")
    assert genecount.gene_counts(reads, exons, distinct_reads=True).first().n == 3
    assert genecount.gene_counts(reads, exons).first().n == 5 + 2 + 0 + 2
