"""Counts of alignments by gene and sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar
from . import overlap


def spans(alignments: DataFrame, coords: str = "parity") -> DataFrame:
    """Alignments that exist, with span_start and span_stop.

    parity: [position, position + query length], both ends closed, as the evident intent of
    counting has it; strict: 1-based [position + 1, position + reference span].
    """
    found = alignments.where("not is_empty")
    if coords == "strict":
        span = cigar.reference_span(F.col("cigar"), F.lit(0))
        return found.withColumns({"span_start": F.col("position") + 1, "span_stop": F.col("position") + span})
    return found.withColumns({"span_start": F.col("position").cast("long"), "span_stop": F.col("position") + cigar.query_length(F.col("cigar"))})


def _exons(features: DataFrame) -> DataFrame:
    return features.where("type = 'exon' and gene_id <> ''").select("contig", "start", "stop", "gene_id")


def hits(alignments: DataFrame, features: DataFrame, coords: str = "parity", **how) -> DataFrame:
    """ordinal, sample, gene_id: a row for each exon that an alignment touches."""
    exons = _exons(features)
    return overlap.overlap_join(spans(alignments, coords).select("ordinal", "sample", "contig", "span_start", "span_stop"), exons, **how).select("ordinal", "sample", "gene_id")


def gene_counts(alignments: DataFrame, features: DataFrame, samples: list[str] | None = None, coords: str = "parity", distinct_reads: bool = False, strategy: str = "binned", bin_size: int = overlap.STRETCH) -> DataFrame:
    """gene_id, sample, n for every gene and sample, 0 without hits.

    A read counts once for each exon it touches, or once for a gene if distinct_reads.
    Samples are named columns of the matrix, so their names may be read by the driver.
    binned: begins and ends are counted by place, and summed up over bins, so no pair of a read and an exon is listed, and
    the work grows with reads and exons, however deep both lie; direct: pairs are listed and counted.
    """
    names = samples if samples is not None else sorted(r[0] for r in alignments.select("sample").where("sample is not null").distinct().collect())
    laid = spans(alignments, coords).select("ordinal", "sample", "contig", "span_start", "span_stop").where("span_start <= span_stop")
    exons = _exons(features)
    if strategy == "direct":
        found = hits(alignments, features, coords, strategy=strategy)
        counts = (found.distinct() if distinct_reads else found).groupBy("gene_id", "sample").agg(F.count("*").alias("n"))
    elif distinct_reads:
        counts = _reads_of(laid, exons, names, bin_size)
    else:
        counts = _touches(laid, overlap.normalised(exons), names, bin_size)
    every = features.where("gene_id <> ''").select("gene_id").distinct().withColumn("sample", F.explode(F.lit(names).cast("array<string>")))
    return every.join(counts, ["gene_id", "sample"], "left").select("gene_id", "sample", F.coalesce("n", F.lit(0)).alias("n"))


def _touches(spans: DataFrame, intervals: DataFrame, names: list[str], bin_size: int) -> DataFrame:
    """gene_id, sample, n: how often spans and intervals (start <= stop) touch.

    An interval is touched by the spans that begin up to its end, without those that end before it begins.
    """
    mark = lambda side, v, sign: intervals.groupBy("contig", "gene_id", v.cast("long").alias("v")).agg((sign * F.count("*")).alias("times")).withColumn("side", F.lit(side))
    marks = mark(0, F.col("stop"), 1).unionByName(mark(1, F.col("start") - 1, -1))
    by_sample = F.explode(F.lit(names).cast("array<string>")).alias("sample")
    found = overlap.ranked(overlap.ends(spans, ["contig", "sample"], "span_start", "span_stop"), marks.select("side", "contig", "v").distinct().select("*", by_sample), ["side", "contig", "sample"], bin_size)
    return marks.join(found, ["side", "contig", "v"]).groupBy("gene_id", "sample").agg(F.sum(F.col("times") * F.col("n")).alias("n")).where("n > 0")


def _reads_of(spans: DataFrame, exons: DataFrame, names: list[str], bin_size: int) -> DataFrame:
    """gene_id, sample, n: how many reads (ordinal, sample) touch a gene.

    A span touches neighbouring stretches of a gene's exons, so it counts once if the gaps that lie in it, between two of
    these, are taken off the stretches that it touches. Reads with more spans than one are met with the stretches one by one.
    """
    read, keys = ["ordinal", "sample"], ["sample", "contig", "span_start", "span_stop"]
    rows = spans.distinct().withColumn("spans", F.count("*").over(Window.partitionBy(*read)))
    one, more = rows.where("spans = 1"), rows.where("spans > 1").drop("spans")
    covered = overlap.merged(exons, ["contig", "gene_id"])
    following = F.lead("start").over(Window.partitionBy("contig", "gene_id").orderBy("start"))
    gaps = covered.select("contig", "gene_id", F.col("stop").alias("start"), following.alias("stop")).where("stop is not null")
    alike = one.groupBy(*keys).agg(F.count("*").alias("reads"))
    crossed = overlap.contained(alike, gaps, strategy="binned").groupBy("gene_id", "sample").agg((-F.sum("reads")).alias("n"))
    several = overlap.overlap_join(more, covered, "binned").select(*read, "gene_id").distinct().groupBy("gene_id", "sample").agg(F.count("*").alias("n"))
    parts = _touches(one, covered, names, bin_size).unionByName(crossed).unionByName(several)
    return parts.groupBy("gene_id", "sample").agg(F.sum("n").alias("n"))


def gene_names(features: DataFrame) -> DataFrame:
    """gene_id, names: distinct gene names over all feature types; a missing name is the id."""
    name = F.coalesce(F.nullif(F.col("gene_name"), F.lit("")), F.col("gene_id"))
    return features.where("gene_id <> ''").groupBy("gene_id").agg(F.sort_array(F.collect_set(name)).alias("names"))


def matrix(counts: DataFrame, samples: list[str]) -> DataFrame:
    """gene_id and a column for each sample."""
    return counts.groupBy("gene_id").pivot("sample", samples).agg(F.sum("n")).na.fill(0, samples)


def write_matrix(counts: DataFrame, features: DataFrame, samples: list[str], path: str) -> None:
    """A single CSV: gene_id with its names in brackets, then a column for each sample."""
    named = matrix(counts, samples).join(gene_names(features), "gene_id")
    label = F.concat("gene_id", F.lit("("), F.array_join("names", " "), F.lit(")"))
    named.select(label.alias("gene_id"), *samples).orderBy("gene_id").coalesce(1).write.mode("errorifexists").csv(path, header=True)


def run_totals(alignments: DataFrame, features: DataFrame, coords: str = "parity") -> DataFrame:
    """alignments, samples, hits, reads_hit, exons, genes of a run, in one row; hits are counted, not listed."""
    touching = overlap.counts(spans(alignments, coords).select("ordinal", "contig", "span_start", "span_stop"), _exons(features))
    found = touching.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("hits"), F.count_distinct("ordinal").alias("reads_hit"))
    one = alignments.where("not is_empty").agg(F.count("*").alias("alignments"), F.count_distinct("sample").alias("samples"))
    two = features.where("gene_id <> ''").agg(F.count_if(F.col("type") == "exon").alias("exons"), F.count_distinct("gene_id").alias("genes"))
    return one.withColumn("k", F.lit(1)).join(found.withColumn("k", F.lit(1)), "k").join(two.withColumn("k", F.lit(1)), "k").drop("k")
