"""From read files to gene counts in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import demux, genecount, mapping
from ..sources import text


def gene_counts(spark: SparkSession, reads: str, barcode_reads: str, barcodes: str, genome: str, features: str, coords: str = "parity", **how) -> DataFrame:
    """gene_id, sample, n: reads are assigned to samples by their barcode reads, aligned and counted.

    Reads without a sample or a place are left out; samples without reads are counted as 0.
    """
    known, length = text.barcodes(spark, barcodes)
    assigned = demux.assign(demux.stitch(text.fastq(spark, reads), text.fastq(spark, barcode_reads)), known, length).where("sample is not null")
    placed = mapping.map_reads(assigned.select("ordinal", "sample", "base"), mapping.index(text.fasta(spark, genome)), **how)
    rows = placed.select("ordinal", "sample", (F.col("aln.position.ref_index") < 0).alias("is_empty"), F.col("aln.position.contig").alias("contig"), F.col("aln.position.position").alias("position"), F.col("aln.cigar").alias("cigar"))
    samples = sorted(r.name for r in known.select("name").distinct().collect())
    return genecount.gene_counts(rows, text.gtf(spark, features), samples, coords)
