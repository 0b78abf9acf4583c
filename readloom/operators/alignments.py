"""Filters, look-ups and figures over alignments and datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_range(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Rows with low <= ordinal < high, and row `low` even if the range is empty."""
    if low > high:
        raise ValueError("low is above high")
    return rows.where((F.col("ordinal") >= low) & (F.col("ordinal") < max(high, low + 1)))


def at(rows: DataFrame, ordinal: int) -> DataFrame:
    return rows.where(F.col("ordinal") == ordinal)


def contig_of_interest(contigs: DataFrame, pattern: str) -> int:
    """ref_index of the first contig whose name contains the pattern, or -1 (no filter)."""
    found = contigs.where(F.contains("name", F.lit(pattern))).agg(F.min("ref_index")).first()[0]
    return -1 if found is None else found


def null_other_contigs(rows: DataFrame, ref_index: int, column: str = "aln", index: str = "ref_index") -> DataFrame:
    """`column` is null where the alignment is on another contig; rows stay. -1: nothing changes."""
    return rows if ref_index < 0 else rows.withColumn(column, F.when(F.col(index) == ref_index, F.col(column)))


def stats(alignments: DataFrame) -> DataFrame:
    """num_aligned, num_mapped, percent_mapped."""
    mapped = F.count_if(F.col("ref_index") != -1)
    return alignments.agg(F.count("*").alias("num_aligned"), mapped.alias("num_mapped"), (mapped * 100.0 / F.nullif(F.count("*"), F.lit(0))).alias("percent_mapped"))


def position_lookup(alignments: DataFrame, wanted: DataFrame) -> DataFrame:
    """Alignments at wanted places (ref_index, position, meta)."""
    return alignments.join(wanted, ["ref_index", "position", "meta"])


def position_range(rows: DataFrame, ref_index: int, low: int, high: int) -> DataFrame:
    """Alignments of a contig with low <= position < high. Of a table that was written in coordinate order, only files and row groups that may hold them are read."""
    return rows.where((F.col("ref_index") == ref_index) & (F.col("position") >= low) & (F.col("position") < high))


def with_next(rows: DataFrame, column: str, chunk: str = "chunk", ordinal: str = "ordinal") -> DataFrame:
    """Rows with `next`, the value of the next row of the chunk (null in the last)."""
    return rows.withColumn("next", F.lead(column).over(Window.partitionBy(chunk).orderBy(ordinal)))


def coordinate_sorted(alignments: DataFrame) -> DataFrame:
    return alignments.orderBy("ref_index", "position", "ordinal")


def union_of(datasets: dict[str, DataFrame]) -> DataFrame:
    """All rows, with the name of their dataset."""
    return reduce(DataFrame.unionByName, [d.withColumn("dataset", F.lit(name)) for name, d in datasets.items()])


def dataset_totals(manifests: DataFrame) -> DataFrame:
    """rows and chunks of manifests(records array<struct<first, last, path>>)."""
    rows = F.aggregate("records", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])
    return manifests.agg(F.sum(rows).alias("rows"), F.sum(F.size("records")).alias("chunks"))
