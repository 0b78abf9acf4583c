"""Row numbers within samples, chunks, and the pairing of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_SIZE = 100_000
#: Ordinals that are numbered together; a large sample is spread over many such stretches.
STRETCH = 1_000_000


def numbered(rows: DataFrame, sample: str = "sample", ordinal: str = "ordinal", stretch: int = STRETCH) -> DataFrame:
    """Rows with `row`, dense from 0 by ordinal within each sample.

    Rows are counted by stretch of ordinals, stretches are summed up, and numbers are given
    within a stretch, so that no task sees a whole sample.
    """
    cut = rows.withColumn("stretch", F.floor(F.col(ordinal) / stretch))
    counts = cut.groupBy(sample, "stretch").agg(F.count("*").alias("in_stretch"))
    before = Window.partitionBy(sample).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(sample).alias("of_sample"), F.col("stretch").alias("of_stretch"), F.coalesce(F.sum("in_stretch").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy(sample, "stretch").orderBy(ordinal)) - 1
    joined = cut.withColumn("own", own).join(offsets, F.col(sample).eqNullSafe(F.col("of_sample")) & (F.col("stretch") == F.col("of_stretch")))
    return joined.withColumn("row", F.col("offset") + F.col("own")).drop("stretch", "own", "of_sample", "of_stretch", "offset")


def chunked(rows: DataFrame, size: int = CHUNK_SIZE, sample: str = "sample", ordinal: str = "ordinal", stretch: int = STRETCH) -> DataFrame:
    """Rows with `row`, `chunk` and `first`, the first row number of the chunk."""
    if size <= 0:
        raise ValueError("the chunk size must be positive")
    chunk = F.floor(F.col("row") / size)
    return numbered(rows, sample, ordinal, stretch).withColumns({"chunk": chunk, "first": chunk * size})


def manifest(chunks: DataFrame, sample: str = "sample") -> DataFrame:
    """sample, chunk, first, last (exclusive), n, path of all chunks."""
    found = chunks.groupBy(sample, "chunk", "first").agg(F.count("*").alias("n"))
    return found.select(sample, "chunk", "first", (F.col("first") + F.col("n")).alias("last"), "n", F.concat_ws("_", sample, "first").alias("path"))


def interleaved(first: DataFrame, second: DataFrame, check: bool = True) -> DataFrame:
    """r1[0], r2[0], r1[1], r2[1], ... with ordinals 0, 1, 2, 3, ...; fails if a mate is missing."""
    if check:
        pairs = first.select("ordinal", F.lit(1).alias("one")).join(second.select("ordinal", F.lit(1).alias("two")), "ordinal", "full")
        if not pairs.where("one is null or two is null").isEmpty():
            raise ValueError("the paired inputs differ in length")
    even = first.withColumn("ordinal", F.col("ordinal") * 2)
    return even.unionByName(second.withColumn("ordinal", F.col("ordinal") * 2 + 1))


def record_offsets(lengths: DataFrame, group: str, ordinal: str = "ordinal", length: str = "length") -> DataFrame:
    """Rows with `offset`, the sum of the lengths before it in its group (a chunk)."""
    before = Window.partitionBy(group).orderBy(ordinal).rowsBetween(Window.unboundedPreceding, -1)
    return lengths.withColumn("offset", F.coalesce(F.sum(length).over(before), F.lit(0)))
