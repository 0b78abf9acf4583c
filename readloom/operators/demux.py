"""Reads to samples, by barcodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXACT, RESCUED, REJECTED = "exact", "rescued", "rejected"


def stitch(reads: DataFrame, barcode_reads: DataFrame, barcode: str = "base") -> DataFrame:
    """Reads with `barcode_base`, the base of the barcode read of the same ordinal.

    Fails if a read has no barcode read; further barcode reads are left out.
    """
    other = barcode_reads.select("ordinal", F.col(barcode).alias("barcode_base"))
    joined = reads.join(other, "ordinal", "left")
    missing = F.raise_error(F.lit("a read has no barcode read")).cast("string")
    return joined.withColumn("barcode_base", F.coalesce("barcode_base", missing))


def assign(reads: DataFrame, barcodes: DataFrame, length: int, barcode: str = "barcode_base") -> DataFrame:
    """Reads with `sample` and `status`: exact, rescued (one barcode at one mismatch) or rejected.

    The answer depends on the first `length` bases alone, so it is found once for each
    distinct key (a map-side distinct) and joined back. Rescue is an equi-join on the key with
    one place masked, which meets all barcodes at a distance of one or less. Of equal barcodes the
    last (by `line`, where the list has it, else by name) counts; two barcodes of one name are
    two candidates.
    """
    key = F.substring(F.col(barcode), 1, length)
    known = barcodes.groupBy("b1").agg(F.max_by("name", "line" if "line" in barcodes.columns else "name").alias("name"))
    masks = F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: F.concat(F.substring("key", F.lit(1), i - 1), F.lit("\0"), F.substring("key", i + 1, F.lit(length))))
    keys = reads.select(key.alias("key")).where("key is not null").distinct()
    exact = keys.join(known, keys["key"] == known["b1"], "left").select("key", "name")
    missed = exact.where(F.col("name").isNull() & (F.length("key") == length)).select("key", F.explode(masks).alias("mask"))
    masked = known.select(F.col("b1").alias("key"), F.col("name").alias("candidate")).where(F.length("key") == length).select("candidate", F.explode(masks).alias("mask"))
    rescued = missed.join(masked, "mask").groupBy("key").agg(F.min("candidate").alias("saved"), F.count("*").alias("n")).where("n = 1").select("key", "saved")  # a barcode meets a key once
    found = exact.join(rescued, "key", "left").select(F.col("key").alias("own_key"), F.coalesce("name", "saved").alias("sample"), F.when(F.col("name").isNotNull(), EXACT).when(F.col("saved").isNotNull(), RESCUED).otherwise(REJECTED).alias("status"))
    return reads.join(found, key == found["own_key"], "left").drop("own_key").withColumn("status", F.coalesce("status", F.lit(REJECTED)))


def stats(assigned: DataFrame) -> DataFrame:
    """status, sample, n."""
    return assigned.groupBy("status", "sample").agg(F.count("*").alias("n"))


def totals(assigned: DataFrame) -> DataFrame:
    """One row: reads, samples, bad barcodes, saved barcodes."""
    one = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, 1).otherwise(0)), F.lit(0))
    return assigned.agg(F.count("*").alias("reads"), F.count_distinct("sample").alias("samples"), one(REJECTED).alias("bad_barcodes"), one(RESCUED).alias("saved_barcodes"))


def rejected(assigned: DataFrame) -> DataFrame:
    return assigned.where(F.col("status") == REJECTED).drop("sample", "status")
