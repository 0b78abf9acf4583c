"""Lines that many sites share, by HyperLogLog sketches that are merged for each line hash."""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: A line of so many distinct sites is boilerplate.
MIN_SITES = 10
LOG_REGISTERS = 12


def _without(text: pa.Array, hashes: pa.Array, cut: pa.Array) -> pa.Array:
    """The lines of a text whose hashes are not among those cut, in time that grows with their number; null where nothing is cut."""
    left, gone = [], []
    for t, h, c in zip(text, hashes, cut, strict=True):
        if not t.is_valid:
            left.append(None)
            gone.append(None)
            continue
        own = h.values.fill_null(0).to_numpy(zero_copy_only=False)
        out = np.isin(own, c.values.to_numpy(zero_copy_only=False)) & h.values.is_valid().to_numpy(zero_copy_only=False)
        lines = t.as_py().split("\n")
        left.append("\n".join([lines[k] for k in np.flatnonzero(~out)]))
        gone.append(int(out.sum()))
    return pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(gone, pa.int64())], ["text", "gone"], mask=pa.array([x is None for x in gone]))


def remove_shared_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, n_lines, n_removed, kept struct<keep...> of every row: lines of `min_sites` distinct sites or more go.

    The document with the smallest doc_id that has such a line keeps it, so that no content
    is lost altogether where whole documents are copied from site to site. Lines end at \\n
    and are compared as they are; lines of spaces alone stay. A null site is no site; null
    texts stay null with no lines, documents without doc_id lose shared lines only if some
    doc_id keeps them, and rows of one doc_id are treated alike.

    Sketches are merged map-side first, so a line that a third of all rows have costs one
    sketch a task. What goes is gathered by doc_id and hash of the text, so a set has no more
    hashes than one text has lines, whatever rows share a doc_id or have none, and a text is cut
    in time that grows with its lines. A doc_id that ties for the smallest keeps the line in all its
    rows; an empty table gives none. Estimates further than five standard errors from `min_sites` decide
    alone; of the lines between, sites are counted exactly.
    """
    parts = F.split("text", "\n")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(site).cast("string").alias("site"), F.struct(*keep).alias("kept") if keep else F.lit(None).alias("kept"))
    whole = F.xxhash64("text").alias("whole")
    lines = rows.select("doc_id", whole, "site", F.explode(parts).alias("line")).where(F.trim("line") != "").select("doc_id", "whole", "site", F.xxhash64("line").alias("h"))
    margin = 5 * 1.04 / sqrt(2**LOG_REGISTERS) * min_sites
    spread = lines.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_REGISTERS)).alias("sites"), F.min("doc_id").alias("keeper")).where(F.col("sites") >= int(min_sites - margin))
    spread = staged(spread, "spread")
    near = spread.where(F.col("sites") <= ceil(min_sites + margin))
    exact = lines.join(near.select("h"), "h", "left_semi").where("site is not null").select("h", "site").distinct().groupBy("h").agg(F.count("*").alias("exact"))
    shared = staged(spread.join(exact, "h", "left").where(F.coalesce("exact", "sites") >= min_sites).select("h", "keeper"), "shared")
    cut = lines.join(shared, "h").where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).groupBy(F.col("doc_id").alias("cut_id"), F.col("whole").alias("cut_whole")).agg(F.collect_set("h").alias("cut"))
    joined = rows.withColumn("whole", whole).join(cut, F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("whole") == F.col("cut_whole")), "left")
    touched, without = F.col("cut").isNotNull(), F.arrow_udf(_without, "struct<text: string, gone: long>")
    out = joined.withColumn("left", without(F.when(touched, F.col("text")), F.when(touched, F.transform(parts, lambda x: F.when(F.trim(x) != "", F.xxhash64(x)))), "cut"))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long")
    return out.select("doc_id", F.coalesce("left.text", "text").alias("text"), n.alias("n_lines"), F.coalesce("left.gone", F.lit(0)).cast("long").alias("n_removed"), "kept")
