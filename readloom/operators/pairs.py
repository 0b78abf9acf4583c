"""Alignments of paired reads: flags, mate fields and template lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar

# Fixed values of the SAM specification.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, FIRST, LAST, SECONDARY = 0x1, 0x2, 0x4, 0x8, 0x10, 0x20, 0x40, 0x80, 0x100


def flags(unmapped: Column, reverse: Column, secondary: Column | None = None) -> Column:
    """The flag of a single read: an unmapped one is never reversed."""
    out = F.when(unmapped, UNMAPPED).otherwise(F.when(reverse, REVERSE).otherwise(0))
    return out if secondary is None else out + F.when(secondary, SECONDARY).otherwise(0)


def template_length(own_start: Column, own_stop: Column, mate_start: Column, mate_stop: Column) -> Column:
    """Signed length from the first read's start to the last one's stop, on one contig; negative for the read that does not start first."""
    return F.when(own_start < mate_start, mate_stop - own_start).otherwise(-(own_stop - mate_start))


def mated(rows: DataFrame, max_insert: int = 1000) -> DataFrame:
    """Interleaved reads (ordinal, base, aln, ...), 2k and 2k + 1 being mates, with `aln` as of a pair.

    Flags tell the first and the last read, a mate that is unmapped or reversed, and proper
    pairs: both mapped to one contig on opposite strands, `max_insert` long at most. An unmapped read
    takes its mate's place; a mate's contig is "=" where it is one's own, and next to an unmapped mate
    stands one's own place. Template lengths count clipped bases as if they were aligned. A read
    without a mate, or whose aln is null, stays as it is; a null mate counts as missing.
    """
    one = Window.partitionBy(F.floor(F.col("ordinal") / 2)).orderBy("ordinal")
    begin, end = cigar.clips(F.col("aln.cigar"))
    start = F.col("aln.position.position") - begin
    info = F.struct(F.col("aln"), start.alias("start"), (F.col("aln.position.position") + F.length("base") - begin).alias("stop"))
    own = rows.withColumn("own", F.when(F.col("aln").isNotNull(), info))
    both = own.withColumn("mate", F.coalesce(F.lag("own").over(one), F.lead("own").over(one)))
    a, m = F.col("own.aln"), F.col("mate.aln")
    lost, mate_lost = a["flag"].bitwiseAND(UNMAPPED) != 0, m["flag"].bitwiseAND(UNMAPPED) != 0
    together = ~lost & ~mate_lost & (a["position"]["ref_index"] == m["position"]["ref_index"])
    length = F.when(together, template_length(F.col("own.start"), F.col("own.stop"), F.col("mate.start"), F.col("mate.stop"))).otherwise(0).cast("long")
    opposite = a["flag"].bitwiseAND(REVERSE) != m["flag"].bitwiseAND(REVERSE)
    bit = lambda when, value: F.when(when, value).otherwise(0)
    flag = a["flag"] + PAIRED + F.when(F.col("ordinal") % 2 == 0, FIRST).otherwise(LAST) + bit(mate_lost, MATE_UNMAPPED) + bit(~mate_lost & (m["flag"].bitwiseAND(REVERSE) != 0), MATE_REVERSE) + bit(together & opposite & (F.abs(length) <= max_insert), PROPER)
    place = F.when(lost & ~mate_lost, m["position"]).otherwise(a["position"])
    contig = F.when(lost | mate_lost | (m["position"]["contig"] == a["position"]["contig"]), "=").otherwise(m["position"]["contig"])
    following = F.when(mate_lost, a["position"]).otherwise(m["position"])
    paired = F.struct(flag.alias("flag"), a["mapping_quality"].alias("mapping_quality"), place.alias("position"), F.struct(following["position"].alias("position"), following["ref_index"].alias("ref_index"), contig.alias("contig")).alias("next_position"), length.alias("template_length"), a["cigar"].alias("cigar"))
    return both.withColumn("aln", F.when(F.col("own").isNotNull() & F.col("mate").isNotNull(), paired).otherwise(F.col("aln"))).drop("own", "mate")
