"""CIGAR strings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the SAM specification: operations in the order of their codes.
OPS = "MIDNSHP=X"
QUERY_OPS, REFERENCE_OPS = "MIS=X", "MDN=X"


def tokens(cigar: Column) -> Column:
    """array<struct<n int, op string>>; a missing number is 0; null for null."""
    found = F.regexp_extract_all(cigar, F.lit(r"\d*[A-Z=*]"), 0)
    number = lambda t: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(t, r"^\d+", 0), F.lit("")), F.lit("9999999999")).cast("int"), F.lit(0))
    return F.transform(found, lambda t: F.struct(number(t).alias("n"), F.substring(t, -1, 1).alias("op")))


def _span(cigar: Column, ops: str) -> Column:
    found = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{ops}]"), 1)
    return F.aggregate(found, F.lit(0).cast("long"), lambda total, n: total + n.cast("long"))


def query_length(cigar: Column) -> Column:
    """Bases of the read that a CIGAR takes: operations M, I, S, = and X; 0 for '' and '*'."""
    return _span(cigar, QUERY_OPS)


def reference_span(cigar: Column, read_length: Column) -> Column:
    """Bases of the reference that a CIGAR covers: M, D, N, = and X; without a CIGAR the read's length."""
    return F.when(cigar.isin("", "*") | cigar.isNull(), read_length.cast("long")).otherwise(_span(cigar, REFERENCE_OPS))


def clips(cigar: Column) -> tuple[Column, Column]:
    """Soft-clipped bases at the begin and at the end."""
    n = lambda pattern: F.coalesce(F.nullif(F.regexp_extract(cigar, pattern, 1), F.lit("")).cast("long"), F.lit(0))
    return n(r"^(?:\d+H)?(\d+)S"), n(r"[^0-9](\d+)S(?:\d+H)?$")


def bam_codes(cigar: Column) -> Column:
    """array<long>: length << 4 | code of each operation, as BAM has them."""
    return F.transform(tokens(cigar), lambda t: F.shiftleft(t["n"].cast("long"), 4).bitwiseOR((F.instr(F.lit(OPS), t["op"]) - 1).cast("long")))
