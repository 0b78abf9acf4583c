"""Predicates on SAM flags."""

from __future__ import annotations

from pyspark.sql import Column

# Fixed values of the SAM specification: bits that are looked at, and whether one must be set.
PREDICATES = {
    "is_primary": (0x100 | 0x800, False),
    "is_paired": (0x1, True),
    "is_discordant": (0x2, False),
    "is_mapped": (0x4, False),
    "is_unmapped": (0x4, True),
    "is_next_unmapped": (0x8, True),
    "is_next_mapped": (0x8, False),
    "is_reverse_strand": (0x10, True),
    "is_forward_strand": (0x10, False),
    "is_first_read": (0x40, True),
    "is_last_read": (0x80, True),
    "is_secondary": (0x100, True),
    "is_supplemental": (0x800, True),
    "is_duplicate": (0x400, True),
}


def predicate(name: str, flag: Column) -> Column:
    """is_discordant and is_next_mapped also hold for unpaired reads, whose bits are clear."""
    bits, wanted = PREDICATES[name]
    found = flag.bitwiseAND(bits)
    return (found != 0) if wanted else (found == 0)
