"""Column types of reads, alignments, features and manifests."""

POSITION = "struct<position: bigint, ref_index: int, contig: string>"
ALIGNMENT = f"struct<flag: int, mapping_quality: int, position: {POSITION}, next_position: {POSITION}, template_length: bigint, cigar: string>"
READS = "ordinal bigint, base string, qual string, meta string"
FEATURES = "contig string, source string, type string, start bigint, stop bigint, score string, strand boolean, frame string, gene_id string, gene_name string"
MANIFEST = "name string, version int, columns array<string>, records array<struct<first: bigint, last: bigint, path: string>>, pool string, ref_genome array<struct<name: string, length: bigint>>"
