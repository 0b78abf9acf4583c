"""Reads, alignments and features made of the events and part tables; the same text runs in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BARCODES = "SELECT * FROM (VALUES ('T0A','GTCAAG'),('T0B','ATGTAA'),('T14A','GACGGG'),('T14B','CCACGC')) AS t(name,b1)"
READS = """SELECT event_id AS ordinal, concat('r', cast(event_id AS STRING), ' user=', cast(user_id AS STRING)) AS meta,
 CASE WHEN event_id % 97 = 0 THEN concat('NNNN', substr(translate(md5(concat('b', cast(event_id AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 5)) ELSE translate(md5(concat('b', cast(event_id AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT') END AS base,
 translate(md5(concat('q', cast(event_id AS STRING))), '0123456789abcdef', '!#%+/5:?@ABCDEFI') AS qual,
 CASE WHEN event_id % 11 = 0 THEN translate(substr(md5(concat('k', cast(event_id AS STRING))), 1, 12), '0123456789abcdef', 'ACGTACGTACGTACGT')
  WHEN event_id % 7 = 0 THEN concat(CASE event_id % 4 WHEN 0 THEN 'NTCAAG' WHEN 1 THEN 'NTGTAA' WHEN 2 THEN 'NACGGG' ELSE 'NCACGC' END, 'TTTTTT')
  ELSE concat(CASE event_id % 4 WHEN 0 THEN 'GTCAAG' WHEN 1 THEN 'ATGTAA' WHEN 2 THEN 'GACGGG' ELSE 'CCACGC' END, 'TTTTTT') END AS barcode_base
 FROM {events}"""
ALIGNMENTS = """SELECT event_id AS ordinal,
 CASE event_id % 4 WHEN 0 THEN 'T0A' WHEN 1 THEN 'T0B' WHEN 2 THEN 'T14A' ELSE 'T14B' END AS sample,
 event_id % 13 = 0 AS is_empty,
 CASE WHEN event_id % 17 = 0 THEN 4 WHEN event_id % 3 = 0 THEN 16 ELSE 0 END AS flag,
 CASE WHEN event_id % 17 = 0 THEN 0 ELSE cast(event_id % 71 AS INT) END AS mapping_quality,
 CASE WHEN event_id % 17 = 0 THEN -1 ELSE cast(event_id % 6 AS INT) END AS ref_index,
 CASE WHEN event_id % 17 = 0 THEN '*' ELSE concat('chr', cast(event_id % 6 AS STRING)) END AS contig,
 CASE WHEN event_id % 17 = 0 THEN 0 ELSE (event_id * 7919) % 20000 END AS position,
 CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 5 = 0 THEN '4S20M2D8M' WHEN event_id % 5 = 1 THEN '10M3I19M' WHEN event_id % 5 = 2 THEN '16=1X15=' WHEN event_id % 5 = 3 THEN '20M500N12M' ELSE '32M' END AS cigar
 FROM {events}"""
FEATURES = """SELECT concat('chr', cast(p_partkey % 5 AS STRING)) AS contig, CASE WHEN p_partkey % 4 = 3 THEN 'gene' ELSE 'exon' END AS type,
 (p_partkey * 104729) % 20000 AS start, (p_partkey * 104729) % 20000 + p_size AS stop, p_partkey % 2 = 0 AS strand,
 concat('ENSG', cast(p_partkey % 100 AS STRING)) AS gene_id, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_brand END AS gene_name
 FROM {part}"""
SAMPLES = ["T0A", "T0B", "T14A", "T14B"]


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        events, part = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("events", "part"))
        self.barcodes: DataFrame = spark.sql(BARCODES)
        self.reads = spark.sql(READS, events=events)
        self.alignments = spark.sql(ALIGNMENTS, events=events)
        self.features = spark.sql(FEATURES, part=part)


#: The same as common table expressions.
WITH = f"WITH bc AS ({BARCODES}), rd AS ({READS.format(events='events')}), al AS ({ALIGNMENTS.format(events='events')}), ft AS ({FEATURES.format(part='part')})"
