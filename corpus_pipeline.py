"""The corpus pipeline: stages over `documents`, each written and read again as the next one's input.

A stage reads the columns of documents alone, whatever else its input has. An empty table gives
an empty one; null and empty texts pass all stages that don't compare them as copies; of rows that are
alike in doc_id and text one is left by near-dedup. doc_ids may repeat or be null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import cotraining, line_dedup, packing, positional_index, simhash_texts
from readloom.llm.common import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; all, if labels have not both classes."""
    return cotraining.accepted(docs.select(*COLUMNS), _table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sources share; n_chars is counted again."""
    out = line_dedup.remove_shared_lines(docs.select(*COLUMNS), keep=("lang", "source"))
    return out.select("doc_id", "text", "kept.lang", "kept.source", F.length("text").cast("long").alias("n_chars")).select(*COLUMNS)


def _hashed(docs: DataFrame) -> DataFrame:
    """The documents with text_hash (null: as empty)."""
    return docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def _kept(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows that are keepers of groups(doc_id, text_hash, keeper_id, keeper_hash, stays) that stay, each once.

    A row is known by doc_id, null or not, and text_hash; only rows that are alike in both are taken for one.
    """
    keeps = F.col("stays") & F.col("doc_id").eqNullSafe(F.col("keeper_id")) & (F.col("text_hash") == F.col("keeper_hash"))
    rows = groups.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).agg(F.count("*").alias("n"), F.bool_or(keeps).alias("keeps"))
    rows = staged(rows.where("n > 1 or not keeps"), "rows")
    alike = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))
    docs = _hashed(docs)
    out = docs.join(rows, alike, "left_anti").select(*COLUMNS)
    again = rows.where("keeps").select("d", "t")
    if again.isEmpty():
        return out
    first = docs.join(again, alike).select(*COLUMNS, "text_hash").dropDuplicates(["doc_id", "text_hash"])
    return out.unionByName(first.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike by 0.8; the smallest doc_id stays, a row without doc_id only if none has one.

    Decided for each row, see `_kept`; `simhash_texts` says what a group is. A text of other shingles than
    all others, however short, stays; null, empty and blank texts are copies of each other.
    """
    return _kept(docs, simhash_texts.groups(_hashed(docs).withColumn("doc_id", F.col("doc_id").cast("long"))))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text benchmark items don't contaminate, whatever doc_id they have."""
    rows = _hashed(docs)
    found = positional_index.contamination(rows.select("text_hash", "text"), _table(spark, sf_dir, "benchmark"), "text_hash", slop=0)
    return rows.join(found.where("contaminated").select(F.col("doc_id").alias("text_hash")).distinct(), "text_hash", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and the sequences that they fill."""
    return packing.pack(docs.select(*COLUMNS))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: A fitted classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{k + 1}")
    return docs
