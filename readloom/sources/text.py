"""Text inputs: FASTQ, GTF, barcode lists, sample indices, dataset lists, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import FEATURES, MANIFEST
from . import block_text


def _lines(spark: SparkSession, path: str, separator: str = "\n") -> tuple[DataFrame, DataFrame]:
    """value, file and line (from 0 in its file) of the files of a path, file being a hash of its name; and file, name and n lines of each file.

    Plain or compressed (.gz, which is one task a file until it is read). Lines are counted for each split of a file;
    a line's number is its place in the split and the lines of the splits before. The counts are broadcast: four
    numbers a split, so 30 MB for 100 TB in splits of 128 MB.
    """
    name = F.col("_metadata.file_path")
    rows = spark.read.option("lineSep", separator).text(path).select("value", F.xxhash64(name).alias("file"), name.alias("name"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"))
    counts = rows.groupBy("file", "split").agg(F.min("name").alias("name"), F.min("id").alias("low"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = F.broadcast(counts.select("file", "split", "low", before.alias("before")))
    lines = rows.join(splits, ["file", "split"]).select("value", "file", (F.col("before") + F.col("id") - F.col("low")).alias("line"))
    return lines, counts.groupBy("file").agg(F.min("name").alias("name"), F.sum("n").alias("n"))


def _offsets(files: DataFrame) -> DataFrame:
    """file and offset of files(file, name, n): the n of all files before it, by name. A row a file, broadcast."""
    before = F.sum("n").over(Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1))
    return F.broadcast(files.select("file", F.coalesce(before, F.lit(0)).alias("offset")))


def fastq(spark: SparkSession, path: str, blocks: bool = False, **how) -> DataFrame:
    """ordinal, meta, base, qual of the FASTQ files of a path (a file, a folder or a pattern), numbered on from file to file by name.

    blocks: the path is a file or folder in compressed blocks, of which one is read by many tasks; `how` as in `block_text.lines`.
    Records are four lines by number in their file, so a quality line may begin with @. An unfinished last
    record of a file is left out; a record whose base and quality differ in length fails.
    """
    part = lambda k: F.max(F.when(F.col("line") % 4 == k, F.regexp_replace("value", "\r$", "")))
    lines, files = block_text.lines(spark, path, **how) if blocks else _lines(spark, path)
    records = lines.groupBy("file", F.floor(F.col("line") / 4).alias("own")).agg(part(0).alias("meta"), part(1).alias("base"), part(3).alias("qual"), F.count("*").alias("n")).where("n = 4")
    offsets = _offsets(files.withColumn("n", F.floor(F.col("n") / 4)))
    records = records.drop("n").join(offsets, "file").withColumn("ordinal", F.col("offset") + F.col("own"))
    failed = F.raise_error(F.concat(F.lit("base and quality differ in length at record "), F.col("ordinal").cast("string"))).cast("string")
    return records.select("ordinal", F.regexp_replace("meta", "^@", "").alias("meta"), "base", F.when(F.length("base") == F.length("qual"), F.col("qual")).otherwise(failed).alias("qual"))


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """Features of GTF files: comments and blank lines anywhere are skipped, whole quoted values kept.

    Rows without gene_id are left out; gene_name is the gene_id where it is missing.
    """
    f = F.split("value", "\t")
    attribute = lambda key: F.regexp_extract(f[8], rf'(?:^|;)\s*{key}\s+(?:"([^"]*)"|([^";\s]+))', 1)
    bare = lambda key: F.regexp_extract(f[8], rf'(?:^|;)\s*{key}\s+(?:"([^"]*)"|([^";\s]+))', 2)
    value = lambda key: F.when(attribute(key) != "", attribute(key)).otherwise(bare(key))
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    out = rows.select(f[0].alias("contig"), f[1].alias("source"), f[2].alias("type"), f[3].cast("long").alias("start"), f[4].cast("long").alias("stop"), f[5].alias("score"), (f[6] == "+").alias("strand"), f[7].alias("frame"), value("gene_id").alias("gene_id"), value("gene_name").alias("name"))
    out = out.where("gene_id <> ''").withColumn("gene_name", F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("gene_id"))).drop("name")
    return out.select(*[c.split()[0] for c in FEATURES.split(", ")])


def barcodes(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """(name, b1, line) rows and the length of the barcodes. The header must be Name, B1; lengths must agree.

    The list ends at the first blank line; of equal barcodes the last counts. A list in several files goes on from file to file by name.
    """
    found, files = _lines(spark, path)
    number = (F.col("offset") + F.col("line")).alias("line")
    lines = found.join(_offsets(files), "file").select(number, F.regexp_replace("value", "\r$", "").alias("value"))
    first = lines.where("line = 0").first()
    if first is None or first.value != "Name\tB1":
        raise ValueError("a barcode list has the columns Name and B1")
    end = lines.where(F.trim("value") == "").agg(F.min("line")).first()[0]
    part = F.split("value", "\t")
    rows = lines.where(F.col("line") > 0) if end is None else lines.where((F.col("line") > 0) & (F.col("line") < end))
    rows = rows.select(part[0].alias("name"), F.get(part, F.lit(1)).alias("b1"), "line")
    out = rows.groupBy("b1").agg(F.max_by("name", "line").alias("name"), F.max("line").alias("line")).select("name", "b1", "line")
    low, high, missing = out.agg(F.min(F.length("b1")), F.max(F.length("b1")), F.count_if(F.col("b1").isNull() | (F.col("b1") == ""))).first()
    if low is None or low != high or missing:
        raise ValueError("barcodes are missing or differ in length")
    return out, low


def sample_index(spark: SparkSession, path: str) -> DataFrame:
    """name, path of a sample index."""
    return spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True).toDF("name", "path")


def write_sample_index(rows: DataFrame, path: str) -> None:
    rows.select(F.col("name").alias("Name"), F.col("path").alias("Path")).coalesce(1).write.csv(path, header=True)


def dataset_list(spark: SparkSession, path: str) -> list[str]:
    """The manifest paths of a JSON array of strings."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("path"))
    return [r.path for r in rows.collect()]


def write_dataset_list(spark: SparkSession, paths: list[str], path: str) -> None:
    spark.createDataFrame([(paths,)], "p array<string>").select(F.to_json("p").alias("value")).coalesce(1).write.text(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a dataset, one row."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True)


def chunks(manifests: DataFrame) -> DataFrame:
    """name, first, last, path of all chunks, by first."""
    return manifests.select("name", F.explode("records").alias("r")).select("name", "r.first", "r.last", "r.path").orderBy("name", "first")


def with_column(manifests: DataFrame, column: str, ref_genome=None) -> DataFrame:
    """The manifest with one more column, added once, and another reference."""
    out = manifests.withColumn("columns", F.array_union("columns", F.array(F.lit(column))))
    return out if ref_genome is None else out.withColumn("ref_genome", F.lit(None).cast("array<struct<name: string, length: bigint>>") if not ref_genome else F.array(*[F.struct(F.lit(n).alias("name"), F.lit(size).cast("long").alias("length")) for n, size in ref_genome]))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """ref_index, name, length, sequence of the contigs of the FASTA files of a path, in their order, file by file by name.

    A contig begins with a line that begins with >, whatever stands further on in it; its name
    ends at the first space. Lines before the first contig of a file are left out.
    """
    records, files = _lines(spark, path, "\n>")
    value = F.regexp_replace("value", "^>", "")
    body = F.upper(F.regexp_replace(F.regexp_replace(value, r"^[^\n]*\n?", ""), r"\s", ""))
    found = records.where((F.col("line") > 0) | F.col("value").startswith(">")).select("file", "line", F.regexp_extract(value, r"^\S*", 0).alias("name"), body.alias("sequence")).where("name <> '' or sequence <> ''")
    counts = found.groupBy("file").agg(F.count("*").alias("n"), F.min("line").alias("first"))
    offsets = _offsets(counts.select("file", "n").join(files.select("file", "name"), "file"))
    placed = found.join(offsets, "file").join(F.broadcast(counts.select("file", "first")), "file")
    return placed.select((F.col("offset") + F.col("line") - F.col("first")).cast("int").alias("ref_index"), "name", F.length("sequence").cast("long").alias("length"), "sequence")
