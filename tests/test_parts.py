"""Files and tasks whose size does not grow with the input."""

from pyspark.sql import functions as F
from readloom.plans import queries
from readloom.plans.fixtures import Fixtures
from readloom.sources import block_text, chunk_source, text
from readloom.sources.store import Store


def test_lines_go_to_files_of_bounded_size(spark):
    x = Fixtures(spark, "/root/testdata/sf0.001")
    path = queries._file(x, queries._fastq(x), "reads", 4, lines=100)
    files = Store(path).names()
    sizes = [r.n for r in spark.read.text(path).groupBy("_metadata.file_path").agg(F.count("*").alias("n")).collect()]
    assert sum(f.endswith(".txt") for f in files) > 2 and all(n % 4 == 0 for n in sizes) and max(sizes) < sum(sizes)
    key = lambda rows: sorted(map(tuple, rows.select("meta", "base", "qual").collect()))
    got = text.fastq(spark, path)
    assert key(got) == key(x.reads) and [r.meta for r in got.orderBy("ordinal").collect()] == [r.meta for r in x.reads.orderBy("ordinal").collect()]


def test_a_barcode_list_is_read_by_lines(spark, tmp_path):
    (tmp_path / "1.txt").write_text("Name\tB1\r\na\tAC\r\nb\tGT\n")
    (tmp_path / "2.txt").write_text("c\tAC\n\nlate\tTT\n")
    rows, size = text.barcodes(spark, str(tmp_path))
    assert size == 2 and sorted(map(tuple, rows.select("name", "b1", "line").collect())) == [("b", "GT", 2), ("c", "AC", 3)]


def test_many_chunks_and_ranges_are_few_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(200).select(F.col("id").alias("ordinal"), F.concat(F.lit("b"), "id").alias("base"))
    chunk_source.write(rows, f"{tmp_path}/ds", "ds", 10)
    monkeypatch.setattr(chunk_source, "TASKS", 3)
    reader = chunk_source.ChunkReader(Store(f"{tmp_path}/ds"), ["base"])
    parts = reader.partitions()
    assert len(parts) == 3 and [o for p in parts for b in reader.read(p) for o in b.column("ordinal").to_pylist()] == list(range(200))
    lines = spark.range(20_000).select(F.col("id").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("value")).repartitionByRange(2, "at").sortWithinPartitions("at")
    block_text.write_lines(lines, f"{tmp_path}/blocks")
    monkeypatch.setattr(block_text, "TASKS", 4)
    found = block_text.BlockReader(Store(f"{tmp_path}/blocks"), None, 30_000)
    parts = found.partitions()
    assert len(parts) <= 4 and [v for p in parts for b in found.read(p) for v in b.column("value").to_pylist()] == [r.value for r in lines.orderBy("at").collect()]
