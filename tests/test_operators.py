import random

import duckdb
import pytest
from readloom.functions import cigar, flags, sequence
from readloom.operators import align, alignments, chunking, demux, genecount, overlap, pairs
from readloom.plans import queries
from readloom.plans.fixtures import Fixtures
from readloom.streaming import workqueue
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for t in ("events", "part"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sql, name):
    got = queries.QUERIES[name](spark, DATA)
    want = sql.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = want.select(*[duckdb.ColumnExpression(c) for c in got.columns]).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows))


def test_flagship(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 400
    assert set(queries.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("size", [1, 7, 64])
def test_binned_equals_direct(spark, size):
    r = random.Random(size)
    one = lambda: r.randint(-50, 150)
    spans = [(k, r.choice("ab"), s := one(), s + r.choice([0, 0, 1, 9, 70])) for k in range(150)]
    ivs = [(k, r.choice("abc"), one(), one()) for k in range(150)]
    left = spark.createDataFrame(spans, "s long, contig string, span_start long, span_stop long")
    right = spark.createDataFrame(ivs, "i long, contig string, start long, stop long")
    want = sorted((a, b) for a, c, x, y in spans for b, d, p, q in ivs if c == d and max(p, q) >= x and min(p, q) <= y)
    for strategy in ("direct", "binned", "auto"):
        got = overlap.overlap_join(left, right, strategy, size).select("s", "i").collect()
        assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("square", [3, 4096])
def test_joins_of_short_and_long_equal_direct(spark, monkeypatch, square):
    monkeypatch.setattr(overlap, "SQUARE", square, raising=False)
    r = random.Random(square)
    one = lambda: r.choice([None, 7, r.randint(-500, 1500), r.randint(-500, 1500)])
    ends = lambda most: (s := one(), None if s is None else s + r.choice([-1, 0, 0, 1, 40, 2000, most]))
    left = spark.createDataFrame([(k, r.choice(["a", "a", "b", None]), *ends(10**7)) for k in range(200)], "s long, contig string, span_start long, span_stop long")
    right = spark.createDataFrame([(k, r.choice(["a", "a", "c", None]), *ends(10**6)) for k in range(200)], "i long, contig string, start long, stop long")
    for join, least in ((overlap.overlap_join, 1000), (overlap.contained, 300)):
        rows = lambda *how: sorted(map(tuple, join(left, right, strategy=how[0], bin_size=how[1]).select("contig", "s", "i", "start", "stop", "span_start", "span_stop").collect()))  # noqa: B023, E731
        want = rows("direct", None)
        assert len(want) > least and rows("binned", None) == want and rows("binned", 256) == want


@pytest.mark.parametrize("join", [overlap.overlap_join, overlap.contained])
def test_pairs_of_one_bin_are_made_by_many_tasks(spark, monkeypatch, join):
    monkeypatch.setattr(overlap, "SQUARE", 50, raising=False)
    spans = spark.range(300, numPartitions=1).selectExpr("id as s", "'a' as contig", "0L as span_start", "15000L as span_stop")
    intervals = spark.range(300, numPartitions=1).selectExpr("id as i", "'a' as contig", "8000L as start", "8010L as stop")
    tasks = [r.n for r in join(spans, intervals, strategy="binned", bin_size=64).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 300 * 300 and len(tasks) >= 3 and max(tasks) < 0.6 * sum(tasks)


def test_copies_grow_with_rows_not_with_pairs(spark, monkeypatch):
    """Each row was copied for every few rows of the other side that its bin has, so ten times the input had a hundred times the rows to shuffle."""
    monkeypatch.setattr(overlap, "SQUARE", 5)

    def copies(n):
        side = lambda name: spark.range(n).selectExpr(f"id as {name}", "'a' as contig", "3 as bin_level", "0L as bin_at")
        return [rows.count() for rows in overlap._dealt(side("s"), side("i"), 4)]

    assert copies(4) == [4, 4]
    few, many = copies(400), copies(4000)
    assert max(few) <= 400 * 6 and max(many) <= 4000 * 6  # 4 partitions, 8 squares each: 6 on a side
    monkeypatch.setattr(overlap, "LARGEST", 100)
    assert copies(4000) == [4000 * 40] * 2


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_intervals_that_are_alike_are_met_once(spark, monkeypatch, kind):
    """Each of many equal intervals was compared with each span; doubles, of which 0.0 and -0.0 would be one, still are."""
    met = []
    monkeypatch.setattr(overlap, "_met", lambda left, right, touch, f=overlap._met: met.append(right.count()) or f(left, right, touch))
    spans = spark.range(40).selectExpr("id as s", "'a' as contig", "id * 3 as span_start", "id * 3 + 20 as span_stop")
    some = spark.range(60).selectExpr(f"cast(id % 6 as {kind}) as i", "'a' as contig", "id % 3 * 10 as start", "id % 3 * 10 + 8 as stop", "if(id % 6 = 5, null, 'x') as note")
    for join in (overlap.overlap_join, overlap.contained):
        rows = lambda how: sorted(map(str, join(spans, some, strategy=how, bin_size=64).select("contig", "s", "i", "start", "stop", "span_start", "span_stop", "note").collect()))  # noqa: B023, E731
        assert len(rows("direct")) > 100 and rows("binned") == rows("direct")
    assert (max(met) <= 6 * 4) == (kind == "bigint")


def test_rescue_needs_one_candidate(spark):
    barcodes = spark.createDataFrame([("x", "AAAA"), ("y", "AATT"), ("z", "CCCC")], "name string, b1 string")
    keys = ["AAAAGG", "AAAT", "CCNC", "CC", None, "GGGG", "AAAC", "NNCC"]
    reads = spark.createDataFrame(list(enumerate(keys)), "ordinal long, barcode_base string")
    got = [(r.sample, r.status) for r in demux.assign(reads, barcodes, 4).orderBy("ordinal").collect()]
    assert got == [("x", "exact"), (None, "rejected"), ("z", "rescued"), (None, "rejected"), (None, "rejected"), (None, "rejected"), ("x", "rescued"), (None, "rejected")]


def test_stitch_needs_all_barcodes(spark):
    reads = spark.createDataFrame([(0, "A"), (1, "C")], "ordinal long, base string")
    assert demux.stitch(reads, spark.createDataFrame([(0, "X"), (1, "Y"), (2, "Z")], "ordinal long, base string")).count() == 2
    with pytest.raises(Exception, match="no barcode read"):
        demux.stitch(reads, spark.createDataFrame([(0, "X")], "ordinal long, base string")).select("barcode_base").collect()


@pytest.mark.parametrize("size", [1, 2, 100])
def test_chunks(spark, size):
    rows = spark.createDataFrame([(k * 3, "ab"[k % 2]) for k in range(11)], "ordinal long, sample string")
    got = chunking.chunked(rows, size, stretch=4).orderBy("ordinal").collect()
    seen = {}
    for r in got:
        n = seen.setdefault(r.sample, 0)
        seen[r.sample] += 1
        assert (r.row, r.chunk, r["first"]) == (n, n // size, n // size * size)
    with pytest.raises(ValueError):
        chunking.chunked(rows, 0)


def test_interleave_needs_pairs(spark):
    one = spark.createDataFrame([(0, "a"), (1, "b")], "ordinal long, base string")
    two = spark.createDataFrame([(0, "c"), (1, "d")], "ordinal long, base string")
    assert [r.base for r in chunking.interleaved(one, two).orderBy("ordinal").collect()] == ["a", "c", "b", "d"]
    with pytest.raises(ValueError):
        chunking.interleaved(one, two.limit(1))


def test_cigars(spark):
    df = spark.createDataFrame([("4S20M2D8M",), ("",), ("*",), (None,), ("M3I",), ("5H10M2P3=1X",)], "c string")
    got = df.select(cigar.query_length(F.col("c")).alias("q"), cigar.reference_span(F.col("c"), F.lit(9)).alias("r"), cigar.tokens(F.col("c")).alias("t")).collect()
    assert [r.q for r in got] == [32, 0, 0, None, 3, 14] and [r.r for r in got] == [30, 9, 9, 9, 0, 14]
    assert [tuple(t) for t in got[4].t] == [(0, "M"), (3, "I")]


def test_unpaired_flags(spark):
    r = spark.range(1).select(*[flags.predicate(n, F.lit(0)).alias(n) for n in flags.PREDICATES]).first()
    assert {n for n in flags.PREDICATES if r[n]} == {"is_primary", "is_discordant", "is_mapped", "is_next_mapped", "is_forward_strand"}


def test_contig_of_interest(spark):
    contigs = spark.createDataFrame([(0, "chr1"), (1, "v|MN985325.1"), (2, "MN985325.2")], "ref_index int, name string")
    assert alignments.contig_of_interest(contigs, "MN985325") == 1 and alignments.contig_of_interest(contigs, "none") == -1
    rows = spark.createDataFrame([(0, 1, "a"), (1, 2, "b")], "ordinal long, ref_index int, aln string")
    assert [r.aln for r in alignments.null_other_contigs(rows, 1).orderBy("ordinal").collect()] == ["a", None]
    assert alignments.null_other_contigs(rows, -1) is rows
    with pytest.raises(ValueError):
        alignments.row_range(rows, 5, 4)


def test_matrix_file(spark, tmp_path):
    x = Fixtures(spark, DATA)
    counts = genecount.gene_counts(x.alignments, x.features)
    genecount.write_matrix(counts, x.features, ["T0A", "T0B"], f"{tmp_path}/m")
    got = spark.read.csv(f"{tmp_path}/m", header=True).collect()
    assert len(got) == 100 and got[0].gene_id.startswith("ENSG0(") and got[0].asDict().keys() == {"gene_id", "T0A", "T0B"}


def test_align_recovers_places(spark):
    r = random.Random(1)
    contigs = ["".join(r.choices("ACGT", k=3000)) for _ in range(3)]
    comp = str.maketrans("ACGT", "TGCA")
    rows, want = [], {}
    for k in range(200):
        c, p, n = r.randrange(3), r.randrange(2900), r.randint(50, 90)
        s = list(contigs[c][p : p + n])
        for _ in range(r.randint(0, 2)):
            j = r.randrange(len(s))
            s[j] = r.choice("ACGT")
        s, back = "".join(s), r.random() < 0.5
        rows.append((k, s.translate(comp)[::-1] if back else s))
        want[k] = (c, p, 16 if back else 0, f"{len(s)}M")
    rows += [(200, "ACGT" * 5), (201, "N" * 60), (202, "".join(r.choices("ACGT", k=60)))]
    ref = spark.createDataFrame([(i, f"c{i}", s) for i, s in enumerate(contigs)], "ref_index int, name string, sequence string")
    got = {x.ordinal: x.aln for x in align.align(spark.createDataFrame(rows, "ordinal long, base string"), ref).collect()}
    for k, (c, p, flag, text) in want.items():
        assert (got[k].position.ref_index, got[k].position.position, got[k].flag, got[k].cigar) == (c, p, flag, text)
    assert all(got[k].flag == 4 and got[k].position.contig == "*" and got[k].position.ref_index == -1 for k in (200, 201, 202))


def test_template_length(spark):
    df = spark.createDataFrame([(10, 20, 50, 60), (50, 60, 10, 20)], "a int, b int, c int, d int")
    assert [r[0] for r in df.select(pairs.template_length(*map(F.col, "abcd"))).collect()] == [50, -50]


def test_queue_goes_on_after_restart(spark, tmp_path):
    paths = lambda a, b: spark.createDataFrame([(f"ds_{k}",) for k in range(a, b)], "path string")
    run = lambda **how: workqueue.process(workqueue.messages(spark, f"{tmp_path}/q", 2), lambda found: found, f"{tmp_path}/done", f"{tmp_path}/ck", **how)
    workqueue.push(paths(0, 9).repartition(3), f"{tmp_path}/q", "pool")
    q = run()
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 9 and len([p for p in q.recentProgress if p["numInputRows"]]) >= 2
    workqueue.push(paths(9, 12), f"{tmp_path}/q")
    run().awaitTermination()
    assert sorted(r.obj_name for r in workqueue.completed(spark, f"{tmp_path}/done").collect()) == sorted(f"ds_{k}" for k in range(12))
    q = run(forever=True)
    workqueue.push(paths(12, 14), f"{tmp_path}/q")
    q.processAllAvailable()
    q.stop()
    assert workqueue.completed(spark, f"{tmp_path}/done").count() == 14


def test_bins(spark):
    df = spark.createDataFrame([(0, 1), (16383, 16385), (0, 1 << 20), (-1, 0), (0, 1 << 29)], "a long, b long")
    got = [r[0] for r in df.select(sequence.bam_bin(F.col("a"), F.col("b"))).collect()]
    assert got == [4681, 585, 73, 4680, 0]
