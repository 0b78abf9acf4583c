import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from readloom.sources import chunk_format, chunk_source, messages
from readloom.sources.store import Store

SCHEMA = "ordinal long, meta string, aln struct<flag: int, mapping_quality: int, position: struct<position: bigint, ref_index: int, contig: string>, next_position: struct<position: bigint, ref_index: int, contig: string>, template_length: bigint, cigar: string>"


def aln(ref, position):
    return {"flag": 0, "mapping_quality": 1, "position": {"position": position, "ref_index": ref, "contig": f"c{ref}"}, "next_position": {"position": -1, "ref_index": -1, "contig": ""}, "template_length": 0, "cigar": f"{position % 50 + 1}M"}


def made(r, n, contigs=4, longest=2000, step=1):
    places = sorted((r.randrange(-1, contigs), r.randrange(longest) // step * step) for _ in range(n))
    return [(k, f"m{r.randrange(5)}", aln(*p)) for k, p in enumerate(places)]


@pytest.fixture(params=["sorted", "unsorted", "holes"])
def dataset(request, spark, tmp_path):
    r = random.Random(4)
    rows = made(r, 1000, step=50)
    if request.param != "sorted":
        places = [x[2] for x in rows]
        if request.param == "unsorted":
            r.shuffle(places)
        rows = [(k, m, None if request.param == "holes" and k % 11 == 0 else p) for (k, m, _), p in zip(rows, places, strict=True)]
    chunk_source.write(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/ds", "ds", 64)
    return request.param, f"{tmp_path}/ds", rows


def inside(rows, test):
    return sorted((k, m, a["position"]["ref_index"], a["position"]["position"]) for k, m, a in rows if a and test(a["position"]["ref_index"], a["position"]["position"]))


def test_filters_on_places(spark, dataset):
    kind, folder, rows = dataset
    ref, position = F.col("aln.position.ref_index"), F.col("aln.position.position")
    cases = [
        ((ref == 2) & (position >= 500) & (position < 800), lambda a, p: a == 2 and 500 <= p < 800),
        (ref == 1, lambda a, p: a == 1),
        ((ref > 0) & (ref <= 2), lambda a, p: 0 < a <= 2),
        ((ref >= 1) & (position == 700), lambda a, p: a >= 1 and p == 700),
        ((ref == 2) & (position > 300), lambda a, p: a == 2 and p > 300),
        ((ref == 9) | (position < 0), lambda a, p: a == 9 or p < 0),
        ((ref == 0) & (position == 550) & (F.col("ordinal") > 100), None),
        (ref < 0, lambda a, p: a < 0),
    ]
    for where, test in cases:
        found = chunk_source.load(spark, folder).where(where)
        got = sorted((r.ordinal, r.meta, r.aln.position.ref_index, r.aln.position.position) for r in found.collect())
        want = [x for x in inside(rows, lambda a, p: a == 0 and p == 550) if x[0] > 100] if test is None else inside(rows, test)
        assert got == want
    few, every = chunk_source.load(spark, folder).where(cases[0][0]), chunk_source.load(spark, folder)
    assert every.rdd.getNumPartitions() == 16
    if kind != "unsorted":
        assert few.rdd.getNumPartitions() <= 4  # the chunks that are opened


def test_a_sorted_chunk_is_searched_not_read(monkeypatch):
    r = random.Random(1)
    column = pa.array([a for _, _, a in made(r, 5000, step=20)], messages.ALIGNMENT)
    assert chunk_source.zone(column)["sorted"]
    body = chunk_format.decode_body(chunk_format.encode_body(*messages.encode(column), "x", 0, chunk_format.STRUCTURED))
    keys = [(x["position"]["ref_index"], x["position"]["position"]) for x in column.to_pylist()]
    read, places = [], messages.places
    monkeypatch.setattr(messages, "places", lambda *a: read.append(len(a[1])) or places(*a))
    for here in [(1, 500), (1, 501), (-1, 0), (-5, 0), (9, 9), keys[0], keys[-1]]:
        read.clear()
        assert chunk_source.bound(body, here) == sum(k < here for k in keys)
        assert chunk_source.bound(body, here, after=True) == sum(k <= here for k in keys)
        assert sum(read) <= 26


def test_zones():
    column = lambda *p: pa.array([x and aln(*x) for x in p], messages.ALIGNMENT)
    assert chunk_source.zone(column((0, 5), (0, 5), (2, 1))) == {"low": [0, 5], "high": [2, 1], "sorted": True}
    assert chunk_source.zone(column((0, 5), None, (2, 1))) == {"low": [0, 5], "high": [2, 1], "sorted": False}
    assert chunk_source.zone(column((2, 1), (0, 5))) == {"low": [0, 5], "high": [2, 1], "sorted": False}
    assert chunk_source.zone(column(None, None)) is None and chunk_source.zone(column()) is None


def test_look_up(spark, dataset):
    kind, folder, rows = dataset
    r = random.Random(7)
    wanted = [(a["position"]["ref_index"], a["position"]["position"], m, n) for n, (_, m, a) in enumerate(rows) if a and n % 9 == 0]
    wanted += [(r.randrange(-1, 5), r.randrange(0, 2000, 50), "m1", -n) for n in range(1, 40)] + [(None, 5, "m1", 9000), (1, None, "m1", 9001), (1, 50, None, 9002), (0, 3, "m1", 9003), wanted[0][:3] + (9004,)]
    df = spark.createDataFrame(wanted, "ref_index int, position long, meta string, asked long")
    of = {}
    for k, m, a in rows:
        if a:
            of.setdefault((a["position"]["ref_index"], a["position"]["position"]), []).append((k, m, a["cigar"]))
    got = chunk_source.look_up(spark, folder, df)
    assert got.columns == ["ref_index", "position", "meta", "asked", "ordinal", "aln"]
    assert sorted((x.asked, x.ordinal, x.meta, x.aln.cigar) for x in got.collect()) == sorted((n, *hit) for a, p, m, n in wanted for hit in of.get((a, p), []) if hit[1] == m)
    places = chunk_source.look_up(spark, folder, df.drop("meta"), ["meta"])
    assert places.columns == ["ref_index", "position", "asked", "ordinal", "meta"]
    assert sorted((x.asked, x.ordinal, x.meta) for x in places.collect()) == sorted((n, k, m) for a, p, _, n in wanted for k, m, _ in of.get((a, p), []))
    with pytest.raises(ValueError, match="no column base"):
        chunk_source.look_up(spark, folder, df, ["base"])


def test_appended_alignments_have_zones(spark, tmp_path):
    rows = made(random.Random(2), 300)
    df = spark.createDataFrame(rows, SCHEMA)
    chunk_source.write(df.select("ordinal", "meta"), f"{tmp_path}/ds", "ds", 100)
    assert "zone" not in json.loads(Store(f"{tmp_path}/ds").read("metadata.json"))["records"][0]
    chunk_source.append_column(spark, f"{tmp_path}/ds", df, "aln")
    zones = [r["zone"] for r in json.loads(Store(f"{tmp_path}/ds").read("metadata.json"))["records"]]
    key = [[a["position"]["ref_index"], a["position"]["position"]] for _, _, a in rows]
    assert zones == [{"low": key[k], "high": key[k + 99], "sorted": True} for k in (0, 100, 200)]
    assert chunk_source.load(spark, f"{tmp_path}/ds", ["meta"]).where("ordinal < 50").count() == 50


# streams


def arrive(spark, folder, low, high):
    spark.range(low, high).select(F.col("id").alias("ordinal"), F.concat(F.lit("b"), "id").alias("base")).coalesce(1).write.mode("append").parquet(folder)


def run(spark, source, folder, checkpoint, **options):
    chunk_source.register(spark)
    found = spark.readStream.schema("ordinal bigint, base string").option("maxFilesPerTrigger", 1).parquet(source)
    found.writeStream.format("readchunks").options(chunk=50, dataset="ds", **options).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder).awaitTermination()


def test_stream_sink_restarts_without_loss_or_repeats(spark, tmp_path):
    source, folder, checkpoint = f"{tmp_path}/in", f"{tmp_path}/ds", f"{tmp_path}/check"
    arrive(spark, source, 0, 120)
    run(spark, source, folder, checkpoint)
    arrive(spark, source, 200, 330)
    arrive(spark, source, 120, 200)
    run(spark, source, folder, checkpoint)
    # the last commit is forgotten by the checkpoint, as if the driver had died after the manifest was written
    commits = sorted(int(p.name) for p in (tmp_path / "check/commits").iterdir() if p.name.isdigit())
    for p in (tmp_path / "check/commits").iterdir():
        if p.name.strip(".").split(".")[0] == str(commits[-1]):
            p.unlink()
    before = Store(folder).names()
    run(spark, source, folder, checkpoint)
    assert Store(folder).names() == before  # files of the repeated batch are deleted
    got = chunk_source.load(spark, folder).orderBy("ordinal").collect()
    assert [(r.ordinal, r.base) for r in got] == [(k, f"b{k}") for k in range(330)]
    found = json.loads(Store(folder).read("metadata.json"))
    assert [r["number"] for r in found["records"]] == list(range(1, len(found["records"]) + 1)) and found["batches"] == {"": commits[-1]}
    assert chunk_source.read_chunks(spark, folder, ["base"]).count() == 330
    arrive(spark, f"{tmp_path}/more", 400, 420)
    run(spark, f"{tmp_path}/more", folder, f"{tmp_path}/check2", stream="second")  # another stream's first batch is no repeat
    assert chunk_source.load(spark, folder).count() == 350
    arrive(spark, f"{tmp_path}/twice", 0, 20)
    with pytest.raises(Exception, match="overlap"):
        run(spark, f"{tmp_path}/twice", folder, f"{tmp_path}/check3", stream="third")
    assert chunk_source.load(spark, folder).count() == 350


def test_stream_reads_chunks_that_come_before_others(spark, tmp_path):
    folder, out = f"{tmp_path}/ds", f"{tmp_path}/out"

    def read():
        chunk_source.register(spark)
        spark.readStream.format("readchunks").load(folder).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start(out).awaitTermination()
        return sorted(r.ordinal for r in spark.read.schema("ordinal bigint, base string").parquet(out).collect())

    arrive(spark, f"{tmp_path}/a", 100, 220)
    run(spark, f"{tmp_path}/a", folder, f"{tmp_path}/c1", stream="a")
    assert read() == list(range(100, 220))
    arrive(spark, f"{tmp_path}/b", 0, 100)
    run(spark, f"{tmp_path}/b", folder, f"{tmp_path}/c2", stream="b")
    assert read() == list(range(220))
    chunk_source.write(spark.range(10).select(F.col("id").alias("ordinal"), F.lit("x").alias("base")), folder, "ds", 50, "overwrite")
    with pytest.raises(Exception, match="overwritten"):
        read()


def test_places_of_many_chunks_are_looked_up_once(spark, tmp_path, monkeypatch):
    """1500 reads at one place, in 15 chunks and with others at both ends: each of these chunks is opened by one task."""
    place = lambda ref, p: {"flag": 0, "mapping_quality": 0, "position": {"position": p, "ref_index": ref, "contig": ""}, "next_position": {"position": -1, "ref_index": -1, "contig": ""}, "template_length": 0, "cigar": ""}
    rows = [(k, f"m{k % 1400}", place(*((-1, 0) if k < 1450 else (1, k // 3)))) for k in range(3000)]
    chunk_source.write(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/ds", "ds", 100)
    wanted = [(a["position"]["ref_index"], a["position"]["position"], m, n) for n, (_, m, a) in enumerate(rows) if n % 4 == 0] + [(-1, 0, None, 9000), (-1, 0, "m2", 9001), (-1, 0, "none", 9002)]
    of = {}
    for k, m, a in rows:
        of.setdefault((a["position"]["ref_index"], a["position"]["position"], m), []).append(k)
    df = spark.createDataFrame(wanted, "ref_index int, position long, meta string, asked long")
    expected = sorted((n, k) for a, p, m, n in wanted for k in of.get((a, p, m), []))
    assert sorted((r.asked, r.ordinal) for r in chunk_source.look_up(spark, f"{tmp_path}/ds", df).collect()) == expected
    zones = chunk_source.Zones(json.loads(Store(f"{tmp_path}/ds").read("metadata.json"))["records"])
    assert zones.n((-1, 0)) == 15 and zones.crowded() == list(range(15)) and zones.holding((1, 999)) == [29]
    every = chunk_source.look_up(spark, f"{tmp_path}/ds", df.where("asked >= 9000").drop("meta"), ["meta"])
    assert every.count() == 3 * 1450
