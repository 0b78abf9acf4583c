import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from readloom.llm import line_dedup, simhash_texts, substring_dedup

from . import brute
from .test_near import made

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(r, n):
    return ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def edited(r, base, n):
    w = list(base)
    for k in r.sample(range(len(w)), n):
        w[k] = "new" + w[k]
    return w


def stage(spark, name, rows, folder="/root/testdata/sf0.001"):
    import corpus_pipeline as cp

    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(3)
    return [(x.doc_id, x.text) for x in dict(cp.STAGES)[name](spark, df, folder).collect()]


def test_no_near_copies_are_left(spark):
    r = random.Random(5)
    rows = list(made())
    for _ in range(12):
        base = words(r, r.choice([60, 200, 500]))
        rows += [(len(rows) + k, " ".join(edited(r, base, r.randint(0, len(base) // 50)))) for k in range(8)]
    rows += [(None, rows[-1][1]), (None, "on its own"), (None, "on its own"), (7, "another of that id")]
    got = stage(spark, "SimHash near-dedup", rows)
    near = lambda a, b: brute.jaccard(a, b) >= 0.8
    assert not [1 for i, a in enumerate(got) for b in got[:i] if near(a[1], b[1])]
    low = {}
    for (i, t), c in zip(rows, brute.components([t for _, t in rows], near)):
        low.setdefault(c, []).append((i is None, i or 0, t or ""))
    kept = {(i is None, i or 0, t or "") for i, t in got}
    assert len(kept) == len(got) and all(min(x) in kept for x in low.values())
    assert (None, "on its own") in got and (7, "another of that id") in got


def test_many_nodes_at_one_key(spark, monkeypatch):
    r = random.Random(6)
    base = words(r, 300)
    rows = [(k, " ".join(edited(r, base, 25))) for k in range(60)]  # about 0.3 alike
    rows += [(100 + k, " ".join(edited(r, rows[k][1].split(), 2))) for k in range(60)]  # near one each
    monkeypatch.setattr(simhash_texts, "FIRST", 1)
    assert sorted(i for i, _ in stage(spark, "SimHash near-dedup", rows)) == list(range(60))


@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_stages_take_odd_tables(spark, kind):
    import corpus_pipeline as cp

    folder = "/root/testdata/sf0.001"
    some = spark.read.parquet(f"{folder}/documents.parquet").limit(30)
    if kind == "empty":
        docs = some.where("false")
    else:
        nothing = some.limit(3).select(*[F.lit(None).cast(t).alias(c) for c, t in some.dtypes])
        docs = some.unionByName(nothing).unionByName(some.limit(4)).unionByName(some.limit(5).withColumn("doc_id", F.lit(None).cast("long")))
        docs = docs.unionByName(some.limit(5).withColumn("text", F.lit("")).withColumn("doc_id", F.col("doc_id") + 900))
    docs = docs.selectExpr("*", "1 AS d", "'a' AS t", "2 AS node", "'k' AS key", "3 AS text_hash", "4 AS n", "5 AS row", "6 AS low", "true AS stays", "7 AS kept", "8 AS bucket")
    n, texts = docs.count(), len({(r.text or "") for r in docs.select("text").collect()})
    for name, stage in cp.STAGES:
        got = stage(spark, docs, folder).collect()
        if kind == "empty":
            assert got == [], name
        elif name == "line dedup":
            assert len(got) == n
        elif name == "SimHash near-dedup":
            assert 1 < len(got) <= texts and len({(r.text or "").strip() for r in got}) == len(got)
        elif name == "packing":
            assert len({(r.sequence_id, r.offset) for r in got}) == len(got) >= n
        else:
            assert 0 < len(got) <= n and {(r.doc_id, r.text) for r in got} <= {(r.doc_id, r.text) for r in docs.collect()}, name


def test_texts_of_a_million_words(spark):
    r = random.Random(9)
    long = " ".join(r.choices([f"w{k}" for k in range(5000)], k=1_000_000))
    rows = [(1, long), (2, long + " and more"), (3, "a short one"), (4, "\n".join(f"line {k % 1000}" for k in range(200_000)))]
    kept = stage(spark, "SimHash near-dedup", rows)
    assert sorted(i for i, _ in kept) == [1, 3, 4]
    assert sorted(i for i, _ in stage(spark, "benchmark decontamination", rows)) == [1, 2, 3, 4]
    pieces = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    assert {x.doc_id: x.n_words for x in substring_dedup.remove_repeats(pieces).collect()} == {i: len(t.split()) for i, t in rows}
    shared = [(i, "\n".join([f"line {k}" for k in range(20_000)]), "en", f"s{i}", 1) for i in range(12)]
    got = {x.doc_id: x.text for x in line_dedup.remove_shared_lines(spark.createDataFrame(shared, SCHEMA)).collect()}
    assert got[0] == shared[0][1] and all(got[i] == "" for i in range(1, 12))


def test_near_is_exact():
    a = np.arange(9, dtype=np.uint64)
    assert simhash_texts.near(a[:8], a[:8]) and simhash_texts.near(a[:4], a[:5]) and not simhash_texts.near(a[:7], a)


def test_bitmaps_bound_the_differing_shingles():
    r = np.random.default_rng(3)
    for n in (1, 7, 200, 5000):
        a, b = (np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)) for _ in range(2))
        b = np.union1d(r.permutation(b)[: n // 4], r.permutation(a)[n // 8 :])
        differ = len(np.setxor1d(a, b))
        bits = sum(int(x).bit_count() for x in (simhash_texts.bitmap(a) ^ simhash_texts.bitmap(b)).view(np.uint64))
        assert bits <= differ and (n != 200 or bits > 0.7 * differ)


def test_near_copies_go_by_row(spark):
    r = random.Random(7)
    texts = [" ".join(words(r, 80)) for _ in range(6)]
    rows = [(1, texts[0]), (5, texts[0]), (5, texts[1]), (5, texts[2]), (5, texts[2]), (None, texts[1]), (None, texts[3]), (None, texts[3]), (None, texts[4])]
    want = [(1, texts[0]), (5, texts[1]), (5, texts[2]), (None, texts[3]), (None, texts[4])]
    assert sorted(map(repr, stage(spark, "SimHash near-dedup", rows))) == sorted(map(repr, want))


def test_contaminated_rows_go_by_row(spark):
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").where("length(text) > 60").first().text
    rows = [(1, item), (1, "clean text"), (None, item), (None, "clean as well"), (2, None)]
    assert sorted(map(repr, stage(spark, "benchmark decontamination", rows))) == sorted(map(repr, [(1, "clean text"), (None, "clean as well"), (2, None)]))
