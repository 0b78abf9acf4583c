import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from readloom.llm import importance

from . import brute


def expected(docs, target, share=5, least=20):
    """[doc_id, n_features, weight, score, rank] of rows (doc_id, text), from plain counts."""

    def found(text):
        w = brute.WORD.findall(brute.lower(text))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    own, s, t = [found(x) for _, x in docs], Counter(), Counter()
    for _, f in own:
        s.update(f)
    for x in target:
        t.update(found(x)[1])
    gain = [math.floor(1000 * math.log((t[k] + 1) * (s.total() + 10000) / ((s[k] + 1) * (t.total() + 10000)))) for k in range(10000)]
    out = []
    for (i, _), (_, f) in zip(docs, own, strict=True):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] for k in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((k for k in range(len(docs)) if own[k][0] >= least), key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0, out[k][1]))
    for rank, k in enumerate(able[: share * len(able) // 100]):
        out[k][4] = rank + 1
    return sorted(map(repr, map(tuple, out)))


def texts(n, seed=3):
    r = random.Random(seed)
    voc = [f"w{k}" for k in range(60)] + ["é" * 5, "Ünder", "漢字", "X" * 63, "y" * 64, "z" * 65, "q" * 300, "a" * 1000]
    return [" ".join(r.choices(voc, k=r.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("how", [{}, {"run_rows": 7, "step": 2}, {"share": 100}, {"share": 100, "run_rows": 11, "step": 1}, {"share": 0}])
def test_draw_equals_plain_counts(spark, how):
    docs = list(enumerate(texts(150))) + [(500, None), (501, ""), (502, " . "), (503, "-".join(["tie"] * 30)), (504, "b\0c " * 9), (505, "Same text " * 20), (505, "Same text " * 20), (505, "Same text " * 21), (None, "Same text " * 20), (None, "none " * 40)]
    target = [*texts(9, 8), None, ""]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    found = importance.resample(rows, spark.createDataFrame([(x,) for x in target], "text string"), **how)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(repr, map(tuple, found.collect()))) == expected(docs, target, how.get("share", 5))


def test_crc_of_runs():
    r = np.random.default_rng(5)
    data = r.integers(0, 256, 5000, dtype=np.uint8)
    start = r.integers(0, 4000, 300)
    end = start + r.integers(0, 900, 300)
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end, strict=True)]
    got = ~(importance.shifted(np.full(300, 0xFFFFFFFF, np.uint32), end - start) ^ importance.plain_states(data, start, end))
    assert got.tolist() == want
    for n in (0, 63, 64, 1 << 20, (1 << 20) + 77):
        assert int(~importance.shifted(np.array([0xFFFFFFFF], np.uint32), np.array([n]))[0] & 0xFFFFFFFF) == zlib.crc32(bytes(n))


def test_tournament_merges_runs():
    r = np.random.default_rng(2)
    for k in (1, 2, 3, 5, 16, 33):
        runs = [np.sort(r.integers(0, 20, r.integers(0, 9))) for _ in range(k)]
        pieces = [np.stack([x, np.full(len(x), i), np.arange(len(x))]) for i, x in enumerate(runs)]
        got = [(int(runs[i][at]), i, at) for i, at in importance.Tournament(pieces).take(sum(map(len, runs)))]
        assert got == sorted((int(v), i, at) for i, x in enumerate(runs) for at, v in enumerate(x))


def test_empty_tables_and_one_long_text(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b " * 20), (2, None)], "doc_id long, text string")
    assert importance.resample(none, some).collect() == []
    assert sorted(map(repr, map(tuple, importance.resample(some, none).collect()))) == expected([(1, "a b " * 20), (2, None)], [])
    long = " ".join(random.Random(1).choices([f"w{k}" for k in range(5000)], k=1_000_000))
    got = importance.resample(spark.createDataFrame([(1, long)], "doc_id long, text string"), some, share=100).first()
    assert (got.n_features, got["rank"]) == (2_999_997, 1)
