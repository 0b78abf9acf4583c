import hashlib
import random

import pytest
from readloom.llm import minhash, queries, simhash, substring_dedup
from readloom.llm.common import Words, xxh64

from . import brute

DATA = "/root/testdata/sf0.001"


def made(seed=3, n=120):
    r = random.Random(seed)
    voc = ["".join(r.choice("abcdé😀ZQ") for _ in range(r.randint(1, 9))) for _ in range(300)]
    passage = [r.choice(voc) for _ in range(60)]
    out = []
    for i in range(n):
        w = [r.choice(voc) for _ in range(r.choice([0, 1, 2, 3, 5, 36, 80, 300]))]
        if i % 4 == 0:
            k = r.randint(0, len(w))
            w[k:k] = passage[r.randint(0, 20) :]
        out.append(r.choice([" ", "\n", "  ", "\t"]).join(w))
    out += ["", None, None, "a " * 200, "b c " * 60, "x" * 4000, out[7], out[8], out[8] + " tail", " \n ", out[4].upper()]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "block", 1) for i, t in made()]
    return spark.createDataFrame(rows, "doc_id long, text string, bucket string, wrap int").repartition(5)


def test_xxh64():
    import xxhash

    w = Words([t.encode() for _, t in made() if t])
    got = xxh64(w.data, w.start, w.end)
    assert [int(x) for x in got] == [xxhash.xxh64_intdigest(bytes(w.data[a:b]), 42) for a, b in zip(w.start, w.end)]


def test_simhash(docs):
    got = {r.doc_id: r for r in simhash.near_groups(simhash.fingerprints(docs)).collect()}
    keys = [brute.simhash(t) for _, t in made()]
    assert [got[i].fingerprint % (1 << 64) for i in range(len(keys))] == keys
    want = brute.components(keys, lambda a, b: (a ^ b).bit_count() <= 2)
    assert [got[i].component_id for i in range(len(keys))] == want


def test_simhash_links_through_others(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(40)]
    keys = list(base)
    for k in range(300):
        keys.append(keys[r.randrange(len(keys))] ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    found = spark.createDataFrame([(i, k - (1 << 64) if k >> 63 else k) for i, k in enumerate(keys)], "doc_id long, fingerprint long")
    got = {r.doc_id: r.component_id for r in simhash.near_groups(found).collect()}
    assert [got[i] for i in range(len(keys))] == brute.components(keys, lambda a, b: (a ^ b).bit_count() <= 2)


def test_repeats(docs):
    got = sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == brute.repeats(made())


def factors_hold(rows, texts, window):
    """Each factor's words also stand at its place in the reference, which is another place."""
    words, begin = {}, {}
    for k, r in enumerate(rows):  # blocks come out in the order of their texts
        begin[k] = len(words.setdefault(r.block_id, []))
        words[r.block_id] += brute.NONSPACE.findall(texts[r.doc_id] or "")
    for k, r in enumerate(rows):
        own = words[r.block_id][begin[k] :]
        covered = set()
        for f in r.factors:
            assert f.words >= window and own[f.start : f.start + f.words] == words[f.source_block][f.source_word : f.source_word + f.words]
            assert (f.source_block, f.source_word) != (r.block_id, begin[k] + f.start)
            covered |= set(range(f.start, f.start + f.words))
        assert len(covered) == r.n_removed and covered == {x for a, b in r.spans for x in range(a, b)}


def test_factors(spark):
    texts = dict(made())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = substring_dedup.remove_repeats(docs).collect()
    assert len({r.block_id for r in rows}) > 2 and sum(len(r.factors) for r in rows) > 20
    factors_hold(rows, texts, 35)
    r = random.Random(8)
    texts = {i: " ".join(r.choice("ab") for _ in range(r.randint(0, 60))) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    factors_hold(substring_dedup.remove_repeats(docs, window=7, gram=3).collect(), texts, 7)


def test_repeats_narrow_alphabet(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randint(0, 60)))) for i in range(60)]
    got = sorted((x.doc_id, x.n_words, x.n_removed, hashlib.sha256(x.kept.encode()).hexdigest()) for x in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=7, gram=3).collect())
    assert got == brute.repeats(rows, 7)


def test_minhash(docs):
    import numpy as np

    texts = [t or "" for _, t in made()]
    got = sorted(minhash.compared_with_next(docs).collect())
    assert [r.doc_id for r in got] == list(range(len(texts)))
    for i, r in enumerate(got):
        t, after = texts[i], texts[(i + 1) % len(texts)]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - brute.jaccard(t, edited)) < 0.2 and abs(r.near_next - brute.jaccard(t, after)) < 0.2
        assert (r.fingerprint == got[7].fingerprint) == (t == texts[7])
    assert np.mean([abs(r.near_edited - brute.jaccard(t, t[: len(t) - len(t) // 2] + a[: len(t) // 2])) for r, t, a in zip(got, texts, texts[1:] + texts[:1])]) < 0.03


def test_minhash_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 7)
    r = random.Random(2)
    ids = [*r.sample(range(-(10**12), 10**12), 60), None, 5, 5]
    rows = [(i, f"w{k} " * r.randint(0, 9)) for k, i in enumerate(ids)]
    got = minhash.compared_with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    by = {i: t for i, t in rows}
    order = sorted((i for i in ids if i is not None and i != 5))
    got = {r.doc_id: r for r in got}
    assert len(got) == len(set(ids))
    for a, b in zip(order, order[1:]):
        if not a < 5 < b:
            t = by[a]
            assert got[a].edited_sha256 == hashlib.sha256((t[: len(t) - len(t) // 2] + by[b][: len(t) // 2]).encode()).hexdigest()


def test_minhash_splits_a_doc_id_of_many_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(minhash, "BUCKET_ROWS", 10)
    r = random.Random(4)
    ids = [None] * 80 + [5] * 90 + [3, 6, 7, 10**12] * 5 + list(range(100, 160))
    docs = spark.createDataFrame([(i, " ".join(r.choices("abcdef", k=r.randint(0, 9)))) for i in ids] + [(5, "same")] * 40, "doc_id long, text string").repartition(3)
    rows = docs.select(F.coalesce("doc_id", F.lit(minhash.LEAST)).alias("k"), "text")
    bounds = minhash._bounds(rows)
    assert len(bounds) == len(set(bounds)) and sum(k == 5 for k, _ in bounds) > 4 and sum(k == minhash.LEAST for k, _ in bounds) > 4
    order = sorted(rows.select("k", F.xxhash64("text").alias("h"), "text").collect())
    want = sorted((a.k, hashlib.sha256((a.text[: len(a.text) - len(a.text) // 2] + b.text[: len(a.text) // 2]).encode()).hexdigest()) for a, b in zip(order, order[1:] + order[:1]))
    got = minhash.compared_with_next(docs).collect()
    assert sorted((minhash.LEAST if x.doc_id is None else x.doc_id, x.edited_sha256) for x in got) == want


@pytest.mark.parametrize("name", ["op1_document_fingerprints", "op8_substring_dedup", "op10_simhash_near_dedup"])
def test_empty_tables(spark, tmp_path, name):
    spark.read.parquet(f"{DATA}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
