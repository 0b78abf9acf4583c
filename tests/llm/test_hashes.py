import random
import zlib

import numpy as np
import pytest
from readloom.llm import common, lm_scoring, positional_index, substring_dedup


def doubled(n, a="a", b="b"):
    """The Thue-Morse word of 2**n letters and its complement: sums of odd numbers' powers modulo 2**64 can't tell them apart from n = 10 on."""
    x, y = a, b
    for _ in range(n):
        x, y = x + y, y + x
    return x, y


def test_hashes_tell_patterns_apart():
    for n in range(3, 15):
        for a, b in (("a", "b"), ("ab", "cd"), ("abcdefgh", "hgfedcba")):
            x, y = doubled(n, a, b)
            h = common.Words([f"{x} {y} {x}".encode()]).hashes()
            assert h[0] == h[2] != h[1]
            items = np.array([hash(c) & (1 << 62) - 1 for c in x] + [hash(c) & (1 << 62) - 1 for c in y] + [hash(c) & (1 << 62) - 1 for c in x], np.uint64)
            s = common.span_hashes(items, np.array([0, len(x), 2 * len(x)]), np.array([len(x), 2 * len(x), 3 * len(x)]))
            assert s[0] == s[2] != s[1]


def test_hashes_depend_on_bytes_alone():
    r = random.Random(1)
    words = ["".join(r.choices("abc", k=r.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 63, 64, 511, 512, 513, 2000]))) for _ in range(3000)]
    found = dict(zip(words, common.Words([" ".join(words).encode()]).hashes().tolist(), strict=True))
    assert len(set(found.values())) == len(set(words))
    r.shuffle(words)
    assert common.Words([w.encode() for w in words]).hashes().tolist() == [found[w] for w in words]


def test_span_hashes_are_those_of_the_sums():
    r = np.random.default_rng(2)
    h = r.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)
    p, base = (1 << 61) - 1, common._IN_SPAN.bases[0]
    start = r.integers(0, 400, 50)
    end = np.minimum(400, start + r.integers(0, 300, 50))
    plain = [sum(int(x) % p * pow(base, k, p) for k, x in enumerate(h[a:b])) % p + (b - a) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
    assert common.span_hashes(h, start, end).tolist() == common.mixed(np.array(plain, np.uint64)).tolist()


@pytest.mark.parametrize("n", [7, 10, 14])
def test_operators_tell_patterns_apart(spark, n):
    x, y = doubled(n)
    shared = " ".join(f"w{k}" for k in range(34))
    docs = spark.createDataFrame([(1, f"{shared} {x}"), (2, f"{shared} {y}")], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.remove_repeats(docs).collect()] == [0, 0]
    items = spark.createDataFrame([(1, x)], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in positional_index.contamination(docs, items).collect()} == {1: 1, 2: 0}
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][0]
    taught = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 != 1][0]
    scores = lm_scoring.score(spark.createDataFrame([(taught, x), (held, y)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_known for r in scores} == {taught: 2, held: 1}
