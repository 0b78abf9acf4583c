import bisect
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from readloom.llm import packing, token_links
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

TEXTS = ["the cat and the dog", "the the the", "  two  spaces \n x <|endoftext|> <s> a", "own ▁ sign", " ", "\n\n", "aaaa" * 900 + " " * 300 + "bb" * 700, "漢字テスト emoji 😀😀 é ﬁ", "tab\tand  more 　 spaces\n  indented\n\tlines  ", "x" * 70_000 + " y " + "z" * 5, "don't  it's 1234 567", "", None]


def plain(rows):
    """What the operator returns, from both libraries as they are."""
    a_side, b_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_side.encode_special_tokens = True
    byte = packing.byte_values()

    def piece(i):
        p = b_side.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()

    own, count = [], Counter()
    for _, text in rows:
        sides = [(i, bytes(byte[c] for c in a_side.id_to_token(i))) for i in a_side.encode(f" {text}", add_special_tokens=False).ids], [(i, piece(i)) for i in b_side.encode(text)] if text else []
        if not text or any(b"".join(t for _, t in s) != f" {text}".encode() for s in sides):
            own.append(None)
            continue
        ends = [np.cumsum([len(t) for _, t in s]).tolist() for s in sides]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in common]
        for k in (0, 1):
            for (i, _), e in zip(sides[k], ends[k], strict=True):
                groups[bisect.bisect_left(common, e)][k].append(i)
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        count.update(links.keys())
        own.append((len(sides[0]), len(sides[1]), groups, links))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (i, _), found in zip(rows, own, strict=True):
        if found is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((i, n_a, n_b, len(groups), links.total(), sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()), hashlib.sha256(shown.encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("how", [{}, {"block_bytes": 2000, "count_blocks": 2, "link_blocks": 2, "stripes": 61}])
def test_links_equal_the_libraries(spark, how):
    some = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 40").collect()]
    rows = [*enumerate(TEXTS), *((100 + k, t) for k, t in enumerate(some)), (7, "the cat"), (7, "the cat"), (None, "the cat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("n_a", F.lit("x"))
    found = token_links.align(docs, **how)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, map(tuple, found.collect()))) == plain(rows)


def test_large_groups_are_paired_by_distinct_ids(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(TEXTS) if t]
    known = token_links.Segments(token_links._pair(packing.vocabulary_file(), token_links.piece_file()))
    monkeypatch.setattr(token_links, "PLAIN_PAIRS", 0)
    other = token_links.Segments(known.both)
    for s in (known, other):
        s.numbers([x for _, t in rows for x in token_links.segments(t)])
    other.encode()
    monkeypatch.undo()
    known.encode()
    assert (known.sums == other.sums).all() and (known.begin == other.begin).all() and (known.pairs == other.pairs).all() and (known.times == other.times).all()


def test_odd_bytes_and_empty_tables(spark):
    assert token_links.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    odd = spark.createDataFrame([(1, bytearray(b"\xff\xfe cat")), (2, bytearray(b"a cat"))], "doc_id long, raw binary").selectExpr("doc_id", "CAST(raw AS STRING) AS text")
    got = {r.doc_id: r for r in token_links.align(odd).collect()}
    assert got[1].n_a == 0 and got[1].groups_sha256 == "" and got[2].n_a == 2


def test_a_million_spaces_and_words(spark):
    long = "a" + " " * 1_000_000 + "b"
    words = "some words \n" * 300_000
    rows = [(1, long), (2, words)]
    got = {r.doc_id: r for r in token_links.align(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    a_side, b_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, t in rows:
        assert (got[i].n_a, got[i].n_b) == (len(a_side.encode(f" {t}", add_special_tokens=False).ids), len(b_side.encode(t)))


@pytest.mark.parametrize("texts", [["a ", "the cat ", "x  y ", "é 1 ", "plain"], ["x" * 70_000 + " ", "ab " * 30_000, "a"]])
def test_a_space_at_the_end_is_a_token(spark, texts):
    rows = list(enumerate(texts))
    out = token_links.align(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(repr(tuple(r)) for r in out.collect()) == plain(rows)
