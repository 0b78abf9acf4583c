import zlib

import numpy as np
import public_tokenizers
from readloom.llm import packing, queries
from tokenizers import Tokenizer

TEXTS = ["a <|endoftext|> x", "<|endoftext|>", "été<|endoftext|><|endoftext|>  don't\n", "<|endoftext|", "two  spaces  <|endoftext|> \n y", "none", "a<|endoftext|>" * 1500, None]


def test_ids_are_those_of_the_tokenizer_as_loaded(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in TEXTS]
    assert 50256 in own[0]
    want = {(i, at, len(ids), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())) for i, ids in enumerate(own) for at in range(0, len(ids), 2048)}
    assert {(r.doc_id, r.start, r.doc_tokens, r.ids_crc32) for r in queries.QUERIES["op3_packing"](spark, str(tmp_path)).collect()} == want


def test_any_long_white_space():
    """tiktoken's pattern fails on a million white space characters in a row; ids are those of tokenizers all the same."""
    for added in (True, False):
        own = packing.Encoder(packing.vocabulary_file(), added)
        tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        tok.encode_special_tokens = not added
        long = ["a" + " " * 1_000_000 + "b", "\n" * 1_000_000, "x" + " \n\t" * 300_000 + "<|endoftext|> y", "k" + "\u3000" * 700_000 + "<|endoftext|>", "\t" * 700_000 + "\x1c z", "a" + " " * 30_000 + "\nb   c" + "\r\n" * 9_000]
        long += ["a" * 1_000_000, "漢字" * 200_000, "7" * 500_000, "!?" * 200_000]
        for t in long:
            assert own.ids(t).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_what_tiktoken_fails_on_goes_to_tokenizers(monkeypatch):
    own = packing.Encoder(packing.vocabulary_file())
    monkeypatch.setattr(packing, "LONG_SPACE", 1 << 40)
    t = "a" + " " * 1_000_000 + "b"
    assert own.ids(t).tolist() == Tokenizer.from_file(packing.vocabulary_file()).encode(t, add_special_tokens=False).ids
