"""Encoding and decoding by distinct words, against the tokenizers library."""

import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from goldweft.llm import bpe_codec  # noqa: E402
from goldweft.llm import wordblocks  # noqa: E402
from goldweft.llm.queries import QUERIES  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def by_library(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def odd_texts():
    rng = random.Random(11)
    letters = "ab  'sTRE\n\t\r\x1c\x85\xa0　é漢Σİς́é12½٣!?#~\U0001f600​Åẞ<|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += [t + rng.choice(["<|endoftext|>", "<|startoftext|>x", "<|ENDOFTEXT|>", "a<|endoftext|>́"]) for t in texts[:300]]
    texts += ["", " \t\n", "one", "x" * 5000, "It's we'll 'SS 'S", "ab" * 3000 + " end", "word " * 20000]
    return texts


def test_equals_the_library(spark):
    texts = odd_texts()
    rows = [(i, t, i, "n", None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block long, word string, codes string").repartition(7)
    got = {r.doc_id: r for r in bpe_codec.round_trip(docs, PATH).collect()}
    tokenizer = library()
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids, decoded = by_library(tokenizer, text)
        row = got[i]
        assert np.frombuffer(row.ids, "<u4").tolist() == ids, repr(text)
        assert (row.n_tokens, row.decoded) == (len(ids), decoded), repr(text)


def test_small_blocks_nulls_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(wordblocks, "BLOCK_BYTES", 64)
    monkeypatch.setattr(wordblocks, "BUCKET_BYTES", 4)
    rows = [(1, "same words here"), (1, "same words here"), (None, "same words"), (2, None), (3, "")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = bpe_codec.round_trip(docs, PATH).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_tokens, r.decoded) for r in got} == {
        (1, 3, "same</w> words</w> here</w>"), (None, 2, "same</w> words</w>"), (2, 0, ""), (3, 0, ""),
    }
    assert bpe_codec.round_trip(docs.filter("1 = 0"), PATH).count() == 0


def test_text_keys_and_other_files(spark):
    docs = spark.createDataFrame([("k", "text")], "id string, body string")
    assert bpe_codec.round_trip(docs, PATH, "id", "body").first().id == "k"
    with pytest.raises(ValueError):
        bpe_codec.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), "id", "body")


def test_decode_of_any_table(spark):
    vocabulary = bpe_codec.Vocabulary({"a": 1, "b</w>": 2}, {}, {"<s>": 4})
    ids = lambda *n: np.array(n, "<u4").tobytes()
    rows = spark.createDataFrame([("x", ids(1, 2, 1)), ("y", ids()), ("z", ids(9, 2, 3, 4, 0)), ("n", None)], "name string, ids binary")
    got = {r.name: r.decoded for r in bpe_codec.decode(rows, vocabulary).collect()}
    assert got == {"x": "a b</w> a", "y": "", "z": "b</w> <s>", "n": ""}


def test_numbers_in_few_bytes():
    for numbers in ([], [0], [127, 128, 16383, 16384, (1 << 21) - 1, 1 << 21, (1 << 28) - 1, 5]):
        assert wordblocks.large(wordblocks.small(numbers)).tolist() == numbers


def test_query_on_the_smallest_data(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op11_bpe_codec"](spark, sf).collect()}
    tokenizer = library()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    assert len(got) == len(docs)
    for doc, text in docs:
        ids, decoded = by_library(tokenizer, text)
        digest = lambda b: hashlib.sha256(b).hexdigest()
        assert got[doc][1:] == (len(ids), digest(np.array(ids, "<u4").tobytes()), digest(decoded.encode()))
