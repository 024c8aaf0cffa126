"""Both tokenizers against the libraries they have to agree with."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierframe.llm import byte_bpe, token_count
from tierframe.llm.merging import PairTable, merge_sequence, merge_words

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "abtheingTHE's'll \n\t▁é①中文ßíé́😀'.,019A  \x00\r\xa0\x1c\x85​ "


def texts_of(spark, sf_dir):
    known = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    draw = random.Random(5)
    made = [
        "".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 90))) for _ in range(400)
    ]
    return known + made + [
        None, "", " ", "a" * 30_000, "ab" * 2_000, " " * 300 + "\n  \n y",
        "<s></s><unk><0x0A>", "x<|endoftext|> y<|endoftext|><|endoftext|>\n",
    ]


def test_counts_agree_with_library(spark, sf_dir, docs_of):
    texts = texts_of(spark, sf_dir)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = token_count.count_tokens(docs_of(texts), PIECES).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id] or ""
        assert row.n_tokens == len(library.encode(text)), repr(text[:60])
        assert row.n_bytes == len(text.encode())
        assert row.over_limit == (row.n_tokens > 4096)


def test_round_trip_agrees_with_library(spark, sf_dir, docs_of):
    texts = texts_of(spark, sf_dir)
    library = Tokenizer.from_file(BYTES)
    rows = byte_bpe.round_trip(docs_of(texts), BYTES).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), digest)
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_ids_extra_columns_and_empty_table(spark, docs_of):
    docs = docs_of(["the end", None], ids=[None, 7]).withColumn("ids", F.lit("x"))
    rows = {r.doc_id: r.ids for r in byte_bpe.encode(docs, BYTES).collect()}
    assert rows == {None: Tokenizer.from_file(BYTES).encode("the end").ids, 7: []}
    docs = docs.withColumn("n_tokens", F.lit(1)).withColumn("n_bytes", F.lit(1))
    assert token_count.count_tokens(docs, PIECES).count() == 2
    assert token_count.count_tokens(docs.limit(0), PIECES).collect() == []
    assert byte_bpe.round_trip(docs.limit(0), BYTES).collect() == []


def test_heap_and_arrays_agree():
    import numpy as np

    # a merged symbol forms a pair that precedes the next pair of the same kind
    pairs = PairTable([0, 2, 1, 0], [1, 0, 0, 0], [5, 1, 7, 9], [2, 3, 4, 5])
    draw = random.Random(2)
    words = [[draw.randint(-1, 2) for _ in range(draw.randint(1, 12))] for _ in range(500)]
    flat = np.array([s for w in words for s in w])
    at = np.repeat(np.arange(len(words)), [len(w) for w in words])
    symbols, owner = merge_words(flat, at, pairs)
    for n, w in enumerate(words):
        assert symbols[owner == n].tolist() == merge_sequence(w, pairs)


def test_words_are_forgotten_when_too_many(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    model = byte_bpe.ByteModel(BYTES)
    plain, joined = byte_bpe.Words(model), byte_bpe.Words(model, joined=True)
    library = Tokenizer.from_file(BYTES)
    for text in ["the cat sat", "on the mat", "the cat", "", "the<|endoftext|> cat"]:
        ids = library.encode(text).ids
        assert model.ids([text], plain) == [ids]
        digests = [",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)]
        digests = [[hashlib.sha256(d.encode()).hexdigest()] for d in digests]
        assert model.digests([text], joined) == ([len(ids)], *digests)
        assert len(plain.ids) <= 5 and len(joined.decimal) == len(joined.bytes) <= 5


def test_other_models_are_refused():
    with pytest.raises((ValueError, KeyError)):
        byte_bpe.ByteModel(public_tokenizers.path("word_bpe_49k.json"))
