"""SentencePiece operator against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from dealspark.llm import common, piece_bpe
from dealspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_bpe.MODEL))


@pytest.fixture(scope="module")
def ours():
    return piece_bpe.Encoder(common.vocabulary(piece_bpe.MODEL), 2000)


def odd_texts():
    rng = random.Random(1)
    texts = ["", " ", "  a  b ", "a\tb\n\nc", "a▁b", "▁", "　x\xa0y", "é ﬁ Ａ", "a\0b", "﻿abc", "<s>abc</s><0x41><unk>",
             "\r\n x", "x );\r\n  y", "a" + " " * 1000 + "b", "a" * 5000, "=-" * 999, "\n" * 77, " " * 15, " " * 31, "x" + " " * 47]
    for letters in ("ab", "aet", "abcdefghij", " a", "\n a\r;)", "東京都日本人", "é🙂 ▁x", "etaoinshrdlu ", "\t \n\r(){};", " ▁"):
        texts += ["".join(rng.choice(letters) for _ in range(rng.choice([3, 10, 50, 300, 2000]))) for _ in range(100)]
    point = lambda: rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x3000), rng.randrange(0x4E00, 0x9FFF), 0x1F600, 32, 10])
    return texts + ["".join(chr(point()) for _ in range(rng.randrange(200))) for _ in range(200)]


def test_ids_and_texts_are_the_librarys(library, ours):
    texts = odd_texts()
    want = library.encode(texts)
    assert [x.tolist() for x in ours(texts)] == want
    assert [ours.pieces.decode(np.array(x, np.int32)) for x in want] == [library.decode(x) for x in want]


def test_any_id_list_decodes_alike(library, ours):
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.randrange(rng.choice([300, 32000])) for _ in range(rng.randrange(9))]
        assert ours.pieces.decode(np.array(ids, np.int32)) == library.decode(ids), ids


@pytest.mark.parametrize("letters, n", [("abcdefghijklmnopqrstuvwxyz", 300_000), ("aet", 100_000), (" ", 300_000), ("a", 300_000)])
def test_very_long_words(library, ours, letters, n):
    rng = random.Random(3)
    text = "".join(rng.choice(letters) for _ in range(n))
    assert ours([text])[0].tolist() == library.encode(text)


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = set()
    for r in docs:
        ids = library.encode(r["text"] or "")
        want.add((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = QUERIES["op12_piece_bpe"](spark, SF).collect()
    assert len(got) == len(docs) and set(map(tuple, got)) == want


def test_nulls_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (None, "a b", "y"), (None, "a b", "y")],
                               "doc_id long, text string, ids string")
    out = piece_bpe.decode(piece_bpe.encode(df)).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["decoded"]) for r in out) == [
        (0, 2, "a b"), (0, 2, "a b"), (1, 0, ""), (1, 0, "")]
    assert piece_bpe.decode(piece_bpe.encode(df.where("false"))).collect() == []
    lists = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {(r["doc_id"], r["decoded"]) for r in piece_bpe.decode(lists).collect()} == {(1, ""), (2, "")}
