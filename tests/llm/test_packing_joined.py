"""Chunks encoded joined have the tokens that each has by itself."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from dealspark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_far_fewer_texts_than_chunks_are_encoded():
    words = [f" w{i}" for i in range(10_000)]
    assert len(packing.joined(words)) <= len(words) / 100
    assert "".join(packing.joined(words)) == "".join(words)


def test_tokens_of_odd_texts_are_the_librarys():
    rng = random.Random(5)
    parts = ["a", "Word", "'s", "don't", "12", "!?", "é", "日本語", "🙂", "́", " ", "  ", "\n", "\t", "\r\n", " ", " ", "　",
             "\x1c", "\x85", "᠎", "​", "\x00", "<|endoftext|>", "Ġ", "▁", "."]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(3000)] + ["", " ", "\n", "x"]
    t = Tokenizer.from_file(PATH)
    got = packing.DocumentTokens(PATH)(texts)
    for text, ids in zip(texts, got):
        assert np.array_equal(ids, t.encode(text, add_special_tokens=False).ids), repr(text)


def test_chunks_whose_ends_a_token_crosses_are_encoded_alone():
    tool = packing.DocumentTokens(PATH)
    tool.token_bytes[:] = 3
    t = Tokenizer.from_file(PATH)
    text = "some plain words in a row"
    assert np.array_equal(tool([text])[0], t.encode(text, add_special_tokens=False).ids)
