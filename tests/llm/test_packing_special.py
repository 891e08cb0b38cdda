"""Tokens of texts that hold a special token, against the library's plain call."""

import numpy as np
import public_tokenizers

from dealspark.llm import packing


def test_special_tokens_as_the_library_does():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  <|endoftext|>\n\n z", "foo  <|endoftext|><|endoftext|>  bar ", " <|endoftext|> ", "plain text"]
    for text, ids in zip(texts, packing.DocumentTokens(path)(texts)):
        assert np.array_equal(ids, t.encode(text, add_special_tokens=False).ids), text
    assert len(packing.DocumentTokens(path)([texts[0]])[0]) == 4
