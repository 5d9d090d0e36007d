"""Codes of whole texts from their distinct pieces: the library's ids, for few pieces."""

import random

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from sluice.llm import token_codes


def test_the_library_gets_each_distinct_word_once(monkeypatch):
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        content = f.read()
    tok = Tokenizer.from_buffer(content)
    token_codes._LOADED.clear()
    _, codes, _ = token_codes._tokenizer(content)
    given, whole = [], codes._whole
    monkeypatch.setattr(codes, "_whole", lambda texts: given.extend(texts) or whole(texts))
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgé", k=8)) for _ in range(50)]
    texts = [a + rng.choice([" ", "\n", ".\n", "&&& ", "!!\n", ",*** "]) + b + rng.choice(["", ".", "###"]) for a in words for b in words]
    for got, text in zip(token_codes._encode_texts(texts, content), texts):
        assert got.tolist() == tok.encode(text, add_special_tokens=False).ids
    # after a space, after a line feed, and the marks: not one piece for each pair and mark
    assert sum(map(len, given)) < 2 * sum(len(w) + 1 for w in words) + 100
    token_codes._LOADED.clear()


def test_odd_texts_and_turned_over_pieces():
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        content = f.read()
    tok = Tokenizer.from_buffer(content)
    token_codes._LOADED.clear()
    _, codes, _ = token_codes._tokenizer(content)
    codes._limit = 40
    rng = random.Random(2)
    parts = ["a", "b", " ", "\n", "it", "'s", "'", "é", "ß", "—", "·", "&&", ".", "1", "½", "一", "\t", "́", "🙂", "_", "'ll", "<|endoftext|>", "|>", "\x1c", "\r", "　", "x" * 70]
    for _ in range(150):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(8)]
        for got, text in zip(token_codes._encode_texts(texts, content), texts):
            assert np.array_equal(got, tok.encode(text, add_special_tokens=False).ids), text
    token_codes._LOADED.clear()
