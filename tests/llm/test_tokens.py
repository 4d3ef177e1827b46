"""Token ids of a public tokenizer: the cache of pieces, and equality with the library."""

import random

import numpy as np
import public_tokenizers

from caselake.llm import tokens as T

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_frequent_pieces_outlive_a_full_cache(monkeypatch):
    """op4: a piece that keeps coming is encoded once however many others come; the cache stays bounded."""
    monkeypatch.setattr(T, "PIECES_IN_CACHE", 8)
    enc, asked = T.TokenEncoder(PATH), []
    real = enc.pieces.tokenize
    enc.pieces.tokenize = lambda word: asked.append(word) or real(word)
    enc.ids(" ".join(f"the w{chr(97 + i)}x" for i in range(26)))
    assert asked.count("the") == 1
    assert len(enc.pieces) + len(enc.pieces.older) <= 8


def test_ids_equal_the_librarys():
    """op4: pieces of letters, marks, digits and signs, and characters that go to the library whole."""
    enc, rng = T.TokenEncoder(PATH), random.Random(4)
    chars = "".join(T._BEYOND_ASCII) + "aZ09'.,-!tsreveml\"~_ \n中ª"
    for _ in range(3000):
        text = "".join(rng.choice(chars) for _ in range(rng.randint(0, 12)))
        assert enc.ids(text) == np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_a_known_word_is_not_encoded_again():
    """op4: a word with signs around it takes its ids from the cache; a very long piece is not kept."""
    enc, asked = T.TokenEncoder(PATH), []
    real = enc.pieces.tokenize
    enc.pieces.tokenize = lambda word: asked.append(word) or real(word)
    texts = ["house café", "(house), house. café, café.", "z" * 5000 + " house", "10.10.10.10 it's 1's"]
    got = [enc.ids(t) for t in texts]
    assert asked.count("house") == 1 and asked.count(",") == asked.count("1") == 1
    assert all(len(p) <= T.LONGEST_IN_CACHE for p in enc.pieces)
    assert got == [np.array(enc.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
