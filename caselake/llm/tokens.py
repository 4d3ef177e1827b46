"""Token ids of a public tokenizer file, computed inside tasks."""

from __future__ import annotations

import codecs
import functools
import json
import re
import struct

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

PIECES_IN_CACHE = 600_000  # in two halves
LONGEST_IN_CACHE = 100     # characters of a piece
SHORT_WORD = 3             # characters of a word that many pieces hold
_ENCODERS: dict[str, TokenEncoder] = {}

# The normalizer and pre-tokenizer under which white space separates tokens and
# a piece's ids depend on the piece alone.
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
# Characters on which the classes of the pattern above are plain to see: ASCII, Spanish and
# French marks, Latin-1 letters and the oe ligature. A text with any other goes to the library whole.
_OTHER = re.compile("[^\t\n\r -~¡¿«»À-ÖØ-öø-ÿŒœ]")
_BEYOND_ASCII = [c for c in map(chr, (*range(0x80, 0x100), 0x152, 0x153)) if not _OTHER.match(c)]
_WORDS = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿœ]+|[0-9]|[^a-zß-öø-ÿœ0-9]+")


@functools.lru_cache(LONGEST_IN_CACHE)
def _packer(n: int):
    return struct.Struct(f"<{n}I").pack


def _byte_level() -> str:
    """The character that stands for each byte in the tokenizer's model; U+FFFE for bytes of no text."""
    level, table = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False), ["\ufffe"] * 256
    for c in [*map(chr, range(0x80)), *_BEYOND_ASCII]:
        for byte, sign in zip(c.encode(), level.pre_tokenize_str(c)[0][0], strict=True):
            table[byte] = sign
    return "".join(table)


class _Pieces(dict):
    """White-space-free piece -> its ids as little-endian bytes. When half of the cache is full it becomes
    the older half, from which pieces that come again are taken over; the rest is forgotten. Very long
    pieces are not kept."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenize, self.older, self.bytes = tokenizer.model.tokenize, {}, _byte_level()

    def word(self, word: str) -> bytes:
        ids = [t.id for t in self.tokenize(word if word.isascii() else codecs.charmap_decode(word.encode(), "strict", self.bytes)[0])]
        return _packer(len(ids))(*ids)

    def known(self, word: str) -> bytes:
        if len(word) <= SHORT_WORD:
            return self[word]
        return self.get(word) or self.older.get(word) or self.word(word)

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            if piece.isalpha() or len(words := _WORDS.findall(piece)) == 1:
                out = self.word(piece)
            else:
                out = b"".join(map(self.known, words))
            if len(piece) > LONGEST_IN_CACHE:
                return out
        if len(self) >= PIECES_IN_CACHE // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = out
        return out


class TokenEncoder:
    """``ids(text)`` equals ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        by_word = (
            spec.get("normalizer") == WORD_NORMALIZER and spec.get("pre_tokenizer") == WORD_PRE_TOKENIZER
            and spec.get("post_processor") is None and model["type"] == "BPE" and not model.get("dropout")
            and not model.get("unk_token") and not model.get("ignore_merges")
        )
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.pieces = _Pieces(self.tokenizer) if by_word else None

    def ids(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a null text has those of the empty one."""
        text = text or ""
        if self.pieces is None or _OTHER.search(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self.pieces.__getitem__, text.lower().split()))


def encoder(path: str) -> TokenEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TokenEncoder(path)
    return _ENCODERS[path]
