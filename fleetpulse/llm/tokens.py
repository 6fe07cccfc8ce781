"""Token ids of whole texts, piece by piece through a bounded cache.

The ids are those that the ``tokenizers`` library gives with the byte-level vocabulary
``byte_bpe_50k.json`` as it is: the vocabulary's one special string has an id of its own
wherever it stands, and the text on each side is encoded by itself. Its pattern never joins what stands on both sides of a
lone space, so a text is cut before such spaces and every piece is encoded once while
the cache holds it. New pieces go through the same vocabulary's rank file, which
``tests/llm`` holds against the ``tokenizers`` library text by text.
"""

from __future__ import annotations

import base64
import re
import struct

from fleetpulse.llm.shared import by_value, once

by_value(__name__)

VOCABULARY = "byte_bpe_50k.tiktoken"
# The vocabulary's special string and its id.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
# Pieces one worker keeps, about 100 MB; a full cache is emptied, never fixed.
CACHE_PIECES = 400_000

# Python's \s holds every character the vocabulary's pattern counts as white space.
_NOT_LONE = re.compile(r"\s |[ ]\s|\A\s|\s\Z")
_LONE_SPACE = re.compile(r" (?=\S)(?<=\S )")


def pieces(text: str) -> list[str]:
    """The text cut before its lone spaces; every part but the first lost its space."""
    if _NOT_LONE.search(text) is None:
        return text.split(" ")
    return _LONE_SPACE.split(text)


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str):
        if len(self) >= CACHE_PIECES:
            self.clear()
        self[piece] = made = self.make(piece)
        return made


class Encoder:
    """Encodes texts; ``path`` is the vocabulary's rank file."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        encode = encoding.encode_ordinary

        def packed(text: str) -> bytes:
            ids = encode(text)
            return struct.pack(f"<{len(ids)}I", *ids)

        self.first = packed
        self.count_first = lambda text: len(encode(text))
        self.bytes_of = _Cache(lambda piece: packed(" " + piece))
        self.count_of = _Cache(lambda piece: len(encode(" " + piece)))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if SPECIAL in text:
            return struct.pack("<I", SPECIAL_ID).join(map(self.encode, text.split(SPECIAL)))
        first, *rest = pieces(text)
        return self.first(first) + b"".join(map(self.bytes_of.__getitem__, rest))

    def count(self, text: str) -> int:
        if SPECIAL in text:
            return text.count(SPECIAL) + sum(map(self.count, text.split(SPECIAL)))
        first, *rest = pieces(text)
        return self.count_first(first) + sum(map(self.count_of.__getitem__, rest))


def encoder(path: str | None = None) -> Encoder:
    """One encoder per worker."""
    return once(f"encoder {path}", lambda: Encoder(path))
