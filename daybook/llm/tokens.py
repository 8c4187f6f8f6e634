"""Token ids of a public byte-level BPE vocabulary, quickly.

Most of a text is words met before. The vocabulary's pattern never joins two words
that a single space parts, so a text is split at its spaces and the ids of each piece
are kept for the next time. Where that rule does not hold (two or more spaces that
the pattern treats together, white space that libraries class differently, special
tokens) the whole text goes to the tokenizer itself.
"""

from __future__ import annotations

import base64
import re
from array import array

import tiktoken
from tokenizers import Tokenizer

#: The pattern of the byte_bpe_50k vocabulary; a fixed value of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# White space beyond the ASCII kinds, and special tokens.
_RARE = re.compile(
    "[\x1c-\x1f\x85\xa0 ᠎ -​    ⁠　﻿]|<\\|"
)
# White space whose grouping depends on more than the piece after one space.
_GROUPED = re.compile(r" \s* (?:\s|\Z)")
_ODD = re.compile("[\ud800-\udfff]")


class TokenIds(dict):
    """Ids of texts as little-endian unsigned 32-bit numbers; the dict keeps pieces met before."""

    LIMIT = 1 << 18
    LONGEST = 64

    def __init__(self, json_path: str, ranks_path: str) -> None:
        super().__init__()
        self.whole = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.quick = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> bytes:
        found = array("I", self.quick.encode_ordinary(" " + piece)).tobytes()
        if len(piece) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[piece] = found
        return found

    def __call__(self, text: str) -> bytes:
        if _RARE.search(text) or _ODD.search(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if _GROUPED.search(text):
            return array("I", self.quick.encode_ordinary(text)).tobytes()
        first, *rest = text.split(" ")
        start = array("I", self.quick.encode_ordinary(first)).tobytes()
        return start + b"".join(map(self.__getitem__, rest))
