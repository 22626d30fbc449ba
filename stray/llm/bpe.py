"""Byte-level BPE pieces: where a text may be cut, and the ids of a cut by the libraries.

The pre-tokeniser's pattern starts a new piece at every blank that a visible character
follows, whatever stands before it, so a text can be encoded part by part at those
blanks. Plain parts are encoded at once by the ranks; of others each chunk is encoded
once and remembered, within a bound.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np

#: Chunks that a task remembers before it starts afresh, and characters that are encoded at once, at least.
REMEMBERED, PORTION = 1 << 16, 1 << 18
#: Characters on which every Unicode version agrees (ASCII and letters of Latin blocks).
PLAIN = re.compile("[\x20-\x7e\n\xc0-\xd6\xd8-\xf6\xf8-ſ]*")
MARK = "<|endoftext|>"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@cache
def byte_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids, from the ranks file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def ranks_encoding(path: str):
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_ranks(path),
                             special_tokens={})


#: A blank at which no chunk begins.
ODD_BLANK = re.compile(r" (?![!-~\w])")


def chunks(text: str) -> list[str]:
    """Cut before each blank that an ASCII sign or a letter or digit follows; joined, the text again."""
    parts = text.split(" ")
    if not ODD_BLANK.search(text):
        out = [" " + p for p in parts]
        if parts[0]:
            out[0] = parts[0]
            return out
        return out[1:]
    out = [parts[0]]
    for p in parts[1:]:
        if p and ("!" <= p[0] <= "~" or p[0].isalnum()):
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out if out[0] else out[1:]


#: A blank at which a chunk begins.
CUT = re.compile(r" (?=[!-~\w])")


def portions(text: str) -> Iterator[str]:
    """Whole chunks of `PORTION` characters or a few more; joined, the text again."""
    at = 0
    while cut := CUT.search(text, at + PORTION):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def plain(text: str) -> bool:
    return MARK not in text and PLAIN.fullmatch(text) is not None


class ChunkEncoder:
    """Ids of texts: plain portions and chunks by the ranks, all others by the tokenizer file itself, which is read when one comes."""

    def __init__(self, path: str, ranks: str) -> None:
        self.path, self.ranks = path, ranks_encoding(ranks)
        self.known: dict[str, list[int]] = {}

    def chunk(self, c: str) -> list[int]:
        if plain(c):
            return self.ranks.encode_ordinary(c)
        return tokenizer(self.path).encode(c, add_special_tokens=False).ids

    def portion(self, text: str) -> list[int]:
        if plain(text):
            return self.ranks.encode_ordinary(text)
        ids: list[int] = []
        for c in chunks(text):
            got = self.known.get(c)
            if got is None:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                got = self.known[c] = self.chunk(c)
            ids += got
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.concatenate([np.array(self.portion(p), dtype="<u4") for p in portions(text)])
