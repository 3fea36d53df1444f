"""Token ids of whole texts by a public byte-level vocabulary."""

from __future__ import annotations

import json
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken

VOCABULARY = "byte_bpe_50k.json"


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in a byte-level vocabulary: Latin-1's own where visible, else the next from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts, equal to those of the ``tokenizers`` library with the same file and without added special tokens.

    The vocabulary is read from that library's file; its ids below the special tokens are also the ranks of its merges, which is
    all that the faster engine used here needs. With ``plain`` the strings of special tokens are ordinary text;
    without, they give the ids of those tokens, as they do in that library.
    """

    def __init__(self, path: str | None = None, plain: bool = False):
        stored = json.loads(Path(path or public_tokenizers.path(VOCABULARY)).read_text())
        special = {token["content"]: token["id"] for token in stored["added_tokens"]}
        letters = byte_letters()
        self.token_bytes = {i: bytes(letters[c] for c in token) for token, i in stored["model"]["vocab"].items() if token not in special}
        ranks = {token: i for i, token in self.token_bytes.items()}
        self.encoding = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={} if plain else special)
        self.allowed = set(self.encoding.special_tokens_set)

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit numbers."""
        return self.encoding.encode_to_numpy(text, allowed_special=self.allowed, disallowed_special=()) if text else np.empty(0, dtype=np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str | None = None, plain: bool = False) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path, plain)
