"""Byte-level BPE with a given vocabulary, one encoder for each Python worker."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

END_OF_TEXT = "<|endoftext|>"
RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Ids of ordinary text (no special tokens) and their bytes."""

    def __init__(self, ranks_path: str, pattern: str = public_tokenizers.PATTERN):
        ranks = read_ranks(ranks_path)
        self._encode = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._bytes = {rank: token for token, rank in ranks.items()}

    def encode(self, text: str) -> np.ndarray:
        """The ids of the whole text; an empty text has none."""
        return np.array(self._encode(text), np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def encoder(ranks_path: str) -> Encoder:
    return Encoder(ranks_path)


class VocabularyEncoder:
    """Ids of a ``tokenizers`` file.

    Its rank file holds the same vocabulary and encodes several times as fast; a text that holds
    the special token's string goes through the file itself, which knows it.
    """

    def __init__(self, json_path: str, ranks_path: str):
        self._json_path, self._full = json_path, None
        self._plain = encoder(ranks_path)

    def encode(self, text: str) -> np.ndarray:
        if END_OF_TEXT not in text:
            return self._plain.encode(text)
        if self._full is None:
            from tokenizers import Tokenizer
            self._full = Tokenizer.from_file(self._json_path)
        return np.array(self._full.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def vocabulary_encoder(json_path: str, ranks_path: str) -> VocabularyEncoder:
    return VocabularyEncoder(json_path, ranks_path)
