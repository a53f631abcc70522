"""Token ids of texts by a public byte-level vocabulary, inside tasks.

Two files of one vocabulary: the ``tokenizers`` JSON, which defines the ids, and the same merges as
``tiktoken`` ranks. Both give the same ids for ordinary text (compared on every code point in a
test); the second is four times as fast, so it is used unless a text holds one of the JSON's
special strings, which only the first one maps to their ids.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer


@dataclass(frozen=True)
class Vocabulary:
    """Paths every executor can open, the split pattern of the ranks, and the id that ends a document."""

    json_path: str = public_tokenizers.path("byte_bpe_50k.json")
    ranks_path: str | None = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN
    end_id: int = 1


@lru_cache(maxsize=2)
def encoder(vocabulary: Vocabulary) -> Callable[[str | None], np.ndarray]:
    """A function from a text (null: empty) to its ids, the end id included, as unsigned 32-bit."""
    end = [vocabulary.end_id]

    @lru_cache(maxsize=1)
    def full() -> Tokenizer:
        """Loaded at the first text that needs it."""
        return Tokenizer.from_file(vocabulary.json_path)

    def slow(text: str) -> list[int]:
        return full().encode(text, add_special_tokens=False).ids

    if vocabulary.ranks_path is None:
        return lambda text: np.array(slow(text or "") + end, "<u4")

    import tiktoken

    with open(vocabulary.ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    with open(vocabulary.json_path) as file:
        special = [t["content"] for t in json.load(file)["added_tokens"]]
    fast = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str | None) -> np.ndarray:
        text = text or ""
        if any(s in text for s in special):
            ids = slow(text)
        else:
            ids = fast.encode_ordinary(text)
        return np.array(ids + end, "<u4")

    return encode
