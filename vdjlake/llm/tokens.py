"""Lengths and ids in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

DEFAULT_VOCABULARY = os.environ.get("VDJLAKE_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: How texts are cut before merges; a fixed value that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(path: str = DEFAULT_VOCABULARY):
    """The tokenizer of a rank file; one a process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_size(path: str = DEFAULT_VOCABULARY) -> int:
    return encoding(path).max_token_value + 1
