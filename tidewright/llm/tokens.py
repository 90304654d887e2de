"""Token ids of a public byte-level BPE, in bulk."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache
from typing import Any

import numpy as np

#: The one special token of the vocabulary; where it occurs in a text it is that one id.
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
#: Id that ends every document.
END_ID = 0
#: Runs of blanks, and of anything else, that the fast encoder's pattern is not trusted with.
BLANKS, OTHERS = 20_000, 200_000
# A run is only tried from its start, so that each character is looked at a fixed number of times.
_LONG_RUN = re.compile(rf"(?<!\s)\s{{{BLANKS}}}|(?<!\S)\S{{{OTHERS}}}")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _slow(path: str) -> Any:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _fast(path: str) -> Any:
    """The same vocabulary as ranks beside the file, or None where it is not there."""
    ranks = path.rsplit(".", 1)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return None
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs, special_tokens={SPECIAL: SPECIAL_ID})


def has_long_run(text: str) -> bool:
    return len(text) >= min(BLANKS, OTHERS) and _LONG_RUN.search(text) is not None


def encode(text: str | None, path: str) -> np.ndarray:
    """The ids the tokenizer file gives for one text, without its end id; null is empty."""
    if not text:
        return np.zeros(0, np.uint32)
    fast = _fast(path)
    if fast is None or has_long_run(text):
        return np.array(_slow(path).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.array(fast.encode(text, allowed_special={SPECIAL}), np.uint32)


@lru_cache(maxsize=2)
def _plain(path: str) -> Any:
    """The tokenizer file itself, with the special token's string as ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    return slow


def encode_plain(text: str, path: str) -> list[int]:
    """The ids of a text in which the special token's string is ordinary text."""
    fast = _fast(path)
    if fast is None or has_long_run(text):
        return _plain(path).encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def document_ids(text: str | None, path: str) -> np.ndarray:
    return np.append(encode(text, path), np.uint32(END_ID))
