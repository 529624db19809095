"""Token ids of whole texts with a public tokenizer file, each distinct word of a worker encoded once."""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

from riskflow.llm.text import Memo, words

_JOINED = 8000
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
# ASCII that is neither letter, digit nor space, without ' (contractions) and < | > (special tokens).
_OTHERS = np.zeros(256, bool)
_OTHERS[[k for k in range(33, 127) if not chr(k).isalnum() and chr(k) not in "'<|>"]] = True
_SPECIAL = ord("<")


class Encoder:
    """Ids as ``tokenizers`` gives them for the whole text without special tokens added.

    For tokenizers that lower-case, drop white space, and pre-tokenize letters apart from punctuation: the ids of a text
    are then those of its parts. Parts end at white space and between an ASCII letter and ASCII punctuation, except beside
    the characters of contractions and special tokens. Distinct parts are encoded by the library, many in a call, and told
    apart by the offsets it returns.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.memo = Memo(self._encode, np.uint32)

    def _encode(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, size = [], []
        for first in range(0, len(found), _JOINED):
            part = found[first : first + _JOINED]
            text = b" ".join(part).decode("utf-8", "replace")
            begins = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 32) + 1
            code = self.library.encode(text, add_special_tokens=False)
            ids.append(np.array(code.ids, np.uint32))
            at = np.fromiter((a for a, _ in code.offsets), np.int64, len(code.offsets))
            size.append(np.bincount(np.searchsorted(begins, at, side="right"), minlength=len(part)))
        return np.concatenate(ids), np.concatenate(size)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block's texts, and the number of ids of each text."""
        found = words(column, lower=True, letters=_LETTERS, others=_OTHERS)
        raw = found.data.tobytes() if len(special := np.flatnonzero(found.data == _SPECIAL)) else b""
        for k in np.unique(np.searchsorted(found.start, special, side="right") - 1).tolist():
            found.hash[k] = xxhash.xxh64_intdigest(raw[found.start[k] : found.end[k]])  # special tokens have a case
        at, size = self.memo.lookup(found)
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self.memo.expand(at, size), total[found.first[1:]] - total[found.first[:-1]]


@cache
def encoder(path: str) -> Encoder:
    """One encoder for a Python worker, with the words of all its tasks."""
    return Encoder(path)
