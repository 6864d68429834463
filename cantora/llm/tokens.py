"""Token ids of a public byte-level BPE vocabulary, inside Spark tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A run of this many non-space characters goes to the library whose merges don't slow down on it.
LONG_RUN = 2000


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable letter: itself where that
    prints, the others from U+0100 on in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """ids of the vocabulary in ``path`` (a tokenizers JSON file); no special tokens are added.

    The merges run in tiktoken on the same vocabulary, which gives the same ids
    several times faster; texts with a very long run go through tokenizers
    itself. The strings of special tokens are ordinary text, or, with ``special``, their
    ids, as tokenizers has it by default."""

    def __init__(self, path: str, special: bool = False):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        named = {t["content"]: t["id"] for t in model.get("added_tokens", ()) if t.get("special")}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in w): i for w, i in model["model"]["vocab"].items() if w not in named}
        self.path, self._exact = path, None
        self._named = named if special else {}
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self._named, key=len, reverse=True))) + ")") if self._named else None
        self._fast = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def exact(self, text: str) -> np.ndarray:
        if self._exact is None:
            from tokenizers import Tokenizer
            self._exact = Tokenizer.from_file(self.path)
            self._exact.encode_special_tokens = True
        return np.array(self._exact.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        parts = self._split.split(text) if self._split else [text]
        if len(parts) == 1:
            return self._ordinary(text)
        return np.concatenate([np.array([self._named[x]], np.uint32) if k % 2 else self._ordinary(x) for k, x in enumerate(parts)])

    def _ordinary(self, text: str) -> np.ndarray:
        if len(text) >= LONG_RUN and max(map(len, text.split()), default=0) >= LONG_RUN or text.isspace():
            return self.exact(text)
        return self._fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False) if text else np.zeros(0, np.uint32)

    def each(self, column: pa.Array) -> Iterator[np.ndarray]:
        """ids of each text of a string column (null: none)."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        for value in column:
            yield self.encode(value.as_py())
