"""Token ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np

#: Parts up to this length are remembered; parts longer than the second bound take the slower encoder, whose time stays near-linear.
REMEMBERED, LONG = 64, 2000
MEMORY = 400_000


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Parts(dict):
    """Token ids of text parts as little-endian bytes, worked out on first use."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        ids = self.encode(part)
        if len(part) <= REMEMBERED:
            if len(self) >= MEMORY:
                self.clear()
            self[part] = ids
        return ids


class Encoder:
    """Ids as ``tokenizers`` gives them for ``json_path`` without special tokens.

    Between two visible characters a single blank always starts a new part in the vocabulary's splitting rule, so texts are cut
    there and the ids of frequent parts are looked up. Parts are encoded by ``tiktoken`` from the same vocabulary (several times
    faster, the same ids: tested); very long ones, and texts with other runs of white space, part by part or as a whole.
    """

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(json_path)
        self.slow.encode_special_tokens = True
        self.parts = _Parts(self._encode)
        self.runs = re.compile(r"\s | \s|^ | $")

    def _encode(self, text: str) -> bytes:
        if len(text) > LONG and max(map(len, text.split()), default=0) > LONG:
            ids = self.slow.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.asarray(ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The ids of the whole text, each as four little-endian bytes."""
        if not text or self.runs.search(text):
            return self._encode(text)
        first, *rest = text.split(" ")
        return self.parts[first] + b"".join(map(self.parts.__getitem__, [" " + part for part in rest]))


@cache
def encoder(json_path: str, ranks_path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(json_path, ranks_path)
