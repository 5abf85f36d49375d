"""Ids of the public byte-level BPE, computed per whole text in worker processes."""

from __future__ import annotations

import base64
import json
import os
import re
from functools import lru_cache

import numpy as np

#: Id put after each document.
END = 2
#: Texts of these characters only have one reading of letters, digits and white space in every Unicode version, so
#: the rank table gives the tokenizer file's ids; others go to the tokenizer itself.
PLAIN = re.compile("[\x00-\x7f¡-©«-±´¶-¸»¿-ſ‐-‧€]*")


class ByteBpe:
    """The tokenizer file's ids, special tokens in a text included, as its own ``encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, model: str, ranks: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken

        self.model, self.slow = model, None
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(model, encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f).get("added_tokens", ())]
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and not any(t in text for t in self.added):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        if self.slow is None:  # read only where it is needed
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.model)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def document(self, text: str | None) -> np.ndarray:
        """The document's ids with END; a null text is empty."""
        return np.append(self.encode(text or ""), np.uint32(END))


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(2)
def byte_bpe(model: str, ranks: str) -> ByteBpe:
    """One instance a process."""
    return ByteBpe(model, ranks)
