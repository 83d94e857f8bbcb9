"""Token ids of whole texts as little-endian unsigned 32-bit bytes."""

from __future__ import annotations

import base64
import functools
import os
import sys
from array import array


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ranks_of(path: str) -> str | None:
    """The same vocabulary as a file of ranks, if it lies beside."""
    beside = path.removesuffix(".json") + ".tiktoken"
    return beside if path.endswith(".json") and os.path.exists(beside) else None


@functools.lru_cache(1)
def encoder(path: str, ordinary_specials: bool = False) -> Encoder:
    """One for each worker process, which serves all its tasks."""
    return Encoder(path, ordinary_specials)


class Encoder:
    """ids(text) of a byte-level tokenizer.

    Texts go through the file of ranks, if there is one: the same pattern and merges at a third of the time. A text that may hold a special token's string
    goes through the tokenizer itself. Nothing is kept between texts."""

    def __init__(self, path: str, ordinary_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary_specials
        self.ordinary, self.direct = ordinary_specials, None
        if ranks := ranks_of(path):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.direct = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self.direct and (self.ordinary or "<|" not in text):
            out = array("I", self.direct(text))
        else:
            out = array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()
