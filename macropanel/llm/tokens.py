"""Public vocabularies inside tasks. Files are named by a folder (``vocab_dir``); None is the installed one."""

from __future__ import annotations

import base64
import os

import public_tokenizers
import tiktoken

#: Below this code point the two libraries split every text alike (tests compare them over all of it).
PLAIN_BELOW = 0x250


def vocab_path(name: str, vocab_dir: str | None = None) -> str:
    return os.path.join(vocab_dir, name) if vocab_dir else public_tokenizers.path(name)


def byte_bpe(vocab_dir: str | None = None) -> tiktoken.Encoding:
    """byte_bpe_50k as ranks, with the special token of byte_bpe_50k.json."""
    with open(vocab_path("byte_bpe_50k.tiktoken", vocab_dir), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})


class ByteBpe:
    """text -> ids of byte_bpe_50k.json with add_special_tokens=False.

    Texts of Latin characters go through the same vocabulary's rank file, which is several times faster; the
    rest, whose Unicode tables the libraries may not share, through the JSON file itself.
    """

    def __init__(self, vocab_dir: str | None = None):
        self.ranks, self.dir, self.json = byte_bpe(vocab_dir), vocab_dir, None

    def __call__(self, text: str):
        """An array of unsigned 32-bit ids."""
        import numpy as np

        if text.isascii() or ord(max(text)) < PLAIN_BELOW:
            if "<|endoftext|>" in text:
                return np.array(self.ranks.encode(text, allowed_special="all"), np.uint32)
            return np.array(self.ranks.encode_ordinary(text), np.uint32)
        if self.json is None:
            from tokenizers import Tokenizer

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            self.json = Tokenizer.from_file(vocab_path("byte_bpe_50k.json", self.dir))
        return np.array(self.json.encode(text, add_special_tokens=False).ids, np.uint32)
