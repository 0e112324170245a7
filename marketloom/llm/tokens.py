"""Token ids of texts, from the vocabulary file of a byte-level BPE tokenizer."""

from __future__ import annotations

import json
from functools import lru_cache

import tiktoken
from tokenizers import Tokenizer

# Fixed value: how byte-level BPE vocabularies of this family cut a text before merging.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Below this code point both libraries are tested to agree on every character.
PLAIN_BELOW = "Ԁ"


class Encoder:
    """Ids as ``tokenizers`` gives them without added special tokens, several times as fast.

    Plain texts are merged by rank with ``tiktoken``, from the same vocabulary.
    Texts with a special token's name or with rarer scripts go to ``tokenizers``.
    """

    def __init__(self, config: str) -> None:
        parsed = json.loads(config)
        self._exact = Tokenizer.from_str(config)
        #: Names of added tokens, each of which is one token wherever it stands in a text.
        self.special = [token["content"] for token in parsed.get("added_tokens", ())]
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in parsed["model"]["vocab"].items()
            if token not in self.special
        }
        self._plain = tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.is_plain(text):
            return self._plain.encode_ordinary(text)
        return self._exact.encode(text, add_special_tokens=False).ids

    def is_plain(self, text: str) -> bool:
        return (text.isascii() or max(text) < PLAIN_BELOW) and not any(name in text for name in self.special)


@lru_cache(maxsize=4)
def encoder(config: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    return Encoder(config)


def vocabulary(path: str) -> str:
    """The vocabulary file's text, read on the driver and sent along with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself where it is visible, else the next one from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
