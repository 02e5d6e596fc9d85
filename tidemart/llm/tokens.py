"""Token ids of texts by public tokenizer files."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Longer texts go to the tokenizer itself, which has no limit on backtracking.
LONGEST_FAST = 200_000


def default_tokenizer() -> str:
    """The path of the 50k byte-level vocabulary; any tokenizer file can be given instead."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_ranks() -> tuple[str, str]:
    """The same vocabulary as a file of merge ranks, and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


class Encoder:
    """``ids(text)`` as uint32, those of the tokenizer file without its special tokens; one per task.

    ``ranks`` may name the same vocabulary as a rank file and its pattern, which gives the same ids in a
    third of the time. Texts in which the tokenizer would see a special token go to the tokenizer.
    """

    def __init__(self, path: str, plain_specials: bool = False, ranks: tuple[str, str] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [] if plain_specials else [token.content for token in added]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks[0], "rb") as file:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("ranks", pat_str=ranks[1], mergeable_ranks=table, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if self.fast and len(text) <= LONGEST_FAST and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def choice(tokenizer: str | None, ranks: tuple[str, str] | None) -> dict:
    """Arguments of :class:`Encoder`; the rank file goes with the default vocabulary only."""
    return {"path": tokenizer or default_tokenizer(), "ranks": ranks or (None if tokenizer else default_ranks())}


def texts_of(column: pa.Array) -> Iterator[str | None]:
    for value in column:
        yield value.as_py()
