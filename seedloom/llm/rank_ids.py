"""Token ids of whole texts without caches, for tasks that need memory for something else.

Where a byte-level BPE file numbers its tokens in the order of its merges, a token's id is its
rank, and tiktoken merges by ranks as the tokenizers library merges by that list. Texts whose ids
could differ, or that tiktoken cannot take, go to the codec: those with special strings, with
characters newer than Unicode 3.2, and very long ones (its pattern may run out of stack on a million
white spaces). So do all texts of files that number their tokens otherwise.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import tiktoken

from seedloom.llm.bpe import PRE_TOKENS, byte_of_char, codec, recent_characters

#: Longest text, in characters, that goes to tiktoken.
LONGEST = 400_000


class RankEncoder:
    """Ids as little-endian unsigned 32-bit integers, as the tokenizers library gives them without added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path, self.special = path, [token["content"] for token in spec["added_tokens"]]
        vocab, to_byte = spec["model"]["vocab"], byte_of_char()
        merged = [vocab["".join(merge if isinstance(merge, list) else merge.split(" "))] for merge in spec["model"]["merges"]]
        single = [i for text, i in vocab.items() if len(text) == 1]
        self.ranked = merged == sorted(set(merged)) and max(single) < min(merged) and len(vocab) <= len(merged) + len(single) + len(self.special)
        if self.ranked:
            ranks = {bytes(to_byte[c] for c in text): i for text, i in vocab.items() if text not in self.special}
            self.encoding = tiktoken.Encoding("own", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> bool:
        """Whether tiktoken gives the text's ids."""
        if not self.ranked or len(text) > LONGEST or any(special in text for special in self.special):
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return not recent_characters().search(text)
        return True

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.plain(text):
            return codec(self.path).encode(text)
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()


@cache
def rank_encoder(path: str) -> RankEncoder:
    """One per worker process and file."""
    return RankEncoder(path)
