"""Token ids of whole texts, at the speed of a merge table by ranks.

A byte-level BPE whose merges make tokens of rising id is the same function as
merging, again and again, the neighbours that make the token of smallest id.
``TokenIds`` checks that of a tokenizer file and lets ``tiktoken`` encode with
the file's own vocabulary. The ids are those that ``tokenizers`` gives, special
tokens in a text included (``tests/llm`` compares them). Texts with very long
runs of white space, on which its pattern would recurse too deep, go through
``forced_bpe``.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

from loanweft.llm.common import FORGET, raw, release
from loanweft.llm.forced_bpe import ForcedBpe, byte_letters, content_of  # noqa: F401

# Fixed value: how a byte-level pre-tokenizer splits a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_SPACE = re.compile(r"\s{4096}")


class TokenIds:
    """Encoder of one tokenizer file's content (``tokenizers`` JSON, byte-level BPE)."""

    def __init__(self, content: str):
        import tiktoken

        described = json.loads(content)
        self.forced = ForcedBpe(content)
        vocabulary, letters = described["model"]["vocab"], byte_letters()
        special = {name.decode(): number for name, number in self.forced.special.items()}
        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in described["model"]["merges"]]
        made = np.array([vocabulary[a + b] for a, b in merges])
        ranks = {bytes(letters[c] for c in word): number for word, number in vocabulary.items() if word not in special}
        if (np.diff(made) <= 0).any() or len(ranks) != 256 + len(made) or set(made.tolist()) != {n for w, n in ranks.items() if len(w) > 1}:
            raise ValueError("the vocabulary is not in the order of its merges")
        self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special, self.pieces = special, self.forced.pieces

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offset of each text in them; a null text has none."""
        each = [self.of(text) if text else np.zeros(0, np.uint32) for text in texts]
        at = np.zeros(len(each) + 1, np.int64)
        np.cumsum([len(ids) for ids in each], out=at[1:])
        return (np.concatenate(each) if each else np.zeros(0, np.uint32)), at

    def of(self, text: str) -> np.ndarray:
        if LONG_SPACE.search(text):
            return self.forced.encode(*raw(pa.array([text])))[0].astype(np.uint32)
        return self.ranks.encode_to_numpy(text, allowed_special="all")


LOADED: dict[str, TokenIds] = {}  # of this worker process
FORGET.append(LOADED.clear)


def loaded(content: str) -> TokenIds:
    if content not in LOADED:
        LOADED.clear()
        LOADED[content] = TokenIds(content)
        release()  # what the file was parsed into
    return LOADED[content]
