"""Token ids from the tokenizer libraries, for operators that count or pack tokens.

The tokenizers file is the authority. Its byte-level vocabulary is also given to tiktoken,
which encodes whole texts about five times as fast and to the same ids. The one difference is
which of the newest letters the two know as letters, so texts with letters beyond the old
Unicode blocks go to the tokenizers library itself; special tokens are cut out beforehand.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import tiktoken
from tokenizers import Tokenizer

from labelloom.llm.bpe import OLD_LETTERS, SPLIT, BytePairs, SharedTokenizer, packed
from labelloom.llm.columns import once_per_worker

_NEWER = re.compile(f"[{OLD_LETTERS}-\U0010ffff]")


class LibraryEncoder:
    def __init__(self, tokenizer_json: str) -> None:
        self.pairs = BytePairs(tokenizer_json)
        self.exact = Tokenizer.from_str(tokenizer_json)
        self.exact.no_truncation()
        self.exact.no_padding()
        merged = [self.pairs.rank[i] for i in sorted(self.pairs.rank)]
        if any(a >= b for a, b in zip(merged, merged[1:], strict=False) if b >= 0):
            raise ValueError("ids must be in the order of the merges")
        ranks = {self.pairs.spelling[i]: i for i in self.pairs.rank}
        self.fast = tiktoken.Encoding("shared", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, text: str) -> bytes:
        if not _NEWER.search(text):
            try:
                return packed(self.fast.encode_ordinary(text))
            except BaseException as error:
                # Its pattern engine gives up on runs of a million white characters or more.
                if type(error).__name__ != "PanicException":
                    raise
        return packed(self.exact.encode(text, add_special_tokens=False).ids)

    def encode_batch(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers; null is empty."""
        return [b"".join([self._ids(s) + special for s, special in self.pairs.segments(t or "")]) for t in texts]


def library_encoder(shared: SharedTokenizer) -> LibraryEncoder:
    return once_per_worker(("library", shared.key), lambda: LibraryEncoder(shared.text()))
