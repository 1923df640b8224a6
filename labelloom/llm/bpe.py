"""Byte-level BPE encoding by one walk over a trie of distinct words, and decoding.

The encoding of a string follows from the last token of each of its prefixes: drop the
last token, and the rest is the encoding of a shorter prefix. In a trie of distinct words
a node stands for a prefix, so its last token is found once for all words below it. Sorted
words visit the trie depth first; the path to the present node is all that is kept.

A token may follow another if merging their bytes from scratch gives these two tokens
again. This is decided by undoing merges at the seam, latest first: a merge across the
seam that would have come before the one being undone rules the pair out.
"""

from __future__ import annotations

import hashlib
import json
import sys
from array import array
from collections.abc import Iterable
from functools import cached_property

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from labelloom.llm.columns import append_columns, once_per_worker, quoted

# The split pattern of byte-level files, a fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Letters below this one have been in Unicode from the start.
OLD_LETTERS = "\u0220"
MARKS = set(".,;:!?")

# Characters of text encoded together.
TOGETHER = 2_000_000

# Words kept with their ids in a worker, and seams kept with their verdict. Beyond these
# the tables are emptied and filled again; results do not depend on them.
KEPT_WORDS = 150_000
KEPT_SEAMS = 200_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file, with its byte.

    Bytes that print stand for themselves, the rest take the letters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class BytePairs:
    """A byte-level BPE vocabulary."""

    def __init__(self, tokenizer_json: str) -> None:
        spec = json.loads(tokenizer_json)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE file without a normalizer is needed")
        if before.get("add_prefix_space") or not before.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("prefix spaces, whole-word matches and other splits are not supported")
        letters = byte_letters()
        vocabulary = model["vocab"]
        self.spelling = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items()}
        self.longest = max(map(len, self.spelling.values()))
        self.merge: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = dict.fromkeys(self.spelling, -1)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, made = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if made in self.parts:
                raise ValueError(f"token {made} has two merges")
            self.merge[a, b] = rank
            self.parts[made] = (a, b)
            self.rank[made] = rank
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that strip or need whole words are not supported")
        self.special_pattern = (
            regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
            if self.special
            else None
        )
        self.pattern = regex.compile(SPLIT)
        self.split = ByteLevel(add_prefix_space=False, use_regex=True)
        for text, i in self.special.items():
            self.spelling[i] = text.encode()
        self.seams: dict[int, bool] = {}

    @cached_property
    def tokens(self) -> ahocorasick.Automaton:
        """Finds all tokens in a string, with their ids and lengths, longest first."""
        usable: dict[int, bool] = {}
        tokens = ahocorasick.Automaton()
        for i in self.rank:
            if self._is_reachable(i, usable):
                tokens.add_word(self.spelling[i].decode("latin-1"), (i, len(self.spelling[i])))
        tokens.make_automaton()
        return tokens

    def pieces(self, text: str) -> list[bytes]:
        """The text cut by the split pattern, as the library itself cuts it.

        Letters that have been in Unicode from the start are cut by the same pattern here,
        which is faster; for the rest the library's own tables of letters decide.
        """
        if text.isascii() or max(text) < OLD_LETTERS:
            return [p.encode() for p in self.pattern.findall(text)]
        return [text[a:b].encode() for _, (a, b) in self.split.pre_tokenize_str(text)]

    def segments(self, text: str) -> list[tuple[str, bytes]]:
        """The stretches of plain text, each with the special token after it."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return [(text, b"")]
        found, at = [], 0
        for match in self.special_pattern.finditer(text):
            found.append((text[at : match.start()], packed([self.special[match[0]]])))
            at = match.end()
        return [*found, (text[at:], b"")]

    def _holds(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge across the seam of a and b comes before rank limit."""
        merge, rank, parts = self.merge, self.rank, self.parts
        while True:
            across = merge.get((a, b))
            if across is not None and across < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], parts[a][1]
            elif rank[b] >= 0:
                # Of equal merges the left one comes first, so the seam's would win.
                limit, b = rank[b] + 1, parts[b][0]
            else:
                return True

    def _is_reachable(self, token: int, known: dict[int, bool]) -> bool:
        """Whether the token's own bytes are merged into it."""
        if token not in known:
            halves = self.parts.get(token)
            known[token] = halves is None or (
                self._is_reachable(halves[0], known)
                and self._is_reachable(halves[1], known)
                and self._holds(*halves, self.rank[token])
            )
        return known[token]

    def _may_follow(self, a: int, b: int) -> bool:
        if len(self.seams) >= KEPT_SEAMS:
            self.seams.clear()
        known = self.seams[a << 32 | b] = self._holds(a, b, len(self.merge) + 1)
        return known

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct words, each as little-endian unsigned 32-bit integers.

        last[d] and length[d] are the state of the trie node d bytes deep on the way to
        the present word: the last token there and how many bytes it has.
        """
        tokens, longest, seams = self.tokens.iter, self.longest, self.seams
        last, length = [-1], [0]
        before = b""
        result: dict[bytes, bytes] = {}
        for word in sorted(words):
            most = min(len(before), len(word))
            differs = int.from_bytes(before[:most]) ^ int.from_bytes(word[:most])
            shared = most - (differs.bit_length() + 7) // 8
            del last[shared + 1 :], length[shared + 1 :]
            # Every token that ends below the shared node begins at most this far above it.
            above = shared - longest if shared > longest else 0
            for place, (found, size) in tokens(word[above:].decode("latin-1")):
                end = above + place + 1
                if end < len(last):
                    continue  # on the shared path, or its last token is found
                start = end - size
                if start:
                    fits = seams.get(last[start] << 32 | found)
                    if fits is None:
                        fits = self._may_follow(last[start], found)
                    if not fits:
                        continue
                last.append(found)
                length.append(size)
            if len(last) <= len(word):
                raise ValueError(f"no token ends at byte {len(last)} of {word!r}")
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at -= length[at]
            ids.reverse()
            result[word] = packed(ids)
            before = word
        return result


class Encoder:
    """Encodes whole texts, each distinct word once as long as it is kept.

    Between two single spaces the split pattern sees nothing of the neighbours: a space
    always opens a new piece. So a text is cut at its spaces and each part, with the space
    before it, is looked up. Where a part is empty or white at an edge this does not
    hold, and the whole text is split by the pattern.
    """

    def __init__(self, pairs: BytePairs) -> None:
        self.pairs = pairs
        self.inner: dict[str, bytes | bool] = {}
        self.first: dict[str, bytes | bool] = {}
        self.older: dict[str, bytes | bool] = {}
        self.marks = {m: pairs.encode_words([m.encode()])[m.encode()] for m in MARKS}

    def _learn(self, kept: dict[str, bytes | bool], parts: set[str], lead: str) -> None:
        """Adds the parts' ids; False for those the whole text must be split for."""
        pieces: dict[str, list[bytes]] = {}
        for part in parts:
            if part.isascii() or (part and max(part) < OLD_LETTERS):
                # The usual cases of the split pattern: letters, and letters with a mark after them.
                if part.isalpha():
                    pieces[part] = [(lead + part).encode()]
                    continue
                if part[-1:] in MARKS and part[:-1].isalpha():
                    known = kept.get(part[:-1])
                    if known:
                        kept[part] = known + self.marks[part[-1]]
                    else:
                        pieces[part] = [(lead + part[:-1]).encode(), part[-1].encode()]
                    continue
            if not part or part[0].isspace() or part[-1].isspace():
                kept[part] = False
            else:
                pieces[part] = self.pairs.pieces(lead + part)
        ids = self.pairs.encode_words({p for made in pieces.values() for p in made})
        for part, made in pieces.items():
            kept[part] = b"".join([ids[p] for p in made])

    def _by_pattern(self, text: str) -> bytes:
        pieces = self.pairs.pieces(text)
        ids = self.pairs.encode_words(set(pieces))
        return b"".join([ids[p] for p in pieces])

    def encode_batch(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        result: list[bytes] = []
        waiting: list[str] = []
        size = 0
        for text in texts:
            waiting.append(text or "")
            size += len(waiting[-1])
            if size >= TOGETHER:
                result += self._encode_some(waiting)
                waiting, size = [], 0
        return result + self._encode_some(waiting)

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        self._make_room()
        inner, first, older = self.inner.get, self.first, self.older
        new_inner: set[str] = set()
        new_first: set[str] = set()
        found, gaps = [], []
        for text in texts:
            for segment, special in self.pairs.segments(text):
                parts = segment.split(" ")
                head = parts[0]
                if head not in first:
                    new_first.add(head)
                parts[0] = ""
                ids = list(map(inner, parts))
                ids[0] = head
                at = 0
                try:
                    while True:
                        at = ids.index(None, at)
                        ids[at] = part = parts[at]
                        gaps.append((ids, at))
                        if part in older:
                            self.inner[part] = older[part]
                        else:
                            new_inner.add(part)
                except ValueError:
                    pass
                found.append((segment, ids, special))
        self._learn(self.inner, new_inner, " ")
        self._learn(first, new_first, "")
        for ids, at in gaps:
            ids[at] = self.inner[ids[at]]
        encoded = iter([self._join(*each) for each in found])
        return [b"".join([next(encoded) for _ in self.pairs.segments(text)]) for text in texts]

    def _join(self, segment: str, ids: list, special: bytes) -> bytes:
        if not segment:
            return special
        ids[0] = self.first[ids[0]]
        return (self._by_pattern(segment) if False in ids else b"".join(ids)) + special

    def _make_room(self) -> None:
        """Words not met since the last time are let go when too many are kept."""
        if len(self.inner) > KEPT_WORDS:
            self.older, self.inner = self.inner, {}
        if len(self.first) > KEPT_WORDS:
            self.first.clear()


class SharedTokenizer:
    """A tokenizer file read on the driver and sent to the workers.

    Its size does not depend on the data (about 1.5 MB). Workers need no copy of the file.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.key = hashlib.sha256(text.encode()).hexdigest()
        self._sent = spark.sparkContext.broadcast(text)

    def text(self) -> str:
        return self._sent.value

    def pairs(self) -> BytePairs:
        return once_per_worker(("pairs", self.key), lambda: BytePairs(self.text()))

    def encoder(self) -> Encoder:
        return once_per_worker(("encoder", self.key), lambda: Encoder(self.pairs()))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", count: str = "n_tokens") -> DataFrame:
    """Adds the ids of each whole text (binary, little-endian unsigned 32-bit) and their number.

    A null or empty text has no ids. Texts of any length are encoded whole; a batch of rows
    is held at a time (spark.sql.execution.arrow.maxRecordsPerBatch). Repeated rows are
    encoded each; an empty table stays empty. No shuffle. Columns named like the results
    are replaced, all others kept.
    """
    shared = SharedTokenizer(df.sparkSession, path)

    def run(texts: pa.Array) -> list[pa.Array]:
        made = shared.encoder().encode_batch(texts.to_pylist())
        return [pa.array(made, pa.binary()), pa.array([len(m) // 4 for m in made], pa.int64())]

    return append_columns(df, [text], [(ids, T.BinaryType()), (count, T.LongType())], run)


def _spelled(pairs: BytePairs, ids: bytes | None) -> str:
    """The text of packed ids."""
    numbers = array("I", ids or b"")
    if sys.byteorder == "big":
        numbers.byteswap()
    spelling = pairs.spelling
    try:
        raw = b"".join(map(spelling.__getitem__, numbers))
    except KeyError:
        raw = b"".join([spelling.get(i, b"") for i in numbers])
    return raw.decode("utf-8", "replace")


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of each row's packed ids, special tokens included.

    Bytes that are no UTF-8 become the replacement character. Null ids give an empty
    text; an id outside the vocabulary is left out, as in the tokenizers library.
    """
    shared = SharedTokenizer(df.sparkSession, path)

    def run(column: pa.Array) -> list[pa.Array]:
        pairs = shared.pairs()
        return [pa.array([_spelled(pairs, own) for own in column.to_pylist()], pa.string())]

    return append_columns(df, [ids], [(text, T.StringType())], run)


def encode_and_decode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", count: str = "n_tokens", decoded: str = "decoded"
) -> DataFrame:
    """encode and decode one after the other in the same worker, with the results of both."""
    shared = SharedTokenizer(df.sparkSession, path)

    def run(texts: pa.Array) -> list[pa.Array]:
        pairs = shared.pairs()
        made = shared.encoder().encode_batch(texts.to_pylist())
        return [
            pa.array(made, pa.binary()),
            pa.array([len(m) // 4 for m in made], pa.int64()),
            pa.array([_spelled(pairs, m) for m in made], pa.string()),
        ]

    return append_columns(
        df, [text], [(ids, T.BinaryType()), (count, T.LongType()), (decoded, T.StringType())], run
    )


def id_array(ids: str = "ids"):
    """The packed ids as an array of numbers, for readers that want them apart."""
    digits = F.hex(F.col(quoted(ids)))
    numbers = F.transform(
        F.sequence(F.lit(1), F.length(digits), F.lit(8)),
        lambda at: F.conv(
            F.reverse(F.regexp_replace(F.substring(digits, at, F.lit(8)), "(.)(.)", "$2$1")), 16, 10
        ).cast("int"),
    )
    return F.when(F.length(digits) > 0, numbers).otherwise(F.array().cast("array<int>"))
