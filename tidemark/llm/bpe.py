"""Byte-level BPE by backtracking over longest matches, and back.

Bytes become Latin-1 characters, so an Aho-Corasick automaton finds the longest vocabulary entry at every position.
A token sequence is what the merges give exactly if every two neighbours are: encoding walks forward with
longest matches, takes a token only if it may follow the last one, tries shorter ones otherwise and steps back where
none is left, never twice over one position. Whether two tokens may be neighbours is remembered.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import list_of, map_batches

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
_MEMO = 500_000
_SPACE_AFTER_SPACE = re.compile(r"\s ")


class _Memo(dict):
    """Remembers a function of one key, up to a bounded number of keys."""

    def __init__(self, function, most: int):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        value = self.function(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        # Tokens that the merges never leave standing can only be whole pieces.
        self.whole, self.halves = set(), {}
        for t, i in ranks.items():
            parts, last = self._merge(t)
            if len(parts) == 1:
                self.whole.add(i)
                self.halves[t] = last
        self.ends, self.starts = (_Memo(lambda i, side=side: self._edge(i, side), _MEMO) for side in (1, 0))
        self.size = {i: len(t) for i, t in self.tokens.items()}
        self.reach = max(self.size.values())
        self.by_chars = {self.tokens[i].decode("latin-1"): i for i in self.whole}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for chars, i in self.by_chars.items():
            self.automaton.add_word(chars, i)
        self.may_follow = _Memo(self._may_follow, _MEMO)
        self.shorter = _Memo(self._shorter, _MEMO)
        self.first = _Memo(self._pieces, 50_000)
        self.later = _Memo(lambda chunk: self._pieces(" " + chunk), 500_000)
        self.piece = _Memo(lambda p: array("i", self.encode_piece(p.encode())).tobytes(), 500_000)

    def merged(self, data: bytes) -> list[int]:
        """Merges applied one by one, lowest rank first; for short strings only, as it is quadratic."""
        return [self.ranks[p] for p in self._merge(data)[0]]

    def _merge(self, data: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """(parts that stay, the two parts of the last merge)."""
        parts, last = [data[i : i + 1] for i in range(len(data))], None
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """(part, rank at which it appears, rank at which it is merged on) of all parts that ever stand at that side of a token."""
        out, part, until = [], self.tokens[token], 1 << 60
        while True:
            born = self.ranks[part] if len(part) > 1 else -1
            out.append((part, born, until))
            if len(part) == 1:
                return out
            part, until = self.halves[part][side], born

    def _may_follow(self, pair: int) -> bool:
        """No merge joins a part at the end of the first token with one at the beginning of the second while both stand.

        Of equal merges the left one goes first.
        """
        for x, x_born, x_until in self.ends[pair >> 32]:
            for y, y_born, y_until in self.starts[pair & 0xFFFFFFFF]:
                rank = self.ranks.get(x + y)
                if rank is not None and rank < x_until and rank <= y_until and x_born < y_until and y_born <= x_until:
                    return False
        return True

    def _shorter(self, token: int) -> int:
        """The longest proper prefix that is a token; -1 if none."""
        data = self.tokens[token]
        for n in range(len(data) - 1, 0, -1):
            if (i := self.ranks.get(data[:n], -1)) in self.whole:
                return i
        return -1

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        if (i := self.ranks.get(data)) is not None:
            return [i]
        size, chars = self.size, data.decode("latin-1")
        open_, out, at, token, last = bytearray(b"\1" * (len(data) + 1)), [], 0, self._longest(chars, 0), -1
        while True:
            end = at + size[token]
            if open_[end] and (last < 0 or self.may_follow[last << 32 | token]):
                out.append(token)
                if end == len(data):
                    return out
                at, last, token = end, token, self._longest(chars, end)
            elif (token := self.shorter[token]) < 0:
                open_[at] = 0
                token = out.pop()
                at, last = at - size[token], out[-1] if out else -1

    def _longest(self, chars: str, at: int) -> int:
        """The longest token at a position: the automaton's trie says how far any token can reach."""
        near = chars[at : at + self.reach]
        for n in range(self.automaton.longest_prefix(near), 0, -1):
            if (i := self.by_chars.get(near[:n])) is not None:
                return i
        raise ValueError("the vocabulary lacks a byte")

    def _pieces(self, text: str) -> bytes:
        return b"".join([self.piece[p] if len(p) < 100 else array("i", self.encode_piece(p.encode())).tobytes() for p in self.pattern.findall(text)])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text. A single space after a character that is no space always begins a match, so such chunks are remembered."""
        if _SPACE_AFTER_SPACE.search(text):
            return np.frombuffer(self._pieces(text), np.int32)
        chunks = text.split(" ")
        head = self.first[chunks[0]] if len(chunks[0]) < 100 else self._pieces(chunks[0])
        rest = chunks[1:]
        if len(text) > 100 * len(chunks) and max(map(len, rest), default=0) > 1000:  # very long chunks are not kept
            return np.frombuffer(head + b"".join(self._pieces(" " + c) if len(c) > 100 else self.later[c] for c in rest), np.int32)
        return np.frombuffer(head + b"".join(map(self.later.__getitem__, rest)), np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(2)
def encoder(path: str = VOCABULARY) -> Encoder:
    """One encoder per Python worker."""
    with open(path, "rb") as lines:
        return Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def encode(df: DataFrame, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``ids array<int>`` for every row, beside all its columns (an old ``ids`` is replaced).

    Null and empty texts have no ids; whole texts of any length are encoded; an empty table gives an empty one.
    """
    kept = df.drop("ids")
    if text not in kept.columns:
        raise ValueError("the text column can't be named ids")
    names = kept.columns
    at = names.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(path)
        found = [coder.encode(t or "") for t in batch.column(at).to_pylist()]
        offsets = np.cumsum([0, *map(len, found)])
        ids = list_of(np.concatenate([*found, np.zeros(0, np.int32)]).astype(np.int32), offsets)
        return pa.RecordBatch.from_arrays([*batch.columns, ids], [*names, "ids"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_batches(kept, run, f"{schema}, ids array<int>")


def decode(df: DataFrame, ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """``decoded binary`` for every row: the bytes of its ids; null ids give no bytes. Ids outside the vocabulary fail."""
    kept = df.drop("decoded")
    names = kept.columns
    at = names.index(ids)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(path)
        out = pa.array([coder.decode(x or ()) for x in batch.column(at).to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, out], [*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_batches(kept, run, f"{schema}, decoded binary")


def round_trip(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, encoded and decoded in one pass without a shuffle.

    Null texts count as empty; ids are kept as they are, null or repeated; an empty table gives an empty one.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(path)
        decimal = _decimals(path)
        n, ids_sha, text_sha = [], [], []
        for text in batch.column(1).to_pylist():
            ids = coder.encode(text or "").tolist()
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
            text_sha.append(hashlib.sha256(coder.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


@lru_cache(2)
def _decimals(path: str) -> dict[int, str]:
    return {i: str(i) for i in encoder(path).tokens}
