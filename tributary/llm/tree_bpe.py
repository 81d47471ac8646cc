"""Byte-level BPE by monoid tree reduction.

A piece of text is cut into leaves that are encoded directly; halves are joined upwards. Joining two
encodings only needs their border: a window of tokens around it is decoded and encoded afresh, and grows
by one token a side (then doubling) until the token before the window and the first one in it, and the last one in it and
the token after it, are stable neighbours. Two tokens are stable neighbours when encoding their bytes
gives the two tokens back. A sequence in which all neighbours are stable is the encoding of its bytes, so
that everything outside the window is then proven final. Between matches of the pattern nothing ever merges: there the join of two
encodings is their concatenation, by which the tree goes on from pieces to chunks and whole texts. Decoding concatenates the
tokens' bytes up a tree as well, two neighbours at a time.

Cases: null and empty texts have no tokens; very long texts and pieces are cut and joined like any other;
bytes that a vocabulary lacks raise KeyError; repeated rows give equal results; further columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from tributary.llm.common import ChunkEncoder, groups, map_rows, take_over, text_batches
from tributary.session import ship

#: Bytes of a leaf.
LEAF = 24
#: Tokens of a leaf in decoding.
DECODE_LEAF = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks file: a line has a token in base64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def up_the_tree(token: Callable[[int], bytes], ids: list[int]) -> bytes:
    """The bytes of ids: those of DECODE_LEAF neighbours at the leaves, then of two neighbours at a time up to the root."""
    parts = [b"".join(map(token, ids[a : a + DECODE_LEAF])) for a in range(0, len(ids), DECODE_LEAF)]
    while len(parts) > 1:
        last = parts[-1:] if len(parts) % 2 else []
        parts = [a + b for a, b in zip(parts[::2], parts[1::2])] + last
    return parts[0] if parts else b""


class TreeBpe:
    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF):
        self.ranks, self.leaf = ranks, leaf
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.stable = lru_cache(1 << 16)(self._stable)

    def merge(self, data: bytes) -> list[int]:
        """Direct encoding of a short run of bytes: join the neighbours of lowest rank until none has one."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == 1 << 60:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
        return [ranks[p] for p in parts]

    def _stable(self, a: int, b: int) -> bool:
        return self.merge(self.tokens[a] + self.tokens[b]) == [a, b]

    def decode(self, ids: list[int]) -> bytes:
        """Concatenates up the tree."""
        return up_the_tree(self.tokens.__getitem__, ids)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both."""
        if not left or not right:
            return left + right
        if self.stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join([self.tokens[t] for t in left[len(left) - i :] + right[:j]]))
            before = i == len(left) or self.stable(left[-i - 1], window[0])
            after = j == len(right) or self.stable(window[-1], right[j])
            if before and after:
                return left[: len(left) - i] + window + right[j:]
            if not before:
                i = min(len(left), i + max(1, i // 2))
            if not after:
                j = min(len(right), j + max(1, j // 2))

    def encode(self, data: bytes) -> list[int]:
        """The encoding of one piece."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self._tree(data)

    def _tree(self, data: bytes) -> list[int]:
        if len(data) <= self.leaf:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self._tree(data[:half]), self._tree(data[half:]))


class TreeEncoder(ChunkEncoder):
    """Encodes chunks piece by piece; pieces are the pattern's matches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int = 300_000):
        super().__init__(most)
        self.bpe, self.pieces = TreeBpe(ranks), regex.compile(pattern)
        self.known: dict[str, list[int]] = {}

    def encode_new(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > 40_000:
            self.known.clear()
        ids: list[int] = []
        lengths, known, encode = np.empty(len(keys), np.int64), self.known, self.bpe.encode
        for i, key in enumerate(keys):
            before = len(ids)
            for piece in self.pieces.findall(self.chunk(key)):
                got = known.get(piece)
                if got is None:
                    got = encode(piece.encode("utf-8", "surrogatepass"))
                    if len(piece) <= 64:
                        known[piece] = got
                ids += got
            lengths[i] = len(ids) - before
        return np.array(ids, np.uint32), lengths


_encoders: dict[tuple[str, str], TreeEncoder] = {}
_tokens: dict[str, list[bytes]] = {}


def _encoder(path: str, pattern: str) -> TreeEncoder:
    """One encoder for each worker, kept from task to task."""
    take_over("tree", _encoders.clear)
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = TreeEncoder(read_ranks(path), pattern)
    return _encoders[path, pattern]


def _token_bytes(path: str) -> list[bytes]:
    """All tokens' bytes by rank."""
    if path not in _tokens:
        tokens = {rank: token for token, rank in read_ranks(path).items()}
        _tokens[path] = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]
    return _tokens[path]


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every whole text."""
    ship(docs.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(ranks_path, pattern)
        for frame in text_batches(frames):
            ids, counts = encoder.encode(list(frame["text"]))
            ids = ids.astype("<u4", copy=False)
            edge = np.concatenate([[0], np.cumsum(counts)])
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "ids": [ids[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]}
            )

    return map_rows(docs.select("doc_id", "text"), work, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids and the bytes they stand for."""
    ship(encoded.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = _token_bytes(ranks_path).__getitem__
        for frame in frames:
            for a, b in groups([len(x) for x in frame["ids"]]):
                part = frame.iloc[a:b]
                yield part.assign(data=[up_the_tree(token, np.frombuffer(x, "<u4").tolist()) for x in part["ids"]])

    return map_rows(encoded.select("doc_id", "ids"), work, "doc_id long, ids binary, data binary")
