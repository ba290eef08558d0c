"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a doubly linked list of byte positions.  Every adjacent pair
that a rank knows sits in that rank's bucket; a two-level bitmap over the
ranks finds the lowest non-empty bucket with find-first-set, so choosing the
next merge costs the same for a pre-token of ten bytes or ten million.  An
entry whose pair has changed since it was queued is stale and is skipped.
Within a bucket the leftmost position comes first, as byte-pair merging by
ranks prescribes.

Nulls encode as the empty text; every text is encoded whole; rows that repeat are encoded
each on their own; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import documents, keyed_text, map_arrow

#: Entries kept in a worker's memo before it starts a new generation.
MEMO = 250_000
_TWO_SPACES = regex.compile(r"[\s\x1c-\x1f]{2}")


class Memo:
    """Piece to ids in two generations: what is still in use outlives a turnover."""

    def __init__(self, size: int = MEMO):
        self.size = size
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def put(self, key: str, ids: tuple[int, ...]) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = ids


class RankQueue:
    """Buckets of positions per rank under a bitmap of two levels.

    ``low[w]`` has a bit for each of ``WIDTH`` ranks, ``top`` a bit for each
    non-zero word.  A bucket is one position, or a heap once it holds more.
    """

    SHIFT = 8
    WIDTH = 1 << SHIFT
    BIT = [1 << i for i in range(WIDTH)]

    def __init__(self, n_ranks: int):
        self.low = [0] * (n_ranks // self.WIDTH + 1)
        self.top = 0
        self.buckets: dict[int, int | list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = position
            word = rank >> 8
            bits = self.low[word]
            if not bits:
                self.top |= 1 << word
            self.low[word] = bits | self.BIT[rank & 255]
        elif type(bucket) is int:
            self.buckets[rank] = [bucket, position] if bucket < position else [position, bucket]
        else:
            heappush(bucket, position)

    def pop(self) -> tuple[int, int] | None:
        """The leftmost position of the lowest rank; None when empty."""
        top = self.top
        if not top:
            return None
        word = (top & -top).bit_length() - 1
        bits = self.low[word]
        bit = bits & -bits
        rank = word << 8 | (bit.bit_length() - 1)
        bucket = self.buckets[rank]
        if type(bucket) is not int:
            position = heappop(bucket)
            if bucket:
                return rank, position
            bucket = position
        del self.buckets[rank]
        self.low[word] = bits = bits ^ bit
        if not bits:
            self.top = top & (top - 1)
        return rank, bucket


class Codec:
    """Encodes by the ranks in ``path``; pieces are the matches of ``pattern``."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.n_ranks = max(self.ranks.values(), default=0) + 1
        self.names = {v: k for k, v in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(self.n_ranks)
        self.pieces, self.words = Memo(), Memo()
        self.text_of = {i: str(i) for i in self.names}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece, by repeated merging of its lowest-ranked pair."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        nxt = list(range(1, n + 2))  # position of the next part; n ends the list
        prv = list(range(-1, n))
        pair: list[int | None] = [rank_of(piece[i : i + 2]) for i in range(n - 1)]  # rank of the pair that starts here
        pair += (None, None)
        queue = self.queue
        push, pop = queue.push, queue.pop
        for i, r in enumerate(pair):
            if r is not None:
                push(r, i)
        while entry := pop():
            rank, i = entry
            if pair[i] != rank:
                continue  # stale
            j = nxt[i]
            end = nxt[j]
            pair[j] = None
            nxt[i] = end
            prv[end] = i
            pair[i] = r = rank_of(piece[i : nxt[end]]) if end < n else None
            if r is not None:
                push(r, i)
            h = prv[i]
            if h >= 0:
                r = rank_of(piece[h:end])
                if pair[h] != r:
                    pair[h] = r
                    if r is not None:
                        push(r, h)
        ids, i = [], 0
        while i < n:
            j = nxt[i]
            ids.append(self.ranks[piece[i:j]])
            i = j
        return tuple(ids)

    def _pieces(self, text: str) -> list[int]:
        memo, out = self.pieces, []
        young, old = memo.young.get, memo.old.get
        for piece in self.pattern.findall(text):
            ids = young(piece)
            if ids is None:
                ids = old(piece) or self.merge(piece.encode())
                if len(piece) <= 64:
                    memo.put(piece, ids)
                    young, old = memo.young.get, memo.old.get
            out.extend(ids)
        return out

    def encode(self, text: str, spaced: bool = True) -> list[int]:
        """Ids of a whole text.

        ``spaced`` tells that the pattern always starts a new piece at a
        single space between two other characters, as the public patterns do;
        then words are memoised whole.
        """
        if not spaced or _TWO_SPACES.search(text):
            return self._pieces(text)
        head, *rest = text.split(" ")
        memo = self.words
        out = self._pieces(head)
        parts = list(map(memo.young.get, rest))
        if None in parts:
            for i, ids in enumerate(parts):
                if ids is None:
                    word = rest[i]
                    parts[i] = ids = memo.old.get(word) or tuple(self._pieces(" " + word))
                    if len(word) <= 64:
                        memo.put(word, ids)
        out.extend(chain.from_iterable(parts))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.names.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    key = (path, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(path, pattern)
    return _codecs[key]


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every text of ``df``; null text gives no ids."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        c = codec(path, pattern)
        return {"doc_id": batch.column("doc_id"), "ids": [c.encode(x) for x in batch.column("text").to_pylist()]}

    return map_arrow(keyed_text(df, key, text), "doc_id long, ids array<int>", rows)


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, payload binary`` from ``doc_id, ids``; null ids decode to nothing."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        c = codec(path, pattern)
        return {"doc_id": batch.column("doc_id"), "payload": [c.decode(x or []) for x in batch.column("ids").to_pylist()]}

    return map_arrow(df.select("doc_id", "ids"), "doc_id long, payload binary", rows)


def digest(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, then decode the ids, and keep digests of both."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        c = codec(path, pattern)
        counts, ids_sha, bytes_sha = [], [], []
        for value in batch.column("text"):
            ids = c.encode(value.as_py())
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(c.text_of.__getitem__, ids)).encode()).hexdigest())
            bytes_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
        return {"doc_id": batch.column("doc_id"), "n_tokens": counts, "ids_sha256": ids_sha, "decoded_sha256": bytes_sha}

    return map_arrow(df, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", rows)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(documents(spark, sf_dir), *public_vocabulary())
