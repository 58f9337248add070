"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut by a pattern; each piece is merged on its own. The merges of a piece are held in buckets,
one for each distinct rank among its neighbouring pairs; a bucket lists the positions of pairs with that
rank. Which buckets are filled is kept as bitmap words of 32 ranks, summarised by a bitmap of the words;
find-first-set on the summary and then on the word gives the lowest filled rank. Positions are nodes of a
doubly linked list. A merge changes the two pairs beside it; their old bucket entries stay and are skipped
when they come up, because the pair at that position no longer has that rank. A piece of n bytes costs
O(n log n) even where a whole document is one piece.

Pieces repeat heavily, so each Python worker keeps the ids of short pieces in a bounded cache.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import kept_by_worker

CACHE_PIECES = 500_000
CACHED_BYTES = 48
CACHED_PAIRS = 500_000
# One bitmap word has 32 bits; Python's integers hold the summary whole.
_SHIFT, _MASK = 5, 31


class PairRanks(dict):
    """Rank of the token that two tokens make (-1: none), by left << 32 | right; filled as pairs come up.

    The rank of a token is its id.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte = [ranks.get(bytes([b]), -1) for b in range(256)]

    def __missing__(self, pair: int) -> int:
        if len(self) >= CACHED_PAIRS:
            self.clear()
        rank = self.ranks.get(self.tokens[pair >> 32] + self.tokens[pair & 0xFFFFFFFF], -1)
        self[pair] = rank
        return rank


def merge(piece: bytes, pairs: PairRanks) -> list[int]:
    """Ids of one piece: always the lowest rank first, the leftmost of equals first."""
    n = len(piece)
    byte = pairs.byte
    token = [byte[b] for b in piece]
    wait = [pairs[a << 32 | b] for a, b in zip(token, token[1:])]  # rank of the pair that begins at a node
    wait.append(-1)
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    buckets: dict[int, int | list[int]] = {}  # one position, or a heap of several
    bits: dict[int, int] = {}
    summary = 0
    for i, rank in enumerate(wait):
        if rank >= 0:
            if rank in buckets:
                _add(buckets, rank, i)
            else:
                buckets[rank] = i
                word = rank >> _SHIFT
                if word in bits:
                    bits[word] |= 1 << (rank & _MASK)
                else:
                    bits[word] = 1 << (rank & _MASK)
                    summary |= 1 << word
    while summary:
        word = (summary & -summary).bit_length() - 1
        filled = bits[word]
        low = filled & -filled
        rank = (word << _SHIFT) + low.bit_length() - 1
        held = buckets[rank]
        if held.__class__ is int:
            i = held
            held = None
        else:
            i = heappop(held)
        if not held:
            del buckets[rank]
            if filled == low:
                del bits[word]
                summary ^= 1 << word
            else:
                bits[word] = filled ^ low
        if wait[i] != rank:
            continue  # stale
        j = after[i]
        end = after[j]
        wait[j] = token[j] = -1
        token[i] = rank
        after[i] = end
        before[end] = i
        fresh = before[i]
        if fresh >= 0:
            pair = pairs[token[fresh] << 32 | rank]
            wait[fresh] = pair
            if pair >= 0:
                if pair in buckets:
                    _add(buckets, pair, fresh)
                else:
                    buckets[pair] = fresh
                    word = pair >> _SHIFT
                    if word in bits:
                        bits[word] |= 1 << (pair & _MASK)
                    else:
                        bits[word] = 1 << (pair & _MASK)
                        summary |= 1 << word
        if end >= n:
            wait[i] = -1
            continue
        pair = pairs[rank << 32 | token[end]]
        wait[i] = pair
        if pair >= 0:
            if pair in buckets:
                _add(buckets, pair, i)
            else:
                buckets[pair] = i
                word = pair >> _SHIFT
                if word in bits:
                    bits[word] |= 1 << (pair & _MASK)
                else:
                    bits[word] = 1 << (pair & _MASK)
                    summary |= 1 << word
    return [t for t in token if t >= 0]


def _add(buckets: dict[int, int | list[int]], rank: int, position: int) -> None:
    held = buckets[rank]
    if held.__class__ is list:
        heappush(held, position)
    else:
        buckets[rank] = [held, position] if held < position else [position, held]


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Encoder and decoder for one rank file; lives in a Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(unicode_space(pattern)).findall
        self.pairs = PairRanks(ranks)
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.length) - self.length

    def piece(self, piece: str) -> bytes:
        """Ids of one match of the pattern."""
        found = self.older_pieces.get(piece)
        if found is None:
            # Half of a surrogate pair is no character; it is encoded as the replacement character.
            raw = piece.encode("utf-8", "replace")
            whole = self.ranks.get(raw)
            found = pack(merge(raw, self.pairs) if whole is None else [whole])
            if len(raw) > CACHED_BYTES:
                return found
        if len(self.pieces) >= CACHE_PIECES:
            self.pieces, self.older_pieces = {}, self.pieces
        self.pieces[piece] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        get, slow = self.pieces.get, self.piece
        return b"".join([get(p) or slow(p) for p in self.find(text)])

    def decode(self, ids: bytes | None) -> bytes:
        found = np.frombuffer(ids or b"", "<u4")
        if len(found) and found.max() >= len(self.length):
            raise ValueError("an id outside the vocabulary")
        length = self.length[found]
        skip = self.begin[found] - (np.cumsum(length) - length)
        return self.pool[np.repeat(skip, length) + np.arange(length.sum())].tobytes()


def unicode_space(pattern: str) -> str:
    """The pattern with Unicode's own notion of white space, which leaves out the separators 1C to 1F."""
    pattern = pattern.replace(r"\s", r"\p{White_Space}")
    return re.sub(r"\\S", lambda _: r"\P{White_Space}", pattern)


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one line per token, base64 bytes and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class Tokenizer:
    """Column functions for one vocabulary.

    The vocabulary is read once by the driver and broadcast; its size is that of the rank file (about a
    megabyte) and does not depend on the data. Null and empty texts give no ids; a null id column
    decodes to empty bytes. Ids outside the vocabulary raise an error.
    """

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        ranks = load_ranks(ranks_path)
        shared = spark.sparkContext.broadcast(ranks)
        with open(ranks_path, "rb") as lines:
            name = hashlib.sha256(lines.read() + pattern.encode()).hexdigest()

        def codec() -> Codec:
            # Its cache serves all tasks that the worker process runs.
            return kept_by_worker(("codec", name), lambda: Codec(shared.value, pattern))

        def encode(texts: pa.Array) -> pa.Array:
            one = codec().encode
            return pa.array((one(t.as_py()) for t in texts), pa.binary(), size=len(texts))

        def decode(ids: pa.Array) -> pa.Array:
            one = codec().decode
            return pa.array((one(x.as_py()) for x in ids), pa.binary(), size=len(ids))

        def numbers(ids: pa.Array) -> pa.Array:
            rows = [np.frombuffer(x.as_py() or b"", "<u4").astype(np.int64) for x in ids]
            return pa.array(rows, pa.list_(pa.int64()))

        self._encode = F.arrow_udf(encode, "binary")
        self._decode = F.arrow_udf(decode, "binary")
        self._numbers = F.arrow_udf(numbers, "array<bigint>")

    def encode(self, text: Column) -> Column:
        """Ids packed as little-endian unsigned 32-bit integers (`binary`)."""
        return self._encode(text)

    def decode(self, packed: Column) -> Column:
        """The bytes that packed ids stand for."""
        return self._decode(packed)

    def ids(self, packed: Column) -> Column:
        """Packed ids as `array<bigint>`."""
        return self._numbers(packed)


def round_trip(docs: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, `ids` (packed), `decoded` (bytes) of every row, no shuffle. Other columns are left out.

    Repeated rows give repeated rows; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col), tokenizer.encode(F.col(text_col)).alias("ids"))
    return rows.select(id_col, "ids", tokenizer.decode(F.col("ids")).alias("decoded"))
