"""Byte-level BPE: texts to ids and back, merges found by a segment tree.

A text is cut by a pattern into pieces.  A piece that is a token itself is that token.  Any other piece starts
as its bytes; the neighbouring pair of tokens with the lowest rank, the leftmost if several have it, becomes one token
until no pair has a rank.  A segment tree over the byte positions holds at each node the
least (rank, position) below it.  Its root names the next merge, and a merge changes three leaves: that of the
merged pair, that of the pair before it, and that of the token that is gone.  A piece of n bytes so takes
O(n log n) steps, also if it is a whole text without a blank.

The ranks are a file of some megabytes at most; the driver reads it and every worker gets it once.  A worker keeps what it has
encoded in two generations of ``MOST_PIECES`` pieces of up to ``KEPT_LENGTH`` characters.

Nulls and odd rows: a null text counts as empty and has no ids; ids that are null decode to null.  Repeated rows come
back as often as they occur.  An empty table gives an empty result.  Other columns may be null and are passed on;
those named like an output column are replaced.
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# Pieces in each of the two generations that a worker keeps, and the longest piece kept.
MOST_PIECES, KEPT_LENGTH = 250_000, 64

# Entry of a pair without a rank, above all others.
NONE = 1 << 80

# Ids are stored as little-endian unsigned 32-bit integers.
ID = "<u4"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token and rank of each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of a piece.

    A token is named by its first byte.  Leaf i of ``tree`` holds rank * n + i of the pair that starts at byte i, a node the
    least of its two children, so the root holds the leftmost pair of the lowest rank.
    """
    n, rank_of = len(piece), ranks.get
    # Where the next and the previous live token start.
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [NONE] * (2 * leaves)
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            tree[leaves + i] = rank * n + i
    for node in range(leaves - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    while (least := tree[1]) != NONE:
        at = least % n
        gone = after[at]
        end = after[at] = after[gone]
        if end < n:
            before[end] = at
            rank = rank_of(piece[at : after[end]])
            changed = [(gone, NONE), (at, NONE if rank is None else rank * n + at)]
        else:
            changed = [(gone, NONE), (at, NONE)]
        previous = before[at]
        if previous >= 0:
            rank = rank_of(piece[previous:end])
            changed.append((previous, NONE if rank is None else rank * n + previous))
        for leaf, entry in changed:
            node = leaves + leaf
            while tree[node] != entry:
                tree[node] = entry
                if node == 1:
                    break
                other = tree[node ^ 1]
                if other < entry:
                    entry = other
                node >>= 1
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at = after[at]
    return [piece[i : after[i]] for i in starts]


class Encoder(dict):
    """Ids of a piece, packed; pieces met again come from one of two generations."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.old, self.pieces = ranks, {}, regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            ids = [rank] if rank is not None else [self.ranks[t] for t in merged(raw, self.ranks)]
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= MOST_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text)))


def decode_ids(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, dtype=ID).tolist()))


# The encoder and the list of tokens of the last broadcast that a worker has met; earlier ones would only fill its memory.
_encoders: dict[tuple[int, str], Encoder] = {}
_tokens: dict[int, list[bytes]] = {}


def _encoder(ranks: Broadcast, pattern: str) -> Encoder:
    key = id(ranks.value), pattern
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks.value, pattern)
    return _encoders[key]


def _token_list(ranks: Broadcast) -> list[bytes]:
    key = id(ranks.value)
    if key not in _tokens:
        listed = [b""] * (1 + max(ranks.value.values(), default=-1))
        for token, rank in ranks.value.items():
            listed[rank] = token
        _tokens.clear()
        _tokens[key] = listed
    return _tokens[key]


def share_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The ranks of a file on the driver, for :func:`encode` and :func:`decode`."""
    return spark.sparkContext.broadcast(read_ranks(path))


def encode(docs: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """``docs`` with n_tokens and ids (binary, little-endian unsigned 32-bit integers)."""

    def packed(texts: pa.Array) -> pa.Array:
        encoder = _encoder(ranks, pattern)
        return pa.array((encoder.encode(t.as_py()) for t in texts), pa.binary())

    # Not to be run once for each use of its result.
    ids = arrow_udf(packed, "binary").asNondeterministic()(F.coalesce("text", F.lit("")))
    return docs.drop("ids").withColumn("ids", ids).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


def decode(tokens: DataFrame, ranks: Broadcast) -> DataFrame:
    """``tokens`` with decoded (binary): the bytes that ids stand for."""

    def unpacked(ids: pa.Array) -> pa.Array:
        listed = _token_list(ranks)
        return pa.array((decode_ids(i.as_py(), listed) if i.is_valid else None for i in ids), pa.binary())

    return tokens.withColumn("decoded", arrow_udf(unpacked, "binary").asNondeterministic()(F.col("ids")))


def round_trip(docs: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """``docs`` with n_tokens, ids and decoded, as :func:`encode` and :func:`decode` give them, from one pass of one worker."""

    def both(texts: pa.Array) -> pa.Array:
        encoder, listed = _encoder(ranks, pattern), _token_list(ranks)
        ids = pa.array((encoder.encode(t.as_py()) for t in texts), pa.binary())
        decoded = pa.array((decode_ids(i.as_py(), listed) for i in ids), pa.binary())
        return pa.StructArray.from_arrays([ids, decoded], ["ids", "decoded"])

    coded = arrow_udf(both, "ids binary, decoded binary").asNondeterministic()(F.coalesce("text", F.lit("")))
    kept = docs.drop("ids", "decoded", "n_tokens")
    return kept.select(*kept.columns, coded.alias("ids")).select(
        *kept.columns, "ids.ids", "ids.decoded", (F.octet_length("ids.ids") / 4).cast("bigint").alias("n_tokens")
    )
