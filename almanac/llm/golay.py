"""The binary Golay code of length 23, and fuzzy keys for 64-bit fingerprints.

The code is perfect: every 23-bit word has exactly one codeword within three bits.
A codeword is named by its 12 data bits, its index.  Words one bit apart may decode
to different codewords, but the codeword of the one always lies within four bits of
the other, and at most six codewords do.  So of two segments one bit apart,
one stores its own index and the other looks up its (up to six) nearby indices.

A fingerprint is cut into three segments of at most 23 bits.  Four differing bits
leave, by the pigeonhole principle, one segment without error or two segments with
exactly one error each:

* a segment without error decodes to the same index and the same syndrome;
* two segments with one error each: their weights differ in parity.  The fingerprint whose
  first segment has even weight stores the pair of own indices ("home"), the odd
  one looks up all pairs of nearby indices ("probe"); the parity of the second segment is part of the key.

Every pair of fingerprints that differs in at most four bits shares a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

# Generator polynomial and lengths of the code.
GENERATOR = 0b110001110101
LENGTH, CHECK_BITS = 23, 11

MAX_BITS = 4

# First bit and length of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


_BIT_SYNDROMES = np.array([_remainder(1 << bit) for bit in range(LENGTH)], dtype=np.int64)


def _nearby_errors() -> np.ndarray:
    """For each syndrome the error patterns that lead to a codeword within four bits, the lightest first, padded with -1."""
    found: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            syndrome = int(np.bitwise_xor.reduce(_BIT_SYNDROMES[list(bits)])) if bits else 0
            found[syndrome].append(sum(1 << bit for bit in bits))
    most = max(map(len, found))
    return np.array([errors + [-1] * (most - len(errors)) for errors in found], dtype=np.int64)


NEARBY = _nearby_errors()


def syndrome(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), dtype=np.int64)
    for bit in range(LENGTH):
        out ^= (words >> bit & 1) * _BIT_SYNDROMES[bit]
    return out


def own_index(words: np.ndarray) -> np.ndarray:
    """Index of the codeword within three bits."""
    return (words ^ NEARBY[syndrome(words), 0]) >> CHECK_BITS


def nearby_indices(words: np.ndarray) -> np.ndarray:
    """Indices of all codewords within four bits, padded with -1."""
    errors = NEARBY[syndrome(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> CHECK_BITS)


def keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of its fingerprint).  The lowest bit of a key is 0 for home and 1 for probe."""
    bits = fingerprints.astype(np.uint64)
    segments = [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows = np.arange(len(bits))
    out_keys, out_rows = [], []
    for s, words in enumerate(segments):
        index, rest = own_index(words), syndrome(words)
        out_keys.append((s << 50) | (index << CHECK_BITS | rest) << 1)
        out_rows.append(rows)
    for pair, (a, b) in enumerate(combinations(range(3), 2)):
        first, second = segments[a], segments[b]
        odd_first, odd_second = np.bitwise_count(first) & 1, (np.bitwise_count(second) & 1).astype(np.int64)
        kind = (3 + pair) << 50
        home = rows[odd_first == 0]
        indices = own_index(first[home]) << 12 | own_index(second[home])
        out_keys.append(kind | (indices << 1 | odd_second[home]) << 1)
        out_rows.append(home)
        probe = rows[odd_first == 1]
        near_a, near_b = nearby_indices(first[probe]), nearby_indices(second[probe])
        both = np.where(
            (near_a[:, :, None] < 0) | (near_b[:, None, :] < 0), -1, near_a[:, :, None] << 12 | near_b[:, None, :]
        ).reshape(len(probe), NEARBY.shape[1] ** 2)
        at, column = np.nonzero(both >= 0)
        out_keys.append(kind | (both[at, column] << 1 | (1 - odd_second[probe[at]])) << 1 | 1)
        out_rows.append(probe[at])
    return np.concatenate(out_keys), np.concatenate(out_rows)
