"""A minimal perfect hash over many keys: ``n`` keys, slots 0 to ``n - 1``, in about four bits a key.

Each level has a field of bits, two for every key it is given. A key whose place in the field no other key has
takes it; the others go on to the next, smaller level. The slot of a key is the number of bits set before its
own. The fields lie in blocks of 64 bytes, each with the count of bits before the block and 448 bits, so looking
up a key reads one block a level (1.6 on average) however many keys there are.

Keys are given as pairs of 64-bit hashes; two keys with the same pair cannot be told apart and are refused.
A key that was not there when the hash was made may get some slot: a fingerprint in the slot has to tell.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np

from custofold.llm.common import mix

BITS = 448
BLOCK = np.dtype([("before", "<u8"), ("bits", "<u8", 7)])
HEAD = struct.Struct("<QQ")


def places(low: np.ndarray, high: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Where each key falls in the field of a level."""
    return (mix(low + high * np.uint64(2 * level + 1)) % np.uint64(bits)).astype(np.int64)


def build(low: np.ndarray, high: np.ndarray) -> bytes:
    """The hash as bytes: number of keys, of levels, blocks of each level, then all blocks."""
    if len(low) and len(np.unique(np.stack([low, high]), axis=1).T) < len(low):
        raise ValueError("two keys have the same hash")
    n, sizes, fields = len(low), [], []
    while len(low):
        blocks = -(-2 * len(low) // BITS)
        at = places(low, high, len(sizes), blocks * BITS)
        alone = np.bincount(at, minlength=blocks * BITS)
        field = np.packbits((alone == 1).reshape(blocks, BITS), axis=1, bitorder="little").view("<u8")
        sizes.append(blocks)
        fields.append(field)
        rest = alone[at] > 1
        low, high = low[rest], high[rest]
    bits = np.concatenate([*fields, np.empty((0, 7), "<u8")])
    out = np.zeros(len(bits), BLOCK)
    out["bits"] = bits
    set_bits = np.bitwise_count(bits).sum(axis=1, dtype=np.uint64)
    out["before"] = np.cumsum(set_bits) - set_bits
    return HEAD.pack(n, len(sizes)) + np.array(sizes, "<u8").tobytes() + out.tobytes()


def head_size(levels: int) -> int:
    return HEAD.size + 8 * levels


def size_of(first: bytes) -> tuple[int, int, int]:
    """Number of keys and of levels, and the size of all bytes, from the first ones."""
    n, levels = HEAD.unpack_from(first)
    blocks = np.frombuffer(first, "<u8", levels, HEAD.size)
    return n, levels, head_size(levels) + int(blocks.sum()) * BLOCK.itemsize


def slots(low: np.ndarray, high: np.ndarray, levels: np.ndarray, block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The slot of each key, -1 for one that no level knows. ``block`` gives the blocks of these numbers."""
    out = np.full(len(low), -1, np.int64)
    rest, start = np.arange(len(low)), 0
    for level, blocks in enumerate(levels.tolist()):
        if not len(rest):
            break
        at = places(low[rest], high[rest], level, blocks * BITS)
        own = block(start + at // BITS)
        word, bit = at % BITS // 64, (at % 64).astype(np.uint64)
        words = own["bits"]
        mine = words[np.arange(len(rest)), word]
        hit = (mine >> bit & np.uint64(1)).astype(bool)
        below = np.bitwise_count(mine & ((np.uint64(1) << bit) - np.uint64(1)))
        earlier = np.where(np.arange(7) < word[:, None], np.bitwise_count(words), 0).sum(axis=1)
        found = own["before"].astype(np.int64) + earlier + below
        out[rest[hit]] = found[hit]
        rest = rest[~hit]
        start += blocks
    return out


def lookup(data: bytes | memoryview, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``slots`` over the whole hash in memory."""
    _, n_levels = HEAD.unpack_from(data)
    levels = np.frombuffer(data, "<u8", n_levels, HEAD.size)
    blocks = np.frombuffer(data, BLOCK, int(levels.sum()), head_size(n_levels))
    return slots(low, high, levels, blocks.__getitem__)
