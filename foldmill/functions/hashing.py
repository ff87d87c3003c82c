"""Hashes that depend on the seed and the row key only, never on partitioning.

md5 rather than xxhash64, so that other SQL engines give the same order and the same draws.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# MD5's constants (RFC 1321): rotations, additions and the words that its four rounds take.
_TURNS = [t for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in four * 4]
_ADDED = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_WORDS = [[i, (5 * i + 1) % 16, (3 * i + 5) % 16, 7 * i % 16][i // 16] for i in range(64)]
_LEFT, _RIGHT = np.array(_TURNS, np.uint32), 32 - np.array(_TURNS, np.uint32)
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def key_hash(key: str | Column, seed: int | str) -> Column:
    """md5 of ``seed:key`` as 32 hex digits; a null key hashes like an empty one."""
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("", F.lit(f"{seed}:"), col.cast("string")))


def hash32(key: str | Column, seed: int | str) -> Column:
    """The first eight hex digits of :func:`key_hash` as a bigint in [0, 2**32)."""
    return F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("bigint")


def draw(seed: int, name: str, index: int) -> int:
    """The same 32-bit draw on the driver, for the few values drawn once per trial."""
    return int(hashlib.md5(f"{seed}:{name}:{index}".encode()).hexdigest()[:8], 16)


def md5_words(prefix: bytes, keys: np.ndarray, suffixes: Sequence[bytes]) -> np.ndarray:
    """MD5 of ``prefix + key + suffix`` for each suffix and key, as arrays of the digests' four little-endian words: (suffix, word, key).

    ``keys`` has a row of bytes for each key, all of one length. What the keys share is added as plain numbers, so many suffixes cost no more bytes.
    """
    out = np.empty((len(suffixes), 4, len(keys)), np.uint32)
    head = len(prefix) + keys.shape[1]
    text = np.zeros((len(keys), -(-head // 4) * 4), np.uint8)
    text[:, : len(prefix)], text[:, len(prefix) : head] = np.frombuffer(prefix, np.uint8), keys
    varying = np.ascontiguousarray(text.view("<u4").T)
    for length in sorted({len(s) for s in suffixes}):
        which = [i for i, s in enumerate(suffixes) if len(s) == length]
        end = head + length
        tails = np.zeros((len(which), (end + 8) // 64 * 64 + 64), np.uint8)
        tails[:, head:end] = [list(suffixes[i]) for i in which]
        tails[:, end], tails[:, -8:] = 0x80, list((8 * end).to_bytes(8, "little"))
        out[which] = _md5_blocks(varying, tails.view("<u4")).swapaxes(0, 1)
    return out


def _md5_blocks(varying: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    """The digests of messages whose word ``w`` is ``varying[w]`` (if it has that many) plus ``fixed[:, w]``: (word, suffix, key)."""
    shape = (len(fixed), varying.shape[1])
    state = np.empty((4, *shape), np.uint32)
    state[:] = np.array(_START, np.uint32)[:, None, None]
    turned = np.empty(shape, np.uint32)
    for first in range(0, fixed.shape[1], 16):
        (a, b, c, d), f = state.copy(), np.empty(shape, np.uint32)
        added = (fixed.T[first:][_WORDS] + np.array(_ADDED, np.uint32)[:, None])[:, :, None]
        for i in range(64):
            if i < 16:
                np.bitwise_xor(c, d, out=f)
                f &= b
                f ^= d
            elif i < 32:
                np.bitwise_xor(b, c, out=f)
                f &= d
                f ^= c
            elif i < 48:
                np.bitwise_xor(b, c, out=f)
                f ^= d
            else:
                np.invert(d, out=f)
                f |= b
                f ^= c
            word = first + _WORDS[i]
            f += a
            f += added[i]
            if word < len(varying):
                f += varying[word]
            np.left_shift(f, _LEFT[i], out=turned)
            f >>= _RIGHT[i]
            f |= turned
            f += b
            a, b, c, d, f = d, f, b, c, a
        for total, part in zip(state, (a, b, c, d)):
            total += part
    return state
