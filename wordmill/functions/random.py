"""Deterministic hash-based uniform numbers.

A value depends only on (seed, name, keys), never on partitioning or task
order, so a job gives the same numbers on 8 threads or 1000 executors and the
same numbers as the SQL oracle: the first 32 bits of an MD5 digest over the
colon-joined keys, scaled to [0, 1).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _digest(seed: int, name: str, keys: tuple) -> Column:
    parts = [F.lit(str(seed)), F.lit(name)]
    for k in keys:
        if isinstance(k, int):
            parts.append(F.lit(str(k)))
        elif isinstance(k, str):
            parts.append(F.col(k).cast("string"))
        else:
            parts.append(k.cast("string"))
    return F.md5(F.concat_ws(":", *parts))


def _digest_sql(seed: int, name: str, keys: tuple[str, ...]) -> str:
    inner = ", ".join([f"'{seed}'", f"'{name}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"md5(concat_ws(':', {inner}))"


def hash_uniform(seed: int, name: str, *keys: Column | str | int) -> Column:
    return F.conv(F.substring(_digest(seed, name, keys), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_32)


def hash_uniform_sql(seed: int, name: str, *keys: str) -> str:
    """The DuckDB text of the same number (keys are SQL expressions)."""
    return f"(CAST(('0x' || substr({_digest_sql(seed, name, keys)}, 1, 8)) AS BIGINT) / {TWO_32})"


def hash_draw(seed: int, name: str, *keys: Column | str | int) -> Column:
    """hash_uniform with 52 bits, for draws among more than 2^32 things."""
    return F.conv(F.substring(_digest(seed, name, keys), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def hash_draw_sql(seed: int, name: str, *keys: str) -> str:
    return f"(CAST(('0x' || substr({_digest_sql(seed, name, keys)}, 1, 13)) AS BIGINT) / {float(2**52)!r})"


def hash_symmetric(seed: int, name: str, *keys) -> Column:
    """Uniform in [-1, 1)."""
    return hash_uniform(seed, name, *keys) * 2.0 - 1.0


# MD5 (RFC 1321): shifts and constants of its 64 steps.
_SHIFT = (7, 12, 17, 22) * 4 + (5, 9, 14, 20) * 4 + (4, 11, 16, 23) * 4 + (6, 10, 15, 21) * 4
_SINE = [np.uint32(int(abs(math.sin(i + 1)) * 2**32) & 0xFFFFFFFF) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
MD5_CELLS = 1 << 15  # messages hashed side by side: their words stay in the cache


def _first_word(message: np.ndarray) -> np.ndarray:
    """The first 32 bits of the MD5 digest of messages of one block, given as 16
    rows of words, one column per message."""
    a, b, c, d = (np.full(message.shape[1], x, np.uint32) for x in _START)
    f, t = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            g = i
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            g = (5 * i + 1) % 16
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            g = (3 * i + 5) % 16
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            g = 7 * i % 16
        f += a
        f += message[g]
        f += _SINE[i]
        np.left_shift(f, np.uint32(_SHIFT[i]), out=t)
        f >>= np.uint32(32 - _SHIFT[i])
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    a += np.uint32(_START[0])
    return a.byteswap()


def hash_uniform_rows(seed: int, name: str, rows: np.ndarray, cols: int) -> np.ndarray:
    """hash_uniform(seed, name, row, column) of each row number (not negative) and of
    the columns 0 .. cols - 1: an array (rows, cols)."""
    out = np.empty((len(rows), cols))
    step = max(1, MD5_CELLS // max(cols, 1))
    for at in range(0, len(rows), step):
        part = np.asarray(rows[at : at + step], np.int64)
        long = np.char.str_len(part.astype("U20"))
        for digits in np.unique(long):
            mine = np.flatnonzero(long == digits)
            head = np.frombuffer(f"{seed}:{name}:".encode(), np.uint8)
            body = np.frombuffer(part[mine].astype(f"S{digits}").tobytes(), np.uint8).reshape(len(mine), digits)
            for lo, hi in _same_length(cols):
                width = len(str(lo))
                size = len(head) + digits + 1 + width
                if size > 55:
                    raise ValueError(f"the name {name!r} is too long to hash its cells side by side")
                text = np.zeros((len(mine), hi - lo, 64), np.uint8)
                text[:, :, : len(head)] = head
                text[:, :, len(head) : len(head) + digits] = body[:, None, :]
                text[:, :, len(head) + digits] = ord(":")
                tail = np.arange(lo, hi).astype(f"S{width}").tobytes()
                text[:, :, size - width : size] = np.frombuffer(tail, np.uint8).reshape(1, hi - lo, width)
                text[:, :, size] = 0x80
                text[:, :, 56:58] = np.array([size * 8 & 0xFF, size * 8 >> 8], np.uint8)
                words = np.ascontiguousarray(text.reshape(-1, 64).view("<u4").T.astype(np.uint32))
                out[at + mine, lo:hi] = _first_word(words).reshape(len(mine), hi - lo) / TWO_32
    return out


def _same_length(n: int) -> list[tuple[int, int]]:
    """0 .. n - 1 cut into ranges of numbers with as many digits."""
    edges = [0] + [10**i for i in range(1, len(str(max(n - 1, 0))))] + [n]
    return [(a, b) for a, b in zip(edges, edges[1:], strict=False) if a < b]
