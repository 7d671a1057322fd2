"""SHA-256 over many messages at once, with chaining states that can be stored and resumed.

The standard library's hash objects can be copied but not written to a table; here the
state after a whole number of 64-byte blocks is eight 32-bit words, 32 bytes a message.
Digests as hex text are exactly one block, so every child slot of a node begins at one.
"""

from __future__ import annotations

import math

import numpy as np


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(x: int) -> int:
    r = round(x ** (1 / 3))
    while r ** 3 > x:
        r -= 1
    while (r + 1) ** 3 <= x:
        r += 1
    return r


_MASK = 0xFFFFFFFF
#: First 32 bits of the fractions of the square and cube roots of the first primes (FIPS 180-4).
START = np.array([math.isqrt(p << 64) & _MASK for p in _primes(8)], np.uint32)
ROUND = [np.uint32(_cube_root(p << 96) & _MASK) for p in _primes(64)]
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block each; ``blocks`` is (n, 16) words."""
    w = list(np.ascontiguousarray(blocks.T))
    a, b, c, d, e, f, g, h = begin = list(np.ascontiguousarray(state.T))
    for i in range(64):
        if i >= 16:
            x, y = w[(i - 15) % 16], w[(i - 2) % 16]
            w[i % 16] = (w[i % 16] + w[(i - 7) % 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3)))
                         + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + w[i % 16] + ROUND[i]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return np.stack([x + y for x, y in zip(begin, (a, b, c, d, e, f, g, h))], axis=1)


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The (n, 16) words of digests (n, 32) written as lowercase hex text."""
    text = np.empty((len(digests), 64), np.uint8)
    text[:, 0::2] = HEX[digests >> 4]
    text[:, 1::2] = HEX[digests & 15]
    return text.view(">u4").astype(np.uint32)


def end_block(n_blocks: np.ndarray) -> np.ndarray:
    """The closing block of messages of ``n_blocks`` whole blocks (fewer than 2**23)."""
    out = np.zeros((len(n_blocks), 16), np.uint32)
    out[:, 0] = 0x80000000
    out[:, 15] = n_blocks * 512
    return out


def digest(state: np.ndarray) -> np.ndarray:
    """States (n, 8) as digests (n, 32)."""
    return state.astype(">u4").view(np.uint8).reshape(-1, 32)


def state_bytes(state: np.ndarray) -> bytes:
    return state.astype(">u4").tobytes()


def states_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(-1, 8)
