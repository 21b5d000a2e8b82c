"""SHA-256 states that can leave their process, many at a time.

``hashlib`` objects can be copied but neither stored nor sent. Here a state is
its eight words, an array row of ``uint32``, so a table can hold it and any task
can go on from it. The hex text of a digest is 64 bytes, one block, so states
between digests need nothing else. Arrays have one column per message: states
(8, n), blocks (16, n); a block of one column serves all messages.
"""

from __future__ import annotations

import functools

import numpy as np

W = np.uint32
DIGEST_BYTES = 32


def _root_bits(n: int, root: int) -> int:
    """First 32 bits of the fraction of the square or cube root of ``n``."""
    scaled, lo, hi = n << (32 * root), 0, 1 << 40
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if mid ** root <= scaled else (lo, mid)
    return lo & 0xFFFFFFFF


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, p))]
ROUND = np.array([_root_bits(p, 3) for p in _PRIMES], W)
START = np.array([_root_bits(p, 2) for p in _PRIMES[:8]], W)


def start(n: int) -> np.ndarray:
    return np.repeat(START[:, None], n, axis=1)


def _turn(x: np.ndarray, k: int) -> np.ndarray:
    return (x >> W(k)) | (x << W(32 - k))


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States after one more block."""
    w = np.empty((64, block.shape[1]), W)
    w[:16] = block
    for i in range(16, 64, 2):  # two at a time: a word needs none nearer than two before it
        a, b = w[i - 15: i - 13], w[i - 2: i]
        w[i: i + 2] = (w[i - 16: i - 14] + (_turn(a, 7) ^ _turn(a, 18) ^ (a >> W(3))) + w[i - 7: i - 5]
                       + (_turn(b, 17) ^ _turn(b, 19) ^ (b >> W(10))))
    w += ROUND[:, None]
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        up = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + w[i]
        a, b, c, d, e, f, g, h = (up + (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b))),
                                  a, b, c, d + up, e, f, g)
    return state + np.stack([a, b, c, d, e, f, g, h])


@functools.cache
def _hex_words() -> np.ndarray:
    """ASCII of four hex digits, by their value."""
    digit = np.frombuffer(b"0123456789abcdef", np.uint8).astype(W)
    v = np.arange(1 << 16, dtype=W)
    return (digit[v >> W(12)] << W(24)) | (digit[(v >> W(8)) & W(15)] << W(16)) | (digit[(v >> W(4)) & W(15)] << W(8)) | digit[v & W(15)]


def hex_block(digest: np.ndarray) -> np.ndarray:
    """Lowercase hex text of digests (8, n) as blocks (16, n)."""
    out = np.empty((16, digest.shape[1]), W)
    out[0::2], out[1::2] = _hex_words()[digest >> W(16)], _hex_words()[digest & W(0xFFFF)]
    return out


def closing_block(n_blocks: np.ndarray) -> np.ndarray:
    """Padding behind ``n_blocks`` whole blocks (512 bits each)."""
    out = np.zeros((16, len(n_blocks)), W)
    out[0] = 0x80000000
    bits = n_blocks.astype(np.uint64) * np.uint64(512)
    out[14], out[15] = (bits >> np.uint64(32)).astype(W), (bits & np.uint64(0xFFFFFFFF)).astype(W)
    return out


def pack(words: np.ndarray) -> bytes:
    """(8, n) as n times 32 bytes."""
    return np.ascontiguousarray(words.T).astype(">u4").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, ">u4").astype(W).reshape(-1, 8).T)
