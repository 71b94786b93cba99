"""Hashes of the words of many texts at once, in numpy.

A word's hash is a polynomial over its bytes modulo 2**64, read off prefix
sums, and then mixed. Equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def byte_table(separators) -> np.ndarray:
    """Byte -> 0 for a separator, else 1 + the byte with A-Z in lower case."""
    out = np.arange(1, 257, dtype=np.uint16)
    out[65:91] += 32
    out[list(separators)] = 0
    return out


#: Words are runs without ASCII white space.
SPACED = byte_table([0x20, *range(0x09, 0x0E)])
#: Words are runs of ASCII letters and digits and of bytes beyond ASCII.
LETTERS = byte_table([b for b in range(128) if not chr(b).isalnum()])


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        with np.errstate(over="ignore"):
            held = np.full(max(n, 1 << 19), base, np.uint64)
            held[0] = 1
            np.multiply.accumulate(held, out=held)
        _POWERS[base] = held
    return held[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(32))


def word_hashes(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, first word of each text and the total): len(texts) + 1 bounds."""
    coded = [t.encode("utf-8") for t in texts]
    end = bytes([int(np.flatnonzero(table == 0)[0])])
    blob = np.frombuffer(end.join([*coded, b""]), np.uint8)
    first = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded], dtype=np.int64)])
    b = table[blob]
    inside = b > 0
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edge[0::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(b * _powers(_BASE, len(b)), out=sums[1:])
        h = mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(b))[starts])
    return h, np.searchsorted(starts, first)


def joined(*parts: np.ndarray) -> np.ndarray:
    """One hash of several hashes in order."""
    with np.errstate(over="ignore"):
        out = np.full(len(parts[0]), len(parts) + 1, np.uint64)
        for p in parts:
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + p)
        return out
