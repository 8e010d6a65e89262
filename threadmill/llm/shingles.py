"""Distinct word shingles of texts as sorted 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

import numpy as np

WORDS = 5
#: Texts are hashed in batches of about this many bytes.
BATCH_BYTES = 1 << 18

_rng = np.random.default_rng(20240601)
_ODD = _rng.integers(1, 2**63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
PLACE = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as needed."""

    def __init__(self):
        self.base, self.n = int(_ODD[0]), 0

    def upto(self, n: int) -> None:
        if n > self.n:
            n = 1 << max(n, 1 << 16).bit_length()
            inverse = pow(self.base, -1, 1 << 64)
            one = np.ones(1, np.uint64)
            self.up = np.cumprod(np.concatenate([one, np.full(n, self.base, np.uint64)]))
            self.down = np.cumprod(np.concatenate([one, np.full(n, inverse, np.uint64)]))
            self.n = n


_powers = Powers()


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of some bytes: words end at [\\x20\\x09-\\x0D], A-Z count as a-z."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], white, [True]])))
    starts, ends = edge[::2], edge[1::2]
    lower = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    _powers.upto(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[lower] * _powers.up[: len(data)])])
    value = (total[ends] - total[starts]) * _powers.down[starts]
    return starts, mix(value + (ends - starts).astype(np.uint64) * _ODD[1])


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: `words` words each, or all words of a shorter text as one."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size + len(texts[to]) <= BATCH_BYTES):
            size += len(texts[to]) + 1
            to += 1
        some = texts[at:to]
        data = np.frombuffer(b"\n".join(some) + b"\n", np.uint8)
        starts, hashes = word_hashes(data)
        ends = np.cumsum([len(t) + 1 for t in some])
        cuts = np.concatenate([[0], np.searchsorted(starts, ends)])
        if len(hashes) >= words:
            runs = hashes[: len(hashes) - words + 1] * PLACE[0]
            for k in range(1, words):
                runs = runs + hashes[k : len(hashes) - words + 1 + k] * PLACE[k]
            runs = mix(runs)
        for a, b in zip(cuts[:-1], cuts[1:]):
            n = b - a
            if n >= words:
                out.append(np.unique(runs[a : b - words + 1]))
            elif n:
                parts = np.concatenate([hashes[a:b] * PLACE[5 : 5 + n], np.array([n], np.uint64) * _ODD[2]])
                out.append(mix(np.cumsum(parts)[-1:]))
            else:
                out.append(np.zeros(0, np.uint64))
        at = to
    return out
