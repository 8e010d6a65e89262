"""Suffix sorting of one shard by external induced sorting.

A shard's text is sorted by recursive induction: the suffixes that start a
climb (S*) get names from a first induction, the string of names is sorted by
the same procedure, and a second induction from the sorted S* suffixes gives
the order of all suffixes. An induction takes its tuples (first character,
length of the run of it, rank of the suffix behind the run) from a bulk
priority queue in order and hands the ranks it gives on to the tuples that wait
for them. The queue is laid out once by the two known components; an
extraction takes all tuples up to a barrier below which nothing waits for
anything in the same extraction, and orders them by rank.

Arrays longer than `MEMORY_ITEMS` that outlive a step (the queue's components,
the ranks, each level's text) live in unnamed files of the task, gone with the
process; memory holds one extraction and the step at hand. Common-prefix values are
computed as the sorted suffixes leave the last queue, for neighbours only and
up to the length that matters, and each is verified on the text.
"""

from __future__ import annotations

import numpy as np

#: Longest array that is kept in memory; longer ones are files.
MEMORY_ITEMS = 1 << 22


def _index(n: int):
    """The integers that number n suffixes."""
    return np.int32 if n < 2**31 - 2 else np.int64


def _keep(a: np.ndarray) -> np.ndarray:
    """An array that outlives its step: in a file if it is long."""
    if len(a) <= MEMORY_ITEMS:
        return a
    out = _array(len(a), a.dtype)
    out[:] = a
    return out


def _array(n: int, dtype) -> np.ndarray:
    if n <= MEMORY_ITEMS:
        return np.zeros(n, dtype)
    import tempfile

    with tempfile.TemporaryFile() as f:  # unnamed; the mapping keeps it until it is dropped
        f.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(f, dtype=dtype, mode="r+", shape=(n,))


def _by(a: np.ndarray, b: np.ndarray | None = None) -> np.ndarray:
    """The order by `a`, then `b` (not negative); a radix sort where both fit 16 bits together. Stable without `b`."""
    top, wide = int(a.max(initial=0)) + 1, 1 if b is None else int(b.max(initial=0)) + 1
    if top * wide <= 1 << 16:
        return np.argsort((a if b is None else a.astype(np.int64) * wide + b).astype(np.uint16), kind="stable")
    return np.argsort(a, kind="stable") if b is None else np.argsort(a.astype(np.int64) * wide + b)


def _induce(c: np.ndarray, item: np.ndarray, seeds: np.ndarray, seed_rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all items and seeds, and the items in order.

    c: processing order of characters, where an item's character is not below
    its successor's. Of one character, items come before seeds. seed_rank: the
    order of the seeds within their character, equal for equal ones; items that
    cannot be told apart get equal ranks.
    """
    n = len(c)
    small = _index(n)
    position = np.flatnonzero(item).astype(small)
    rank = _array(n, small)
    # the run of equal characters that an item stands in, and the suffix behind it
    inner = item[:-1] & item[1:] & (c[:-1] == c[1:])
    top = int(c.max()) + 1
    char = c[position]
    if inner.any():
        stop = np.arange(n, dtype=small)
        stop[:-1][inner] = n
        behind = np.minimum.accumulate(stop[::-1])[::-1][position] + small(1)
        run = behind - position
        layout = _by(char, run)
    else:
        behind = position + small(1)
        run = None
        layout = _by(char)
    # ranks are numbers that keep (character, item before seed, order within)
    n_items = np.bincount(char, minlength=top)
    n_seeds = np.bincount(c[seeds], minlength=top)
    base = np.concatenate([[0], np.cumsum(n_items + n_seeds)[:-1]])
    rank[seeds] = (base + n_items)[c[seeds]] + seed_rank
    # the layout of the queue: by character, then run
    position, behind, char = _keep(position[layout]), _keep(behind[layout]), _keep(char[layout])
    # barriers: no tuple may wait for an item of its own extraction
    waits = item[behind]
    most = np.full(top, -1, np.int64)
    if waits.any():
        np.maximum.at(most, char[waits], c[behind[waits]])
    most = np.maximum.accumulate(most)
    ends = np.cumsum(n_items)
    step = char[1:] != char[:-1]
    if run is not None:
        run = run[layout]
        step |= run[1:] != run[:-1]
    group = _keep(np.concatenate([[0], np.cumsum(step)]))  # of equal character and run
    order = _array(len(position), small)
    # a tuple's rank: that of its place among the items, shifted by the seeds before its character
    seeds_before = np.cumsum(n_seeds) - n_seeds
    shift = max(1, int(n).bit_length())
    at = 0
    while at < len(position):
        low = int(char[at])
        high = max(int(np.searchsorted(most, low)), low + 1)  # the first character with a tuple that waits for one from here on
        to = int(ends[min(high, top) - 1])
        keys = (group[at:to] << shift) | rank[behind[at:to]]
        by = np.argsort(keys)
        keys = keys[by]
        place = position[at:to][by]
        # equal tuples share the rank of their first
        dense = np.arange(at, to)
        dense[1:][keys[1:] == keys[:-1]] = 0
        rank[place] = np.maximum.accumulate(dense) + seeds_before[char[at:to]]
        order[at:to] = place
        at = to
    return rank, order


def sorted_suffixes(t: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of `t` (integers, the last one smaller than all others) in order."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    t = _keep(np.asarray(t, _index(n)))
    # a suffix climbs (S) if the next character that differs is larger
    climbs = np.ones(n, bool)
    climbs[:-1] = t[1:] > t[:-1]
    even = t[1:] == t[:-1]
    if even.any():
        known = np.arange(n, dtype=_index(n))
        known[:-1][even] = n
        climbs = climbs[np.minimum.accumulate(known[::-1])[::-1]]
    star = np.flatnonzero(climbs[1:] & ~climbs[:-1]) + 1
    falls = ~climbs
    mirrored = t.max() - t
    last = star[-1:] if len(star) and star[-1] == n - 1 else np.array([n - 1])
    assert last[0] == n - 1

    def both(star_rank):
        rank, falling = _induce(t, falls, star, star_rank)
        # seeds of the second induction: falling suffixes, in mirrored order within their character
        lead = np.sort(falling)
        size = np.bincount(t[lead], minlength=int(t.max()) + 1)
        within = rank[lead] - _base_of(t, falls, star)[t[lead]]
        return (*_induce(mirrored, climbs & _not_last(n), np.concatenate([lead, [n - 1]]),
                         np.concatenate([size[t[lead]] - 1 - within, [0]])), rank, falling)

    # names: S* substrings in order, equal ones alike
    first = np.zeros(len(star), np.int64)
    names_rank, *_ = both(first)
    key = -names_rank[star]
    key[star == n - 1] = key.min() - 1 if len(key) else 0
    distinct, name = np.unique(key, return_inverse=True)
    if len(distinct) < len(star):
        inner = sorted_suffixes(name)
        place = np.empty(len(star), np.int64)
        place[inner] = np.arange(len(star))
    else:
        place = name
    # the order of S* suffixes within their character
    by = _by(t[star], place)
    count = np.bincount(t[star], minlength=int(t.max()) + 1)
    start = np.concatenate([[0], np.cumsum(count)[:-1]])
    star_rank = np.empty(len(star), np.int64)
    star_rank[by] = np.arange(len(star)) - start[t[star[by]]]
    _, climbing, _, falling = both(star_rank)
    climbing = np.concatenate([[n - 1], climbing[::-1]])
    whole = np.concatenate([falling, climbing])
    # of one character, falling suffixes come first
    return whole[_by(t[whole])]


def _not_last(n: int) -> np.ndarray:
    out = np.ones(n, bool)
    out[-1] = False
    return out


def _base_of(c: np.ndarray, item: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """First rank of each character in an induction over these items and seeds."""
    top = int(c.max()) + 1
    total = np.bincount(c[item], minlength=top) + np.bincount(c[seeds], minlength=top)
    return np.concatenate([[0], np.cumsum(total)[:-1]])


def shared_prefix(data: np.ndarray, x: np.ndarray, y: np.ndarray, length: int) -> np.ndarray:
    """Which pairs of positions have `length` equal bytes from there on (in chunks that fit the cache)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    alike = np.arange(len(x))
    out = np.zeros(len(x), bool)
    starts = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    # the ends first: neighbours in order mostly differ late or not at all
    for at in reversed(starts):
        if not len(alike):
            return out
        a = np.ascontiguousarray(words[x[alike] + at]).view(np.uint64).ravel()
        b = np.ascontiguousarray(words[y[alike] + at]).view(np.uint64).ravel()
        alike = alike[a == b]
    out[alike] = True
    return out


def repeated_starts(data: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """Of the start positions `wanted` (mask over the bytes, each with `length` bytes
    of its own behind it), those whose string of `length` bytes starts at another one too."""
    t = np.concatenate([data.astype(np.int64) + 1, [0]])
    order = sorted_suffixes(t)
    order = order[order < len(data)]
    order = order[wanted[order]]
    alike = shared_prefix(data, order[:-1], order[1:], length) if len(order) > 1 else np.zeros(0, bool)
    out = np.zeros(len(data), bool)
    out[order[:-1][alike]] = True
    out[order[1:][alike]] = True
    return out
