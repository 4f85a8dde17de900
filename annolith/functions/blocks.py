"""difflib's ratio of many pairs of texts at once, exactly.

difflib takes the longest block of a window that both texts share, then the windows before and after it. Here the windows of all pairs
go on together, level by level, in NumPy: the stretches of equal characters along a diagonal are listed once, and each level cuts them to
its windows, takes the longest of each (of equal ones that with the first place in a, then in b) and splits the windows. Stretches of two
characters or more go first, found by pairs of characters; single ones are looked for in the small windows that these leave. As in
difflib, characters that make up over a hundredth of a second text of 200 characters or more start no block, but a block grows over them.
"""

from __future__ import annotations

import difflib

import numpy as np

#: Characters of the pairs that go on together, products of their lengths, and equal places of a part at most.
CHARS, AREA, MOST = 1 << 18, 1 << 25, 1 << 21
#: Products of lengths under which difflib itself takes less time.
LITTLE = 1 << 14
#: From how many characters on difflib leaves out frequent ones.
LONG = 200
STEP, BITS = 16, 21
_LAST = (1 << BITS) - 1


def ratios(firsts: list[str], seconds: list[str]) -> np.ndarray:
    """SequenceMatcher(None, a, b).ratio() of each a of firsts with the b of seconds in its place."""
    out = np.array([1.0 if a == b else 0.0 for a, b in zip(firsts, seconds, strict=True)])
    open_ = [i for i, (a, b) in enumerate(zip(firsts, seconds, strict=True)) if a and b and a != b]
    if open_:
        out[open_] = _ratios([firsts[i] for i in open_], [seconds[i] for i in open_])
    return out


def _ratios(firsts: list[str], seconds: list[str]) -> np.ndarray:
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (firsts, seconds))
    if (la * lb).sum() <= LITTLE:
        return 2.0 * _exactly(firsts, seconds) / (la + lb)
    out = np.zeros(len(la))
    cost = np.maximum((la + lb) * (AREA // CHARS), np.where(lb < LONG, la * lb, 0)).cumsum()
    a = 0
    while a < len(la):
        b = max(a + 1, int(np.searchsorted(cost, (cost[a - 1] if a else 0) + AREA, "right")))
        out[a:b] = _matched(firsts[a:b], seconds[a:b], la[a:b], lb[a:b])
        a = b
    return 2.0 * out / (la + lb)


def _flat(texts: list[str], sizes: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all texts with marks before, between and after them, each character's place there, each text's first place)."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    place = np.arange(len(raw)) + np.repeat(np.arange(len(texts)), sizes) + STEP
    flat = np.full(len(raw) + len(texts) + 2 * STEP, mark, np.int32)
    flat[place] = raw
    return flat, place, np.cumsum(sizes) - sizes + np.arange(len(texts)) + STEP


def _grown(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
    """How many characters are equal from places x of a and y of b on, `most` at most; way: 1 forth, -1 back."""
    n = np.zeros(len(x), np.int64)
    live = np.flatnonzero((most > 0) & (a[x] == b[y]))
    steps = np.arange(STEP)
    while len(live):
        at = n[live, None] + steps
        # a mark ends each text before its place could leave the array
        own = np.minimum(at, most[live, None])
        equal = (a[x[live, None] + way * own] == b[y[live, None] + way * own]) & (at < most[live, None])
        whole = equal.all(axis=1)
        n[live] += np.where(whole, STEP, equal.argmin(axis=1))
        live = live[whole]
    return n


def _exactly(firsts: list[str], seconds: list[str]) -> np.ndarray:
    return np.array([float(sum(x.size for x in difflib.SequenceMatcher(None, a, b).get_matching_blocks())) for a, b in zip(firsts, seconds, strict=True)])


class _Many(Exception):
    """More equal places than a part may have."""


def _matched(firsts: list[str], seconds: list[str], la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Characters in the matching blocks of each pair."""
    n = len(la)
    if n == 1 and max(la[0], lb[0]) >= _LAST:
        return _exactly(firsts, seconds)
    a, at_a, alo = _flat(firsts, la, -1)
    b, at_b, blo = _flat(seconds, lb, -2)
    windows = np.stack([np.arange(n), alo, alo + la, blo, blo + lb])
    # second texts' frequent characters, which start no block
    rare, grows = b, lb >= LONG
    if grows.any():
        key = np.repeat(np.arange(n), lb) << BITS | b[at_b]
        order, known, often, _ = _grouped(key)
        popular = (lb[known >> BITS] >= LONG) & (often > lb[known >> BITS] // 100 + 1)
        rare = b.copy()
        rare[at_b[order[np.repeat(popular, often)]]] = -2
    matched = np.zeros(n)
    try:
        short = _levels(a, b, rare, windows[:, ~grows], 2, grows, matched)
        _levels(a, b, rare, np.concatenate([short, windows[:, grows]], axis=1), 1, grows, matched)
    except _Many:
        if n == 1:  # difflib holds two lines of them at a time
            return _exactly(firsts, seconds)
        h = n // 2
        return np.concatenate([_matched(firsts[:h], seconds[:h], la[:h], lb[:h]), _matched(firsts[h:], seconds[h:], la[h:], lb[h:])])
    return matched


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places of key in its order, distinct keys, how often each occurs, where each begins in that order)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return order, key[first], np.diff(first, append=len(key)), first


def _grams(flat: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of all windows' first characters of `width` ones, keys of window and characters)."""
    sizes = np.maximum(hi - lo - width + 1, 0)
    win = np.repeat(np.arange(len(lo)), sizes)
    place = np.arange(len(win)) + np.repeat(lo - np.cumsum(sizes) + sizes, sizes)
    if width == 2:
        return place, (win << BITS | flat[place]) << BITS | flat[place + 1]
    key = win << BITS | flat[place]
    return (place[flat[place] >= 0], key[flat[place] >= 0])


def _stretches(a: np.ndarray, rare: np.ndarray, windows: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(place in a, place in b, window, length) of all stretches of `width` equal characters or more within windows."""
    _, alo, ahi, blo, bhi = windows
    at_a, key_a = _grams(a, alo, ahi, width)
    at_b, key_b = _grams(rare, blo, bhi, width)
    if not len(key_a) or not len(key_b):
        return (np.zeros(0, np.int64),) * 4
    order, known, often, first = _grouped(key_b)
    found = np.minimum(np.searchsorted(known, key_a), len(known) - 1)
    times = np.where(known[found] == key_a, often[found], 0)
    total = int(times.sum())
    if total > MOST:
        raise _Many
    j = at_b[order[np.repeat(first[found] - np.cumsum(times) + times, times) + np.arange(total)]]
    i, win = np.repeat(at_a, times), np.repeat(key_a >> width * BITS, times)
    starts = (a[i - 1] != rare[j - 1]) | (i == alo[win]) | (j == blo[win])
    i, j, win = i[starts], j[starts], win[starts]
    most = np.minimum(ahi[win] - i, bhi[win] - j)
    long, step, live = np.full(len(i), width), width, np.flatnonzero(most > width)
    while len(live := live[a[i[live] + step] == rare[j[live] + step]]):
        step += 1
        long[live] = step
        live = live[most[live] > step]
    return i, j, win, long


def _levels(a: np.ndarray, b: np.ndarray, rare: np.ndarray, windows: np.ndarray, width: int, grows: np.ndarray, matched: np.ndarray) -> np.ndarray:
    """Adds the characters in blocks of `width` or more to matched; the windows (pair, from and to in a, in b) that have none are returned."""
    left = []
    i, j, win, long = _stretches(a, rare, windows, width)
    while windows.shape[1]:
        pair, alo, ahi, blo, bhi = windows
        best = np.zeros(len(pair), np.int64)
        np.maximum.at(best, win, long << 2 * BITS | (_LAST - i + alo[win]) << BITS | (_LAST - j + blo[win]))
        size = best >> 2 * BITS
        left.append(windows[:, size == 0])
        x, y = (np.where(size > 0, lo + _LAST - (best >> bits & _LAST), lo) for lo, bits in ((alo, BITS), (blo, 0)))
        g = np.flatnonzero(grows[pair])
        if len(g):
            back = _grown(a, b, x[g] - 1, y[g] - 1, np.minimum(x[g] - alo[g], y[g] - blo[g]), -1)
            x[g], y[g], size[g] = x[g] - back, y[g] - back, size[g] + back
            u, v = x[g] + size[g], y[g] + size[g]
            size[g] += _grown(a, b, u, v, np.minimum(ahi[g] - u, bhi[g] - v), 1)
        matched += np.bincount(pair, size, len(matched))
        u, v = x + size, y + size
        before, after = (size > 0) & (alo < x) & (blo < y), (size > 0) & (u < ahi) & (v < bhi)
        less = np.minimum(long, np.minimum(x[win] - i, y[win] - j))
        skip = np.maximum(0, np.maximum(u[win] - i, v[win] - j))
        p, q = (less >= width) & before[win], (long - skip >= width) & after[win]
        number = np.cumsum(before) - 1, np.cumsum(after) - 1 + np.count_nonzero(before)
        long = np.concatenate([less[p], (long - skip)[q]])
        i, j, win = np.concatenate([i[p], (i + skip)[q]]), np.concatenate([j[p], (j + skip)[q]]), np.concatenate([number[0][win[p]], number[1][win[q]]])
        earlier, later = np.stack([pair, alo, x, blo, y])[:, before], np.stack([pair, u, ahi, v, bhi])[:, after]
        windows = np.concatenate([earlier, later], axis=1)
    return np.concatenate([windows, *left], axis=1)
