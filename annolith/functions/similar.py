"""The most similar of the last texts by difflib's ratio, exactly, with few measured.

The ratio is 2 m / t, with m matched characters of t. Characters counted by their last eight bits give at least as many in
common, so the sum of the smaller counts bounds m from above for all kept texts in one NumPy step. Matched characters come in the
same order in both texts, so the longest common subsequence bounds m more closely; it is found for all kept texts in one pass.
Texts are then measured in order of that bound, several at once, until it falls under what is already found.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Generator

import numpy as np

from annolith.functions import blocks

#: Asks for ratios of pairs, is sent them, and returns (ratio, text) of the nearest.
Search = Generator[list[tuple[str, str]], list[float] | None, list[tuple[float, str]]]

#: Kept texts under which bounds cost more than they save.
FEW = 3
#: Kept texts that are measured at once, at first; then twice as many each time.
ONCE = 4
#: Characters of a text over which the closer bound would take too long.
WIDE = 1000
#: Searches that are led together.
TOGETHER = 256


def counts(text: str) -> np.ndarray:
    return np.bincount(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) & 255, minlength=256)


class Common:
    """Lengths of the longest common subsequences of a text with all of several others, in one pass over its characters, by Hyyrö's
    bit-parallel rule. The others lie side by side in one long number for each character; each has `width` bits, of which one at
    least stays free for the carry of an addition."""

    def __init__(self):
        self.width, self.laid, self.masks, self.full = 64, [], {}, 0

    def _turn(self, text: str, at: int) -> None:
        """Puts a text's characters in a free place, or takes them away."""
        own, bit = {}, 1
        for c in text:
            own[c] = own.get(c, 0) | bit
            bit <<= 1
        for c, bits in own.items():
            self.masks[c] = self.masks.get(c, 0) ^ bits << at
            if not self.masks[c]:
                del self.masks[c]
        self.full ^= bit - 1 << at

    def lay(self, texts: list[str]) -> None:
        """The others from now on, of no fewer places than before. Only places with another text are changed."""
        longest = max(map(len, texts))
        if longest >= self.width:
            self.width, self.laid, self.masks, self.full = (longest // 64 + 1) * 64, [], {}, 0
        self.laid += [""] * (len(texts) - len(self.laid))
        for i, text in enumerate(texts):
            if text != self.laid[i]:
                self._turn(self.laid[i], i * self.width)
                self._turn(text, i * self.width)
                self.laid[i] = text

    def lengths(self, text: str) -> np.ndarray:
        full, masks = self.full, self.masks
        left = full
        for c in text:
            if c in masks:
                met = left & masks[c]
                left = (left + met | left - met) & full
        found = np.frombuffer((full ^ left).to_bytes(len(self.laid) * self.width // 8, "little"), "<u8")
        return np.bitwise_count(found).reshape(len(self.laid), -1).sum(axis=1, dtype=np.int64)


class Recent:
    """A ring of the last `size` texts, each with a value of the caller's. kept_first: kept texts are difflib's first argument.
    known: ratios of (first, second) that the caller has measured already."""

    def __init__(self, size: int, kept_first: bool = False, known: dict[tuple[str, str], float] | None = None):
        self.size, self.kept_first, self.n, self.known = size, kept_first, 0, {} if known is None else known
        self.texts: list[str] = []
        self.values: list = []
        self.table = np.zeros((min(size, 16), 256), np.int32)
        self.common = Common()

    def add(self, text: str, value=None) -> None:
        place, self.n = self.n % self.size, self.n + 1
        if place == len(self.texts):
            self.texts.append(text)
            self.values.append(value)
            if place == len(self.table):
                self.table = np.concatenate([self.table, np.zeros((min(self.size, 2 * place) - place, 256), np.int32)])
        self.texts[place], self.values[place] = text, value
        self.table[place] = counts(text)

    def in_order(self) -> list[tuple]:
        """(text, value) from the oldest to the newest."""
        start = self.n % self.size if self.n > self.size else 0
        order = [*range(start, len(self.texts)), *range(start)]
        return [(self.texts[i], self.values[i]) for i in order]

    def search(self, text: str, k: int, least: float = 0.0, differ: bool = False) -> Search:
        """nearest of what is kept now, for `together`."""
        n = len(self.texts)
        if n > FEW or (n and least > 0):
            lengths = self.table[:n].sum(axis=1) + len(text)
            part = lambda most: np.where(lengths > 0, 2.0 * most / np.maximum(lengths, 1), 1.0)
            bounds = part(np.minimum(self.table[:n], counts(text)).sum(axis=1))
            if len(text) <= WIDE and np.count_nonzero(bounds >= least) > FEW:
                self.common.lay([x if len(x) <= WIDE else "" for x in self.texts])
                bounds = np.where(lengths - len(text) <= WIDE, part(self.common.lengths(text)), bounds)
        else:
            bounds = np.ones(n)
        order = np.argsort(-bounds, kind="stable")
        return self._steps(text, [self.texts[i] for i in order], bounds[order], k, least, differ)

    def _steps(self, text: str, texts: list[str], bounds: np.ndarray, k: int, least: float, differ: bool) -> Search:
        best: list[tuple[float, str]] = []
        seen: dict[str, float] = {}
        at, many = 0, ONCE
        while k > 0 and at < len(texts):
            floor = max(least, best[0][0]) if len(best) == k else least
            part = texts[at : at + min(many, int(np.count_nonzero(bounds[at:] >= floor)))]
            if not part:
                break
            part, at, many = [x for x in part if not differ or x != text], at + len(part), 2 * many
            pairs = {x: (x, text) if self.kept_first else (text, x) for x in part if x not in seen}
            seen.update((x, self.known[p]) for x, p in pairs.items() if p in self.known)
            asked = [x for x in pairs if x not in seen]
            seen.update(zip(asked, (yield [pairs[x] for x in asked]) if asked else (), strict=True))
            for found in ((seen[x], x) for x in part if seen[x] >= least):
                if len(best) < k:
                    heapq.heappush(best, found)
                else:
                    heapq.heappushpop(best, found)
        return sorted(best, reverse=True)

    def nearest(self, text: str, k: int, least: float = 0.0, differ: bool = False) -> list[tuple[float, str]]:
        """The k kept texts of greatest (ratio, text), in falling order, of those with a ratio of `least` or more; differ: without equal texts."""
        return together([self.search(text, k, least, differ)])[0]


def together(searches: list[Search]) -> list[list[tuple[float, str]]]:
    """What each search finds. What all of them ask for next is measured at once."""
    found: list[list[tuple[float, str]]] = [[] for _ in searches]
    live: list[tuple[int, list[float] | None]] = [(i, None) for i in range(len(searches))]
    while live:
        asked = []
        for i, told in live:
            try:
                asked.append((i, searches[i].send(told)))
            except StopIteration as end:
                found[i] = end.value
        pairs = [p for _, ask in asked for p in ask]
        ratios = iter(blocks.ratios([a for a, _ in pairs], [b for _, b in pairs]).tolist())
        live = [(i, list(itertools.islice(ratios, len(ask)))) for i, ask in asked]
    return found
