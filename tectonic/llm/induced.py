"""External induced suffix sorting with common prefixes, vectorised with numpy.

Suffixes are typed L or S against their successor; the leftmost S of each run (S*) are sorted by
recursion on their names, then all L are induced from S* in ascending order and all S from L in
descending order. The tuples (suffix, common prefix with the one before) wait in a queue per first
character, the priority queue of the induction; a queue larger than its memory goes to files and
is read back when its character is reached. A common prefix of two induced suffixes is one more
than the least common prefix between their sources, found by range minima over the sources.

Common prefixes are exact up to ``cap``; suffixes that agree on ``cap`` symbols may come in any
order. So the recursion needs names only up to that depth. Its string has as many symbols as
names, too many for a queue each, so the recursion is finished by prefix doubling, whose ranks
also give the common prefixes of S* suffixes.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np

from tectonic.llm import hashing as H

MEMORY = 64 << 20
BLOCK = 1 << 18  # symbols whose names are hashed at once


class Queues:
    """One first-in first-out queue of (suffix, common prefix) per character, on disk beyond
    ``memory`` bytes. Files live in the task's own temporary folder until ``close``."""

    def __init__(self, size: int, memory: int):
        self.waiting = [[] for _ in range(size)]
        self.files: list[list[str]] = [[] for _ in range(size)]
        self.memory, self.held, self.folder, self.written = memory, 0, None, 0

    def push(self, c: int, items: np.ndarray, lcps: np.ndarray) -> None:
        self.waiting[c].append((items, lcps))
        self.held += items.nbytes + lcps.nbytes
        if self.held > self.memory:
            self.folder = self.folder or tempfile.mkdtemp(prefix="suffixes-")
            for d, parts in enumerate(self.waiting):
                if parts:
                    path = os.path.join(self.folder, f"{self.written}.npz")
                    np.savez(path, items=np.concatenate([p[0] for p in parts]), lcps=np.concatenate([p[1] for p in parts]))
                    self.files[d].append(path)
                    self.written += 1
                    parts.clear()
            self.held = 0

    def take(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for path in self.files[c]:
            with np.load(path) as saved:
                parts.append((saved["items"], saved["lcps"]))
            os.unlink(path)
        parts += self.waiting[c]
        self.held -= sum(p[0].nbytes + p[1].nbytes for p in self.waiting[c])
        self.files[c], self.waiting[c] = [], []
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.uint16)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def close(self) -> None:
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low:high]) of many non-empty ranges, by doubling tables."""
    out = values[low]
    width = high - low
    table, span = values, 1
    while True:
        here = np.flatnonzero((width >= span) & (width < 2 * span))
        if len(here):
            out[here] = np.minimum(table[low[here]], table[high[here] - span])
        if not (width >= 2 * span).any():
            return out
        table = np.minimum(table[:-span], table[span:])
        span *= 2


class _Induction:
    def __init__(self, text: np.ndarray, cap: int, memory: int):
        self.text, self.cap, self.memory = text, cap, memory
        self.size = int(text.max(initial=0)) + 1
        n = len(text)
        ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))
        lengths = np.diff(np.append(-1, ends))
        rises = np.append(text[ends[:-1]] < text[ends[:-1] + 1], False)
        self.is_s = np.repeat(rises, lengths)
        self.run = np.minimum(np.repeat(ends, lengths) - np.arange(n) + 1, cap).astype(np.uint16)
        self.stars = np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]).astype(np.int32) + 1

    def _push(self, queues: Queues, since: np.ndarray, c: int, kind: bool, items: np.ndarray,
              lcps: np.ndarray, with_lcps: bool):
        """Queue the predecessors of one type; those of the same character come back as the next wave."""
        before = items - 1
        at = np.flatnonzero((items > 0) & (self.is_s[before] == kind))
        chars = self.text[before[at]]
        order = np.argsort(chars, kind="stable")
        at, chars = at[order], chars[order]
        if not len(at):
            np.minimum(since, lcps.min(), out=since)
            return at.astype(np.int32), lcps[:0]
        first = np.ones(len(at), bool)
        first[1:] = chars[1:] != chars[:-1]
        heads = np.flatnonzero(first)
        bounds = np.append(heads, len(at))
        new = np.zeros(len(at), np.uint16)
        if with_lcps:
            later = np.flatnonzero(~first)
            if len(later):
                new[later] = _least(lcps, at[later - 1] + 1, at[later] + 1)
            new[heads] = np.minimum(np.minimum.accumulate(lcps)[at[heads]], since[chars[heads]])
            new = np.minimum(new + 1, self.cap).astype(np.uint16)
            least = np.append(np.minimum.accumulate(lcps[::-1])[::-1], self.cap).astype(np.uint16)
            np.minimum(since, least[0], out=since)
            since[chars[heads]] = least[at[bounds[1:] - 1] + 1]
        wave = before[:0], new[:0]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            d = int(chars[a])
            if d == c:
                wave = before[at[a:b]], new[a:b]
            else:
                queues.push(d, before[at[a:b]], new[a:b])
        return wave

    def _waves(self, queues: Queues, since: np.ndarray, c: int, kind: bool, with_lcps: bool):
        since[:] = 0
        items, lcps = queues.take(c)
        if len(lcps):
            lcps[0] = 0
        out = []
        while len(items):
            out.append((items, lcps))
            items, lcps = self._push(queues, since, c, kind, items, lcps, with_lcps)
        if not out:
            return items, lcps
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])

    def run_all(self, stars: np.ndarray, star_lcps: np.ndarray, with_lcps: bool = True) -> Iterator[tuple]:
        """From sorted S*, per character in descending order: L and S suffixes, both ascending,
        each followed by their common prefixes."""
        n, text = len(self.text), self.text
        since = np.zeros(self.size, np.uint16)
        queues, large = Queues(self.size, self.memory), Queues(self.size, self.memory)
        try:
            bounds = np.searchsorted(text[stars], np.arange(self.size + 1))
            queues.push(int(text[n - 1]), np.array([n - 1], np.int32), np.zeros(1, np.uint16))
            for c in range(self.size):
                items, lcps = self._waves(queues, since, c, False, with_lcps)
                if len(items):
                    large.push(c, items, lcps)
                low, high = bounds[c], bounds[c + 1]
                if high > low:
                    own, own_lcps = stars[low:high], star_lcps[low:high].copy()
                    own_lcps[0] = min(self.run[items[-1]], self.run[own[0]]) if len(items) else 0
                    self._push(queues, since, c, False, own, own_lcps, with_lcps)
            queues.close()
            queues = Queues(self.size, self.memory)
            for c in range(self.size - 1, -1, -1):
                items, lcps = self._waves(queues, since, c, True, with_lcps)
                own, own_lcps = large.take(c)
                if len(own):
                    down, down_lcps = own[::-1], np.append(own_lcps[1:], 0)[::-1].astype(np.uint16)
                    down_lcps[0] = min(self.run[own[-1]], self.run[items[-1]]) if len(items) else 0
                    self._push(queues, since, c, True, down, down_lcps, with_lcps)
                up = lcps
                if len(items):
                    up = np.append(lcps[1:], 0)[::-1].astype(np.uint16)
                    up[0] = min(self.run[own[-1]], self.run[items[-1]]) if len(own) else 0
                yield own, own_lcps, items[::-1], up
        finally:
            queues.close()
            large.close()

    def sorted_stars(self) -> tuple[np.ndarray, np.ndarray]:
        """S* suffixes in order (up to ``cap`` symbols) and their common prefixes."""
        stars, text, n = self.stars, self.text, len(self.text)
        m = len(stars)
        if not m:
            return stars, np.zeros(0, np.uint16)
        # names: sort the substrings between S* by inducing from S* in any order of their bucket
        any_order = stars[np.argsort(text[stars], kind="stable")]
        is_star = np.zeros(n, bool)
        is_star[stars] = True
        parts = [s[is_star[s]] for _, _, s, _ in self.run_all(any_order, np.zeros(m, np.uint16), False)]
        by_name = np.concatenate(parts[::-1])
        place = np.empty(n, np.int32)
        place[stars] = np.arange(m, dtype=np.int32)
        del parts, is_star, any_order
        ends = np.append(stars[1:] + 1, n)
        marks = np.empty(m, H.U64)
        for i, j in H.slices(np.append(stars, n), BLOCK):  # names overlap by a symbol
            low = int(stars[i])
            sums = H.prefix_sums(text[low:ends[j - 1]].astype(H.U64) + H.U64(1))
            marks[i:j] = H.span_hashes(sums, stars[i:j] - low, ends[i:j] - low)
        marks ^= H.mix((ends - stars).astype(H.U64))
        marks[-1] ^= H.U64(1)  # the last one ends with the text
        own = place[by_name]
        new = np.ones(m, bool)
        new[1:] = marks[own[1:]] != marks[own[:-1]]
        del marks, place, by_name
        rank = np.empty(m, np.int64)
        rank[own] = np.cumsum(new)
        ranks, step, order = [rank.astype(np.int32)], 1, own
        bits = int(m + 1).bit_length()
        reach = np.append(stars, n + self.cap)
        while rank.max() < m and (reach[step:] - reach[:-step]).min() < self.cap:
            key = rank << bits
            key[:-step] += rank[step:]
            if 3 * bits < 64:  # sort keys that carry their index
                key = np.sort((key << bits) | np.arange(m))
                order = key & ((1 << bits) - 1)
                key >>= bits
            else:
                order = np.argsort(key)
                key = key[order]
            rank = np.empty(m, np.int64)
            rank[order] = np.cumsum(np.append(True, key[1:] != key[:-1]))
            ranks.append(rank.astype(np.int32))
            step *= 2
        # common prefixes of neighbours: whole names by the ranks, then symbols
        a, b = order[:-1].copy(), order[1:].copy()
        for level in range(len(ranks) - 1, -1, -1):
            padded = np.append(ranks[level], np.zeros(1 << len(ranks), np.int32))
            here = padded[a]
            same = (here == padded[b]) & (here > 0)
            step = same.astype(np.int64) << level
            a += step
            b += step
        where = np.append(stars, n)
        lcp = np.minimum(where[np.minimum(a, m)] - stars[order[:-1]], self.cap).astype(np.int64)
        x, y = stars[order[:-1]] + lcp, stars[order[1:]] + lcp
        live = np.flatnonzero((lcp < self.cap) & (x < n) & (y < n))
        while len(live):
            live = live[text[x[live]] == text[y[live]]]
            lcp[live] += 1
            x[live] += 1
            y[live] += 1
            live = live[(lcp[live] < self.cap) & (x[live] < n) & (y[live] < n)]
        return stars[order], np.append(0, lcp).astype(np.uint16)


def suffix_buckets(text: np.ndarray, cap: int, memory: int = MEMORY):
    """Per first character, in descending order: (suffixes ascending, common prefix of each with
    the one before it, 0 for the first)."""
    if not len(text):
        return
    work = _Induction(text, cap, memory)
    for large, large_lcps, small, small_lcps in work.run_all(*work.sorted_stars()):
        yield np.concatenate((large, small)), np.concatenate((large_lcps, small_lcps))


def repeated_starts(text: np.ndarray, length: int, memory: int = MEMORY) -> np.ndarray:
    """Flags of the positions whose next ``length`` symbols occur at another position too."""
    flags = np.zeros(len(text), bool)
    for suffixes, lcps in suffix_buckets(text, length, memory):
        same = np.flatnonzero(lcps >= length)
        flags[suffixes[same]] = True
        flags[suffixes[same - 1]] = True
    return flags
