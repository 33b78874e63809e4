"""External induced sorting of suffixes, with common prefixes carried along.

Queues hold tuples (position, common prefix with the tuple before) by first
character; tuples enter a queue in sorted order, so the queues of all characters
together are a priority queue of suffixes.  What exceeds MEMORY_TUPLES goes to
files.  Small suffixes are induced from large ones and the reverse, starting
from the leftmost-small positions, which are sorted by words of their characters
until these cover the depth that is asked for.

A common prefix is carried as 1 + the least value met in the source stream since
the last tuple that went to the same queue, at most ``depth``.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

MEMORY_TUPLES = 4_000_000
BLOCK = 1 << 20


class Queues:
    """A queue of tuples for each character; blocks beyond the memory limit are kept in files."""

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit, self.held, self.files = folder, limit, 0, 0
        self.blocks: dict[int, list] = {}

    def push(self, char: int, position: np.ndarray, common: np.ndarray) -> None:
        self.blocks.setdefault(char, []).append((position, common))
        self.held += len(position)
        if self.held > self.limit:
            self.spill()

    def spill(self) -> None:
        """Write all blocks that are held, each queue's as one file."""
        for own in self.blocks.values():
            here = [b for b in own if not isinstance(b, str)]
            if here:
                path = os.path.join(self.folder, f"{self.files}.npz")
                self.files += 1
                np.savez(path, p=np.concatenate([b[0] for b in here]), c=np.concatenate([b[1] for b in here]))
                # held blocks always follow the files of their queue
                own[:] = [b for b in own if isinstance(b, str)] + [path]
        self.held = 0

    def take(self, char: int):
        """Remove the blocks that are in the queue now, and give them in pieces of BLOCK tuples (the last may be smaller)."""
        waiting, n = [], 0
        for b in self.blocks.pop(char, []):
            if isinstance(b, str):
                with np.load(b) as f:
                    b = f["p"], f["c"]
            else:
                self.held -= len(b[0])
            waiting.append(b)
            n += len(b[0])
            if n >= BLOCK:
                yield from self._pieces(waiting)
                waiting, n = [], 0
        if n:
            yield from self._pieces(waiting)

    @staticmethod
    def _pieces(blocks: list):
        position, common = (np.concatenate([b[k] for b in blocks]) for k in (0, 1))
        for k in range(0, len(position), BLOCK):
            yield position[k : k + BLOCK], common[k : k + BLOCK]


class _Stream:
    """Sends the predecessors of a sorted stream of suffixes to their queues."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, queues: Queues, depth: int):
        self.text, self.wanted, self.queues, self.depth = text, wanted, queues, depth
        self.since = np.zeros(int(text.max()) + 1, np.uint8)  # least common prefix since the last tuple to each queue

    def feed(self, position: np.ndarray, common: np.ndarray) -> None:
        if not len(position):
            return
        before = position - 1
        at = np.flatnonzero(self.wanted[before] & (before >= 0))
        before = before[at]
        char = self.text[before]
        order = np.argsort(char, kind="stable")
        at, before, char = at[order], before[order], char[order]
        n = len(at)
        if not n:
            np.minimum(self.since, common.min(), out=self.since)
            return
        cuts = np.flatnonzero(char[1:] != char[:-1]) + 1
        firsts = np.concatenate(([0], cuts))
        # the least of common[low : at + 1], where low follows the tuple before of the same character
        bounds = np.empty(2 * n, np.int64)
        bounds[1::2] = at + 1
        bounds[2::2] = at[:-1] + 1
        bounds[2 * firsts] = 0
        new = np.minimum.reduceat(np.append(common, np.uint8(255)), bounds)[::2]
        own = char[firsts]
        new[firsts] = np.minimum(new[firsts], self.since[own])
        new = np.minimum(new, self.depth - 1).astype(np.uint8) + np.uint8(1)
        rest = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(255))  # the least from each place on
        np.minimum(self.since, rest[0], out=self.since)
        lasts = np.append(cuts, n)
        self.since[own] = rest[at[lasts - 1] + 1]
        for c, a, b in zip(own.tolist(), firsts.tolist(), lasts.tolist(), strict=True):
            self.queues.push(c, before[a:b], new[a:b])


def _kinds(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """True for suffixes smaller than the one after them; and the length of the run of equal characters (capped)."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])  # last places of runs
    last = np.r_[change, n - 1]
    end = np.repeat(last, np.diff(last, prepend=-1))
    small = np.zeros(n, bool)
    inner = end < n - 1
    small[inner] = text[end[inner]] < text[end[inner] + 1]
    small[n - 1] = True
    return small, np.minimum(end - np.arange(n) + 1, 255).astype(np.uint8)


def _induce(text, small, runs, seeds, seed_common, depth, folder, limit, emit):
    """Induce all suffixes from the ordered ``seeds``; ``emit(position, common)`` gets them from the largest down.

    ``common`` there is the prefix in common with the suffix emitted before.
    """
    chars = np.unique(text)
    queues, large = Queues(folder, limit), {}
    stream = _Stream(text, ~small, queues, depth)
    seed_char = text[seeds]
    low, high = np.searchsorted(seed_char, chars), np.searchsorted(seed_char, chars, "right")
    kept = Queues(os.path.join(folder, "large"), limit)
    os.makedirs(kept.folder, exist_ok=True)
    for k, c in enumerate(chars.tolist()):
        last = None
        while c in queues.blocks:
            for position, common in queues.take(c):
                if last is None:
                    common = np.r_[np.uint8(0), common[1:]]
                stream.feed(position, common)
                kept.push(c, position, common)
                last = position[-1]
        large[c] = last
        for s in range(int(low[k]), int(high[k]), BLOCK):
            own = seeds[s : min(s + BLOCK, high[k])]
            common = seed_common[s : min(s + BLOCK, high[k])].copy()
            if s == low[k]:
                common[0] = 0 if last is None else min(runs[last], runs[own[0]], depth)
            stream.feed(own, common)
    queues = Queues(folder, limit)
    stream = _Stream(text, small, queues, depth)
    for c in chars[::-1].tolist():
        last = None
        while c in queues.blocks:
            for position, common in queues.take(c):
                if last is None:
                    common = np.r_[np.uint8(0), common[1:]]
                stream.feed(position, common)
                emit(position, common)
                last = position[-1]
        # the large suffixes of this character, from the largest down
        blocks, follow = [], None
        for position, common in kept.take(c):
            blocks.append((position, common))
        for position, common in reversed(blocks):
            down = position[::-1]
            shared = np.r_[np.uint8(0) if follow is None else follow, common[:0:-1]].astype(np.uint8)
            if follow is None and last is not None:
                shared[0] = min(runs[last], runs[down[0]], depth)
            stream.feed(down, shared)
            emit(down, shared)
            follow = common[0]


def _ordered(text: np.ndarray, seeds: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The seeds sorted by the first ``depth`` characters of their suffixes (or a few more), and the prefix, at most ``depth``, each has in common with the one before.

    Words of as many characters as 63 bits hold are compared one after the other, each
    only for the seeds that are still equal to another.
    """
    n, bits = len(text), int(text.max()).bit_length()
    each = min(63 // bits, depth)
    padded = np.concatenate((text, np.zeros(each, text.dtype))).astype(np.int64)
    word = np.zeros(n + 1, np.int64)  # the characters from each place on
    for k in range(each):
        word[:n] <<= bits
        word[:n] |= padded[k : k + n]
    least = np.array([1 << bits * k for k in range(each)], np.int64)  # that a difference of the last, the last but one, ... character makes
    order, common, same = seeds, np.zeros(len(seeds), np.int64), np.ones(len(seeds), bool)  # same: equal to the one before
    same[:1] = False
    for k in range(0, depth, each):
        some = np.flatnonzero(same | np.append(same[1:], False))
        if not len(some):
            break
        value, group = word[np.minimum(order[some] + k, n)], np.cumsum(~same)[some]
        by = np.lexsort((value, group)) if k else np.argsort(value, kind="stable")
        order = order.copy() if k == 0 else order
        order[some], value = order[some[by]], value[by]
        inner = np.flatnonzero(same[some])
        differ = value[inner] ^ value[inner - 1]
        common[some[inner]] += each - np.searchsorted(least, differ, "right")
        same[some[inner]] = differ == 0
    return order, np.minimum(common, depth).astype(np.uint8)


def sorted_suffixes(text: np.ndarray, depth: int, emit, limit: int = MEMORY_TUPLES) -> None:
    """Give all suffixes of ``text`` (uint16; its last character is its only 0) to ``emit(positions, common)`` in blocks, from the largest down.

    The order holds for the first ``depth`` (at most 200) characters; ``common`` is the
    prefix that a suffix has in common with the one given before it, at most ``depth``.
    """
    if len(text) < 2:
        return emit(np.arange(len(text)), np.zeros(len(text), np.uint8))
    small, runs = _kinds(text)
    seeds = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    with tempfile.TemporaryDirectory(prefix="induced-") as folder:
        order, common = _ordered(text, seeds, depth)
        _induce(text, small, runs, order, common, depth, folder, limit, emit)
    emit(np.array([len(text) - 1]), np.zeros(1, np.uint8))  # the end, which nothing induces
