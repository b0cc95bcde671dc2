"""Byte-pair merging of many short fragments at once, in numpy.

All fragments of a batch lie in one array. In each round every fragment that still has a known pair
merges its best one (lowest rank, leftmost among equals), so a round is a few array operations over
all fragments, and there are as many rounds as the longest chain of merges.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Mapping

import numpy as np

NO_PAIR = np.int32(2**31 - 1)

# Symbols from which a fragment is merged by itself with a heap, as it would need too many rounds.
LONG_FRAGMENT = 64


class PairMerger:
    """The pairs of a vocabulary: (left, right) -> (rank, what the two become)."""

    def __init__(self, pairs: Mapping[tuple[int, int], tuple[int, int]], symbols: int):
        self.pairs, self.symbols = pairs, symbols
        keys = np.fromiter((a * symbols + b for a, b in pairs), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**63 - 1))
        values = np.array([*pairs.values()], np.int32).reshape(-1, 2)[order]
        self.rank = np.append(values[:, 0], NO_PAIR)
        self.made = np.append(values[:, 1], np.int32(0))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and products of pairs; unknown pairs have rank NO_PAIR."""
        wanted = left.astype(np.int64) * self.symbols + right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.rank[at], NO_PAIR), self.made[at]

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of consecutive fragments of the given sizes, and their new sizes."""
        if not len(sizes):
            return symbols, sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)
        long = sizes[owner] > LONG_FRAGMENT
        done: list[tuple[np.ndarray, np.ndarray]] = []
        if long.any():
            ends = np.cumsum(sizes)
            for i in np.flatnonzero(sizes > LONG_FRAGMENT).tolist():
                alone = np.array(self.merge_one(symbols[ends[i] - sizes[i] : ends[i]].tolist()), symbols.dtype)
                done.append((alone, np.full(len(alone), i)))
            symbols, owner = symbols[~long], owner[~long]
        done += self._rounds(symbols, owner)
        symbols, owner = (np.concatenate(parts) for parts in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(owner, minlength=len(sizes))

    def _rounds(self, symbols: np.ndarray, owner: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        done = [(symbols[:0], owner[:0])]
        symbols = symbols.copy()
        rank = np.full(len(symbols), NO_PAIR)
        made = np.zeros(len(symbols), np.int32)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner], made[inner] = self.look_up(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(starts, append=len(owner))
            best = np.minimum.reduceat(rank, starts)
            alive = best != NO_PAIR
            if not alive.all():
                stay = np.repeat(alive, sizes)
                done.append((symbols[~stay], owner[~stay]))
                symbols, owner, rank, made = symbols[stay], owner[stay], rank[stay], made[stay]
                best, sizes = best[alive], sizes[alive]
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            at = at[np.diff(owner[at], prepend=-1) != 0]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
            at -= np.arange(len(at))
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed] = NO_PAIR
            changed = changed[changed + 1 < len(symbols)]
            changed = changed[owner[changed] == owner[changed + 1]]
            rank[changed], made[changed] = self.look_up(symbols[changed], symbols[changed + 1])
        return done

    def merge_one(self, ids: list[int]) -> list[int]:
        """One fragment of any length: the best pair is kept on top of a heap."""
        pairs, n = self.pairs, len(ids)
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] != pair[0] or j >= n or ids[j] != pair[1]:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = pairs[pair][1], -1
            after[i] = k = after[j]
            if k < n:
                ahead[k] = i
            for a, b in ((ahead[i], i), (i, k)):
                if a >= 0 and b < n and (p := (ids[a], ids[b])) in pairs:
                    heapq.heappush(heap, (pairs[p][0], a, p))
        return [x for x in ids if x >= 0]


class Remembered:
    """Packed ids of fragments met lately, in two generations, so that those met again are kept."""

    def __init__(self, most: int):
        self.most = most
        self.now: dict = {}
        self.older: dict = {}

    def unknown(self, fragments: Iterable) -> list:
        """The different fragments whose ids are not known; all others can then be looked up in `now`."""
        wanted = set(fragments)
        fresh = wanted.difference(self.now)
        if len(self.now) + len(fresh) > self.most:
            self.older, fresh = dict(self.now), wanted
            self.now.clear()
        known = {f: self.older[f] for f in fresh if f in self.older}
        self.now.update(known)
        return list(fresh.difference(known))
