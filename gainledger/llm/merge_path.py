"""Merging two sorted lists of token ends by merge-path partitioning.

The merge of two sorted lists is a path from corner to corner of their grid. Diagonals at equal
distances cross it at one point each, found by binary search, and so cut the merge into pieces of
equal work that know nothing of each other. All pieces are merged side by side, one step of every
piece at a time; what they emit is laid end to end, which stitches groups that reach over pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Steps of a piece: more steps mean fewer, longer pieces and more rounds of narrower arrays.
PIECE_STEPS = 256


def split_points(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many elements of `a` are among the first d of the merge, for every diagonal d.

    Equal elements of `a` come first. All diagonals are searched at once.
    """
    low = np.maximum(diagonals - len(b), 0)
    high = np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        # a[middle] belongs to the first d if it does not exceed the element of b it would push out.
        before = np.zeros(len(middle), bool)
        before[open_] = a[middle[open_]] <= b[diagonals[open_] - 1 - middle[open_]]
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low


@dataclass
class Alignment:
    """Overlaps of the tokens of two lists: links (left[k], right[k]) in the order of the text, and
    for every link whether both tokens end there, which closes a group."""

    left: np.ndarray
    right: np.ndarray
    closes: np.ndarray


def align(a: np.ndarray, b: np.ndarray, steps: int = PIECE_STEPS) -> Alignment:
    """All pairs of overlapping tokens, given the strictly rising byte ends of both lists.

    Both lists end at the same byte. Each element of the merge stands for the end of one token while
    another of the other list is open; only the second of two equal ends opens no overlap.
    """
    total = len(a) + len(b)
    pieces = -(-total // steps)
    i = split_points(a, b, np.arange(pieces, dtype=np.int64) * steps)
    j = np.arange(pieces, dtype=np.int64) * steps - i
    left = np.empty((steps, pieces), np.int32)
    right = np.empty((steps, pieces), np.int32)
    kind = np.empty((steps, pieces), np.int8)  # 0 a link, 1 a link that closes a group, 2 none
    beyond = np.int64(2**62)
    a_ends, b_ends = np.append(a, beyond), np.append(b, beyond)
    for step in range(steps):
        end_a, end_b = a_ends[i], b_ends[j]
        from_a = end_a <= end_b
        left[step], right[step] = i, j
        # The end of b after the equal end of a opens no overlap.
        second = ~from_a & (i > 0) & (a_ends[i - 1] == end_b)
        kind[step] = np.where(second | (np.minimum(end_a, end_b) == beyond), 2, end_a == end_b)
        i = np.minimum(i + from_a, len(a))
        j = np.minimum(j + ~from_a, len(b))
    kind = kind.T.ravel()
    links = np.flatnonzero(kind < 2)
    return Alignment(left.T.ravel()[links], right.T.ravel()[links], kind[links] == 1)
