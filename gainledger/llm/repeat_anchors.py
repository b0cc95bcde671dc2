"""Anchors: positions of a text chosen by its content alone.

Of every LENGTH bytes in a row the GRAM-byte string with the smallest hash is an anchor, so two texts
that share LENGTH bytes have an anchor at the same place inside them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Bytes that count as a repeat, bytes of an anchor, and how far a repeat reaches beyond its anchor.
LENGTH = 50
GRAM = 16
REACH = LENGTH - GRAM
# Bytes whose hashes are held at once.
PIECE_BYTES = 1 << 20
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over every `width` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[: len(values) - step], values[step:])
        have += step
    return values


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on, by doubling; never zero."""
    hashed = (raw.astype(np.uint64) + np.uint64(1)) * _ODD[0]
    hashed ^= hashed >> np.uint64(29)
    have = 1
    while have < GRAM:
        step = min(have, GRAM - have)
        tail = hashed[step:]
        hashed = (hashed[: len(hashed) - step] * _ODD[1]) ^ (tail + (tail >> np.uint64(31)))
        hashed *= _ODD[2]
        hashed ^= hashed >> np.uint64(32)
        have += step
    return hashed | np.uint64(1)


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text number, begin, bytes) in groups of bounded size; pieces of a long text overlap so that
    every LENGTH bytes in a row are in one of them."""
    held, size = [], 0
    for number, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - LENGTH + 1), PIECE_BYTES):
            piece = text[begin : begin + PIECE_BYTES + LENGTH - 1]
            held.append((number, begin, piece))
            size += len(piece)
            if size >= PIECE_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, position in the text) of all anchors, text by text, in order."""
    found = []
    for pieces in _pieces(texts):
        hashed, piece, position = _anchors_of([p for *_, p in pieces])
        number, begin = (np.array([p[i] for p in pieces], np.int64) for i in (0, 1))
        found.append((hashed, number[piece], position + begin[piece]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed, text, position = (np.concatenate(c) for c in zip(*found, strict=True))
    if any(len(t) >= PIECE_BYTES + LENGTH for t in texts):  # overlaps have theirs twice
        order = np.lexsort((position, text))
        hashed, text, position = hashed[order], text[order], position[order]
        new = np.append(True, (text[1:] != text[:-1]) | (position[1:] != position[:-1]))[: len(text)]
        hashed, text, position = hashed[new], text[new], position[new]
    return hashed, text, position


def _anchors_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(t) for t in texts]) if texts else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    if not len(ends) or ends[-1] < LENGTH:
        return np.zeros(0, np.uint64), none, none
    hashed = _gram_hashes(np.frombuffer(b"".join(texts), np.uint8))
    width = REACH + 1
    least = _slide(hashed, width, np.minimum)
    # Windows that run over the end of their text choose nothing.
    sizes = np.array([len(t) for t in texts])
    whole = np.arange(len(least)) + LENGTH <= np.repeat(ends, sizes)[: len(least)]
    least = np.where(whole, least, np.uint64(0))
    margin = np.zeros(width - 1, np.uint64)
    best = _slide(np.concatenate([margin, least, margin]), width, np.maximum)
    at = np.flatnonzero(best == hashed)
    text = np.searchsorted(ends, at, "right")
    return hashed[at], text, at - (ends - sizes)[text]


def contexts(texts: list[bytes], text: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes around anchors, REACH on either side, and the columns where a repeat may begin.

    Returns a matrix with zeros beyond the ends of a text, and the first and last such column.
    """
    gap = b"\0" * REACH
    padded = np.frombuffer(gap.join([b"", *texts, b""]), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + REACH) - sizes
    width = LENGTH + REACH
    view = np.lib.stride_tricks.sliding_window_view(padded, width)
    matrix = view[begins[text] + position - REACH]
    first = np.maximum(0, REACH - position)
    last = np.minimum(REACH, sizes[text] - LENGTH - position + REACH)
    columns = np.arange(width)
    matrix = np.where((columns >= first[:, None]) & (columns < last[:, None] + LENGTH), matrix, np.uint8(0))
    return matrix, first, last


def column_wise(matrix: np.ndarray, group: np.ndarray, first: np.ndarray, last: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each row the columns from which LENGTH bytes also stand in a row of smaller `order`.

    Rows are strings of one collection, compared inside their group (groups come sorted). Columns
    are inserted from the last to the first, one symbol of every string each round. The symbols in
    the order of the suffixes so far are the round's part of the Burrows-Wheeler transform; sorting
    them stably gives the order of the longer suffixes, and the common prefix of two neighbours is
    one more than the least common prefix between their places before. From LENGTH columns on, runs
    of neighbours with a common prefix of LENGTH are equal strings. Bit c of the result: column c.
    """
    n, width = matrix.shape
    place = np.arange(n)
    common = np.zeros(n + 1, np.int64)  # common[k]: of the suffixes at k - 1 and k
    mask = np.zeros(n, np.int64)
    above = np.iinfo(np.int64).max
    for column in range(width - 1, -1, -1):
        key = group[place] * 256 + matrix[place, column]
        moved = np.argsort(key, kind="stable")
        place, key = place[moved], key[moved]
        longer = np.zeros(n + 1, np.int64)
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        if len(same):
            spans = np.stack([moved[same - 1] + 1, moved[same] + 1], axis=1).ravel()
            longer[same] = 1 + np.minimum.reduceat(common, spans)[::2]
        common = longer
        if column <= REACH:
            begins = np.flatnonzero(common[:n] < LENGTH)
            valid = (first[place] <= column) & (column <= last[place])
            ranked = np.where(valid, order[place], above)
            least = np.repeat(np.minimum.reduceat(ranked, begins), np.diff(np.append(begins, n)))
            hit = place[valid & (ranked > least)]
            mask[hit] |= np.int64(1) << np.int64(column)
    return mask


def begins_of(position: np.ndarray, mask: np.ndarray, size: int) -> np.ndarray:
    """Where repeats begin in a text of `size` bytes, from anchors and their columns."""
    columns = np.arange(REACH + 1)
    chosen = (mask[:, None] >> columns) & 1 == 1
    begins = (position[:, None] - REACH + columns)[chosen]
    return begins[(begins >= 0) & (begins + LENGTH <= size)]


def covered(begins: np.ndarray, size: int) -> np.ndarray:
    """Which of `size` bytes a repeat covers."""
    marks = np.zeros(size + LENGTH, np.int64)
    marks[begins + LENGTH] = 1
    upto = np.cumsum(marks)
    return upto[LENGTH:] > upto[:size]
