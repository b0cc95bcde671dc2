"""Normalisation through a compiled character map, with the place in the source of every character.

The map is a double-array trie over UTF-8 prefixes; its values are places in a list of replacements.
At every character the longest prefix known to the trie is replaced; other characters stay. All
characters of a batch walk down the trie at once.
"""

from __future__ import annotations

import numpy as np

SPACE, MARK = 0x20, 0x2581  # white space inside pieces is written as the mark
LABEL = np.uint32(1 << 31 | 0xFF)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def utf8_width(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF).astype(np.int64)


class CharacterMap:
    """The compiled map of a model; an empty one leaves every character as it is."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4")
        self.strings = compiled[4 + size :]
        self.known: dict[int, np.ndarray] = {}
        # A text may be cut before a space where no prefix of the map goes on over it.
        inside = np.flatnonzero(self.units & LABEL == SPACE)
        self.cuts_at_spaces = not len(inside) or inside.tolist() == [int(self._offset(self.units[:1])[0]) ^ SPACE]

    @staticmethod
    def _offset(units: np.ndarray) -> np.ndarray:
        return (units >> 10) << ((units & np.uint32(1 << 9)) >> 6)

    def replacement(self, value: int) -> np.ndarray:
        if value not in self.known:
            text = self.strings[value : self.strings.index(b"\0", value)].decode()
            self.known[value] = code_points(text)
        return self.known[value]

    def longest(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and value of the longest known prefix at each place; no bytes where there is none.

        `data` ends with a zero byte, which no prefix holds.
        """
        length, value = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
        if not len(self.units):
            return length, value
        walk = np.arange(len(begins))
        place = begins.copy()
        node = np.full(len(begins), self._offset(self.units[:1])[0], np.uint32)
        depth = 0
        while len(walk):
            letter = data[place].astype(np.uint32)
            node = node ^ letter
            inside = (letter != 0) & (node < len(self.units))
            walk, place, node, letter = walk[inside], place[inside], node[inside], letter[inside]
            unit = self.units[node]
            on = (unit & LABEL) == letter
            walk, place, node, unit = walk[on], place[on] + 1, node[on], unit[on]
            depth += 1
            node = node ^ self._offset(unit)
            leaf = (unit >> 8) & 1 == 1
            length[walk[leaf]] = depth
            value[walk[leaf]] = self.units[node[leaf]] & np.uint32(0x7FFFFFFF)
        return length, value

    def apply(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points of the mapped text; the source byte at which each prefix begins, and the length
        of the whole source; the code points that each prefix becomes."""
        points = code_points(text)
        width = utf8_width(points)
        ends = np.cumsum(width)
        begins, total = ends - width, ends[-1:]
        sizes = np.ones(len(points), np.int64)
        if not len(self.units):
            return points, np.concatenate([begins, total]), sizes
        data = np.frombuffer(text.encode() + b"\0", np.uint8)
        length, value = self.longest(data, begins)
        taken = np.ones(len(points), bool)
        covered = 0
        for i in np.flatnonzero(length > width).tolist():
            if begins[i] < covered:
                continue  # inside a longer prefix that began before
            covered = begins[i] + length[i]
            taken[i + 1 : np.searchsorted(begins, covered)] = False
        points, begins, length, value = points[taken], begins[taken], length[taken], value[taken]
        sizes = sizes[taken]
        mapped = np.flatnonzero(length)
        values, which = np.unique(value[mapped], return_inverse=True)
        strings = [self.replacement(int(v)) for v in values]
        if strings:
            sizes[mapped] = np.array([len(s) for s in strings])[which]
        out = np.repeat(points, sizes)
        ends = np.cumsum(sizes)
        for k, string in enumerate(strings):
            if len(string):
                at = mapped[which == k]
                out[(ends[at] - len(string))[:, None] + np.arange(len(string))] = string
        return out, np.concatenate([begins, total]), sizes


class Normaliser:
    """Character map, white space rules and marks, as a model's specification states them."""

    def __init__(self, spec):
        if not spec.escape_whitespaces:
            raise ValueError("a model whose pieces hold plain spaces")
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces

    def apply(self, text: str, first: bool = True, last: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the normalised text and their places in the source, and the last one's end.

        `first` and `last` say whether the text begins and ends where its document does.
        """
        if not text:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        points, places, sizes = self.map.apply(text)
        begins, total, head = np.repeat(places[:-1], sizes), places[-1], places[0]
        if self.squeeze:
            space = points == SPACE
            plain = sizes == 1
            plain[plain] = space[(np.cumsum(sizes) - sizes)[plain]]
            head = places[np.argmin(plain) if not plain.all() else -1]
            after = np.empty(len(points), bool)
            after[1:] = space[:-1]
            after[:1] = first
            keep = ~(space & after)
            if last:
                filled = np.flatnonzero(~space & (points != MARK))
                solid = filled[-1] + 1 if len(filled) else 0
                if solid < len(points):
                    total = begins[solid]
                keep[solid:] = False
            points, begins = points[keep], begins[keep]
        points = np.where(points == SPACE, np.uint32(MARK), points)
        if self.prefix and first and (len(points) or not self.squeeze):
            points = np.concatenate([np.array([MARK], np.uint32), points])
            begins = np.concatenate([[head], begins])
        return points, np.append(begins, total)
