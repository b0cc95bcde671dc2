"""The automaton of conversation repair: what mending the rest of a conversation costs, and how.

A conversation is a string of signatures, one letter for each row: `s`, `u`, `a` or `o` for the role
(any other role), upper case where the text is truncated, `x` where the row has to go. Reading it from
the end, a node of the automaton stands for one suffix, shared by all conversations that end so; it
holds for every grammar state what the cheapest repair of the suffix costs and how its audit begins.

The grammar is (s?(ua)+)?. Its states: nothing yet, after s, after u, after a. In every state each
edit leads to one state only, so the first letter of an audit decides between equally cheap ones.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache
from os.path import commonprefix

import numpy as np

# Fixed values of the contract: costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
KEEP_TO = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]  # by state: the state after a kept role
WANTED = ["user", "user", "assistant", "user"]  # by state: the role that an insert or a new role gives
WANTED_TO = [2, 2, 3, 2]
AT_END = [(0, ""), (10, "II"), (5, "I"), (0, "")]  # by state: cost and audit where no row is left
STATES = range(4)
LETTERS = "suaoSUAOx"

Costs = tuple[int, int, int, int]


def _cheapest(options: list[tuple[int, str, int]]) -> tuple[int, str, int]:
    """The option with the least cost, and of those the least audit."""
    return min(options, key=lambda option: option[:2])


@cache
def before(letter: str, rest: Costs) -> list[tuple[int, str, int]]:
    """By grammar state: cost, edits up to and with this row, and the state after it.

    `rest` is what the following rows cost in each state.
    """
    role, truncated = letter.lower(), TRUNCATED * letter.isupper()
    consumed = []
    for state in STATES:
        options = [(DELETE + rest[state], "D", state)]
        if letter != "x":
            options.append((truncated + REROLE + rest[WANTED_TO[state]], "R", WANTED_TO[state]))
            if role in KEEP_TO[state]:
                options.append((truncated + rest[KEEP_TO[state][role]], "K", KEEP_TO[state][role]))
        consumed.append(_cheapest(options))
    # One insert, then two: a third would only come back to the state after the first.
    found = consumed
    for _ in range(2):
        inserted = [found[WANTED_TO[state]] for state in STATES]
        inserted = [(INSERT + cost, "I" + edits, to) for cost, edits, to in inserted]
        found = [_cheapest([consumed[state], inserted[state]]) for state in STATES]
    return found


def class_of(costs: Iterable[int]) -> Costs:
    """Costs but for what all states have in common: all that earlier rows need to know."""
    costs = tuple(costs)
    return tuple(c - min(costs) for c in costs)


@cache
def classes() -> tuple[list[Costs], dict[Costs, int]]:
    """All classes that suffixes can have (they are few); the first is that of the empty suffix."""
    listed = [class_of(cost for cost, _ in AT_END)]
    for known in listed:
        for letter in LETTERS:
            new = class_of(cost for cost, _, _ in before(letter, known))
            if new not in listed:
                listed.append(new)
    return listed, {c: i for i, c in enumerate(listed)}


@cache
def steps() -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """By letter: the class before it for every class after it, and the state after it for every
    class after it and state before it."""
    listed, numbers = classes()
    found = {letter: [before(letter, known) for known in listed] for letter in LETTERS}
    to = {x: np.array([numbers[class_of(c for c, _, _ in row)] for row in rows]) for x, rows in found.items()}
    after = {x: np.array([[to for _, _, to in row] for row in rows]) for x, rows in found.items()}
    return to, after


def pass_through(signature: str) -> tuple[np.ndarray, np.ndarray]:
    """A part of a conversation as a function of what follows it: for every class after it the class
    before it, and the grammar state after it for every state before it."""
    to, after = steps()
    count = len(classes()[0])
    now = np.arange(count)
    out = np.tile(np.arange(len(STATES)), (count, 1))
    rows = np.arange(count)[:, None]
    for letter in reversed(signature):
        out = out[rows, after[letter][now]]
        now = to[letter][now]
    return now, out


@dataclass(slots=True)
class Node:
    """One suffix: by grammar state its cost, and its audit as edits and the audit of what follows."""

    costs: Costs
    audits: list


def open_root(number: int) -> Node:
    """The node after the last row of a part, behind which something of a class follows."""
    return Node(classes()[0][number], [("", state, None) for state in STATES])


def closed_root() -> Node:
    """The node after the last row of a conversation."""
    return Node(tuple(cost for cost, _ in AT_END), [(edits, state, None) for state, (_, edits) in enumerate(AT_END)])


def node_before(letter: str, node: Node) -> Node:
    low = min(node.costs)
    found = before(letter, class_of(node.costs))
    return Node(
        tuple(cost + low for cost, _, _ in found), [(edits, to, node.audits[to]) for _, edits, to in found]
    )


def read_audit(cell) -> tuple[str, int]:
    """The edits from a node on, and the grammar state in which they end."""
    edits = []
    while True:
        letters, state, rest = cell
        edits.append(letters)
        if rest is None:
            return "".join(edits), state
        cell = rest


class Automaton:
    """Nodes of signatures that come sorted from their ends, those with one root together.

    Neighbours share their longest common suffix: only the nodes before it are made anew, so every
    node is made once, and no more than the nodes of one signature are held.
    """

    def __init__(self):
        self.path: list[Node] = []
        self.root, self.done = None, ""

    def node(self, closing: bool, number: int, signature: str) -> Node:
        """The node of a signature that ends its conversation, or has something of a class behind it."""
        backwards = signature[::-1]
        if self.root != (closing, number):
            self.root, self.done = (closing, number), ""
            self.path = [closed_root() if closing else open_root(number)]
        common = len(commonprefix([backwards, self.done]))
        del self.path[common + 1 :]
        for letter in backwards[common:]:
            self.path.append(node_before(letter, self.path[-1]))
        self.done = backwards
        return self.path[-1]
