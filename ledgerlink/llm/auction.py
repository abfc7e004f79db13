"""Cheapest edits that make a conversation alternate, by the auction algorithm for shortest paths.

A conversation is a string of turns: ``u``, ``a``, ``s`` or ``o`` for a turn whose role starts with u, a, s or anything
else, in capitals if its text is truncated, and ``x`` for a turn that has to go.  Nodes are (turns read, state); the
states are nothing yet, after s, after u, after a.  Arcs are Delete (4), Keep (0), Rerole (3), the latter two 3 more for a
truncated turn, and Insert (3), which reads no turn.  The end is reached from nothing yet and from after a.

``auction`` raises node prices by path contraction and extension until the path reaches the destination.  Prices stay
feasible (price <= cost + price of the next node), so at the end price(origin) is the distance and every arc of every
cheapest path is tight; ``traced`` follows the tight arcs that lead on to the destination, smallest label first.

A long conversation is cut into blocks of LEAF turns.  A block's table has, for each state before and after it, the least
cost and the smallest labels of that cost; blocks of blocks are lattices of the same kind.  Inserts belong to the turn
read next, so no block's labels are the beginning of another's and comparing block by block is comparing the whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

START, AFTER_S, AFTER_U, AFTER_A = STATES = range(4)
LEAF = 32
DELETE, REROLE, INSERT, MEND = 4, 3, 3, 3

#: node -> [(label, cost, node)]; labels of one node differ in their first place
Arcs = dict[int, list[tuple]]


def auction(arcs: Arcs, origin: int, end: int, price: dict[int, int]) -> None:
    """Raise ``price`` until price[origin] - price[end] is the distance.  Each node that can be reached leads to ``end``;
    cycles have positive cost."""
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        least, best = min((cost + price[to], to) for _, cost, to in arcs[node])
        if price[node] < least:  # contraction: the node's price rises, and the path steps back
            price[node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(best)


def traced(arcs: Arcs, origin: int, end: int, price: dict[int, int]) -> tuple[list, list[int]]:
    """Labels and nodes of the tight path from origin to end whose labels are smallest."""
    back = defaultdict(list)
    for node, out in arcs.items():
        for _, cost, to in out:
            if price[node] == cost + price[to]:
                back[to].append(node)
    leads, todo = {end}, [end]
    while todo:
        todo += (new := [x for x in back[todo.pop()] if x not in leads])
        leads.update(new)
    labels, nodes = [], [origin]
    while nodes[-1] != end:
        node = nodes[-1]
        label, _, to = min((x for x in arcs[node] if x[2] in leads and price[node] == x[1] + price[x[2]]), key=lambda x: x[0])
        labels.append(label)
        nodes.append(to)
    return labels, nodes


def leading(arcs: Arcs, end: int) -> Arcs:
    """The arcs between nodes that lead to ``end``."""
    back = defaultdict(list)
    for node, out in arcs.items():
        for _, _, to in out:
            back[to].append(node)
    leads, todo = {end}, [end]
    while todo:
        todo += (new := [x for x in back[todo.pop()] if x not in leads])
        leads.update(new)
    return {node: [x for x in out if x[2] in leads] for node, out in arcs.items() if node in leads}


def turn_arcs(turn: str, state: int) -> list[tuple[str, int, int]]:
    """(label, cost, next state) of reading one turn; a run of ``x`` is read at once."""
    if turn[0] == "x":
        return [("D" * len(turn), DELETE * len(turn), state)]
    first, more = turn.lower(), MEND if turn.isupper() else 0
    out = [("D", DELETE, state), ("R", REROLE + more, AFTER_A if state == AFTER_U else AFTER_U)]
    kept = {("s", START): AFTER_S, ("a", AFTER_U): AFTER_A} | {("u", x): AFTER_U for x in (START, AFTER_S, AFTER_A)}
    if (first, state) in kept:
        out.append(("K", more, kept[first, state]))
    return out


def insert_arc(state: int, level: int) -> tuple[str, int, int]:
    return ("I", INSERT, 4 * level + (AFTER_A if state == AFTER_U else AFTER_U))


@dataclass
class Block:
    """``table``: (state before, state after) -> (cost, labels, states after each part)."""

    table: dict[tuple[int, int], tuple[int, object, list[int]]]
    parts: list[Block] | None = None

    def ranks(self) -> dict[tuple[int, int], int]:
        """For each state before, the place of each state after in the order of the labels."""
        out = {}
        for before in STATES:
            ends = sorted((x[1], after) for (b, after), x in self.table.items() if b == before)
            out |= {(before, after): k for k, (_, after) in enumerate(ends)}
        return out

    def edits(self, before: int, after: int) -> str:
        if self.parts is None:
            return self.table[before, after][1]
        out = []
        for part, state in zip(self.parts, self.table[before, after][2], strict=True):
            out.append(part.edits(before, state))
            before = state
        return "".join(out)


def _tables(arcs: Arcs, ends: dict[int, int], befores: tuple[int, ...], per_level: int) -> dict:
    found = {}
    for end, after in ends.items():
        own = leading(arcs, end)
        price = dict.fromkeys([*own, end], 0)
        for before in befores:
            if before in own or before == end:
                auction(own, before, end, price)
                labels, nodes = traced(own, before, end, price)
                found[before, after] = (price[before] - price[end], labels, [x % 4 for x in nodes[1:]][:per_level])
    return found


def leaf(turns: list[str], last: bool, befores: tuple[int, ...] = STATES) -> Block:
    """A block of turns; the last one of a conversation also takes the inserts at its end, and ends in state 0."""
    n, arcs = len(turns), {}
    for i, turn in enumerate(turns):
        for s in STATES:
            arcs[4 * i + s] = [insert_arc(s, i), *((label, cost, 4 * (i + 1) + to) for label, cost, to in turn_arcs(turn, s))]
    if last:
        for s in STATES:
            arcs[4 * n + s] = [insert_arc(s, n)] + ([("", 0, 4 * (n + 1))] if s in (START, AFTER_A) else [])
    ends = {4 * (n + 1): START} if last else {4 * n + s: s for s in STATES}
    return Block({k: (cost, "".join(labels), []) for k, (cost, labels, _) in _tables(arcs, ends, befores, 0).items()})


def joined(parts: list[Block]) -> Block:
    arcs: Arcs = {}
    for i, part in enumerate(parts):
        rank = part.ranks()
        for (before, after), (cost, _, _) in part.table.items():
            arcs.setdefault(4 * i + before, []).append((rank[before, after], cost, 4 * (i + 1) + after))
    return Block(_tables(arcs, {4 * len(parts) + s: s for s in STATES}, STATES, len(parts)), parts)


def tree(blocks: list[Block]) -> Block:
    while len(blocks) > 1:
        blocks = [joined(blocks[i : i + LEAF]) for i in range(0, len(blocks), LEAF)]
    return blocks[0]


def block(turns: str, last: bool = False) -> Block:
    """The block of a whole string of turns (with ``last``, up to the conversation's end)."""
    read = re.findall("x+|[^x]", turns)
    if last and len(read) <= LEAF:
        return leaf(read, True, (START,))
    blocks = [leaf(read[i : i + LEAF], False) for i in range(0, len(read), LEAF)]
    return tree(blocks + [leaf([], True)] if last else blocks)


def cheapest(turns: str) -> tuple[int, str]:
    """The least cost, and of the edits of that cost the smallest in ASCII order."""
    return _cheapest(turns) if len(turns) <= LEAF else _whole(turns)


def _whole(turns: str) -> tuple[int, str]:
    whole = block(turns, True)
    return whole.table[START, START][0], whole.edits(START, START)


_cheapest = lru_cache(maxsize=1 << 16)(_whole)
