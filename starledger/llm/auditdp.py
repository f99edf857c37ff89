"""Edit histories for operator 13: a dynamic program that keeps, per state, the
cheapest history and of these the ASCII-least, without copying histories.

A history is a chain of nodes.  A node holds its last symbol, its depth, a
rolling hash of all symbols up to it, and its ancestors 1, 2, 4, ... steps up.
Two histories of equal cost are compared where their longest common prefix ends,
which the hashes find by halving steps; equal hashes are believed only after
both chains have been followed to a common node.

States: E (nothing yet), S (a system turn), U (a user turn last), A (an
assistant turn last).  E and A are complete.
"""

from __future__ import annotations

from itertools import zip_longest

MOD = (1 << 61) - 1
BASE = 0x1F3D5B79A2C4E6F
E, S, U, A = range(4)
#: the state after a user, an assistant or a system turn; -1: not allowed
AFTER = {"u": (U, U, -1, U), "a": (-1, -1, A, -1), "s": (S, -1, -1, -1)}
#: the only turn that a reroled or an inserted turn can be
NEXT = (U, U, A, U)
#: fixed values of the cost model
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: a history before the first symbol
ROOT = 0


class Histories:
    """Nodes as parallel lists; a node is its number."""

    def __init__(self):
        self.symbol, self.parent, self.depth, self.hash = [""], [ROOT], [0], [0]
        self.up: list[list[int]] = []                       # up[k][node]: 2**k steps up

    def add(self, parent: int, symbol: str) -> int:
        node, depth = len(self.symbol), self.depth[parent] + 1
        self.symbol.append(symbol)
        self.parent.append(parent)
        self.depth.append(depth)
        value = ord(symbol) if len(symbol) == 1 else _text_hash(symbol)
        self.hash.append((self.hash[parent] * BASE + value) % MOD)
        while depth >> len(self.up):
            self.up.append([ROOT] * node)
        above = parent
        for level in self.up:
            level.append(above)
            above = level[above] if above != ROOT else ROOT
        return node

    def lift(self, node: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                node = self.up[k][node]
            steps >>= 1
            k += 1
        return node

    def same(self, x: int, y: int) -> bool:
        """Whether histories of one depth hold the same symbols: by hash, then
        by following both until they meet."""
        if self.hash[x] != self.hash[y]:
            return False
        while x != y:
            if self.symbol[x] != self.symbol[y]:
                return False
            x, y = self.parent[x], self.parent[y]
        return True

    def parting(self, x: int, y: int) -> tuple[int, int]:
        """The depth of the longest common prefix, and the smaller depth."""
        least = min(self.depth[x], self.depth[y])
        x, y = self.lift(x, self.depth[x] - least), self.lift(y, self.depth[y] - least)
        if self.same(x, y):
            return least, least
        for k in range(len(self.up) - 1, -1, -1):
            if 1 << k <= self.depth[x] and not self.same(self.up[k][x], self.up[k][y]):
                x, y = self.up[k][x], self.up[k][y]
        return self.depth[x] - 1, least

    def after(self, node: int, depth: int) -> list[str]:
        """The symbols behind the first ``depth``."""
        out = []
        while self.depth[node] > depth:
            out.append(self.symbol[node])
            node = self.parent[node]
        return out[::-1]

    def less(self, x: int, y: int) -> bool:
        """Whether history x is ASCII-less than y."""
        if x == y:
            return False
        common, least = self.parting(x, y)
        if common == least:
            return self.depth[x] < self.depth[y]
        a, b = (self.symbol[self.lift(n, self.depth[n] - common - 1)] for n in (x, y))
        if len(a) == 1 == len(b) or a[:1] != b[:1]:
            return a < b
        return _joined_less(self.after(x, common), self.after(y, common))

    def text(self, node: int) -> str:
        return "".join(self.after(node, 0))


def _text_hash(text: str) -> int:
    value = len(text)
    for c in text:
        value = (value * BASE + ord(c)) % MOD
    return value


def _joined_less(x: list[str], y: list[str]) -> bool:
    for a, b in zip_longest((c for s in x for c in s), (c for s in y for c in s), fillvalue=""):
        if a != b:
            return a < b
    return False


def _better(h: Histories, best: list, state: int, cost: int, parent: int, symbol: str) -> None:
    """Keep (cost, parent + symbol) for ``state`` if it is cheaper, or as cheap
    and ASCII-less."""
    old = best[state]
    if old is None or cost < old[0]:
        best[state] = (cost, h.add(parent, symbol))
    elif cost == old[0] and h.less(node := h.add(parent, symbol), old[1]):
        best[state] = (cost, node)


def _inserted(h: Histories, best: list) -> None:
    """Add the turns that can be inserted here; a third one would come back to
    a state at a higher cost."""
    for _ in range(2):
        for state in (E, S, A, U):
            if best[state] is not None:
                cost, node = best[state]
                to = NEXT[state]
                if best[to] is None or cost + INSERT <= best[to][0]:
                    _better(h, best, to, cost + INSERT, node, "I")


#: a row: its role's initial, and what is wrong with it; then how many exact
#: copies of it follow, which are duplicates and must go
Row = tuple[str, bool, bool, int]


def histories(rows: list[Row], start: int) -> list[tuple[int, str] | None]:
    """Per last state, the least (cost, history) of the rows from ``start``.
    A row is (initial, must go, truncated, further copies).

    No two histories that meet in a state at one cost are a prefix of one
    another (they hold an edit for each row, so they could differ by insertions
    alone, and then in cost): the lesser stays the lesser whatever follows."""
    h = Histories()
    best: list[tuple[int, int] | None] = [None] * 4
    best[start] = (0, ROOT)
    copies: dict[int, int] = {}                    # depth by rows -> further copies, to write a history out
    for i, (initial, gone, truncated, more) in enumerate(rows):
        _inserted(h, best)
        after: list[tuple[int, int] | None] = [None] * 4
        extra = TRUNCATED if truncated else 0
        for state in (E, S, U, A):
            if best[state] is None:
                continue
            cost, node = best[state]
            _better(h, after, state, cost + DELETE, node, "D")
            if gone:
                continue
            to = AFTER[initial][state] if initial in AFTER else -1
            if to >= 0:
                _better(h, after, to, cost + extra, node, "K")
            if NEXT[state] != to:                  # a role changed to itself costs more than to keep it
                _better(h, after, NEXT[state], cost + extra + REROLE, node, "R")
        if more:                                   # D is the least symbol: insertions come behind the copies
            copies[i] = more
            after = [b and (b[0] + DELETE * more, b[1]) for b in after]
        best = after
    _inserted(h, best)
    return [b and (b[0], _with_copies(h.text(b[1]), copies)) for b in best]


def _with_copies(text: str, copies: dict[int, int]) -> str:
    if not copies:
        return text
    out, row = [], 0
    for c in text:
        out.append(c)
        if c != "I":
            out.append("D" * copies.get(row, 0))
            row += 1
    return "".join(out)


def least(ends: list[tuple[int, str] | None]) -> tuple[int, str, int]:
    """(cost, history, state) of the cheapest complete history."""
    return min((*ends[s], s) for s in (E, A) if ends[s] is not None)


class Chain:
    """Histories of a conversation's consecutive parts, put together: a node's
    symbol is the history of one part."""

    def __init__(self):
        self.h = Histories()
        self.best: list[tuple[int, int] | None] = [(0, ROOT), None, None, None]
        #: of each node: (the part's place, its first state, its last state)
        self.of: list[tuple[int, int, int]] = [(-1, E, E)]

    def add(self, part: int, table: dict[tuple[int, int], tuple[int, str]]) -> None:
        """``table``: (first, last state) -> (cost, history) of the part."""
        after: list[tuple[int, int] | None] = [None] * 4
        for (first, last), (cost, text) in sorted(table.items()):
            if self.best[first] is None:
                continue
            before, node = self.best[first]
            count = len(self.of)
            _better(self.h, after, last, before + cost, node, text)
            self.of += [(part, first, last)] * (len(self.h.symbol) - count)
        self.best = after

    def end(self) -> tuple[int, list[tuple[int, int, int, str]]]:
        """(cost, [(part, first state, last state, history)]) of the cheapest
        complete history."""
        done = [self.best[s] for s in (E, A) if self.best[s] is not None]
        best = done[0]
        for other in done[1:]:
            if other[0] < best[0] or other[0] == best[0] and self.h.less(other[1], best[1]):
                best = other
        parts, node = [], best[1]
        while node != ROOT:
            parts.append((*self.of[node], self.h.symbol[node]))
            node = self.h.parent[node]
        return best[0], parts[::-1]
