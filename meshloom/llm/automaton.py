"""A generalised suffix automaton over sequences of integers."""

from __future__ import annotations

from collections.abc import Iterable


class SuffixAutomaton:
    """States in lists: next[s] (edges), link[s], length[s]. State 0 is the empty string."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: Iterable[int]) -> list[int]:
        """The states of the sequence's prefixes; each has its prefix as its longest string, also after later additions."""
        last, states = 0, []
        for c in sequence:
            last = self.extend(last, c)
            states.append(last)
        return states

    def extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self.clone(last, c, q)
        cur = self.state({}, length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p < 0:
            link[cur] = 0
        else:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self.clone(p, c, q)
        return cur

    def clone(self, p: int, c: int, q: int) -> int:
        new = self.state(dict(self.next[q]), self.length[p] + 1)
        self.link[new], self.link[q] = self.link[q], new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def state(self, edges: dict[int, int], n: int) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(n)
        return len(self.next) - 1

    def shortest_first(self) -> list[int]:
        """All states but the first, parents before the states that link to them."""
        return sorted(range(1, len(self.link)), key=self.length.__getitem__)
