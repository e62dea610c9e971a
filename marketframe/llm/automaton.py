"""Generalised suffix automaton over any hashable symbols (word hashes, characters)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """Accepts every substring of every added sequence. State 0 is the root; ``go[s]`` maps a symbol to the next
    state, ``link[s]`` is the suffix link and ``length[s]`` the longest substring of the state. At most two states
    per added symbol."""

    def __init__(self, sequences: Iterable[Sequence] = ()):
        self.go: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        for s in sequences:
            self.add(s)

    def __len__(self) -> int:
        return len(self.go)

    def _state(self, length: int, go: dict, link: int) -> int:
        self.length.append(length)
        self.go.append(go)
        self.link.append(link)
        return len(self.go) - 1

    def _split(self, p: int, c) -> int:
        """The state reached from p by c, of which p's longest string plus c is the longest; split off if need be."""
        go, link, length = self.go, self.link, self.length
        q = go[p][c]
        if length[q] == length[p] + 1:
            return q
        new = self._state(length[p] + 1, dict(go[q]), link[q])
        link[q] = new
        while p >= 0 and go[p].get(c) == q:
            go[p][c] = new
            p = link[p]
        return new

    def add(self, sequence: Sequence) -> list[int]:
        """Adds a sequence; returns the state of each of its prefixes as they were when added."""
        go, link = self.go, self.link
        at, states = 0, []
        for c in sequence:
            if c in go[at]:
                at = self._split(at, c)
            else:
                p, new = at, self._state(self.length[at] + 1, {}, 0)
                while p >= 0 and c not in go[p]:
                    go[p][c] = new
                    p = link[p]
                link[new] = 0 if p < 0 else self._split(p, c)
                at = new
            states.append(at)
        return states

    def walk(self, sequence: Sequence) -> list[int]:
        """The states of the prefixes of an added sequence."""
        at, states = 0, []
        for c in sequence:
            at = self.go[at][c]
            states.append(at)
        return states

    def matching(self, sequence: Sequence) -> list[int]:
        """Matching statistics: for each position, the length of the longest suffix of the sequence up to and with it
        that occurs in an added sequence."""
        go, link, length = self.go, self.link, self.length
        at, n, out = 0, 0, []
        for c in sequence:
            while at and c not in go[at]:
                at = link[at]
                n = length[at]
            if c in go[at]:
                at = go[at][c]
                n += 1
            out.append(n)
        return out
