"""Suffix automaton over a shard of reference passages, and matching statistics against it."""

from __future__ import annotations


class SuffixAutomaton:
    """All substrings of the added sequences. Each state knows where the first of its occurrences
    ends, in the order in which sequences were added."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]
        self.size = 0

    def add(self, sequence: list) -> None:
        """Adds one sequence; its places are numbered on from the last one's."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        last, place = 0, self.size
        for symbol in sequence:
            p = last
            q = nxt[p].get(symbol)
            if q is not None:  # known from an earlier sequence
                last = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
            else:
                last = len(link)
                nxt.append({})
                link.append(0)
                length.append(length[p] + 1)
                first.append(place)
                while q is None and p >= 0:
                    nxt[p][symbol] = last
                    p = link[p]
                    q = nxt[p].get(symbol) if p >= 0 else None
                if q is not None:
                    link[last] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
            place += 1
        self.size = place

    def _state(self, length: int, edges: dict, link: int, first: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.first.append(first)
        return len(self.link) - 1

    def _split(self, p: int, symbol, q: int) -> int:
        """A copy of ``q`` for its substrings that end in the longest of ``p`` and ``symbol``."""
        nxt, link = self.next, self.link
        copy = self._state(self.length[p] + 1, dict(nxt[q]), link[q], self.first[q])
        while p >= 0 and nxt[p].get(symbol) == q:
            nxt[p][symbol] = copy
            p = link[p]
        link[q] = copy
        return copy

    def first_ends(self, sequence: list, window: int) -> list[int]:
        """For each place of ``sequence`` where a run of ``window`` symbols of the automaton ends:
        where that run's first occurrence ends; -1 elsewhere. The longest match that ends at each
        place is followed over suffix links and cut to the state that holds the run."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        state = matched = 0
        out = []
        for symbol in sequence:
            to = nxt[state].get(symbol)
            if to is None:
                while state and symbol not in nxt[state]:
                    state = link[state]
                matched = length[state]
                to = nxt[state].get(symbol)
                if to is None:
                    out.append(-1)
                    continue
            state = to
            matched += 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                out.append(first[state])
            else:
                out.append(-1)
        return out
