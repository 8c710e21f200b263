"""Suffix automaton over the words of one reference, and matching statistics against it."""

from __future__ import annotations


class SuffixAutomaton:
    """All substrings of a sequence of words, in one state for each class of end positions."""

    def __init__(self, words: list):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _extend(self, last: int, w) -> int:
        moves, link, length = self.next, self.link, self.length
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in moves[p]:
            moves[p][w] = state
            p = link[p]
        if p >= 0:
            q = moves[p][w]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                twin = len(moves)
                moves.append(moves[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(w) == q:
                    moves[p][w] = twin
                    p = link[p]
                link[q] = link[state] = twin
        return state

    def matches(self, words: list) -> list[int]:
        """For each word, the length of the longest run of words ending there that the reference holds."""
        moves, link, length = self.next, self.link, self.length
        state = n = 0
        out = []
        for w in words:
            while state and w not in moves[state]:
                state = link[state]
                n = length[state]
            step = moves[state].get(w)
            if step is None:
                n = 0
            else:
                state, n = step, n + 1
            out.append(n)
        return out

    def spans(self, words: list, least: int) -> list[tuple[int, int]]:
        """Maximal spans (start, end) of words covered by matches of at least ``least`` words."""
        out: list[list[int]] = []
        for i, n in enumerate(self.matches(words)):
            if n >= least:
                if out and out[-1][1] >= i - n + 1:
                    out[-1][1] = i + 1
                    out[-1][0] = min(out[-1][0], i - n + 1)
                else:
                    out.append([i - n + 1, i + 1])
        return [tuple(s) for s in out]
