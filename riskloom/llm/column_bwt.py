"""Burrows-Wheeler transform and common prefixes of a collection of strings, built column by column.

Round t inserts the t-th symbol from the end of every string that has one, all strings at once: the suffix of
length t of a string follows from its suffix of length t - 1, whose place in the order is known. The place of the
new one is the number of smaller symbols in the transform plus the number of equal symbols up to that place. The
transform, as one ascending list of places per symbol, and the common prefix lengths are sequences that each round
reads from front to back and writes anew with the new entries merged in; suffixes themselves are never stored or
compared. The common prefix of a new suffix with a neighbour of the same first symbol is one more than the
least common prefix between the two places they come from, and zero with any other.
"""

from __future__ import annotations

import numpy as np

#: An entry of the transform is symbol << 24 | place; sorted entries are the lists of places, symbol by symbol.
_BITS = 24
_PLACE = np.uint32((1 << _BITS) - 1)


class Collection:
    """The transform and the common prefixes ``lcp`` of all suffixes of some byte strings.

    Strings hold no byte 0 and at most 254 bytes, a collection under 2^24 bytes. The order of suffixes begins
    with the empty ones, in the order of the strings; ``lcp[i]`` is the common prefix of suffixes i - 1 and i,
    ``entries`` the sorted entries of the transform without those of whole strings, before which nothing stands.
    """

    def __init__(self, strings: list[bytes]):
        m = len(strings)
        self.sizes = sizes = np.array([len(s) for s in strings], dtype=np.int64)
        longest, n = int(sizes.max(initial=0)), m
        most = m + int(sizes.sum())
        if longest > 254 or most >> _BITS:
            raise ValueError("strings of up to 254 bytes, under 2^24 in all")
        # Column t holds the symbol that stands t places before the end, 0 before the first.
        joined = np.frombuffer(b"".join(strings), dtype=np.uint8)
        columns = np.zeros((longest + 1, m), dtype=np.uint32)
        columns[np.repeat(np.cumsum(sizes), sizes) - np.arange(len(joined)) - 1, np.repeat(np.arange(m), sizes)] = joined
        string = np.flatnonzero(sizes)
        came = columns[0, string] << _BITS | string.astype(np.uint32)  # the entries that the next round extends
        # What a round reads and what it writes, and room for its own steps.
        entries, next_entries = (np.empty(most, dtype=np.uint32) for _ in range(2))
        lcp, next_lcp = (np.zeros(most + 1, dtype=np.uint8) for _ in range(2))
        old, shift = np.empty(most + 1, dtype=bool), np.empty(most + 1, dtype=np.uint32)
        spare = np.empty(most, dtype=np.int64)
        size = len(came)
        entries[:size] = np.sort(came)
        for t in range(1, longest + 1):
            # In the order of their places, in which neighbours are near each other in every list.
            by = np.argsort(came, kind="stable")
            came, string = came[by], string[by]
            now, k = entries[:size], len(came)
            own = np.searchsorted(now, came)
            new, at, symbol = own + m, came & _PLACE, came >> _BITS
            before, after = now[np.maximum(own - 1, 0)], now[np.minimum(own + 1, size - 1)]
            # A neighbour of the same first symbol comes from the nearest equal symbol of the transform.
            has_before = (own > 0) & (before >> _BITS == symbol)
            has_after = (own < size - 1) & (after >> _BITS == symbol)
            with_before = self._least(lcp, (before & _PLACE)[has_before] + 1, at[has_before] + 1)
            with_after = self._least(lcp, at[has_after] + 1, (after & _PLACE)[has_after] + 1)
            to = old[:n + k]
            to[:] = True
            to[new] = False
            next_lcp[:n + k][to] = lcp[:n]
            next_lcp[new] = 0
            next_lcp[n + k] = 0
            next_lcp[new[has_before]] = with_before + np.uint8(1)
            next_lcp[new[has_after] + 1] = with_after + np.uint8(1)
            lcp, next_lcp = next_lcp, lcp
            # Old places move on by the number of entries that come before them.
            moved = shift[:n + 1]
            moved[:] = 0
            np.add.at(moved, new - np.arange(k), 1)
            np.cumsum(moved, out=moved)
            held, far = spare[:size], next_entries[:size]
            np.bitwise_and(now, _PLACE, out=held)
            np.take(moved, held, out=far, mode="clip")
            now += far
            n += k
            symbol = columns[t, string]
            came = (symbol << _BITS | new.astype(np.uint32))[symbol != 0]
            string = string[symbol != 0]
            more = np.sort(came)
            place = np.searchsorted(now, more) + np.arange(len(more))
            to = old[:size + len(more)]
            to[:] = True
            to[place] = False
            merged = next_entries[:size + len(more)]
            merged[to] = now
            merged[place] = more
            size += len(more)
            entries, next_entries = next_entries, entries
        self.entries, self.lcp = entries[:size], lcp[:n]

    @staticmethod
    def _least(lcp: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Least lcp[first:end] for each pair, first < end; later pairs begin further back, so no gap is read."""
        back = np.argsort(first, kind="stable")[::-1]
        out = np.empty(len(first), dtype=np.uint8)
        if len(first):
            out[back] = np.minimum.reduceat(lcp, np.stack((first[back], end[back]), axis=1).ravel())[::2]
        return out

    def repeated(self, width: int) -> list[np.ndarray]:
        """For each string the starts of its substrings of ``width`` bytes that start at another place as well."""
        m, same = len(self.sizes), self.lcp >= width
        twice = same | np.concatenate((same[1:], [False]))
        step = np.zeros(len(self.lcp), dtype=np.int64)
        step[self.entries & _PLACE] = m + np.arange(len(self.entries))
        place, owners, starts = np.arange(m), [], []
        for t in range(1, int(self.sizes.max(initial=0)) + 1):
            alive = self.sizes >= t
            place[alive] = step[place[alive]]
            if t >= width:
                own = np.flatnonzero(alive & twice[place])
                owners.append(own)
                starts.append(self.sizes[own] - t)
        if not owners:
            return [np.empty(0, dtype=np.int64)] * m
        owner, start = np.concatenate(owners), np.concatenate(starts)
        by = np.lexsort((start, owner))
        return np.split(start[by], np.searchsorted(owner[by], np.arange(1, m)))
