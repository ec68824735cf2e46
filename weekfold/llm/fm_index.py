"""A bidirectional FM-index over a vocabulary, searched for words one edit away.

Each word stands in the index as a ring ``#word``, so its closing delimiter is
its opening one. Two indexes are kept, of the words and of the words read
backwards. A pattern is an interval of suffix ranks in both, of the same size:
extending it to the left narrows the interval of the first by the symbol's
rank and moves that of the second by the number of smaller symbols, and the
other way round. Ranks and numbers of smaller symbols come from wavelet
matrices. All queries of a vocabulary move together, one symbol at a time, in
numpy arrays.
"""

from __future__ import annotations

import numpy as np

DELIMITER = 0


class Ranks:
    """A wavelet matrix over small integers."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.levels = max(int(kinds - 1).bit_length(), 1)
        self.ones, self.zeros = [], []
        rest = symbols.astype(np.int32)
        for level in range(self.levels - 1, -1, -1):
            bit = (rest >> level) & 1
            ones = np.zeros(len(rest) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(rest) - int(ones[-1]))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        every = np.arange(kinds)
        # where the rows of each symbol begin on the last level, and in sorted order
        self.last = self._descend(every, np.zeros(kinds, dtype=np.int64), np.zeros(kinds, dtype=np.int64))[0]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=kinds))])

    def _descend(self, symbol, low, high):
        smaller = np.zeros(len(low), dtype=np.int64)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = ((symbol >> (self.levels - 1 - k)) & 1).astype(bool)
            o_low, o_high = ones[low], ones[high]
            smaller += np.where(up, (high - low) - (o_high - o_low), 0)
            low = np.where(up, zeros + o_low, low - o_low)
            high = np.where(up, zeros + o_high, high - o_high)
        return low, high, smaller

    def narrow(self, symbol, low, size):
        """The interval of each pattern with its symbol before it, its size, and how many rows have a smaller symbol."""
        at, end, smaller = self._descend(symbol, low, low + size)
        return self.first[symbol] + at - self.last[symbol], end - at, smaller

    def children(self, low, size):
        """(row, symbol, low, size, smaller) for every symbol that stands before a pattern, for all patterns."""
        row, symbol = np.arange(len(low)), np.zeros(len(low), dtype=np.int64)
        high, smaller = low + size, np.zeros(len(low), dtype=np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            o_low, o_high = ones[low].astype(np.int64), ones[high].astype(np.int64)
            below = (high - low) - (o_high - o_low)
            left, right = np.flatnonzero(below), np.flatnonzero(o_high - o_low)
            row = np.concatenate([row[left], row[right]])
            smaller = np.concatenate([smaller[left], (smaller + below)[right]])
            symbol = np.concatenate([symbol[left] * 2, symbol[right] * 2 + 1])
            low, high = (
                np.concatenate([(low - o_low)[left], (zeros + o_low)[right]]),
                np.concatenate([(high - o_high)[left], (zeros + o_high)[right]]),
            )
        return row, symbol, self.first[symbol] + low - self.last[symbol], high - low, smaller


def _sorted_rotations(text: np.ndarray, left: np.ndarray, kinds: int) -> np.ndarray:
    """Positions by the symbols up to the end of their word, then by word; ``left`` counts those symbols."""
    bits = max(int(kinds - 1).bit_length(), 1)
    packed = 62 // bits
    key, alive = text.astype(np.int64), np.ones(len(text), dtype=bool)
    for j in range(1, packed):
        alive &= left > j
        following = np.zeros(len(text), dtype=np.int64)
        following[:-j or None] = text[j:] if j < len(text) else 0
        key = (key << bits) | np.where(alive, following, 0)
    done, longest = packed, int(left.max(initial=0))
    while True:
        order = np.argsort(key, kind="stable")
        if done >= longest:
            return order
        # doubling: the next ``done`` symbols are those of the position ``done`` further on
        ahead = key[order]
        rank = np.empty(len(text), dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[True], ahead[1:] != ahead[:-1]]))
        then = np.where(left > done, rank[np.minimum(np.arange(len(text)) + done, len(text) - 1)], 0)
        key, done = rank * (len(text) + 2) + then, 2 * done


def _index(flat: np.ndarray, lengths: np.ndarray, kinds: int) -> Ranks:
    """Ranks over the symbols that stand before the sorted rotations of sorted words."""
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    text = np.zeros(int((lengths + 1).sum()), dtype=np.int64)
    inner = np.ones(len(text), dtype=bool)
    inner[starts] = False
    text[inner] = flat
    left = np.repeat(starts + lengths + 1, lengths + 1) - np.arange(len(text))
    before = np.roll(text, 1)
    before[starts] = text[starts + lengths]  # rings: before the delimiter stands the word's end
    return Ranks(before[_sorted_rotations(text, left, kinds)], kinds)


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64) + 1


class Patterns:
    """Queries as symbols, one after the other; symbols that no word has are -1."""

    def __init__(self, words: list[str], alphabet: np.ndarray):
        found = _codes(words)
        at = np.searchsorted(alphabet, found)
        at[at == len(alphabet)] = 0
        self.flat = np.where(alphabet[at] == found, at, -1) if len(alphabet) else np.full(len(found), -1)
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]

    def at(self, query, place):
        return self.flat[self.starts[query] + place]


class VariantIndex:
    """Distinct words, none of them empty; word numbers are those of ``self.words``."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        self.alphabet = np.unique(np.concatenate([[DELIMITER], _codes(self.words)]))
        kinds = len(self.alphabet)
        self.symbols = int(sum(map(len, self.words)) + len(self.words))

        def index(some: list[str]) -> Ranks:
            flat = np.searchsorted(self.alphabet, _codes(some))
            return _index(flat, np.array([len(w) for w in some], dtype=np.int64), kinds)

        self.onward = index(self.words)
        self.backward = index(sorted(w[::-1] for w in self.words))

    def left_exact(self, queries: list[str], half: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers: one edit apart, with the query's first ``half`` characters before the edit."""
        query, word, _ = self._search(queries, half, self.onward, self.backward)
        return query, word

    def right_exact(self, queries: list[str], half: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers: one edit apart, with the query's last ``half`` characters behind the edit."""
        query, _, word = self._search([q[::-1] for q in queries], half, self.backward, self.onward)
        return query, word

    def _search(self, queries: list[str], half: int, before: Ranks, after: Ranks):
        """One search of the scheme: the first half from its end to the delimiter, then the other one with an error.

        ``before`` extends patterns to the left, ``after`` to the right; mirrored
        queries take them the other way round.
        """
        patterns = Patterns(queries, self.alphabet)
        query = np.flatnonzero(patterns.lengths >= half)
        low, other, size = (np.full(len(query), x, dtype=np.int64) for x in (0, 0, self.symbols))
        for place in range(half - 1, -2, -1):
            symbol = patterns.at(query, place) if place >= 0 else np.zeros(len(query), dtype=np.int64)
            known = symbol >= 0
            query, symbol, low, other, size = (x[known] for x in (query, symbol, low, other, size))
            low, size, smaller = before.narrow(symbol, low, size)
            other = other + smaller
            query, low, other, size = (x[size > 0] for x in (query, low, other, size))
        exact = (query, np.full(len(query), half, dtype=np.int64), low, other, size)
        erred = tuple(x[:0] for x in exact)
        found = []
        while len(exact[0]) or len(erred[0]):
            # with the error behind: the rest of the query, then the delimiter
            query, place, low, other, size = erred
            ends = place == patterns.lengths[query]
            symbol = np.where(ends, DELIMITER, patterns.at(query, np.where(ends, 0, place)))
            keep = symbol >= 0
            query, place, low, other, size, symbol, ends = (
                x[keep] for x in (query, place, low, other, size, symbol, ends)
            )
            other, size, smaller = after.narrow(symbol, other, size)
            low, alive = low + smaller, size > 0
            found.append((query[alive & ends], low[alive & ends], other[alive & ends]))
            going = alive & ~ends
            later = [(query[going], place[going] + 1, low[going], other[going], size[going])]
            # without one: every symbol that occurs is the next one, replaces it, or is put before it
            query, place, low, other, size = exact
            inside = place < patterns.lengths[query]
            row, symbol, c_other, c_size, smaller = after.children(other, size)
            letter = symbol != DELIMITER
            row, symbol, c_other, c_size, smaller = (x[letter] for x in (row, symbol, c_other, c_size, smaller))
            wanted = np.where(inside, patterns.at(query, np.where(inside, place, 0)), -2)[row]
            state = (query[row], place[row], low[row] + smaller, c_other, c_size)
            same, differs = symbol == wanted, symbol != wanted
            exact = tuple(x[same] for x in (state[0], state[1] + 1, *state[2:]))
            replaced = differs & inside[row]
            later.append(tuple(x[replaced] for x in (state[0], state[1] + 1, *state[2:])))
            # a doubled letter counts once: it is put in, or left out, at the end of its run
            later.append(tuple(x[differs] for x in state))
            following = place + 1 < patterns.lengths[query]
            then = np.where(following, patterns.at(query, np.where(following, place + 1, 0)), -2)
            now = patterns.at(query, np.where(inside, place, 0))
            left_out = inside & ((now != then) | (now == -1))
            later.append(tuple(x[left_out] for x in (query, place + 1, low, other, size)))
            erred = tuple(np.concatenate(x) for x in zip(*later))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, dtype=np.int64),) * 3
