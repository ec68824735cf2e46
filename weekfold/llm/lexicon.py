"""Approximate look-up of words in a lexicon: a Levenshtein automaton on a trie."""

from __future__ import annotations


def allowed_edits(length: int) -> int:
    """Edits by which a word may differ from a term of this length."""
    return 0 if length < 4 else 1 if length < 10 else 2


class Trie:
    """Terms as paths of letters; None leads from the last letter to the term."""

    def __init__(self, terms):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[None] = term


def matches(word: str, trie: Trie, edits: int = 1, swaps: bool = False) -> dict[str, int]:
    """The terms at most ``edits`` edits away from ``word``, with the edits of each.

    An edit is a letter more, less or another; with ``swaps`` also two
    neighbouring letters in each other's place. The automaton of the word is run
    along all paths of the trie at once. Its state has, for each number of edits,
    the set of places reached in the word, as bits, and the set of those where
    the first letter of a swap was read. A path is left when all are empty.
    """
    at: dict[str, int] = {}
    for i, letter in enumerate(word):
        at[letter] = at.get(letter, 0) | (1 << i)
    end = 1 << len(word)
    full = (end << 1) - 1
    found = {}
    # leaving out the first letters of the word are edits
    todo = [(trie.root, tuple((1 << e) & full for e in range(edits + 1)), (0,) * (edits + 1))]
    while todo:
        node, reached, swapped = todo.pop()
        for letter, below in node.items():
            if letter is None:
                least = next((e for e, places in enumerate(reached) if places & end), None)
                if least is not None:
                    found[below] = least
                continue
            same = at.get(letter, 0)
            then = [(reached[0] & same) << 1]
            begun = [0]
            for e in range(1, edits + 1):
                less = reached[e - 1]
                # the term's letter in another one's place, or one letter more; then one left out; or a swap's end
                then.append((((reached[e] & same) << 1) | (less << 1) | less | (then[-1] << 1)
                             | ((swapped[e] & same) << 2)) & full)
                begun.append(less & (same >> 1) if swaps else 0)
            if any(then) or any(begun):
                todo.append((below, tuple(then), tuple(begun)))
    return found


def _without(word: str, edits: int) -> set[str]:
    """The word, and what is left of it without up to ``edits`` of its letters."""
    every = last = {word}
    for _ in range(edits):
        last = {w[:i] + w[i + 1:] for w in last for i in range(len(w))}
        every = every | last
    return every


class Filter:
    """Cuts off most words that no term is ``edits`` edits or swaps from, and none other.

    An edit leaves out, puts in or replaces a letter, so without that letter the
    word and the term are alike; after a swap they are without the first letter
    of the pair and its second. So a word and a term ``edits`` edits apart share
    what is left without at most so many letters of each. With two edits, one of
    three parts of the term with a letter between them stays as it is, at most
    two letters from its place: a swap changes no two of them.
    """

    def __init__(self, terms, edits: int = 1):
        self.edits = edits
        self.left: set[str] = set()
        self.lengths: set[int] = set()
        # length of the word -> (place, size) -> parts
        self.parts: dict[int, dict[tuple[int, int], set[str]]] = {}
        for term in terms:
            n = len(term)
            self.left |= _without(term, edits)
            lengths = range(n - edits, n + edits + 1)
            self.lengths.update(lengths)
            if edits < 2:
                continue
            cuts = [(n + 1) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                part = term[a:b - 1]
                for length in lengths:
                    places = self.parts.setdefault(length, {})
                    # edits in front move the part, edits behind it have the rest of the change of length
                    for place in range(max(0, a - edits), a + edits + 1):
                        moved = abs(place - a) + abs(length - n - (place - a))
                        if moved <= edits:
                            places.setdefault((place, place + len(part)), set()).add(part)

    def may_match(self, word: str) -> bool:
        n = len(word)
        if n not in self.lengths:
            return False
        left = self.left
        if self.edits == 1:
            if word in left:
                return True
            for i in range(n):
                if word[:i] + word[i + 1:] in left:
                    return True
            return False
        if self.edits > 1:
            for (a, b), parts in self.parts[n].items():
                if word[a:b] in parts:
                    break
            else:
                return False
        return not left.isdisjoint(_without(word, self.edits))
