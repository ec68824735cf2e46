"""Boolean trigram queries from regular expressions.

A query is ``None`` (any text may match), a trigram, or a pair of "and"/"or"
and a set of queries. It holds for the ASCII-lowered UTF-8 text of everything
the expression matches, so the texts it leaves out cannot match.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

EXACT_LIMIT = 64


def _parts(kind: str, query) -> frozenset:
    """The parts of a query of this kind; any other query is its only part."""
    return query[1] if isinstance(query, tuple) and query[0] == kind else frozenset({query})


def _all(queries):
    found = frozenset().union(*(_parts("and", q) for q in queries if q is not None))
    if len(found) <= 1:
        return next(iter(found), None)
    return "and", found


def _any(queries):
    found = frozenset().union(*(_parts("or", q) for q in queries))
    if None in found or not found:
        return None
    # a query that asks for more than another one adds nothing to it
    found = frozenset(q for q in found if not any(_parts("and", r) < _parts("and", q) for r in found))
    return next(iter(found)) if len(found) == 1 else ("or", found)


def _of_texts(texts: set[bytes]):
    """The query for a text that contains one of ``texts``."""
    return _any(_all(t[i:i + 3] for i in range(len(t) - 2)) for t in texts)


class _Part:
    """What an expression matches: all texts if few, else texts it must begin and end with."""

    def __init__(self, exact=None, head=frozenset({b""}), tail=frozenset({b""}), query=None):
        self.exact, self.head, self.tail, self.query = exact, head, tail, query

    def loose(self) -> "_Part":
        if self.exact is None:
            return self
        return _Part(
            None, frozenset(t[:2] for t in self.exact), frozenset(t[-2:] for t in self.exact),
            _of_texts(self.exact),
        )


ANYTHING = _Part()
NOTHING_READ = _Part(exact=frozenset({b""}))


def _then(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= EXACT_LIMIT:
        return _Part(exact=frozenset(x + y for x in a.exact for y in b.exact))
    before, after = (a.exact or a.tail), (b.exact or b.head)
    across = None
    if len(before) * len(after) <= EXACT_LIMIT:
        across = _of_texts({x[-2:] + y[:2] for x in before for y in after})
    head = a.head if a.exact is None else frozenset(
        (x + y)[:2] for x in a.exact for y in (b.exact or b.head)
    )
    tail = b.tail if b.exact is None else frozenset(
        (x + y)[-2:] for x in (a.exact or a.tail) for y in b.exact
    )
    return _Part(None, head, tail, _all([a.loose().query, b.loose().query, across]))


def _either(parts: list[_Part]) -> _Part:
    if all(p.exact is not None for p in parts) and sum(len(p.exact) for p in parts) <= EXACT_LIMIT:
        return _Part(exact=frozenset().union(*(p.exact for p in parts)))
    parts = [p.loose() for p in parts]
    return _Part(
        None, frozenset().union(*(p.head for p in parts)), frozenset().union(*(p.tail for p in parts)),
        _any(p.query for p in parts),
    )


def _lowered(code: int) -> bytes:
    return chr(code).lower().encode() if code < 128 else chr(code).encode()


def _class(items) -> _Part:
    codes: set[int] = set()
    for op, arg in items:
        if op is C.LITERAL:
            codes.add(arg)
        elif op is C.RANGE and arg[1] - arg[0] < 64:
            codes.update(range(arg[0], arg[1] + 1))
        else:
            return ANYTHING
    texts = frozenset(map(_lowered, codes))
    return _Part(exact=texts) if len(texts) <= 8 else ANYTHING


def _part(op, arg) -> _Part:
    if op is C.LITERAL:
        return _Part(exact=frozenset({_lowered(arg)}))
    if op is C.IN:
        return _class(arg)
    if op is C.BRANCH:
        return _either([_sequence(x) for x in arg[1]])
    if op is C.SUBPATTERN:
        return _sequence(arg[3])
    if op is C.ATOMIC_GROUP:
        return _sequence(arg)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, inner = arg
        once = _sequence(inner)
        if least == 0:
            return _either([NOTHING_READ, once]) if most == 1 else ANYTHING
        out = once
        for _ in range(min(least, 4) - 1):
            out = _then(out, once)
        return out if most == least <= 4 else _then(out, ANYTHING)
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
        return NOTHING_READ
    return ANYTHING


def _sequence(items) -> _Part:
    out = NOTHING_READ
    for op, arg in items:
        out = _then(out, _part(op, arg))
    return out


def query_of(pattern: str, flags: int = 0):
    """The trigram query of a pattern; ``None`` if it has no mandatory trigram.

    Case is folded for ASCII letters only: a pattern that ignores case must say
    ``re.ASCII``, or else name no letter that folds to another alphabet.
    """
    compiled = re.compile(pattern, flags)
    if compiled.flags & re.IGNORECASE and not compiled.flags & re.ASCII:
        raise ValueError("a pattern that ignores case needs re.ASCII here")
    return _sequence(_parser.parse(pattern, flags)).loose().query


def trigrams_of(query) -> set[bytes]:
    if query is None:
        return set()
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(trigrams_of, query[1]))
