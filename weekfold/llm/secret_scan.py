"""Secret scans through a trigram inverted index.

Every rule is a regular expression, from which a Boolean query of trigrams is
derived. The index is built per shard (a slice of an input partition): for
each trigram that some rule asks for, the sorted positions of the shard's
texts that contain it. The queries intersect and unite these postings, and
only their candidates are searched with the expression itself. Rules without a
mandatory trigram search every text. Shards are independent, so there is no
shuffle, and a trigram that all texts contain costs no more than its postings
in a shard.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from weekfold.llm.tables import narrow
from weekfold.llm.trigrams import query_of, trigrams_of

SHARD_CHARS = 16_000_000
SHARD_TEXTS = 8_192


@dataclass(frozen=True)
class Rule:
    """A kind of secret; of its leftmost matches those count whose group is long enough."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0


# The kinds of the base scan, in the order in which ties are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        re.IGNORECASE | re.ASCII, 2, 8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),  # whole runs, as of [0-9a-f]+ with 32 or more
)
# Published formats of further secrets.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 0, 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)


class ShardIndex:
    """Postings of the wanted trigrams over the texts of one shard."""

    def __init__(self, texts: list[str], wanted: set[bytes]):
        lowered = [t.encode().lower() for t in texts]  # bytes.lower() is ASCII only
        self.everything = np.arange(len(texts))
        self.postings = {
            g: np.array([i for i, t in enumerate(lowered) if g in t], dtype=np.int64) for g in wanted
        }

    def candidates(self, query) -> np.ndarray:
        """Positions of the texts for which the query holds."""
        if query is None:
            return self.everything
        if isinstance(query, bytes):
            return self.postings[query]
        kind, parts = query
        found = sorted((self.candidates(p) for p in parts), key=len)
        out = found[0]
        for other in found[1:]:
            if kind == "and" and not len(out):
                break
            out = np.intersect1d(out, other, True) if kind == "and" else np.union1d(out, other)
        return out


def _scanner(rules: tuple[Rule, ...]) -> Callable[[list[str]], list[list[tuple[int, int, int]]]]:
    """Finds (start, rule number, end) of every text of a shard."""
    plans = [(query_of(r.pattern, r.flags), re.compile(r.pattern, r.flags), r) for r in rules]
    wanted = set().union(*(trigrams_of(q) for q, _, _ in plans))

    def scan(texts: list[str]) -> list[list[tuple[int, int, int]]]:
        index = ShardIndex(texts, wanted)
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (query, expression, rule) in enumerate(plans):
            for i in index.candidates(query).tolist():
                for m in expression.finditer(texts[i]):
                    s, e = m.span(rule.group)
                    if e - s >= rule.least:
                        spans[i].append((m.start(), k, m.end()))
        for found in spans:
            found.sort()
        return spans

    return scan


def _shards(texts: list[str]) -> Iterator[slice]:
    start = chars = 0
    for i, t in enumerate(texts):
        if i > start and (chars + len(t) > SHARD_CHARS or i - start >= SHARD_TEXTS):
            yield slice(start, i)
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def secret_spans(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, kind, start, end, secret): a row for each match, in code points, end exclusive.

    Matches of one kind do not overlap; those of different kinds may. Null and
    empty texts have no matches, a repeated row has its matches as often as it
    occurs, and ids may be null. Other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan = _scanner(rules)
        for batch in batches:
            ids, texts = batch["doc_id"], batch["text"].tolist()
            for part in _shards(texts):
                own = texts[part]
                hits = [(i, *h) for i, found in enumerate(scan(own)) for h in found]
                if not hits:
                    continue
                yield pd.DataFrame({
                    "doc_id": ids.iloc[[part.start + h[0] for h in hits]].array,
                    "kind": [rules[h[2]].kind for h in hits],
                    "start": [h[1] for h in hits],
                    "end": [h[3] for h in hits],
                    "secret": [own[h[0]][h[1]:h[3]] for h in hits],
                })

    return narrow(docs, key, text).mapInPandas(
        run, "doc_id long, kind string, start int, end int, secret string"
    )


def secret_report(
    docs: DataFrame, base: tuple[Rule, ...] = BASE_RULES, more: tuple[Rule, ...] = MORE_RULES,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, and all spans.

    Columns ``doc_id``, ``n_<kind>`` for each base rule, ``base_sha256`` and
    ``spans`` (``kind:start:end``, comma-joined, by start, then rule). Nulls,
    empty texts and repeated rows as in ``secret_spans``; a document without
    matches has zeros, the digest of the empty text and empty ``spans``.
    """
    rules = base + more

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan = _scanner(rules)

        def written(found):
            return ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in found)

        for batch in batches:
            ids, texts = batch["doc_id"], batch["text"].tolist()
            for part in _shards(texts):
                spans = scan(texts[part])
                own = [written([h for h in found if h[1] < len(base)]) for found in spans]
                out = {"doc_id": ids.iloc[part].array}
                for k, rule in enumerate(base):
                    out[f"n_{rule.kind}"] = [sum(h[1] == k for h in found) for found in spans]
                out["base_sha256"] = [hashlib.sha256(x.encode()).hexdigest() for x in own]
                out["spans"] = [written(found) for found in spans]
                yield pd.DataFrame(out)

    counts = ", ".join(f"n_{r.kind} long" for r in base)
    return narrow(docs, key, text).mapInPandas(
        run, f"doc_id long, {counts}, base_sha256 string, spans string"
    )
