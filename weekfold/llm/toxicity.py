"""Toxicity from a learned lexicon, matched with Levenshtein automata.

From labelled documents a lexicon is learned: words, and beginnings of words,
that occur far more often in toxic documents. Every word of a text is looked up
in it with the intersection of its Levenshtein automaton and the lexicon's
trie, so misspelled terms are found too: one edit away (a swap of neighbouring
letters is one), from ten letters on two. How much these mean is learned per
term and edits. The new words of many texts are looked up together; their
lengths and letters first tell which can be near a term at all. Each hit is
weighed by its term and by its context: a window of words around it tells
quotation (quotation marks, words that the sample has around terms in clean
documents) from abuse. A logistic model on sums of these weights gives the score.

Fitting uses at most ``LABELLED_ROWS`` labelled documents (a parameter),
chosen by a hash of the id.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold.llm.lexicon import Filter, Trie, allowed_edits, matches
from weekfold.llm.linear import SparseRows, fit_logistic, sigmoid
from weekfold.llm.pretokens import slices
from weekfold.llm.tables import narrow
from weekfold.session import settle

LABELLED_ROWS = 20_000
TERMS = 600
BEGINNINGS = range(4, 9)
WINDOW = 5
QUOTED = 0.25  # part of its weight that a term has inside quotation marks
MISSPELLED = 0.6  # part of its weight that each edit leaves a term before anything is known of it
DOUBT = 2.0  # documents that it takes to change this as much as it counts itself
LONGEST = 40  # letters of a term
CONTEXT_WORDS = 2_000
THRESHOLD = 0.3
SEEN_WORDS = 500_000  # words that a task remembers
SLICE_CHARS = 2_000_000  # characters whose words are looked up together
_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = re.compile(r"[\"“”„«»‹›]|(?<!\w)[‘’]|[‘’](?!\w)")  # between two letters it is an apostrophe


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def terms_of(text: str) -> set[tuple[str, bool]]:
    """The distinct words of a text, and the beginnings of its longer words."""
    words = set(_WORD.findall(text.lower()))
    out = {(w, False) for w in words}
    for n in BEGINNINGS:
        out.update((w[:n], True) for w in words if len(w) > n)
    return out


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.iloc[at:at + 500]
            toxic: Counter = Counter()
            clean: Counter = Counter()
            for text, label in zip(part["text"], part["toxic"]):
                (toxic if label else clean).update(terms_of(text))
            every = list(toxic | clean)
            if not every:
                continue
            yield pd.DataFrame({
                "term": [t for t, _ in every], "beginning": [b for _, b in every],
                "in_toxic": [toxic[t] for t in every], "in_clean": [clean[t] for t in every],
            })


def learn_lexicon(labelled: DataFrame, terms: int = TERMS) -> dict[tuple[str, bool], float]:
    """The ``terms`` clearest terms of (text, toxic) rows, with their log odds.

    A term must be in at least three toxic documents, eight times as frequent
    there as in the others, and in so many that chance is ruled out.
    """
    n_toxic, n_all = labelled.agg(F.sum("toxic"), F.count("*")).first()
    n_toxic, n_clean = n_toxic or 0, n_all - (n_toxic or 0)
    in_toxic = (F.col("in_toxic") + 0.5) / (n_toxic + 1.0)
    in_clean = (F.col("in_clean") + 0.5) / (n_clean + 1.0)
    share = (F.col("in_toxic") + F.col("in_clean")) / F.lit(float(max(n_all, 1)))
    expected = F.lit(float(n_toxic)) * share
    surprise = (F.col("in_toxic") - expected) / F.sqrt(expected + 1e-9)
    best = (
        labelled.mapInPandas(_term_counts, "term string, beginning boolean, in_toxic long, in_clean long")
        .groupBy("term", "beginning").agg(F.sum("in_toxic").alias("in_toxic"), F.sum("in_clean").alias("in_clean"))
        .where(F.expr("in_toxic >= 3 and length(term) > 2") & (F.length("term") < LONGEST))
        .withColumn("weight", F.log(in_toxic / in_clean))
        .where((F.col("weight") > math.log(8)) & (surprise > 5))
        .orderBy(F.desc(surprise), "term", "beginning").limit(terms).collect()
    )
    # a beginning that is nearly always the same word, or the same longer beginning, tells nothing new
    kept = {}
    for r in best:
        longer = (
            o for o in best if o["term"] != r["term"] and o["term"].startswith(r["term"]) or
            (o["term"] == r["term"] and not o["beginning"])
        )
        if not (r["beginning"] and any(o["in_toxic"] >= 0.7 * r["in_toxic"] for o in longer)):
            kept[r["term"], r["beginning"]] = r["weight"]
    return kept


class Matcher:
    """Hits of a lexicon in texts: (place among the words, weight, edits, term).

    ``misspelled`` has the weight of a term so many edits away; without it that
    is a fixed part of the term's weight.
    """

    def __init__(
        self, lexicon: dict[tuple[str, bool], float], misspelled: dict[tuple[str, int], float] | None = None,
    ):
        self.words = {t: w for (t, beginning), w in lexicon.items() if not beginning}
        self.beginnings = {t: w for (t, beginning), w in lexicon.items() if beginning}
        self.sizes = sorted({len(t) for t in self.beginnings}, reverse=True)
        self.misspelled = {
            (t, e): MISSPELLED ** e * w for t, w in self.words.items() for e in range(1, allowed_edits(len(t)) + 1)
        } | (misspelled or {})
        self.spellings = []
        for edits in (1, 2):
            terms = [t for t in self.words if allowed_edits(len(t)) == edits]
            self.spellings.append((edits, Trie(terms), Filter(terms, edits)))
        # words as they are written: those that were looked up, and what was found
        self.seen: set[str] = set()
        self.found: dict[str, tuple[float, int, str]] = {}
        self.near = []
        for edits in (1, 2):
            for t in self.words:
                if allowed_edits(len(t)) == edits:
                    letters, counts = _letters([t])
                    self.near.append((t, edits, letters[0], counts[0]))

    def look_up(self, word: str, near: list[tuple[str, int]] | None = None) -> tuple[float, int, str] | None:
        """The best term: as written, then by its beginning, then misspelled.

        ``near`` has the terms that may be within their edits, if that is known:
        the automaton then runs on their part of the trie alone.
        """
        if word in self.words:
            return self.words[word], 0, word
        for n in self.sizes:
            if word[:n] in self.beginnings:
                return self.beginnings[word[:n]], 0, word[:n]
        if near is None:
            tries = [(edits, trie) for edits, trie, fits in self.spellings if fits.may_match(word)]
        else:
            tries = [
                (edits, Trie(own)) for edits, _, fits in self.spellings
                if (own := [t for t, e in near if e == edits]) and fits.may_match(word)
            ]
        found = (
            (self.misspelled[t, e], e, t)
            for edits, trie in tries for t, e in matches(word, trie, edits, swaps=True).items()
        )
        # a misspelling that was learned to say nothing is an ordinary word
        return max((x for x in found if x[0] > 0), default=None)

    def _may_be_near(self, words: list[str]) -> dict[int, list[tuple[str, int]]]:
        """For words, by number, the terms (and their edits) that they may be near by lengths and letters.

        An edit changes the length by one at most, the set of letters by two, and
        so their counts; a swap changes nothing. So no pair is left out that an
        automaton accepts.
        """
        lengths = np.array([len(w) for w in words])
        letters, counts = _letters(words)
        by_length = {n: np.flatnonzero(lengths == n) for n in np.unique(lengths).tolist()}
        out: dict[int, list[tuple[str, int]]] = {}
        for term, edits, own, own_counts in self.near:
            for n in range(len(term) - edits, len(term) + edits + 1):
                at = by_length.get(n)
                if at is None:
                    continue
                at = at[np.bitwise_count(letters[at] ^ own) <= 2 * edits]
                at = at[np.abs(counts[at] - own_counts).sum(axis=1) <= 2 * edits]
                for i in at.tolist():
                    out.setdefault(i, []).append((term, edits))
        return out

    def learn(self, words: set[str]) -> None:
        """Look up the words (as written) that were not seen yet."""
        new = list(words - self.seen)
        if len(self.seen) + len(new) > SEEN_WORDS:
            self.seen.clear()
            self.found.clear()
            new = list(words)
        self.seen.update(new)
        lowered = [w.lower() for w in new]
        close = self._may_be_near(lowered) if new else {}
        some = set(close)
        some.update(i for i, w in enumerate(lowered) if w in self.words)
        for n in self.sizes:
            some.update(i for i, w in enumerate(lowered) if w[:n] in self.beginnings)
        for i in some:
            hit = self.look_up(lowered[i], close.get(i, []))
            if hit is not None:
                self.found[new[i]] = hit

    def hits(self, words: list[str]) -> list[tuple[int, float, int, str]]:
        every = set(words)
        if not every <= self.seen:
            self.learn(every)
        found = self.found
        if found.keys().isdisjoint(every):
            return []
        return [(i, *found[w]) for i, w in enumerate(words) if w in found]


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The set of letters of each (non-empty) word as bits, and the counts of its letters; some letters share a place."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    sets = np.bitwise_or.reduceat(np.uint64(1) << (codes & 63).astype(np.uint64), starts)
    place = np.repeat(np.arange(len(words)), lengths) * 32 + (codes & 31)
    return sets, np.bincount(place, minlength=32 * len(words)).reshape(-1, 32).astype(np.int16)


def _quoted(text: str, spans: list[tuple[int, int]]) -> list[bool]:
    """Whether an odd number of quotation marks stands before a word on its line, and one after it.

    ``spans`` are in the order of the text, so each line is looked for and its marks are read once.
    """
    marks = [m.start() for m in _QUOTES.finditer(text)]
    out = []
    first = at = last = 0  # among the marks: the first one of the line, the next one, the first one after the line
    stop = -1
    for s, e in spans:
        if s > stop:
            line = text.rfind("\n", max(stop, 0), s) + 1
            stop = text.find("\n", e)
            stop = stop if stop >= 0 else len(text)
            first = at = bisect_left(marks, line, last)
            last = bisect_left(marks, stop, first)
        at = bisect_left(marks, s, at, last)
        out.append((at - first) % 2 == 1 and at < last)
    return out


FEATURES = 7


def features(text: str, matcher: Matcher, context: dict[str, float]) -> np.ndarray:
    """Sums of hit weights by context, their number and density."""
    return _features(text, _WORD.findall(text), matcher, context)


def _features(text: str, words: list[str], matcher: Matcher, context: dict[str, float]) -> np.ndarray:
    hits = matcher.hits(words)
    out = np.zeros(FEATURES)
    if not hits:
        return out
    spans = [m.span() for m in _WORD.finditer(text)]
    quoted = _quoted(text, [spans[h[0]] for h in hits])
    total = tone = 0.0
    for (i, weight, _, _), inside in zip(hits, quoted):
        around = words[max(0, i - WINDOW):i] + words[i + 1:i + 1 + WINDOW]
        tone += sum(context.get(w.lower(), 0.0) for w in around) / max(len(around), 1)
        value = weight * (QUOTED if inside else 1.0)
        total += value
        out[0] = max(out[0], value)
    out[1] = np.log1p(total)
    out[2] = np.tanh(tone)
    out[3] = np.log1p(sum(quoted))
    out[4] = np.log1p(len({t for _, w, _, t in hits if w > 1}))
    out[5] = np.log1p(1000 * sum(w > 1 for _, w, _, _ in hits) / (len(words) + 20))
    out[6] = float(total > 6)
    return out


def _all_features(texts: list[str], matcher: Matcher, context: dict[str, float]) -> list[np.ndarray]:
    """Features of texts, whose new words are looked up together, slice by slice."""
    out = []
    for part in slices(texts, SLICE_CHARS):
        split = [_WORD.findall(t) for t in texts[part]]
        matcher.learn(set().union(*split))
        out += [_features(t, w, matcher, context) for t, w in zip(texts[part], split)]
    return out


def _surroundings(matcher: Matcher):
    """For toxic and for other documents: words around hits, and misspelled terms."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
            split = [_WORD.findall(t.lower()) for t in batch["text"]]
            matcher.learn(set().union(*split))
            for words, label in zip(split, batch["toxic"]):
                found: set[tuple[str, int]] = set()
                for i, _, edits, term in matcher.hits(words):
                    if edits:
                        found.add((term, edits))
                    else:
                        found.update((w, 0) for w in words[max(0, i - WINDOW):i] + words[i + 1:i + 1 + WINDOW])
                counts[bool(label)].update(found)
            every = list(counts[True] | counts[False])
            if not every:
                continue
            yield pd.DataFrame({
                "word": [w for w, _ in every], "edits": [e for _, e in every],
                "toxic": [counts[True][x] for x in every], "clean": [counts[False][x] for x in every],
            })

    return run


def learn_surroundings(
    labelled: DataFrame, lexicon: dict[tuple[str, bool], float], size: int = CONTEXT_WORDS,
) -> tuple[dict[str, float], dict[tuple[str, int], float]]:
    """Log odds of the most frequent words around terms, and of terms misspelled by so many edits.

    What looks like a misspelled term is often an ordinary word: each starts with
    a part of its term's weight and loses it as clean documents have it.
    """
    n_toxic, n_all = labelled.agg(F.sum("toxic"), F.count("*")).first()
    base = (n_toxic or 0) + 1.0
    base /= n_all - (n_toxic or 0) + 1.0
    matcher = Matcher(lexicon)
    counts = settle(
        labelled.mapInPandas(_surroundings(matcher), "word string, edits int, toxic long, clean long")
        .groupBy("word", "edits").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "surroundings",
    )
    misspelled = {}
    for r in counts.where("edits > 0").collect():  # at most two for each term of the lexicon
        start = matcher.misspelled[r["word"], r["edits"]]
        odds = base * math.exp(start)
        share = odds / (1 + odds)
        seen = math.log((r["toxic"] + DOUBT * share) / (r["clean"] + DOUBT * (1 - share)) / base)
        misspelled[r["word"], r["edits"]] = min(max(seen, 0.0), start)
    around = (
        counts.where("edits = 0 and toxic + clean >= 5")
        .orderBy(F.desc(F.col("toxic") + F.col("clean")), "word").limit(size).collect()
    )
    toxic = sum(r["toxic"] for r in around) + 1.0
    clean = sum(r["clean"] for r in around) + 1.0
    context = {r["word"]: math.log(((r["toxic"] + 5) / toxic) / ((r["clean"] + 5) / clean)) for r in around}
    return context, misspelled


def _feature_rows(matcher: Matcher, context: dict[str, float]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "toxic": batch["toxic"], "features": _all_features(batch["text"].tolist(), matcher, context),
            })

    return run


def learn(labelled: DataFrame) -> tuple[Matcher, dict[str, float], np.ndarray]:
    """Lexicon, context weights and model weights from a bounded table of (text, toxic)."""
    lexicon = learn_lexicon(labelled)
    context, misspelled = learn_surroundings(labelled, lexicon)
    matcher = Matcher(lexicon, misspelled)
    rows = labelled.mapInPandas(_feature_rows(matcher, context), "toxic int, features array<double>").collect()
    columns = np.arange(FEATURES)
    table = SparseRows([columns] * len(rows), [np.array(r["features"]) for r in rows])
    return matcher, context, fit_logistic(table, np.array([float(r["toxic"]) for r in rows]), FEATURES)


def _scores(matcher: Matcher, context: dict, weights: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            table = np.array(_all_features(batch["text"].tolist(), matcher, context)).reshape(-1, FEATURES)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "score": sigmoid(table @ weights[:-1] + weights[-1]),
            })

    return run


def toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    labelled_rows: int = LABELLED_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each row of ``docs``.

    ``labels`` has (doc_id, toxic) rows; those that are ``held_out`` or null are
    never read. At most about ``labelled_rows`` of the others are used. Only the
    text enters a score: null and empty texts get that of a text without hits.
    Without any labels every score is 0.5. Repeated rows get equal scores, and a
    null id is not held out. Terms have fewer than ``LONGEST`` letters. Other
    columns are ignored.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # a bounded choice: a share of all ids by hash, and never more than the bound
    share = min(1.0, labelled_rows / max(usable.count(), 1))
    ids = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)
    source = narrow(docs, key, text)
    labelled = settle(
        source.join(F.broadcast(settle(ids, "label-ids")), "doc_id").select("text", "toxic").repartition(8), "labelled"
    )
    return source.mapInPandas(_scores(*learn(labelled)), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
