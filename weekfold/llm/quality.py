"""Document quality from weak labels.

Overlapping heuristics vote good, bad or nothing on every document. How often
each of them is right is not known: expectation-maximisation over the counts of
all vote patterns estimates it, together with the share of good documents, and
gives every pattern a posterior. These posteriors are the labels from which a
linear scorer on hashed features learns; it then scores every document, those
without votes too.

The votes of all documents are counted (at most ``3 ** len(HEURISTICS)``
patterns); only the scorer is fitted on a bounded sample, about
``SAMPLE_ROWS`` documents chosen by a hash of the text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekfold.llm.linear import SparseRows, fit_logistic, sigmoid
from weekfold.llm.tables import narrow
from weekfold.session import settle

SAMPLE_ROWS = 4_000
WIDTH = 1 << 14
KEEP = 0.5
ROUNDS = 200
_SIGNS = re.compile(r"[^\w\s]{3,}")
_LETTER = re.compile(r"\w")
_COMMON_END = frozenset(".,;:?!)]}\"'”’»…-")
_RUN = re.compile(r"(.)\1+", re.DOTALL)


KNOWN = 150_000


class Words:
    """The words of one text: how often each occurs, and how often pairs and neighbours repeat."""

    def __init__(self, text: str):
        self.text = text
        self.list = text.split()
        self.counts = Counter(self.list)
        self.echoes = sum(map(eq, self.list, self.list[1:]))
        pairs = Counter(zip(self.list, self.list[1:]))
        # every pair once, and again for each that repeats
        once = sum(1 for n in pairs.values() if n == 1)
        self.repeated_pairs = max(len(self.list) - 1, 0) - once


class Measurer:
    """Shares of words and lines that the heuristics look at; what a word has is kept (bounded)."""

    def __init__(self):
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        """Letters, other signs, and 1 or 0 for: a run of signs, odd end, upper case, nothing but signs."""
        if word.isalpha():
            found = (len(word), 0, 0, 0, int(len(word) > 1 and word.isupper()), 0)
        else:
            letters = sum(map(str.isalpha, word))
            digits = sum(map(str.isdigit, word))
            last = word[-1]
            found = (
                letters, len(word) - letters - digits, int(_SIGNS.search(word) is not None),
                int(last not in _COMMON_END and not last.isalnum()), int(len(word) > 1 and word.isupper()),
                int(_LETTER.search(word) is None),
            )
        if len(self.known) >= KNOWN:
            self.known.clear()
        self.known[word] = found
        return found

    def measures(self, words: Words) -> dict[str, float]:
        """A text without words gives zeros."""
        letters = marks = signs = ends = upper = bare = 0
        known = self.known
        for w, n in words.counts.items():
            got = known.get(w) or self.of_word(w)
            letters += got[0] * n
            if got[1]:
                marks += got[1] * n
                signs += got[2] * n
                ends += got[3] * n
                bare += got[5] * n
            if got[4]:
                upper += n
        n, text = len(words.list), words.text
        least = max(n, 1)
        lines = [x for x in text.split("\n") if x.strip()]
        return {
            "words": n,
            "signs": signs / least,
            "upper": upper / least,
            "shouts": text.count("!") / least,
            "bars": text.count("|") / least,
            "bare": bare / least,
            "ends": ends / least,
            "echo": words.echoes / least,
            "variety": len(words.counts) / least,
            "pairs": words.repeated_pairs / max(n - 1, 1),
            "lines": 1 - len(set(lines)) / max(len(lines), 1),
            "marks": marks / max(letters + marks, 1),
            "length": letters / least,
        }

    def votes(self, words: Words) -> str:
        """One sign of each heuristic: ``+``, ``-`` or ``0``."""
        m = self.measures(words)
        return "".join(["0+-"[h(m)] for h in HEURISTICS])


def _beyond(name: str, good: float, bad: float, least: int = 1):
    """Bad from ``bad`` on, good up to ``good``, nothing between or below ``least`` words."""

    def vote(m: dict[str, float]) -> int:
        if m["words"] < least:
            return 0
        x = m[name]
        return -1 if x >= bad else 1 if x <= good else 0

    return vote


def _within(name: str, low: float, high: float, least: int = 1):
    def vote(m: dict[str, float]) -> int:
        return 0 if m["words"] < least else 1 if low <= m[name] <= high else -1

    return vote


def _variety(m: dict[str, float]) -> int:
    """Few different words; long texts repeat more, so what is expected falls with length."""
    if m["words"] < 20:
        return 0
    expected = min(1.0, (100 / m["words"]) ** 0.25)
    return -1 if m["variety"] < 0.4 * expected else 1 if m["variety"] > 0.55 * expected else 0


# Several look at the same fault from different sides: only where votes overlap can
# their accuracy be estimated.
HEURISTICS = (
    _beyond("signs", 0.02, 0.2),
    _beyond("ends", 0.05, 0.3),
    _beyond("upper", 0.1, 0.5),
    _beyond("shouts", 0.05, 0.3),
    _beyond("bars", 0.02, 0.2),
    _beyond("bare", 0.05, 0.25),
    _beyond("marks", 0.06, 0.11, 8),
    _beyond("echo", 0.04, 0.25, 4),
    _variety,
    _beyond("pairs", 0.35, 0.7, 20),
    _beyond("lines", 0.3, 0.6, 20),
    _within("length", 2.0, 14.0, 3),
)


def votes(text: str) -> str:
    return Measurer().votes(Words(text))


def _patterns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    measurer = Measurer()
    for batch in batches:
        counts = Counter(measurer.votes(Words(t)) for t in batch["text"])
        if counts:
            yield pd.DataFrame({"pattern": list(counts), "n": list(counts.values())})


def pattern_counts(docs: DataFrame) -> dict[str, int]:
    rows = docs.mapInPandas(_patterns, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    return {r["pattern"]: r["n"] for r in rows.collect()}


class VoteModel:
    """Two kinds of documents; the votes of each heuristic have a chance in each kind to be "good".

    Silence tells nothing. Faults are of many sorts, so a bad document gets
    few of the possible "bad" votes, while a good one hardly gets any: the
    estimates start from there, and a prior worth ``PRIOR`` of the documents
    holds the kinds to these roles.
    """

    PRIOR = 0.02

    def __init__(self, counts: dict[str, int], rounds: int = ROUNDS):
        patterns = list(counts)
        weight = np.array([counts[p] for p in patterns], dtype=np.float64)
        plus, minus = self._cast(patterns)
        strength = max(self.PRIOR * weight.sum(), 1.0)
        self.good = 0.8
        self.right = np.vstack([np.full(len(HEURISTICS), 0.5), np.full(len(HEURISTICS), 0.98)])  # bad, good
        post = np.select([minus.sum(axis=1) >= 2, minus.sum(axis=1) == 1], [0.02, 0.6], 0.98)
        for _ in range(rounds if len(patterns) else 0):
            for kind, w, usual in ((1, weight * post, 0.98), (0, weight * (1 - post), 0.5)):
                self.right[kind] = (w @ plus + usual * strength) / (w @ (plus + minus) + strength)
            self.good = (weight @ post + 1) / (weight.sum() + 2)
            post = self._posterior(plus, minus)

    @staticmethod
    def _cast(patterns: list[str]) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(patterns), len(HEURISTICS))
        plus = np.array([[v == "+" for v in p] for p in patterns], dtype=np.float64).reshape(shape)
        return plus, np.array([[v == "-" for v in p] for p in patterns], dtype=np.float64).reshape(shape)

    def _posterior(self, plus: np.ndarray, minus: np.ndarray) -> np.ndarray:
        bad, good = self.right
        odds = np.log(self.good / (1 - self.good)) + plus @ np.log(good / bad) + minus @ np.log((1 - good) / (1 - bad))
        return sigmoid(odds)

    def posterior(self, pattern: str) -> float:
        """Probability that a document with these votes is good."""
        return float(self._posterior(*self._cast([pattern]))[0])

    def accuracy(self) -> np.ndarray:
        """For each heuristic, the share of its votes that are right."""
        bad, good = self.right
        return self.good * good + (1 - self.good) * (1 - bad)


class Hasher:
    """Hashed features of a text: shapes of words, repetition and the words themselves."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.known: dict[str, tuple[int, int]] = {}
        self.echo, self.pairs, self.new = (self.slot(n) for n in ("=echo", "=pairs", "=new"))

    def slot(self, name: str) -> int:
        return xxhash.xxh64_intdigest(name) % self.width

    @staticmethod
    def shape(word: str) -> str:
        """A for capitals, a for other letters, 9 for digits; signs as they are; runs as one."""
        if word.isalpha():
            return "A" if word.isupper() else "Aa" if word[0].isupper() else "a"
        kinds = "".join(["A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word])
        return _RUN.sub(r"\1", kinds)

    def of_word(self, word: str) -> tuple[int, int]:
        if len(self.known) >= KNOWN:
            self.known.clear()
        found = self.known[word] = self.slot("s" + self.shape(word)), self.slot("w" + word.lower())
        return found

    def features(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Columns and values; values are roots of shares of the words, so length does not matter."""
        known, counts = self.known, {self.echo: words.echoes, self.pairs: words.repeated_pairs}
        counts[self.new] = counts.get(self.new, 0) + len(words.counts)
        for w, n in words.counts.items():
            for c in known.get(w) or self.of_word(w):
                counts[c] = counts.get(c, 0) + n
        columns = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
        values = np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) / max(len(words.list), 1)
        return columns, np.sqrt(values)


def _sample_rows(model: VoteModel, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, measurer = Hasher(width), Measurer()
        for batch in batches:
            texts = [Words(t) for t in batch["text"]]
            rows = [hasher.features(t) for t in texts]
            yield pd.DataFrame({
                "columns": [c for c, _ in rows], "values": [v for _, v in rows],
                "label": [model.posterior(measurer.votes(t)) for t in texts],
            })

    return run


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, width: int = WIDTH) -> tuple[VoteModel, np.ndarray]:
    """The vote model of all documents, and the scorer's weights from a bounded sample of them."""
    counts = pattern_counts(docs)
    model = VoteModel(counts)
    share = min(1.0, sample_rows / max(sum(counts.values()), 1))
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # copies of one text may exceed the share: the bound holds in the order of the hash
    bounded = sample.orderBy(F.xxhash64("text"), "text").limit(2 * sample_rows)
    rows = bounded.mapInPandas(
        _sample_rows(model, width), "columns array<int>, values array<float>, label double"
    ).collect()
    table = SparseRows([np.array(r["columns"], dtype=np.int64) for r in rows], [np.array(r["values"]) for r in rows])
    return model, fit_logistic(table, np.array([r["label"] for r in rows]), width, steps=150)


def score_of(words: Words, hasher: Hasher, weights: np.ndarray) -> float:
    """The scorer's chance that a text is good; 0 for a text without words."""
    if not words.list:
        return 0.0
    columns, values = hasher.features(words)
    return float(sigmoid(values @ weights[columns] + weights[-1]))


def _scored(model: VoteModel | None, weights: np.ndarray, width: int):
    """Scores, and with a vote model the posteriors of the votes, which are taken once more for them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, measurer = Hasher(width), Measurer()
        posteriors: dict[str, float] = {}
        for batch in batches:
            labels, scores = [], []
            for text in batch["text"]:
                words = Words(text)
                scores.append(score_of(words, hasher, weights))
                if model is not None:
                    pattern = measurer.votes(words)
                    if pattern not in posteriors:
                        posteriors[pattern] = model.posterior(pattern)
                    labels.append(posteriors[pattern])
            out = pd.DataFrame({"doc_id": batch["doc_id"], "score": scores})
            yield out if model is None else out.assign(weak_label=labels)

    return run


def quality(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: float = KEEP,
    sample_rows: int = SAMPLE_ROWS, width: int = WIDTH, weak_labels: bool = False,
) -> DataFrame:
    """(doc_id, score, kept): one row for each row of ``docs``.

    ``score`` is that of the scorer, from 0 to 1 (good); ``kept`` says that it
    is ``keep`` or more. With ``weak_labels`` a column ``weak_label`` has the
    posterior of the heuristics' votes, for which every text is judged again.
    Texts without words, null texts among them, have score 0. Equal texts get
    equal scores; ids may be null or repeat; other columns are ignored.
    """
    source = narrow(docs, key, text)
    model, weights = learn(source, sample_rows, width)
    return source.mapInPandas(
        _scored(model if weak_labels else None, weights, width),
        "doc_id long, score double" + (", weak_label double" if weak_labels else ""),
    ).withColumn("kept", F.col("score") >= keep)


def good_rows(
    docs: DataFrame, text: str = "text", keep: float = KEEP, sample_rows: int = SAMPLE_ROWS, width: int = WIDTH,
) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns; nothing is shuffled.

    Null and empty texts go; ids may be null or repeat, and columns may have any
    names; an empty table stays empty.
    """
    model, weights = learn(narrow(docs, text, text).select("text"), sample_rows, width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(width)
        for batch in batches:
            good = [score_of(Words(t), hasher, weights) >= keep for t in batch["text_"]]
            yield batch.loc[np.array(good, dtype=bool), ["row"]]

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text_"))
    return rows.mapInPandas(run, rows.select("row").schema).select("row.*")
