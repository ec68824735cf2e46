"""Spelling variants of a vocabulary, by search schemes over a bidirectional FM-index.

A word and another one edit away agree exactly in the first or in the last half
of the word. Words are therefore dealt out twice by each half that a query of
their length, or one letter shorter or longer, may have; a query goes only where
its own half is. Each group builds one index of its words and runs one search of
the scheme: the half exactly, then the other one with one error. A half that so
many words share that they exceed a group is split: its words are dealt out by
their hash, its queries go to every part. Each group returns one row for a query
with the number and the best of its matches, never pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold.llm.fm_index import VariantIndex
from weekfold.session import settle

#: Runs of letters: ASCII, and U+00C0 to U+00FF as UTF-8 bytes.
_LETTER = rb"(?:[a-z]|\xc3[\x80-\xbf])"
HELD_WORDS = 200_000
#: Characters that one group indexes: about so many, and at most (but for a single longer word).
GROUP_CHARS, MOST_CHARS = 500_000, 1_500_000
MIN_LENGTH, MIN_COUNT, RATIO, DROP_EVERY = 7, 2, 10, 31
_NOTHING = pd.DataFrame([], columns=["word", "n_near", "form_n", "form"])


def _counted(least: int, drop_every: int):
    find = re.compile(_LETTER + b"{%d,}" % least).findall

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[bytes] = Counter()

        def rows() -> Iterator[pd.DataFrame]:
            kept = [(letters, n) for w, n in held.items() if len(letters := w.decode()) >= least]
            held.clear()
            if kept:
                yield pd.DataFrame({"word": [w for w, _ in kept], "n": [n for _, n in kept]})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                # bytes: lower() knows ASCII only, which is what is asked for
                own = Counter(find(text.encode().lower()))
                if drop_every:
                    start = zlib.crc32(f"{doc_id}:".encode())
                    for word in [w for w in own if zlib.crc32(w, start) % drop_every == 0]:
                        letters, at = word.decode(), zlib.crc32(word, start)
                        n = own.pop(word)
                        at %= len(letters)
                        held[(letters[:at] + letters[at + 1:]).encode()] += n
                held.update(own)
                if len(held) > HELD_WORDS:
                    yield from rows()
        yield from rows()

    return run


def vocabulary(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_every: int = 0,
) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least ``min_length`` letters and ``min_count`` occurrences.

    With ``drop_every`` a letter is deleted from the runs of a document whose
    CRC32 it divides (misspellings for measuring). Null texts have no words; a
    null id stands as an empty string in the CRC32. Every row counts, repeated
    ones too; whole texts are read; other columns are ignored.
    """
    source = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc_id"), F.col(text).cast("string").alias("text")
    ).where("text is not null")
    counted = source.mapInPandas(_counted(min_length, drop_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _best(index: VariantIndex, counts: np.ndarray, queries: list[str], found: np.ndarray, words: np.ndarray):
    """One row for each query with matches: their number, the largest count and the first word that has it."""
    if not len(found):
        return _NOTHING
    order = np.lexsort((words, -counts[words], found))
    found, words = found[order], words[order]
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    best = words[starts]
    return pd.DataFrame({
        "word": [queries[q] for q in found[starts].tolist()],
        "n_near": np.diff(np.append(starts, len(found))),
        "form_n": counts[best],
        "form": [index.words[w] for w in best.tolist()],
    })


def _search(group: pd.DataFrame) -> pd.DataFrame:
    stored, asked = group[group["indexed"]], group[group["asked"]]
    if stored.empty or asked.empty:
        return _NOTHING
    n = dict(zip(stored["word"], stored["n"]))
    index = VariantIndex(list(n))
    counts = np.array([n[w] for w in index.words], dtype=np.int64)
    queries, half = asked["word"].tolist(), int(group["half"].iloc[0])
    if group["side"].iloc[0] == 0:
        found, words = index.left_exact(queries, half)
    else:
        found, words = index.right_exact(queries, half)
        # what agrees in the left half too is found by the other search
        new = np.array([
            not index.words[w].startswith(queries[q][:len(queries[q]) - half])
            for q, w in zip(found.tolist(), words.tolist())
        ], dtype=bool)
        found, words = found[new], words[new]
    return _best(index, counts, queries, found, words)


def _halves(words: DataFrame) -> DataFrame:
    """A row for each half by which a word is stored (side 0: first letters), and whether it asks with that half itself."""
    length = F.char_length("word")

    def keys(side: int) -> Column:
        lengths = F.array(*[(length + d).cast("int") for d in (-1, 0, 1)])
        half = F.array_distinct(F.transform(lengths, lambda x: F.floor((x + side) / 2).cast("int")))
        return F.transform(half, lambda x: F.struct(F.lit(side).alias("side"), x.alias("half")))

    rows = words.select("word", "n", F.explode(F.concat(keys(0), keys(1))).alias("key")).select("word", "n", "key.*")
    part = F.when(F.col("side") == 0, F.substring("word", F.lit(1), F.col("half"))).otherwise(
        F.substring("word", (length - F.col("half") + 1).cast("int"), F.col("half"))
    )
    return rows.where(F.col("half") <= length).select(
        "*", F.xxhash64(part).alias("part"), (F.col("half") == F.floor((length + F.col("side")) / 2)).alias("asks")
    )


def neighbours(words: DataFrame, group_chars: int = GROUP_CHARS, most_chars: int = MOST_CHARS) -> DataFrame:
    """(word, n_near, form_n, form) for each word with others at one inserted, deleted or replaced letter.

    ``words`` has distinct non-empty (word, n); ``form`` is the neighbour of the
    largest n, ties to the first in code-point order.
    """
    rows = _halves(words)
    size = F.sum(F.char_length("word") + 1)
    totals = rows.groupBy("side", "half").agg(F.ceil(size / group_chars).alias("slots"))
    slotted = rows.join(totals, ["side", "half"]).withColumn("slot", F.pmod("part", "slots"))
    loads = slotted.groupBy("side", "half", "slot").agg(
        F.when(size > most_chars, F.ceil(size / group_chars)).otherwise(1).cast("int").alias("parts")
    )
    own = F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).cast("int")
    everywhere = F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own")))
    groups = (
        slotted.join(loads, ["side", "half", "slot"]).withColumn("own", own)
        .select("side", "half", "slot", "word", "n", "own", "asks", everywhere.alias("sub"))
        .select("side", "half", "slot", "sub", "word", "n", (F.col("own") == F.col("sub")).alias("indexed"), F.col("asks").alias("asked"))
    )
    found = groups.groupBy("side", "half", "slot", "sub").applyInPandas(
        _search, "word string, n_near long, form_n long, form string"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms; each round doubles the steps."""
    reached = settle(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if reached.join(on, "root", "left_semi").isEmpty():
            return reached
        reached = settle(
            reached.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "forms"
        )


def spelling_variants(words: DataFrame, ratio: int = RATIO, **sizes) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every (word, n) of a vocabulary.

    ``form`` is the most frequent word one edit away, if it has at least
    ``ratio`` times the word's occurrences, else null, as ``form_n``; ``root`` is
    the last word of the chain of forms, the word itself if it has no form. Ties
    go to the smaller word in code-point order; equal rows of one word add up.
    Null and empty words take no part. An empty vocabulary gives no rows; other
    columns are ignored.
    """
    known = settle(
        words.where("word is not null and word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n")),
        "vocabulary",
    )
    near = settle(neighbours(known, **sizes), "neighbours")
    joined = known.join(near, "word", "left")
    enough: Column = F.col("form_n") >= ratio * F.col("n")
    joined = settle(joined.select(
        "word", F.when(enough, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form_n")).alias("form_n"),
    ), "variants")
    roots = _roots(joined.where("form is not null").select("word", "form"))
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
