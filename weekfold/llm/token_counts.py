"""Token counts from pre-token frequencies.

A byte-level BPE tokenizer never merges across pre-tokens, so a document's
count is the sum of its pre-tokens' counts. Each distinct pre-token is counted
once, wherever it occurs:

* the most frequent ones (`HEAD`, found over all documents) are counted first
  and handed to every task as one small table;
* every other pre-token travels, with its frequency, to the partition of its
  hash, is counted there once for all its documents, and the products are
  summed per document.

The head has at most ``HEAD`` entries of at most ``HEAD_BYTES`` bytes, whatever
the corpus; it only decides which way a pre-token goes, never a result. A
pre-token that many documents share is in the head, so no partition is hot; a
longer one is there under its digest.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekfold.llm.pretokens import slices, splitter
from weekfold.llm.tables import narrow

HEAD = 200_000
HEAD_BYTES = 64
BATCH_HEAD = 50_000
KNOWN = 400_000
SLICE_CHARS = 4_000_000
LACKS = 1 << 40  # more than any word has tokens


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The tokenizer of ``path`` and its special strings, one for each worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    spec = json.loads(tok.to_str())
    before = spec.get("pre_tokenizer") or {}
    if (
        spec.get("normalizer") or before.get("type") != "ByteLevel"
        or before.get("add_prefix_space") or not before.get("use_regex", True)
    ):
        raise ValueError(f"{path} is no plain byte-level tokenizer")
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
        raise ValueError(f"{path} has added tokens that take up their surroundings")
    return tok, tuple(a["content"] for a in spec["added_tokens"])


def count_pieces(path: str, pretokens: list[str]) -> list[int]:
    """Tokens of each pre-token."""
    tok, _ = tokenizer(path)
    return [len(e.ids) for e in tok.encode_batch_fast(pretokens, add_special_tokens=False)]


def _stretches(text: str, specials: tuple[str, ...]) -> tuple[list[str], int]:
    """The text between special strings, and how many of those there are."""
    parts = [text]
    found = 0
    if any(s in text for s in specials):
        import regex

        first_longest = "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))
        parts = regex.split(first_longest, text)
        found = len(parts) - 1
    return parts, found


def _frequent(path: str, pattern: str):
    """Of each batch, the most frequent pre-tokens with their occurrences."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, specials = splitter(pattern), tokenizer(path)[1]
        for batch in batches:
            later: Counter = Counter()
            counts: Counter = Counter()
            for text in batch["text"]:
                for part in _stretches(text, specials)[0]:
                    words = split.words(part)
                    if words is None:
                        counts.update(split.find(part))
                    else:
                        counts.update(split.find(words[0]))
                        later.update(words[1])
            words, times = list(later), np.fromiter(later.values(), dtype=np.int64, count=len(later))
            found, starts = split.spaced(words)
            for p, n in zip(found, np.repeat(times, np.diff([*starts, len(found)])).tolist()):
                counts[p] += n
            names = list(counts)
            n_of = np.fromiter(counts.values(), dtype=np.int64, count=len(names))
            if len(names) > BATCH_HEAD:
                top = np.argpartition(n_of, -BATCH_HEAD)[-BATCH_HEAD:]
                names, n_of = [names[i] for i in top.tolist()], n_of[top]
            long = np.array([_is_long(p) for p in names], dtype=bool)
            for of_long in (False, True):
                own = [p for p, is_long in zip(names, long.tolist()) if is_long == of_long]
                if own:
                    yield pd.DataFrame({
                        "pretoken": [_digest(p).hex() for p in own] if of_long else own, "long": of_long,
                        "n": n_of[long == of_long],
                        # a long one is not sent on, so its tokens are counted here
                        "pieces": pd.array(count_pieces(path, own) if of_long else [None] * len(own), dtype="Int32"),
                    })

    return run


def _is_long(pretoken: str) -> bool:
    return len(pretoken) > HEAD_BYTES or len(pretoken) * 4 > HEAD_BYTES and len(pretoken.encode()) > HEAD_BYTES


def _digest(pretoken: str) -> bytes:
    """What stands for a long pre-token in the head, so that its size stays bounded."""
    return hashlib.blake2b(pretoken.encode(), digest_size=16).digest()


class Head:
    """Token counts of the most frequent pre-tokens; long ones are known by their digests."""

    def __init__(self, short: dict[str, int], long: dict[bytes, int]):
        self.short, self.long = short, long

    def of_long(self, pretoken: str) -> int | None:
        # no character has more than four bytes
        if len(pretoken) * 4 <= HEAD_BYTES or not self.long or not _is_long(pretoken):
            return None
        return self.long.get(_digest(pretoken))

    def get(self, pretoken: str) -> int | None:
        n = self.short.get(pretoken)
        return self.of_long(pretoken) if n is None else n


def frequent_pretokens(docs: DataFrame, path: str, pattern: str, head: int = HEAD) -> DataFrame:
    """(pretoken, long, pieces): the ``head`` most frequent pre-tokens of all documents with their token counts.

    Those of more than ``HEAD_BYTES`` bytes are ``long`` and given as the hex text of their digests.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pieces = b["pieces"].fillna(0).astype("int64").to_numpy(copy=True)
            short = ~b["long"].to_numpy(bool)
            pieces[short] = count_pieces(path, b["pretoken"][short].tolist())
            yield b[["pretoken", "long"]].assign(pieces=pieces)

    return (
        docs.select("text")
        .mapInPandas(_frequent(path, pattern), "pretoken string, long boolean, n long, pieces int")
        .groupBy("pretoken", "long").agg(F.sum("n").alias("n"), F.max("pieces").alias("pieces"))
        .orderBy(F.desc("n"), "pretoken", "long").limit(head)
        .select("pretoken", "long", "pieces")
        .mapInPandas(counted, "pretoken string, long boolean, pieces int")
    )


def _document_rows(path: str, pattern: str, head):
    """One row with the head's sum per document, and one for each other distinct pre-token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, specials, known = splitter(pattern), tokenizer(path)[1], head.value
        short = known.short
        # of each word after a space: its tokens as far as the head has them, less LACKS if it lacks some
        seen: dict[str, int] = {}
        first: dict[str, str] = {}  # the first pre-token that it lacks
        more: dict[str, list[str]] = {}  # the others, of the few words that lack several

        def weigh(words: set[str]) -> None:
            if len(seen) >= KNOWN:
                for kept in (seen, first, more):
                    kept.clear()
            new = [w for w in words if w not in seen]
            if not new:
                return
            found, starts = split.spaced(new)
            counts = np.array([*map(short.get, found, repeat(-1))], dtype=np.int64)
            missing = np.flatnonzero(counts < 0)
            if known.long:
                for i in missing.tolist():
                    n = known.of_long(found[i])
                    counts[i] = -1 if n is None else n
                missing = np.flatnonzero(counts < 0)
            counts[missing] = 0
            totals = np.add.reduceat(counts, starts)
            word = np.searchsorted(starts, missing, "right") - 1
            leads = np.diff(word, prepend=-1) > 0
            totals[word[leads]] -= LACKS
            seen.update(zip(new, totals.tolist()))
            first.update((new[w], found[i]) for w, i in zip(word[leads].tolist(), missing[leads].tolist()))
            for w, i in zip(word[~leads].tolist(), missing[~leads].tolist()):
                more.setdefault(new[w], []).append(found[i])

        for batch in batches:
            texts = batch["text"].tolist()
            for own in slices(texts, SLICE_CHARS):
                part = batch.iloc[own]
                read = []  # of each text: pre-tokens found directly, later words, special strings
                for text in texts[own]:
                    direct: list[str] = []
                    later: list[str] = []
                    stretches, special = _stretches(text, specials)
                    for x in stretches:
                        words = split.words(x)
                        direct += split.find(x if words is None else words[0])
                        if words is not None:
                            later += words[1]
                    read.append((direct, later, special))
                weigh(set().union(*(later for _, later, _ in read)))
                rows: list[int] = []  # rows of the part, one for each pre-token of the tail
                tails: list[str] = []
                times: list[int] = []
                sums = []
                for i, (direct, later, total) in enumerate(read):
                    tokens = [*map(seen.__getitem__, later)]
                    lacking = [w for w, n in zip(later, tokens) if n < 0]
                    tail = Counter(map(first.__getitem__, lacking))
                    for w in filter(more.__contains__, lacking):
                        tail.update(more[w])
                    for p in direct:
                        n = known.get(p)
                        if n is None:
                            tail[p] += 1
                        else:
                            total += n
                    sums.append(total + sum(tokens) + LACKS * len(lacking))
                    rows += [i] * len(tail)
                    tails += tail
                    times += tail.values()
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].array, "text_key": part["text_key"].array, "pretoken": None, "times": 0,
                    "known": sums, "n_bytes": [len(t.encode()) for t in texts[own]], "copies": 1,
                })
                for at in range(0, len(rows), 200_000):
                    some = rows[at:at + 200_000]
                    yield pd.DataFrame({
                        "doc_id": part["doc_id"].array.take(some), "text_key": part["text_key"].array.take(some),
                        "pretoken": tails[at:at + 200_000], "times": times[at:at + 200_000],
                        "known": 0, "n_bytes": 0, "copies": 0,
                    })

    return run


def _count_once(path: str):
    """Counts each pre-token of the partition once and joins it to its documents' frequencies.

    Rows of a pre-token stand together, so only the last one of a batch is kept for the next.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: dict[str, int] = {}
        for batch in batches:
            last = batch["pretoken"].iloc[-1] if len(batch) else None
            new = [p for p in batch["pretoken"].dropna().unique() if p not in pieces]
            for at in range(0, len(new), 10_000):
                pieces.update(zip(new[at:at + 10_000], count_pieces(path, new[at:at + 10_000])))
            n = batch["pretoken"].map(pieces).fillna(0).astype("int64") * batch["times"]
            yield batch[["doc_id", "text_key", "n_bytes", "copies"]].assign(known=batch["known"] + n)
            pieces = {last: pieces[last]} if last in pieces else {}

    return run


_KEY = "doc_id long, text_key long"


def token_counts(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text",
    limit: int = 1024, head: int = HEAD,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): one row for each row of ``docs``.

    ``path`` must be a byte-level tokenizer without normaliser and ``pattern``
    its pre-token pattern; anything else is refused. Special strings inside a
    text count as one token each. A null text counts as empty, which has no
    tokens; a null id stays null. Rows are told apart by id and text, so a
    repeated row is returned as often as it occurs, and rows that share an id
    but not the text keep their own counts. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = narrow(docs, key, text).withColumn("text_key", F.xxhash64("text"))
    # at most ``head`` entries of at most HEAD_BYTES bytes
    table = Head({}, {})
    for r in frequent_pretokens(rows, path, pattern, head).toLocalIterator():
        if r["long"]:
            table.long[bytes.fromhex(r["pretoken"])] = r["pieces"]
        else:
            table.short[r["pretoken"]] = r["pieces"]
    shared = spark.sparkContext.broadcast(table)
    sums = (
        rows.mapInPandas(
            _document_rows(path, pattern, shared),
            f"{_KEY}, pretoken string, times long, known long, n_bytes long, copies long",
        )
        .withColumn("slot", F.coalesce(F.xxhash64("pretoken"), F.lit(0)))
        .withColumn("slot", F.when(F.col("pretoken").isNull(), F.xxhash64("doc_id", "text_key")).otherwise(F.col("slot")))
        .repartition("slot").sortWithinPartitions("slot").drop("slot")
        .mapInPandas(_count_once(path), f"{_KEY}, n_bytes long, copies long, known long")
        .groupBy("doc_id", "text_key")
        .agg(F.sum("known").alias("known"), F.sum("n_bytes").alias("n_bytes"), F.sum("copies").alias("copies"))
    )
    # equal rows were summed together; each gets its equal share
    return (
        sums.select(
            "doc_id",
            F.expr("n_bytes div copies").alias("n_bytes"),
            F.expr("known div copies").alias("n_tokens"),
            F.explode(F.expr("sequence(1L, copies)")).alias("copy"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
