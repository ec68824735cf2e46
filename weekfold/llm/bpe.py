"""Byte-level BPE encoding with a queue of merge ranks.

All distinct pre-tokens of a batch are merged together. They lie one after the
other in one array of nodes, linked to their neighbours inside the same
pre-token. A bucket for each merge rank holds the nodes whose pair with the
next node has that rank; a bitmap of three levels marks the buckets that are
not empty, so that finding the lowest rank takes three look-ups. A bucket is
emptied at once: entries whose pair has changed meanwhile are stale and
skipped, the rest merge from left to right. Every node is pushed at most
three times, so one pre-token of a million bytes costs as much as many short
ones of the same total size.

Short pre-tokens, which are nearly all, need no queue: those of one length lie
side by side, and in each round every one of them merges its lowest pair.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from weekfold.llm.pretokens import slices, splitter
from weekfold.llm.tables import narrow

KEPT_PIECES = 200_000
BATCH_CHARS = 3_000_000
SHORT_BYTES = 48  # below 64, so that a place takes six bits
NONE = -1


class RankBitmap:
    """A set of ranks with find-first, as bitmaps of bitmaps (64 bits a word)."""

    def __init__(self, size: int):
        self.levels: list[list[int]] = []
        while True:
            size = (size + 63) // 64
            self.levels.append([0] * size)
            if size == 1:
                break

    def add(self, rank: int) -> None:
        for level in self.levels:
            rank, bit = rank >> 6, 1 << (rank & 63)
            before = level[rank]
            level[rank] = before | bit
            if before:
                return

    def discard(self, rank: int) -> None:
        for level in self.levels:
            rank, bit = rank >> 6, 1 << (rank & 63)
            level[rank] &= ~bit
            if level[rank]:
                return

    def first(self) -> int:
        """The lowest rank, or -1."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return NONE
            at = (at << 6) | ((word & -word).bit_length() - 1)
        return at


class Ranks:
    """A vocabulary of byte strings by rank, with every pair that can merge."""

    def __init__(self, path: str):
        self.rank: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                self.rank[base64.b64decode(token)] = int(rank)
        self.size = max(self.rank.values()) + 1
        self.token = [b""] * self.size
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        keys, merged = [], []
        for token, rank in self.rank.items():
            for i in range(1, len(token)):
                left, right = self.rank.get(token[:i]), self.rank.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.merged = np.array(merged, dtype=np.int64)[order]

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of token ids, -1 where they don't merge."""
        wanted = left * self.size + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.merged[at], NONE)


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    """One vocabulary for each worker process and file."""
    return Ranks(path)


def merge_all(pieces: list[bytes], vocabulary: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces in one array, and the number of ids of each piece."""
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    ids = vocabulary.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    n = len(ids)
    piece = np.repeat(np.arange(len(pieces)), size)
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    ends = np.cumsum(size)
    after[ends[size > 0] - 1] = NONE
    before[(ends - size)[size > 0]] = NONE
    alive = np.ones(n, dtype=bool)
    # rank of each node's pair with the next node
    current = np.full(n, NONE, dtype=np.int64)
    inner = np.flatnonzero(after >= 0)
    current[inner] = vocabulary.pair(ids[inner], ids[after[inner]])

    waiting: dict[int, list[np.ndarray]] = {}
    marks = RankBitmap(vocabulary.size)

    def push(nodes: np.ndarray) -> None:
        nodes = nodes[current[nodes] >= 0]
        if not len(nodes):
            return
        rank = current[nodes]
        order = np.argsort(rank, kind="stable")
        nodes, rank = nodes[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        starts = [0, *cuts.tolist()]
        for r, s, e in zip(rank[starts].tolist(), starts, [*starts[1:], len(nodes)]):
            bucket = waiting.get(r)
            if bucket is None:
                waiting[r] = [nodes[s:e]]
                marks.add(r)
            else:
                bucket.append(nodes[s:e])

    push(inner)
    while (rank := marks.first()) >= 0:
        marks.discard(rank)
        bucket = waiting.pop(rank)
        nodes = bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))
        nodes = nodes[alive[nodes] & (current[nodes] == rank)]  # the others are stale
        if not len(nodes):
            continue
        # of neighbours that share a node ("aaa"), every second one merges
        first = np.ones(len(nodes), dtype=bool)
        first[1:] = after[nodes[:-1]] != nodes[1:]
        if not first.all():
            start = np.maximum.accumulate(np.where(first, np.arange(len(nodes)), 0))
            nodes = nodes[(np.arange(len(nodes)) - start) % 2 == 0]
        right = after[nodes]
        beyond = after[right]
        # A merge may give a pair of a lower rank, which then comes before the
        # merges to its right in the same piece: those wait in the bucket.
        left = before[nodes]
        left_id = np.where(left >= 0, ids[left], NONE)
        joined = np.zeros(len(nodes), dtype=bool)
        joined[1:] = left[1:] == right[:-1]
        left_id[joined] = rank
        lower = np.zeros(len(nodes), dtype=bool)
        for has, a, b in (
            (left >= 0, left_id, np.full(len(nodes), rank)),
            (beyond >= 0, np.full(len(nodes), rank), np.where(beyond >= 0, ids[beyond], 0)),
        ):
            at = np.flatnonzero(has)
            new = vocabulary.pair(a[at], b[at])
            lower[at] |= (new >= 0) & (new < rank)
        if lower.any():
            own = piece[nodes]
            stop = np.full(len(nodes), len(nodes))
            stop[lower] = np.flatnonzero(lower)
            fresh = np.ones(len(nodes), dtype=bool)
            fresh[1:] = own[1:] != own[:-1]
            at = np.flatnonzero(fresh)
            least = np.minimum.reduceat(stop, at)[np.cumsum(fresh) - 1]
            now = np.arange(len(nodes)) <= least
            if not now.all():
                waiting[rank] = [nodes[~now]]
                marks.add(rank)
                nodes, right, beyond = nodes[now], right[now], beyond[now]
        ids[nodes] = rank
        alive[right] = False
        after[nodes] = beyond
        has = beyond >= 0
        before[beyond[has]] = nodes[has]
        left = before[nodes]
        changed = np.unique(np.concatenate([nodes, left[left >= 0]]))
        follower = after[changed]
        current[changed] = NONE
        inside = changed[follower >= 0]
        current[inside] = vocabulary.pair(ids[inside], ids[after[inside]])
        push(inside)
    return ids[alive], np.bincount(piece[alive], minlength=len(pieces))


def merge_short(pieces: list[bytes], vocabulary: Ranks) -> list[bytes]:
    """The ids of each piece, as little-endian unsigned 32-bit integers.

    All pieces have the same number of bytes, 2 to ``SHORT_BYTES``. Columns are
    pieces. In each round the lowest pair of every piece, the leftmost of
    equals, becomes one id; pieces without a pair are done.
    """
    n = len(pieces[0])
    ids = vocabulary.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8).reshape(-1, n).T]
    none = np.iinfo(np.int64).max >> 6 << 6
    own = np.arange(len(pieces))
    place = np.arange(n)[:, None]
    out = [b""] * len(pieces)

    def ranked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair with room for its place."""
        rank = vocabulary.pair(left, right)
        return np.where(rank >= 0, rank << 6, none)

    lowest = ranked(ids[:-1], ids[1:])
    while True:
        best = (lowest | place[:len(lowest)]).min(axis=0) if len(lowest) else np.full(len(own), none)
        done = best >= none
        if done.any():
            width = 4 * len(ids)
            flat = ids[:, done].T.astype("<u4").tobytes()
            for i, at in enumerate(own[done].tolist()):
                out[at] = flat[i * width:(i + 1) * width]
            rest = ~done
            ids, lowest, own, best = ids[:, rest], lowest[:, rest], own[rest], best[rest]
            if not len(own):
                return out
        at, merged = best & 63, best >> 6
        column = np.arange(len(own))
        ids = np.where(place[:len(ids) - 1] > at, ids[1:], ids[:-1])
        ids[at, column] = merged
        lowest = np.where(place[:len(lowest) - 1] >= at, lowest[1:], lowest[:-1])
        has = np.flatnonzero(at > 0)
        lowest[at[has] - 1, has] = ranked(ids[at[has] - 1, has], merged[has])
        has = np.flatnonzero(at < len(lowest))
        lowest[at[has], has] = ranked(merged[has], ids[at[has] + 1, has])


def encode_pieces(pieces: list[str], vocabulary: Ranks) -> dict[str, bytes]:
    """For each pre-token its ids, as little-endian unsigned 32-bit integers."""
    out: dict[str, bytes] = {}
    long: list[str] = []
    short: defaultdict[int, list[str]] = defaultdict(list)
    for p in pieces:
        data = p.encode()
        whole = vocabulary.rank.get(data)
        if whole is not None:
            out[p] = whole.to_bytes(4, "little")
        elif 2 <= len(data) <= SHORT_BYTES:
            short[len(data)].append(p)
        else:
            long.append(p)
    for same in short.values():
        out.update(zip(same, merge_short([p.encode() for p in same], vocabulary)))
    if long:
        ids, counts = merge_all([p.encode() for p in long], vocabulary)
        flat = ids.astype("<u4").tobytes()
        at = 0
        for p, n in zip(long, (counts * 4).tolist()):
            out[p] = flat[at:at + n]
            at += n
    return out


class Encoder:
    """Encodes texts, keeping the ids of pre-tokens and words seen before (bounded)."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = ranks(path)
        self.split = splitter(pattern)
        self.known: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}  # of a word after a space

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KEPT_PIECES or len(self.later) > KEPT_PIECES:
            self.known.clear()
            self.later.clear()
        find, known, later = self.split.find, self.known, self.later
        firsts: list[list[str]] = []
        rests: list[list[str]] = []
        new_words: set[str] = set()
        for t in texts:
            words = self.split.words(t)
            if words is None:
                firsts.append(find(t))
                rests.append([])
            else:
                firsts.append(find(words[0]))
                rests.append(words[1])
                new_words.update(words[1])
        unseen = [w for w in new_words if w not in later]
        found, starts = self.split.spaced(unseen)
        wanted = set(found).union(*firsts)
        known.update(encode_pieces([p for p in wanted if p not in known], self.vocabulary))
        coded = [*map(known.__getitem__, found)]
        for w, start, end in zip(unseen, starts, [*starts[1:], len(found)]):
            later[w] = coded[start] if end - start == 1 else b"".join(coded[start:end])
        return [
            b"".join([*map(known.__getitem__, first), *map(later.__getitem__, rest)])
            for first, rest in zip(firsts, rests)
        ]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.token.__getitem__, ids.tolist()))


def _encoded(path: str, pattern: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts, BATCH_CHARS):
                ids = [np.frombuffer(b, dtype="<u4") for b in encoder.encode(texts[part])]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[part].array, "ids": ids})

    return run


def _digests(path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts, BATCH_CHARS):
                flat = encoder.encode(texts[part])
                decoded = [encoder.decode(np.frombuffer(b, dtype="<u4")) for b in flat]
                ids = {"ids": [np.frombuffer(b, dtype="<i4") for b in flat]} if with_ids else {}
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[part].array,
                    **ids,
                    "n_tokens": [len(b) // 4 for b in flat],
                    "ids_sha256": [hashlib.sha256(b).hexdigest() for b in flat],
                    "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded],
                })

    return run


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<long>): the token ids of every text, one row for each row of ``docs``.

    The ids are those of the merge ranks in ``path`` applied to each match of
    ``pattern``. A null text counts as empty and has no ids; ids of rows may be
    null or repeat; other columns are ignored. No shuffle.
    """
    return narrow(docs, key, text).mapInPandas(_encoded(path, pattern), "doc_id long, ids array<long>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes binary): the bytes that the ids of ``encode`` stand for; null ids give no bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = ranks(path).token
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "bytes": [b"" if x is None else b"".join([token[i] for i in x]) for x in batch["ids"]],
            })

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, bytes binary")


def round_trip(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of ids and of what they decode to.

    As ``decode(encode(docs))``, in one pass; ``with_ids`` adds the ids
    themselves as ``ids array<int>``. Nulls, empty texts and repeated rows as in
    ``encode``.
    """
    return narrow(docs, key, text).mapInPandas(
        _digests(path, pattern, with_ids),
        f"doc_id long, {'ids array<int>, ' if with_ids else ''}"
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
