"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Every paragraph (piece between line breaks) becomes a wide vector of 32-bit
numbers; the fingerprint of a text is their sum modulo 2^32. The order of
paragraphs does not matter, and a paragraph is added or taken away without the
rest of the text. The first ``EXACT`` numbers are hashed from the whole
paragraph, so that fingerprints are equal only for equal multisets. The others
count the paragraph's different runs of ``GRAM`` characters, each with a hashed
sign in a hashed place: sums of paragraphs stay such counts, and the cosine of
two of them estimates how much the texts have in common.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekfold.llm.tables import narrow
from weekfold.session import settle

EXACT, COUNTS, GRAM = 32, 128, 8  # GRAM is a power of two
#: Consecutive ids whose texts meet in one place.
SPAN = 256
#: Characters of a paragraph whose runs are counted together.
SLICE = 1 << 18
#: Characters, about, that are hashed side by side.
BLOCK = 1 << 15
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.min_scalar_type(2 * COUNTS - 1)


def _mixed(h):
    h = (h ^ (h >> np.uint64(32))) * _ODD
    return h >> np.uint64(8)


def _grams(symbols: np.ndarray) -> np.ndarray:
    """A hash for each run of ``GRAM`` characters, put together from its halves."""
    h, width, factor = symbols, 1, _ODD
    with np.errstate(over="ignore"):
        while width < GRAM:
            h = h[:-width] * factor + h[width:]
            width, factor = 2 * width, factor * factor
        return _mixed(h + factor * np.uint64(GRAM))


@lru_cache(maxsize=1 << 12)
def _short(paragraph: str) -> np.uint64:
    """The hash of a paragraph shorter than ``GRAM``, its only run."""
    with np.errstate(over="ignore"):
        h = np.uint64(len(paragraph))
        for c in paragraph:
            h = h * _ODD + np.uint64(ord(c))
        return _mixed(h)


def _pieces(paragraphs: list[str]) -> Iterator[tuple[int, str]]:
    """Numbers of paragraphs and their text; long ones in slices that overlap, a run counts once in each slice."""
    for i, p in enumerate(paragraphs):
        for at in range(0, max(len(p) - GRAM + 1, 1) if p else 0, SLICE):
            yield i, p[at:at + SLICE + GRAM - 1]


def _distinct(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The places of each piece's different runs, one piece behind the other, and how many each one has."""
    joined = "".join([p if len(p) >= GRAM else p.ljust(GRAM) for p in pieces])
    h = _grams(np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64))
    lengths = np.array([max(len(p), GRAM) for p in pieces])
    ends = np.cumsum(lengths)
    starts, lasts = ends - lengths, ends - GRAM + 1
    for p, start, last in zip(pieces, starts.tolist(), lasts.tolist()):
        if len(p) < GRAM:
            h[start] = _short(p)
        else:
            h[start:last].sort()
    new = np.ones(len(h), dtype=bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    new[starts] = True
    new[(lasts[:-1, None] + np.arange(GRAM - 1)).ravel()] = False  # runs across two pieces
    return (h[new] % np.uint64(2 * COUNTS)).astype(_PLACE), np.add.reduceat(new, starts, dtype=np.int64)


class Paragraphs:
    """Paragraphs that are hashed together, of one text or several; any stretch of them can be summed."""

    __slots__ = ("digests", "places", "at")

    def __init__(self, paragraphs: list[str]):
        digests = b"".join([hashlib.shake_128(p.encode()).digest(4 * EXACT) for p in paragraphs])
        self.digests = np.frombuffer(digests, dtype="<u4").reshape(-1, EXACT)
        sizes = np.zeros(len(paragraphs) + 1, dtype=np.int64)
        places, owners, block, length = [np.zeros(0, dtype=_PLACE)], [], [], 0
        for i, piece in itertools.chain(_pieces(paragraphs), [(-1, "")]):
            if block and (i < 0 or length + len(piece) > BLOCK):
                found, counts = _distinct(block)
                places.append(found)
                np.add.at(sizes, np.array(owners) + 1, counts)
                owners, block, length = [], [], 0
            owners.append(i)
            block.append(piece)
            length += len(piece)
        self.places, self.at = np.concatenate(places), np.cumsum(sizes)

    def lanes(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The sum of the vectors from paragraph ``first`` to before ``last``."""
        last = len(self.digests) if last is None else last
        counts = np.bincount(self.places[self.at[first]:self.at[last]], minlength=2 * COUNTS)
        out = np.empty(EXACT + COUNTS, dtype=np.uint32)  # modulo 2^32
        out[:EXACT] = self.digests[first:last].sum(axis=0, dtype=np.uint32)
        out[EXACT:] = (counts[:COUNTS] - counts[COUNTS:]).astype(np.uint32)
        return out


class Fingerprint:
    """The sum of the vectors of a multiset of paragraphs."""

    __slots__ = ("lanes",)

    def __init__(self, lanes: np.ndarray | None = None):
        self.lanes = np.zeros(EXACT + COUNTS, dtype=np.uint32) if lanes is None else lanes

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        out = cls()
        out.add(text.split("\n"))
        return out

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        return cls(np.frombuffer(bytes.fromhex(text), dtype="<u4").astype(np.uint32))

    def __str__(self) -> str:
        return self.lanes.astype("<u4").tobytes().hex()

    def copy(self) -> Fingerprint:
        return Fingerprint(self.lanes.copy())

    def add(self, paragraphs: list[str], times: int = 1) -> None:
        """Insert paragraphs, or take them away with ``times`` = -1."""
        sums = Paragraphs(paragraphs).lanes().astype(np.int64)
        with np.errstate(over="ignore"):
            self.lanes += (times * sums).astype(np.uint32)  # modulo 2^32

    def likeness(self, other: Fingerprint) -> float:
        """Cosine of the counts, from 0 to 1; 1 only for equal fingerprints."""
        if np.array_equal(self.lanes, other.lanes):
            return 1.0
        a, b = (x.lanes[EXACT:].astype(np.int32).astype(np.float64) for x in (self, other))
        both = np.sqrt((a @ a) * (b @ b))
        return float(min(max(a @ b / both, 0.0), 1.0 - 1e-9)) if both else 0.0


def edited_text(text: str, following: str) -> str:
    """The last quarter of the text replaced by as many characters of the next one (or all it has)."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


class _Text:
    """A row with its fingerprint and its stretch of hashed paragraphs."""

    __slots__ = ("doc_id", "text", "hashed", "first", "last", "print")

    def __init__(self, doc_id, text: str, hashed: Paragraphs, first: int, last: int):
        self.doc_id, self.text, self.hashed, self.first, self.last = doc_id, text, hashed, first, last
        self.print = Fingerprint(hashed.lanes(first, last))


def _texts(rows: list[tuple]) -> list[_Text]:
    """(doc_id, text) with fingerprints; the paragraphs of all are hashed together."""
    split = [text.split("\n") for _, text in rows]
    hashed = Paragraphs(list(itertools.chain.from_iterable(split)))
    ends = list(itertools.accumulate(map(len, split)))
    return [_Text(*row, hashed, end - len(own), end) for row, own, end in zip(rows, split, ends)]


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows, whose last field is the text, in lists of about ``BLOCK`` characters."""
    group, length = [], 0
    for row in rows:
        group.append(row)
        length += len(row[-1])
        if length >= BLOCK:
            yield group
            group, length = [], 0
    if group:
        yield group


def _edit(text: str, following: str) -> tuple[int, list[str], int]:
    """The number of paragraphs that the edit leaves whole, those it makes anew, and how many of the next text it ends.

    Between the first new paragraph and the last one come the next text's paragraphs from its second one on.
    """
    cut = len(text) // 4
    start = text.rfind("\n", 0, len(text) - cut) + 1
    joint, taken = text[start:len(text) - cut], following[:cut]
    breaks = taken.count("\n")
    new = [joint + taken] if not breaks else [joint + taken[:taken.index("\n")], taken[taken.rindex("\n") + 1:]]
    return text.count("\n", 0, start), new, breaks


_COLUMNS = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
]
_REPORT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _rows(pairs: list[tuple[_Text, _Text]]) -> Iterator[tuple]:
    """A row of the report for each text and its next one: paragraphs go and come, only cut ones are hashed anew."""
    edits = [_edit(own.text, following.text) for own, following in pairs]
    made, at = Paragraphs([p for _, new, _ in edits for p in new]), 0
    for (own, following), (whole, new, breaks) in zip(pairs, edits):
        lanes = own.print.lanes - own.hashed.lanes(own.first + whole, own.last) + made.lanes(at, at + len(new))
        if breaks > 1:
            lanes += following.hashed.lanes(following.first + 1, following.first + breaks)
        at += len(new)
        changed = Fingerprint(lanes)
        edited = edited_text(own.text, following.text)
        yield (
            own.doc_id, len(own.text), hashlib.sha256(edited.encode()).hexdigest(), str(own.print), str(changed),
            own.print.likeness(changed), own.print.likeness(following.print),
        )


def _with_next(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in the order of their spans and ids, each with the one behind it; guests only follow."""
    before = None
    for batch in batches:
        out = []
        for group in _groups(batch.itertuples(index=False, name=None)):
            pairs = []
            for (_, guest, _, _), here in zip(group, _texts([row[2:] for row in group])):
                if before is not None:
                    pairs.append((before, here))
                # behind a guest, which ends its span, comes another span
                before = None if guest else here
            out += _rows(pairs)
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS)


def _alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    nothing, = _texts([(None, "")])
    for batch in batches:
        out = []
        for group in _groups((None, text) for text in batch["text"]):
            out += _rows([(own, nothing) for own in _texts(group)])
        if out:
            frame = pd.DataFrame(out, columns=_COLUMNS)
            yield frame.assign(doc_id=pd.array([None] * len(out), dtype="Int64"))


def _followers(first: DataFrame) -> DataFrame:
    """(span, next_id): the first id of the span behind each one; behind the last comes the first one.

    Spans are sorted into ranges and written, which fixes the ranges; inside one
    a window looks ahead, and the first span of each range is one small row.
    """
    ranged = settle(
        first.repartitionByRange("span").withColumn("range", F.spark_partition_id()), "spans"
    )
    starts = sorted(ranged.groupBy("range").agg(F.min("first_id").alias("first_id")).collect())  # one row a partition
    spark = first.sparkSession
    ahead = spark.createDataFrame(
        [(r["range"], starts[(i + 1) % len(starts)].first_id) for i, r in enumerate(starts)],
        "range int, ahead long",
    )
    return ranged.join(ahead, "range").withColumn(
        "next_id", F.expr("coalesce(lead(first_id) over (partition by range order by span), ahead)")
    ).select("span", "next_id")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row.

    The edited text has its last quarter of characters replaced by as many of
    the next document (or all it has), in the order of ids; rows of one id stand
    in the order of their texts, behind the last row comes the first one, which
    may be the row itself. Rows without an id have no next document; an empty
    text stands for it. Null texts are empty; repeated rows count each; whole
    texts are hashed; an empty table gives no rows; other columns are ignored.

    Texts are shuffled once, to the span of ids they belong to; the first text
    of each span also goes to the end of the one before.
    """
    rows = narrow(docs, key, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    placed = rows.where("doc_id is not null").withColumn("span", F.expr(f"doc_id div {span}"))
    first = placed.groupBy("span").agg(F.min("doc_id").alias("first_id"))
    # a row for each span; a text is chosen where the first id of a span has several
    guests = (
        rows.join(settle(_followers(first), "followers"), F.col("doc_id") == F.col("next_id"))
        .groupBy("span", "doc_id").agg(F.min("text").alias("text"))
    )
    columns = ["span", "guest", "doc_id", "text"]
    both = placed.withColumn("guest", F.lit(False)).select(columns).unionByName(
        guests.withColumn("guest", F.lit(True)).select(columns)
    )
    ordered = both.repartition("span").sortWithinPartitions(*columns)
    return ordered.mapInPandas(_with_next, _REPORT).unionByName(
        rows.where("doc_id is null").select("text").mapInPandas(_alone, _REPORT)
    )
