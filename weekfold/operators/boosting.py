"""Boosted trees for many models in one run.

All models of a run (one for each position and target, say, or for each trial of
a search, or for each fold) grow together, level by level, over one table of
binned rows. A row belongs to a *frame* (its features and one label) and a model
names its frame, its settings and the parts of the frame it is fitted on.

Each level is one pass: every task adds up gradients by (model, node, feature,
bin), the sums meet by (model, node) and return the node's best split, so the
driver holds the trees and nothing of the data. Models whose frame has at most
``LOCAL_ROWS`` rows are grown by the same steps inside one task each, all at the
same time. Gradients are rounded to a power of two, so sums are exact in any
order: both ways, any partitioning and any rerun give the same trees.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekfold.operators.histograms import BINS, Forest, Rows
from weekfold.session import settle, ship_package

#: Rows of a frame that one task may hold: some 250 bytes each with 47 features.
LOCAL_ROWS = 1_000_000
#: Tasks for each core that share out the models of one task each; nodes whose splits are sought at once.
_SHARES, _SOUGHT = 3, 8
#: Trees between two writings of the margins; histograms (of nodes) of one pass.
KEPT_TREES, PASS_NODES = 16, 2_000
_GRID = 24

NODE = np.dtype([
    ("tree", "i4"), ("feature", "i2"), ("bin", "i2"), ("left", "i4"), ("value", "f8"), ("gain", "f8"), ("rows", "i8"),
])


@dataclass(frozen=True)
class Settings:
    """How one model is grown; names on the right are those of other libraries."""

    depth: int = 6
    rate: float = 0.05
    trees: int = 200
    rows: float = 1.0  # subsample
    columns: float = 1.0  # colsample_bytree
    least_weight: float = 1.0  # min_child_weight
    gamma: float = 0.0
    alpha: float = 0.0
    penalty: float = 0.0  # lambda
    positive_weight: float = 1.0
    seed: int = 42
    task: str = "regression"


_SPARK_NAMES = {"maxDepth": "depth", "stepSize": "rate", "maxIter": "trees", "subsamplingRate": "rows",
                "minInstancesPerNode": "least_weight", "seed": "seed"}


def settings(task: str, **params) -> Settings:
    """Settings from Spark's parameter names or our own."""
    return Settings(task=task, **{_SPARK_NAMES.get(k, k): v for k, v in params.items()})


@dataclass
class Spec:
    name: str
    frame: str
    settings: Settings
    parts: tuple[int, ...] = (0,)
    base: float = 0.0


@dataclass
class Frame:
    """What the rows of a frame have in common."""

    cuts: list[np.ndarray]
    scale: float
    n: int = 0
    #: rows and sum of labels of each part
    parts: dict[int, tuple[int, float]] = field(default_factory=dict)

    def rows(self, parts) -> int:
        return sum(self.parts.get(p, (0, 0.0))[0] for p in parts)

    def base(self, parts, task: str) -> float:
        """What a model says before its first tree: the mean of its parts, as log-odds for a classification."""
        n = self.rows(parts)
        mean = sum(self.parts.get(p, (0, 0.0))[1] for p in parts) / n if n else 0.0
        if task == "regression":
            return mean
        share = min(max(mean, 1e-6), 1 - 1e-6)
        return float(np.log(share / (1 - share)))

    def bins(self, values: np.ndarray) -> np.ndarray:
        """Bins of feature rows; missing values lie in the first."""
        out = np.empty(values.shape, dtype=np.uint8)
        for j, cuts in enumerate(self.cuts):
            out[:, j] = np.searchsorted(cuts, values[:, j], side="left")
        out[np.isnan(values)] = 0
        return out


# --- trees ------------------------------------------------------------------------------
def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def _chance(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A number from 0 to 1 for each key, another one for each tree."""
    with np.errstate(over="ignore"):
        salt = np.uint64(seed & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree + 1)
        return (_mixed(keys ^ _mixed(np.array([salt]))) >> np.uint64(11)) / float(1 << 53)


def reached(nodes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The node in which each row ends."""
    at = np.zeros(len(bins), dtype=np.int64)
    every = np.arange(len(bins))
    while True:
        feature = nodes["feature"][at]
        inner = feature >= 0
        if not inner.any():
            return at
        right = bins[every, np.maximum(feature, 0)] > nodes["bin"][at]
        at = np.where(inner, nodes["left"][at] + right, at)


def split_trees(nodes: np.ndarray) -> list[np.ndarray]:
    starts = np.flatnonzero(np.diff(nodes["tree"], prepend=-1))
    return np.split(nodes, starts[1:]) if len(nodes) else []


def _weight(s: Settings, tree: int) -> float:
    """The first tree counts in full, as in Spark's boosting."""
    return 1.0 if tree == 0 else s.rate


def _forest(trees: list[np.ndarray], s: Settings) -> Forest:
    return Forest(trees, [_weight(s, int(nodes["tree"][0])) for nodes in trees])


def _add(margin: np.ndarray, bins: np.ndarray, trees: list[np.ndarray], s: Settings) -> np.ndarray:
    return _forest(trees, s).add(margin, bins)


def _gradients(label: np.ndarray, margin: np.ndarray, scale: float, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    if s.task == "regression":
        g, h = label - margin, np.ones(len(label))
        return np.rint(g * scale) / scale, h
    p = 1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40)))
    w = np.where(label > 0.5, s.positive_weight, 1.0)
    grid = float(1 << _GRID)
    return np.rint(w * (label - p) * grid) / grid, np.rint(w * p * (1 - p) * grid) / grid


class Growing:
    """A tree under way."""

    def __init__(self, spec: Spec, tree: int):
        self.spec, self.tree, self.depth = spec, tree, 0
        self.nodes = np.zeros(1, dtype=NODE)
        self.nodes["tree"], self.nodes["feature"] = tree, -1
        self.active = [0]

    @property
    def open(self) -> bool:
        return bool(self.active) and self.depth < self.spec.settings.depth

    def slots(self, at: np.ndarray) -> np.ndarray:
        """Number of each row's node among the active ones, -1 if it is closed."""
        table = np.full(len(self.nodes), -1, dtype=np.int64)
        table[self.active] = np.arange(len(self.active))
        return table[at]

    def advance(self, best: dict[int, np.ndarray]) -> None:
        """Split the active nodes that have a best split; ``best`` is by node."""
        s, fresh, active = self.spec.settings, [], []
        for node in self.active:
            b = best.get(node)
            if b is None:
                continue
            if node == 0:
                self.nodes["value"][0], self.nodes["rows"][0] = _value(b["g"], b["h"], s), b["n"]
            if b["feature"] < 0:
                continue
            left = len(self.nodes) + len(fresh)
            for g, h, n in ((b["gl"], b["hl"], b["nl"]), (b["g"] - b["gl"], b["h"] - b["hl"], b["n"] - b["nl"])):
                fresh.append((self.tree, -1, 0, 0, _value(g, h, s), 0.0, n))
            self.nodes["feature"][node], self.nodes["bin"][node] = b["feature"], b["bin"]
            self.nodes["left"][node], self.nodes["gain"][node] = left, b["gain"]
            active += [left, left + 1]
        self.nodes = np.concatenate([self.nodes, np.array(fresh, dtype=NODE)])
        self.active, self.depth = active, self.depth + 1


BEST = np.dtype([("feature", "i2"), ("bin", "i2"), ("gain", "f8"), ("gl", "f8"), ("hl", "f8"), ("nl", "i8"),
                 ("g", "f8"), ("h", "f8"), ("n", "i8")])


def _value(g: float, h: float, s: Settings) -> float:
    pull = np.sign(g) * max(abs(g) - s.alpha, 0.0)
    return float(pull / (h + s.penalty)) if h + s.penalty > 0 else 0.0


def _columns(s: Settings, tree: int, features: int) -> np.ndarray:
    """The features a tree may use."""
    if s.columns >= 1:
        return np.ones(features, dtype=bool)
    order = np.argsort(_chance(np.arange(features, dtype=np.uint64) + np.uint64(1 << 40), s.seed, tree), kind="stable")
    out = np.zeros(features, dtype=bool)
    out[order[:max(1, round(s.columns * features))]] = True
    return out


def histograms(bins, slots, g, h, nodes: int) -> np.ndarray:
    """(node, feature, bin, [gradient, weight, rows]) sums of rows in open nodes."""
    inside = slots >= 0
    if not inside.all():
        bins, slots, g, h = bins[inside], slots[inside], g[inside], h[inside]
    n, features = bins.shape
    place = ((slots[:, None] * features + np.arange(features)) * BINS + bins).ravel()
    size = nodes * features * BINS
    sums = [np.bincount(place, np.repeat(w, features), minlength=size) for w in (g, h)]
    sums.append(np.bincount(place, minlength=size).astype(np.float64))
    return np.stack(sums, axis=-1).reshape(nodes, features, BINS, 3)


def best_splits(sums: np.ndarray, s: Settings, tree: int, sizes: list[int] | None = None) -> np.ndarray:
    """The best split of each node; feature -1 where none is allowed. Ties go to the first feature and bin.

    ``sizes`` are the numbers of bins of the features; no row lies beyond them.
    """
    nodes, features = sums.shape[:2]
    last = np.full(features, BINS) if sizes is None else np.asarray(sizes)
    open_ = _columns(s, tree, features)[:, None] & (np.arange(BINS) < last[:, None] - 1)
    places = np.flatnonzero(open_.ravel())
    total = sums[:, 0].sum(axis=1)
    out = np.zeros(nodes, dtype=BEST)
    out["feature"] = -1
    out["g"], out["h"], out["n"] = total.T
    if not places.size:
        return out
    left = np.cumsum(np.ascontiguousarray(np.moveaxis(sums, -1, 0)), axis=-1).reshape(3, nodes, -1).take(places, axis=2)
    whole = total.T[:, :, None]
    right = whole - left

    def worth(x):
        pull = np.maximum(np.abs(x[0]) - s.alpha, 0.0)
        under = x[1] + s.penalty
        return np.divide(pull * pull, under, out=np.zeros_like(pull), where=under > 0)

    gain = 0.5 * (worth(left) + worth(right) - worth(whole)) - s.gamma
    heavy = (left[1] >= s.least_weight) & (right[1] >= s.least_weight)
    gain = np.where(heavy & (left[2] > 0) & (right[2] > 0), gain, -np.inf)
    at = gain.argmax(axis=1)
    every = np.arange(nodes)
    found = gain[every, at] > 1e-12
    out["feature"] = np.where(found, places[at] // BINS, -1)
    out["bin"] = places[at] % BINS
    out["gain"] = np.where(found, gain[every, at], 0.0)
    out["gl"], out["hl"], out["nl"] = left[:, every, at]
    return out


# --- fitting ----------------------------------------------------------------------------
def _sampled(spec: Spec, tree: int, row: np.ndarray, part: np.ndarray) -> np.ndarray:
    mine = np.isin(part, spec.parts)
    if spec.settings.rows < 1:
        mine &= _chance(row.view(np.uint64), spec.settings.seed, tree) < spec.settings.rows
    return mine


def _unpacked(packed: pd.Series, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(-1, features)


def _next_tree(spec: Spec, number: int, data: Rows, own: np.ndarray, frame: Frame, label, row, margin) -> np.ndarray:
    """The next tree of a model whose rows are ``own``; their margins get its answers.

    A split deals out the rows of its node. Of two children the one with fewer
    rows is summed, the other one is the difference from their parent: sums are
    exact, so it is the same.
    """
    s, growing = spec.settings, Growing(spec, number)
    rows, n = own, len(own)
    if s.rows < 1:
        drawn = _chance(row[own].view(np.uint64), s.seed, number) < s.rows
        # the drawn rows first, here and in every node
        rows = np.concatenate([own[drawn], own[~drawn]])
        n = int(drawn.sum())
    first = rows[:n]
    g, weights, scale = np.zeros(data.n), None, frame.scale
    g[first], h = _gradients(label[first], margin[first], scale, s)
    if s.task != "regression":
        weights, scale = np.zeros(data.n), float(1 << _GRID)
        weights[first] = h
    least = max(2.0, 2 * s.least_weight) if weights is None else 2.0
    held = {0: (rows, n)}
    sums = {0: data.sums([first], g, weights, scale)[0]}
    while growing.open:
        best: dict[int, np.ndarray] = {}
        sought = [node for node in growing.active if node in sums]
        for k in range(0, len(sought), _SOUGHT):
            some = sought[k:k + _SOUGHT]
            best.update(zip(some, best_splits(np.stack([sums[node] for node in some]), s, number, data.sizes)))
        split = growing.active
        growing.advance(best)
        nodes = growing.nodes
        split = [node for node in split if nodes["feature"][node] >= 0]
        pairs = []
        for node in split:
            rows, _ = held.pop(node)
            left = int(nodes["left"][node])
            right = data.columns[nodes["feature"][node]].take(rows) > nodes["bin"][node]
            for child, some in ((left, np.flatnonzero(~right)), (left + 1, np.flatnonzero(right))):
                held[child] = rows.take(some), int(nodes["rows"][child])
            small, large = sorted((left, left + 1), key=lambda child: held[child][1])
            if held[large][1] >= least:  # else neither can be split
                pairs.append((node, small, large))
        if growing.open:
            found = data.sums([held[small][0][:held[small][1]] for _, small, _ in pairs], g, weights, scale)
            sums = {
                child: of for (node, small, large), one in zip(pairs, found)
                for child, of in ((small, one), (large, sums[node] - one)) if held[child][1] >= least
            }
    for node, (rows, _) in held.items():
        margin[rows] += _weight(s, number) * growing.nodes["value"][node]
    return growing.nodes


def _grown(spec: Spec, frame: Frame, data: Rows, label, row, part, grown: np.ndarray) -> np.ndarray:
    """All trees of one model, from all rows of its frame, which may be in any order: sums are exact."""
    trees, s = split_trees(grown), spec.settings
    own = np.flatnonzero(np.isin(part, spec.parts))
    margin = np.full(data.n, spec.base)
    if trees:
        margin[own] = _add(margin[own], data.bins[own], trees, s)
    for number in range(len(trees), s.trees):
        trees.append(_next_tree(spec, number, data, own, frame, label, row, margin))
    return np.concatenate(trees) if trees else np.zeros(0, dtype=NODE)


def _binary(column: pa.Array, width: int) -> np.ndarray:
    """Rows of bytes of an Arrow column, each of the same width."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    if len(column) and (np.diff(ends) != width).any():
        raise ValueError(f"rows of bins are not all of {width} features")
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]].reshape(-1, width) if len(column) else (
        np.zeros((0, width), dtype=np.uint8)
    )


def _local(shares: list[list[Spec]], frames: dict[str, Frame], grown: dict[str, np.ndarray]):
    """All trees of the models of a share, whose frame's rows are the rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            share = np.asarray(batch.column("share"))
            for one in np.unique(share):
                own = batch if (share == one).all() else batch.filter(pa.array(share == one))
                width = len(frames[shares[one][0].frame].cuts)
                held.setdefault(int(one), []).append((
                    _binary(own.column("bins"), width).copy(),
                    *[own.column(c).to_numpy(zero_copy_only=False) for c in ("label", "row", "part")],
                ))
        for one in list(held):
            bins, label, row, part = (np.concatenate(x) for x in zip(*held.pop(one)))
            frame = frames[shares[one][0].frame]
            data = Rows(bins, [len(c) + 1 for c in frame.cuts])
            for spec in shares[one]:
                nodes = _grown(spec, frame, data, label, row, part, grown[spec.name])
                yield pa.RecordBatch.from_pydict({"model": [spec.name], "nodes": [nodes.tobytes()]})

    return run


def _shares(specs: list[Spec], frames: dict[str, Frame], trees: dict[str, int], most: int) -> list[list[Spec]]:
    """Models in at most ``most`` shares (but one for each frame), each of one frame and all of about the same work."""
    work = {
        # a node takes as long as a thousand rows on one level
        s.name: max(s.settings.trees - trees[s.name], 0)
        * (s.settings.depth * frames[s.frame].rows(s.parts) + 1_000 * 2 ** s.settings.depth) + 1
        for s in specs
    }
    by_frame: dict[str, list[Spec]] = {}
    for s in specs:
        by_frame.setdefault(s.frame, []).append(s)
    total = sum(work.values())
    out = []
    for own in by_frame.values():
        count = min(len(own), max(1, round(most * sum(work[s.name] for s in own) / total)))
        parts: list[list[Spec]] = [[] for _ in range(count)]
        loads = [0] * count
        for s in sorted(own, key=lambda s: -work[s.name]):
            k = loads.index(min(loads))
            parts[k].append(s)
            loads[k] += work[s.name]
        out += zip(loads, parts)
    # the longest first
    return [part for _, part in sorted(out, key=lambda x: -x[0])]


@dataclass
class _State:
    """A model of many rows under way: trees in the stored margins, later ones, and the one that grows."""

    spec: Spec
    kept: list[np.ndarray]
    later: list[np.ndarray] = field(default_factory=list)
    growing: Growing | None = None


def _by_frame(batch: pd.DataFrame):
    for frame, rows in batch.groupby("frame", sort=False):
        yield frame, rows


def _sums(chosen: dict[str, list[tuple[_State, int]]], frames: dict[str, Frame]):
    """Histograms of a task; ``chosen`` has each frame's states with their place among its margins."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, rows in _by_frame(batch):
                frame = frames[name]
                bins = _unpacked(rows["bins"], len(frame.cuts))
                label, row, part = (rows[c].to_numpy() for c in ("label", "row", "part"))
                margins = np.array(rows["margins"].tolist(), dtype=np.float64).reshape(len(rows), -1)
                for state, place in chosen.get(name, ()):
                    s, growing = state.spec.settings, state.growing
                    mine = _sampled(state.spec, growing.tree, row, part)
                    if not mine.any():
                        continue
                    own = bins[mine]
                    g, h = _gradients(label[mine], _add(margins[mine, place], own, state.later, s), frame.scale, s)
                    sums = histograms(own, growing.slots(reached(growing.nodes, own)), g, h, len(growing.active))
                    model = state.spec.name
                    held[model] = held[model] + sums if model in held else sums
        growing = {st.spec.name: st.growing for states in chosen.values() for st, _ in states}
        for model, sums in held.items():
            some = np.flatnonzero(sums[..., 2].any(axis=(1, 2)))
            yield pd.DataFrame({
                "model": [model] * len(some), "node": [growing[model].active[i] for i in some],
                "sums": [sums[i].tobytes() for i in some],
            })

    return run


def _met(specs: dict[str, Spec], trees: dict[str, int], features: dict[str, int]):
    """The best split of one node, from the sums of all tasks."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        model, node = group["model"].iloc[0], int(group["node"].iloc[0])
        shape = (1, features[model], BINS, 3)
        total = np.zeros(shape)
        for sums in group["sums"]:
            total += np.frombuffer(sums).reshape(shape)
        best = best_splits(total, specs[model].settings, trees[model])
        return pd.DataFrame({"model": [model], "node": [node], "best": [best.tobytes()]})

    return run


def _with_margins(states: dict[str, list[_State]], frames: dict[str, Frame], stored: bool):
    """Rows with the margins of their frame's models, grown trees included."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, rows in _by_frame(batch):
                frame = frames[name]
                bins = _unpacked(rows["bins"], len(frame.cuts))
                old = np.array(rows["margins"].tolist()).reshape(len(rows), -1) if stored else None
                new = np.stack([
                    _add(old[:, k], bins, st.later, st.spec.settings) if stored
                    else _add(np.full(len(rows), st.spec.base), bins, st.kept, st.spec.settings)
                    for k, st in enumerate(states[name])
                ], axis=1)
                yield rows[["frame", "row", "bins", "label", "part"]].assign(margins=list(new))

    return run


_ROWS = "frame string, row long, bins binary, label double, part int"


def _grow_far(rows: DataFrame, specs: list[Spec], frames: dict[str, Frame], grown: dict[str, np.ndarray]) -> dict:
    """Models of many rows, level by level over all of them at once."""
    states = {s.name: _State(s, split_trees(grown[s.name])) for s in specs}
    by_frame: dict[str, list[_State]] = {}
    for st in states.values():
        by_frame.setdefault(st.spec.frame, []).append(st)
    by_name = {s.name: s for s in specs}
    features = {s.name: len(frames[s.frame].cuts) for s in specs}
    rows = rows.where(F.col("frame").isin(list(by_frame)))
    margins = settle(rows.mapInPandas(_with_margins(by_frame, frames, False), f"{_ROWS}, margins array<double>"), "margins")

    def count(st: _State) -> int:
        return len(st.kept) + len(st.later)

    while True:
        under_way = [st for st in states.values() if count(st) < st.spec.settings.trees]
        if not under_way:
            return {n: np.concatenate(st.kept + st.later) for n, st in states.items()}
        for st in under_way:
            st.growing = Growing(st.spec, count(st))
        while any(st.growing.open for st in under_way):
            found: dict[str, dict[int, np.ndarray]] = {}
            waiting = [st for st in under_way if st.growing.open]
            while waiting:
                # as many models as one pass may hold sums for
                now, held = [], 0
                while waiting and (not now or held + len(waiting[0].growing.active) <= PASS_NODES):
                    held += len(waiting[0].growing.active)
                    now.append(waiting.pop(0))
                chosen: dict[str, list[tuple[_State, int]]] = {}
                for st in now:
                    own = by_frame[st.spec.frame]
                    chosen.setdefault(st.spec.frame, []).append((st, own.index(st)))
                numbers = {st.spec.name: st.growing.tree for st in now}
                best = (
                    margins.mapInPandas(_sums(chosen, frames), "model string, node int, sums binary")
                    .groupBy("model", "node")
                    .applyInPandas(_met(by_name, numbers, features), "model string, node int, best binary")
                )
                for r in best.collect():  # one small row for each open node
                    found.setdefault(r.model, {})[r.node] = np.frombuffer(r.best, dtype=BEST)[0]
                for st in now:
                    st.growing.advance(found.get(st.spec.name, {}))
        for st in under_way:
            st.later.append(st.growing.nodes)
            st.growing = None
        if max(len(st.later) for st in states.values()) >= KEPT_TREES:
            margins = settle(
                margins.mapInPandas(_with_margins(by_frame, frames, True), f"{_ROWS}, margins array<double>"), "margins"
            )
            for st in states.values():
                st.kept, st.later = st.kept + st.later, []


def grow(
    rows: DataFrame, specs: list[Spec], frames: dict[str, Frame], grown: dict[str, np.ndarray] | None = None,
    local_rows: int | None = None,
) -> dict[str, np.ndarray]:
    """Trees of each model, by its name; ``grown`` are trees to go on from.

    ``rows`` is a stored table of ``binned`` rows. Models without rows in their
    parts get trees of one node that say 0.
    """
    most = LOCAL_ROWS if local_rows is None else local_rows
    ship_package(rows.sparkSession)
    grown = {s.name: (grown or {}).get(s.name, np.zeros(0, dtype=NODE)) for s in specs}
    near = [s for s in specs if frames[s.frame].n <= most]
    out = {}
    if near:
        spark = rows.sparkSession
        done = {s.name: len(split_trees(grown[s.name])) for s in near}
        shares = _shares(near, frames, done, _SHARES * spark.sparkContext.defaultParallelism)
        # a row goes to each share of its frame: as often as there are tasks for it, not models
        names = spark.createDataFrame([(own[0].frame, i) for i, own in enumerate(shares)], "frame string, share int")
        found = (
            rows.join(F.broadcast(names), "frame").select("share", "bins", "label", "row", "part")
            .repartitionById(len(shares), "share")
            .mapInArrow(_local(shares, frames, {s.name: grown[s.name] for s in near}), "model string, nodes binary")
        )
        out = {r.model: np.frombuffer(r.nodes, dtype=NODE) for r in found.collect()}
        for s in near:
            if s.name not in out:  # its frame has no rows here
                none = np.zeros(0)
                out[s.name] = _grown(
                    s, frames[s.frame], Rows(np.zeros((0, len(frames[s.frame].cuts)), np.uint8), [1] * len(frames[s.frame].cuts)),
                    none, none.astype(np.int64), none, grown[s.name],
                )
    far = [s for s in specs if frames[s.frame].n > most]
    if far:
        out |= _grow_far(rows, far, frames, grown)
    return out


# --- rows -------------------------------------------------------------------------------
def _values(features: Column, kind: str) -> Column:
    return features if kind.startswith("array") else vector_to_array(features)


def _cuts(df: DataFrame) -> list:
    """(frame, at, cuts): the values below which a 32nd, two 32nds and so on of a feature's values lie.

    Equal values are counted first. Their counts, not the rows, are sorted and
    summed for each feature, so the cuts are exact, whatever the partitions.
    """
    values = df.select("frame", F.posexplode("values").alias("at", "value")).where("value is not null and not isnan(value)")
    counts = values.groupBy("frame", "at", "value").agg(F.count(F.lit(1)).alias("n"))
    feature = Window.partitionBy("frame", "at")
    upto = F.sum("n").over(feature.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("n").over(feature)
    # the rank of a share is rounded up, so that it is first reached by whole 32nds
    reached = counts.select("frame", "at", "value", "n", upto.alias("upto"), total.alias("total")).where(
        F.expr(f"upto * {BINS} div total > (upto - n) * {BINS} div total")
        & F.expr(f"(upto - n) * {BINS} < total * {BINS - 1}")
    )
    return reached.groupBy("frame", "at").agg(F.array_sort(F.collect_list("value")).alias("cuts")).collect()


def frames_of(df: DataFrame, alike: Callable[[str], str] | None = None) -> dict[str, Frame]:
    """Cuts, scale and sums of each frame from its rows (frame, values array<double>, label, part).

    Frames, parts and features are configured names, so what the driver gets is
    bounded by them. Frames of the same ``alike`` have the same features in as
    many rows, so their cuts are found once.
    """
    grid = float(1 << 20)
    about = df.groupBy("frame", "part").agg(
        F.count("*").alias("n"), F.max(F.abs("label")).alias("most"), F.max(F.size("values")).alias("width"),
        # sums of whole numbers, the same in any order
        F.sum(F.round(F.col("label") * grid).cast("decimal(38,0)")).alias("total"),
    ).collect()
    out: dict[str, Frame] = {}
    most: dict[str, float] = {}
    for r in about:
        frame = out.setdefault(r.frame, Frame([np.empty(0)] * r.width, 1.0))
        frame.n += r.n
        frame.parts[r.part] = (r.n, float(r.total) / grid)
        most[r.frame] = max(most.get(r.frame, 0.0), r.most)
    for name, frame in out.items():
        frame.scale = 2.0 ** (_GRID - int(np.ceil(np.log2(2 * most[name] + 1))))
    if alike is None:
        for r in _cuts(df):
            out[r.frame].cuts[r["at"]] = np.array(r.cuts, dtype=np.float64)
        return out
    groups: dict[tuple, list[str]] = {}
    for name, frame in out.items():
        groups.setdefault((alike(name), len(frame.cuts), frozenset((p, n) for p, (n, _) in frame.parts.items())), []).append(name)
    same = {names[0]: names for names in groups.values()}
    for r in _cuts(df.where(F.col("frame").isin(list(same)))):
        for name in same[r.frame]:
            out[name].cuts[r["at"]] = np.array(r.cuts, dtype=np.float64)
    return out


def specified(frames: dict[str, Frame], name: str, frame: str, settings: Settings, parts=(0,)) -> Spec:
    """A model of some parts of a frame, starting from their mean."""
    return Spec(name, frame, settings, tuple(parts), frames[frame].base(parts, settings.task))


def _binned(frames: dict[str, Frame]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("frame").dictionary_encode()
            codes = names.indices.to_numpy(zero_copy_only=False)
            for code, name in enumerate(names.dictionary.to_pylist()):
                own = batch.filter(pa.array(codes == code))
                bins = frames[name].bins(_matrix(own.column("values"), len(frames[name].cuts)))
                yield pa.RecordBatch.from_arrays([
                    own.column("frame"), own.column("row"), _bytes(bins), own.column("label"), own.column("part")
                ], names=["frame", "row", "bins", "label", "part"])

    return run


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of doubles of an Arrow column of lists, missing ones as NaN."""
    if len(column) and set(np.unique(column.value_lengths().to_numpy())) != {width}:
        raise ValueError(f"feature rows are not all of {width} values")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


def _bytes(bins: np.ndarray) -> pa.Array:
    """Rows of bytes as an Arrow column."""
    n, width = bins.shape
    ends = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(bins))])


def binned(df: DataFrame, frames: dict[str, Frame]) -> DataFrame:
    """A stored table of (frame, row, bins, label, part) from (frame, row, values, label, part)."""
    ship_package(df.sparkSession)
    rows = df.where(F.col("frame").isin(list(frames))).select("frame", "row", "values", "label", "part")
    return settle(rows.mapInArrow(_binned(frames), _ROWS), "binned")


# --- models -----------------------------------------------------------------------------
@dataclass
class Models:
    """Fitted models by name, with their frames."""

    specs: dict[str, Spec]
    frames: dict[str, Frame]
    nodes: dict[str, np.ndarray]

    def trees(self, name: str) -> int:
        return int(self.nodes[name]["tree"][-1]) + 1 if len(self.nodes[name]) else 0

    def importance(self, name: str) -> np.ndarray:
        """Shares of the total gain of the features; zeros if nothing was split."""
        nodes = self.nodes[name]
        inner = nodes["feature"] >= 0
        gain = np.bincount(
            nodes["feature"][inner], nodes["gain"][inner], minlength=len(self.frames[self.specs[name].frame].cuts)
        )
        return gain / gain.sum() if gain.sum() > 0 else gain

    def scores(self, rows: DataFrame, keep: list[str], kinds: str, only: dict[str, int] | None = None) -> DataFrame:
        """(model, ``keep``, margin) of ``binned`` rows for each model of their frame.

        ``only`` names the part of the rows that a model is asked about; the others are left out.
        """
        by_frame: dict[str, list[str]] = {}
        for s in self.specs.values():
            by_frame.setdefault(s.frame, []).append(s.name)
        me = self

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            forests = me._forests()
            for batch in batches:
                for name, rows in _by_frame(batch):
                    bins = _unpacked(rows["bins"], len(me.frames[name].cuts))
                    for model in by_frame.get(name, ()):
                        own, mine = rows, bins
                        if only is not None:
                            at = np.flatnonzero(rows["part"].to_numpy() == only[model])
                            own, mine = rows.iloc[at], bins[at]
                        margin = forests[model].add(np.full(len(own), me.specs[model].base), mine)
                        yield own[keep].assign(model=model, margin=margin)[["model", *keep, "margin"]]

        return rows.mapInPandas(run, f"model string, {kinds}, margin double")

    def _forests(self) -> dict[str, Forest]:
        return {n: _forest(split_trees(v), self.specs[n].settings) for n, v in self.nodes.items()}

    def transform(self, df: DataFrame, model: str = "model", features: str = "features") -> DataFrame:
        """``df`` with ``prediction`` (and ``probability`` of label 1) of the model that the row names.

        Null where there is no such model. Only the number of the row and its
        features go through Python.
        """
        ship_package(df.sparkSession)
        me = self
        kind = dict(df.dtypes)[features]
        forests: dict[str, Forest] = {}  # made once a task

        @F.pandas_udf("double")
        def margin(name: pd.Series, values: pd.Series) -> pd.Series:
            out = np.full(len(name), np.nan)
            for one in name.dropna().unique():
                if one not in me.nodes:
                    continue
                at = np.flatnonzero((name == one).to_numpy())
                spec = me.specs[one]
                bins = me.frames[spec.frame].bins(np.array(values.iloc[at].tolist(), dtype=np.float64).reshape(len(at), -1))
                if one not in forests:
                    forests[one] = _forest(split_trees(me.nodes[one]), spec.settings)
                out[at] = forests[one].add(np.full(len(at), spec.base), bins)
            return pd.Series(out)

        scored = df.withColumn("_margin", F.nanvl(margin(F.col(model), _values(F.col(features), kind)), F.lit(None)))
        if all(s.settings.task == "regression" for s in self.specs.values()):
            return scored.withColumn("prediction", F.col("_margin")).drop("_margin")
        return scored.withColumn("probability", 1 / (1 + F.exp(-F.col("_margin")))).withColumn(
            "prediction", (F.col("probability") > 0.5).cast("double")
        ).drop("_margin")

    # --- storage ------------------------------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        """Two tables below ``path``: a row for each model and a row for each node."""
        about = [
            (n, s.frame, json.dumps(asdict(s.settings)), list(s.parts), s.base, f.scale, f.n, [c.tolist() for c in f.cuts])
            for n, s in self.specs.items() for f in [self.frames[s.frame]]
        ]
        spark.createDataFrame(
            about, "model string, frame string, settings string, parts array<int>, base double, scale double, n long, "
            "cuts array<array<double>>"
        ).write.mode("overwrite").parquet(f"{path}/models")
        table = pd.concat([
            pd.DataFrame(v).assign(model=n, node=np.concatenate([np.arange(len(t)) for t in split_trees(v)] or [[]]))
            for n, v in self.nodes.items()
        ])
        spark.createDataFrame(
            table[["model", "tree", "node", "feature", "bin", "left", "value", "gain", "rows"]],
            "model string, tree int, node int, feature short, bin short, left int, value double, gain double, rows long",
        ).write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Models:
        specs, frames, nodes = {}, {}, {}
        for r in spark.read.parquet(f"{path}/models").collect():
            specs[r.model] = Spec(r.model, r.frame, Settings(**json.loads(r.settings)), tuple(r.parts), r.base)
            frames[r.frame] = Frame([np.array(c, dtype=np.float64) for c in r.cuts], r.scale, r.n)
        table = spark.read.parquet(f"{path}/nodes").orderBy("model", "tree", "node").toPandas()
        for n in specs:
            own = table[table["model"] == n]
            nodes[n] = np.zeros(len(own), dtype=NODE)
            for c in NODE.names:
                nodes[n][c] = own[c].to_numpy()
        return cls(specs, frames, nodes)


def fit(
    df: DataFrame, chosen: Settings | Callable[[str], Settings], model: str = "model", features: str = "features",
    label: str = "label", key: str = "feature_id", least_rows: int = 1, local_rows: int | None = None,
    alike: Callable[[str], str] | None = None,
) -> Models:
    """One model for each value of ``model``, all at once, each fitted on its rows.

    ``chosen`` are the settings of all models, or of each by its name. Values
    with fewer than ``least_rows`` rows get no model. Rows are sampled for each
    tree by the hash of ``key`` (of the features, without such a column). Rows
    without label, features or model take no part; missing values of features
    lie in the first bin. Models of the same ``alike`` have the same features
    and differ in their labels.
    """
    rows = frame_rows(df, model, features, label, key)
    frames = {n: f for n, f in frames_of(rows, alike).items() if f.n >= least_rows}
    specs = [specified(frames, n, n, chosen(n) if callable(chosen) else chosen) for n in frames]
    if not specs:
        return Models({}, {}, {})
    return Models({s.name: s for s in specs}, frames, grow(binned(rows, frames), specs, frames, local_rows=local_rows))


def frame_rows(
    df: DataFrame, frame: str, features: str = "features", label: str = "label", key: str = "feature_id",
    part: Column | None = None,
) -> DataFrame:
    """(frame, row, values, label, part) of rows that have all of them."""
    values = _values(F.col(features), dict(df.dtypes)[features])
    return df.select(
        F.col(frame).alias("frame"), F.xxhash64(F.col(key) if key in df.columns else values).alias("row"),
        values.alias("values"), F.col(label).cast("double").alias("label"),
        (F.lit(0) if part is None else part).cast("int").alias("part"),
    ).where("frame is not null and label is not null and values is not null and part is not null")
