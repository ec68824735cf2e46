"""Sums of gradients by feature and bin, and the trees' answers, over the binned rows of one frame.

Rows are whole numbers on a grid, so a sum and a count share one double: the
gradient in its lower digits and the row in its upper ones, in as many rows at a
time as a double holds exactly. Of many rows, the bins of several features are
one code of at most ``CELLS`` values, so that a row is added once for all of
them; a feature's sums are those of the codes that have its bin.
"""

from __future__ import annotations

from itertools import accumulate, pairwise
from math import prod

import numpy as np

BINS = 32
#: Values of a code; rows from which codes are shorter than adding each feature.
CELLS, MANY_ROWS = 1_024, 4_000
#: Rows of one addition at most, and nodes of one addition of few rows.
_PIECE, _NODES = 16_384, 32
#: Elements (rows by trees) that are sent down the trees at once.
_SENT = 32_768


def _groups(sizes: list[int], cells: int) -> list[list[int]]:
    """Features whose numbers of bins multiply to at most ``cells``, the larger ones first."""
    out: list[tuple[int, list[int]]] = []
    for j in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
        for i, (product, own) in enumerate(out):
            if product * sizes[j] <= cells:
                out[i] = product * sizes[j], [*own, j]
                break
        else:
            out.append((sizes[j], [j]))
    return [own for _, own in out]


class Rows:
    """Binned rows of one frame; ``sizes`` are the numbers of bins of the features."""

    def __init__(self, bins: np.ndarray, sizes: list[int]):
        self.bins, self.n, self.features = bins, *bins.shape
        self.columns = np.ascontiguousarray(bins.T)
        self.sizes = sizes
        self._codes: list[tuple[np.ndarray, list[int], tuple[int, ...]]] | None = None
        self._ends: list[int] = []

    @property
    def codes(self) -> list[tuple[np.ndarray, list[int], tuple[int, ...]]]:
        """(code of each row, its features, their numbers of bins), made when they are first needed."""
        if self._codes is None:
            self._codes = []
            for own in _groups(self.sizes, CELLS):
                code = np.zeros(self.n, dtype=np.uint16)
                for j in own:
                    code *= np.uint16(self.sizes[j])
                    code += self.columns[j]
                self._codes.append((code, own, tuple(self.sizes[j] for j in own)))
            self._ends = [0, *accumulate(prod(radix) for _, _, radix in self._codes)]
        return self._codes

    def sums(self, lists: list[np.ndarray], g: np.ndarray, h: np.ndarray | None, scale: float) -> np.ndarray:
        """(list, feature, bin, [gradient, weight, rows]) sums of lists of rows.

        ``g`` are whole multiples of ``1 / scale`` by row; ``h`` likewise, None
        if every weight is 1.
        """
        out = np.zeros((len(lists), self.features, BINS, 3))
        most = max((float(np.abs(g[rows]).max(initial=0.0)) for rows in lists), default=0.0) * scale
        digits = int(np.ceil(np.log2(most + 1)))
        # rows of which the sums of gradients stay below half a row's place, and all below 2^53
        piece = 1 << min(max((50 - digits) // 2, 0), 30)
        piece = min(piece, _PIECE)
        place = float(1 << digits) * 2 * piece
        packed = g * scale + place
        small: list[int] = []
        for i, rows in enumerate(lists):
            if len(rows) < MANY_ROWS or piece < MANY_ROWS:
                small.append(i)
                continue
            self._many(out[i], rows, packed, h, piece, place)
        self._few(out, lists, small, packed, h, piece, place)
        out[..., 0] /= scale
        if h is None:
            out[..., 1] = out[..., 2]
        return out

    def _many(self, out, rows, packed, h, piece, place) -> None:
        """Sums of one list by codes."""
        codes, ends = self.codes, self._ends
        cells, held = np.empty(ends[-1]), np.zeros((2 if h is None else 3, ends[-1]))
        for start in range(0, len(rows), piece):
            own = rows[start:start + piece]
            w, v = packed[own], None if h is None else h[own]
            for (code, _, _), (a, b) in zip(codes, pairwise(ends)):
                at = code.take(own)
                cells[a:b] = np.bincount(at, w, minlength=b - a)
                if v is not None:
                    held[2, a:b] += np.bincount(at, v, minlength=b - a)
            n = np.floor(cells / place + 0.5)
            held[1] += n
            held[0] += cells - n * place
        into = out[..., [0, 2, 1][:len(held)]].transpose(2, 0, 1)
        for (_, own, radix), (a, b) in zip(codes, pairwise(ends)):
            tables = held[:, a:b].reshape(-1, *radix)
            for k, j in enumerate(own):
                into[:, j, :radix[k]] = np.add.reduce(tables, axis=tuple(x + 1 for x in range(len(own)) if x != k))
        out[..., 0], out[..., 2] = into[0], into[1]
        if h is not None:
            out[..., 1] = into[2]

    def _few(self, out, lists, which, packed, h, piece, place) -> None:
        """Sums of short lists, some of them at once, feature by feature."""
        base = np.arange(self.features) * BINS
        size = self.features * BINS
        at = 0
        while at < len(which):
            # at most ``piece`` rows of a list meet in a cell, as the lists are cut
            some, total = [], 0
            while at < len(which) and len(some) < _NODES and (not some or total + len(lists[which[at]]) <= _PIECE):
                some.append(which[at])
                total += len(lists[which[at]])
                at += 1
            longest = max(len(lists[i]) for i in some)
            for start in range(0, longest, piece):
                parts = [lists[i][start:start + piece] for i in some]
                rows = np.concatenate(parts)
                slots = np.repeat(np.arange(len(some)) * size, [len(p) for p in parts])
                cell = (self.bins.take(rows, axis=0) + (slots[:, None] + base)).ravel()
                packs = np.bincount(cell, np.repeat(packed[rows], self.features), minlength=len(some) * size)
                n = np.floor(packs / place + 0.5)
                shape = (len(some), self.features, BINS)
                out[some, :, :, 0] += (packs - n * place).reshape(shape)
                out[some, :, :, 2] += n.reshape(shape)
                if h is not None:
                    weight = np.bincount(cell, np.repeat(h[rows], self.features), minlength=len(some) * size)
                    out[some, :, :, 1] += weight.reshape(shape)


class Forest:
    """Trees laid one after another, through which rows are sent several trees at a time."""

    def __init__(self, trees: list[np.ndarray], weights: list[float]):
        nodes = np.concatenate(trees) if trees else None
        self.weights = weights
        self.starts = np.cumsum([0, *[len(t) for t in trees]])
        if nodes is None:
            return
        inner = nodes["feature"] >= 0
        own = np.repeat(self.starts[:-1], [len(t) for t in trees])
        # a leaf sends every row to itself
        self.feature = np.where(inner, nodes["feature"], 0).astype(np.intp)
        self.bin = np.where(inner, nodes["bin"], 255).astype(np.uint8)
        self.left = np.where(inner, nodes["left"] + own, np.arange(len(nodes))).astype(np.intp)
        self.value = nodes["value"].astype(np.float64)
        self.depths = np.zeros(len(trees), dtype=int)
        level, of, depth = self.starts[:-1], np.arange(len(trees)), 0
        while (going := inner[level]).any():
            of = np.concatenate([of[going], of[going]])
            level = np.concatenate([self.left[level[going]], self.left[level[going]] + 1])
            depth += 1
            self.depths[of] = depth

    def add(self, margin: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """``margin`` and the weighted answers of the trees for rows of bins, tree by tree."""
        margin = margin.copy()
        n, features = bins.shape
        count = len(self.starts) - 1
        if not n or not count:
            return margin
        rows = min(n, 2_048)
        step = max(1, _SENT // rows)
        for a in range(0, n, rows):
            flat = np.ascontiguousarray(bins[a:a + rows]).ravel()
            m = len(flat) // features
            base = np.arange(m) * features
            for t in range(0, count, step):
                last = min(count, t + step)
                at = np.repeat(self.starts[t:last], m)
                where = np.tile(base, last - t)
                for _ in range(self.depths[t:last].max()):
                    right = flat.take(where + self.feature.take(at)) > self.bin.take(at)
                    at = self.left.take(at)
                    at += right
                values = self.value.take(at).reshape(last - t, m)
                for k in range(t, last):
                    margin[a:a + m] += self.weights[k] * values[k - t]
        return margin
