"""Rolling measures of all statistics of a row at once, as one row per statistic.

Spark numbers the rows and brings each entity together and in order; a task then
takes them batch by batch, remembers the last rows of the batch before, and
computes the cells of a batch with numpy. A Spark window evaluates a frame of
ten rows anew for every row, measure and statistic, and needs the long rows,
many times the wide ones, sorted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Cells (rows x statistics) computed at a time, so that they stay in the processor's cache.
CELLS = 16_384


def measures_of(cells, usable, at, stride, number, room, windows, measures):
    """``{(measure, window): (values, whether there is one)}`` over the rows before each cell of ``at``.

    ``cells`` and ``usable`` are flat, ``stride`` apart from row to row; ``number``
    is the row's own and ``room`` tells how many earlier rows its entity has.
    Means and moments are updated from the oldest row on, by the steps of Spark's
    aggregates, so that values half-way between two rounded ones fall alike.
    """
    m = len(at)
    past = {}
    for k in range(1, max(windows) + 1):
        before = at - k * stride
        past[k] = cells[before], usable[before] & (room >= k)
    out = {}
    for window in windows:
        n, total, place, mean, joint, spread, square = (np.zeros(m) for _ in range(7))
        low, high = np.full(m, np.nan), np.full(m, -np.inf)
        for k in range(window, 0, -1):
            x, ok = past[k]
            total += np.where(ok, x, 0.0)
            # not-a-number is larger than any number
            low = np.fmin(low, np.where(ok, x, np.nan))
            high = np.where(ok, np.maximum(high, x), high)
            # what is not there lies at the mean and moves nothing
            dx = np.where(ok, number - k, place) - place
            x = np.where(ok, x, mean)
            dy = x - mean
            dxn, dyn = dx / (n + 1), dy / (n + 1)
            n += ok
            mean += dyn
            place += dxn
            joint += dx * (x - mean)
            spread += dx * (dx - dxn)
            square += dy * (dy - dyn)
        some, two = n > 0, n > 1
        found = {
            "avg": lambda: (total / n, some),
            "stddev": lambda: (np.sqrt(square / (n - 1)), two),
            "trend": lambda: (joint / spread, two),
            "min": lambda: (low, some),
            "max": lambda: (high, some),
        }
        for name in measures:
            out[name, window] = found[name]()
    return out


def _rounded(values, places):
    scale = 10.0 ** places
    near = np.copysign(np.floor(np.abs(values) * scale + 0.5) / scale, values) + 0.0
    # beyond that a double has no such places
    return np.where(np.abs(values) < 2.0 ** 52 / scale, near, values)


def long_rows(batches, stats, always, bits, first, windows, measures, keep, places=None):
    """Record batches of the long layout from batches of wide rows, whole entities in order.

    Columns of a batch: ``keep``, game_number, _groups (bits of the groups the
    entity ever was in), then the statistics as doubles. ``bits`` holds the bits
    of the groups that have each statistic, ``always`` names those of everyone,
    ``first`` is the number of an entity's first row; measures are rounded to ``places``.
    """
    reach, width = max(windows), len(stats)
    names = pa.array(stats, pa.string())
    tail, tail_ok, last = np.zeros((reach, width)), np.zeros((reach, width), bool), first - 1
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        cells, usable = np.zeros((reach + size, width)), np.ones((reach + size, width), bool)
        cells[:reach], usable[:reach] = tail, tail_ok
        for j, s in enumerate(stats):
            column = batch.column(s)
            if column.null_count:
                usable[reach:, j] = column.is_valid().to_numpy(zero_copy_only=False)
            cells[reach:, j] = column.to_numpy(zero_copy_only=False)
        number = batch.column("game_number").to_numpy(zero_copy_only=False).astype(np.int64)
        follows = np.concatenate([[last], number[:-1]]) + 1
        if not ((number == first) | (number == follows)).all():
            raise ValueError("the rows of an entity are not together and in order")
        tail, tail_ok, last = cells[size:].copy(), usable[size:].copy(), number[-1]
        groups = batch.column("_groups").to_numpy(zero_copy_only=False).astype(np.int64)
        flat, flat_ok, step = cells.ravel(), usable.ravel(), max(1, CELLS // max(width, 1))
        for lo in range(0, size, step):
            hi = min(size, lo + step)
            chosen = np.flatnonzero(always | ((groups[lo:hi, None] & bits) != 0))
            if not len(chosen):
                continue
            row, stat = np.divmod(chosen, width)
            row += lo
            at = chosen + (reach + lo) * width
            room = number[row] - first
            with np.errstate(all="ignore"):
                found = measures_of(flat, flat_ok, at, width, number[row], room, windows, measures)
                if places is not None:
                    found = {k: (_rounded(v, places), ok) for k, (v, ok) in found.items()}
            where = pa.array(row)
            arrays = [batch.column(c).take(where) for c in (*keep, "game_number")]
            arrays += [names.take(pa.array(stat)), pa.array(flat[at], mask=~flat_ok[at])]
            arrays += [pa.array(v, mask=~ok) for v, ok in (found[m, n] for n in windows for m in measures)]
            arrays += [pa.array(np.minimum(room, n)) for n in windows]
            yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
