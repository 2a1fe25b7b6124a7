"""Values along an array in many of its ranges at once, by numpy: histograms, and percentiles, means and modes from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Cells of a table, and values taken from ranges, that a step holds at a time; a longer range stands alone.
CELLS = 1 << 22


def spread(low: np.ndarray, high: np.ndarray, most: int = CELLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the range, index) for each index of the ranges low <= index < high, ``most`` at a time."""
    lengths = np.maximum(high - low, 0)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(low):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, "right")))
        n = lengths[first:last]
        owner = np.repeat(np.arange(first, last), n)
        yield owner, np.arange(len(owner)) + np.repeat(low[first:last] - np.cumsum(n) + n, n)
        first = last


class Values:
    """Distinct values of an array in their order (NaN: null, left out), and how often each occurs in ranges of it: from the
    counts before every ``block``-th index and a look into the blocks at the ends, or where these counts would be too many, by a look at all."""

    def __init__(self, values: np.ndarray, block: int):
        known = ~np.isnan(values)
        self.distinct, codes = np.unique(values[known], return_inverse=True)
        self.width, self.block, self.before = len(self.distinct) + 1, block, None  # nulls come last
        self.codes = np.full(len(values), len(self.distinct))
        self.codes[known] = codes
        marks = len(values) // block + 1
        if marks * self.width <= CELLS:
            inside = np.bincount(np.arange(len(values)) // block * self.width + self.codes, minlength=marks * self.width).reshape(marks, self.width)
            self.before = np.concatenate([np.zeros((1, self.width), inside.dtype), np.cumsum(inside, axis=0)])

    def counts(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """A row for each row of low and high, both of any number of ranges a row; a column for each distinct value."""
        n, per = low.shape
        out = np.zeros((n, self.width), np.int64)
        ends = [(low, high)]
        if self.before is not None:
            first, last = -(-low // self.block), high // self.block
            across = first <= last
            first, last = np.where(across, first, 0), np.where(across, last, 0)
            for i in range(per):
                out += self.before[last[:, i]] - self.before[first[:, i]]
            ends = [(low, np.where(across, first * self.block, high)), (np.where(across, last * self.block, high), high)]
        low, high = (np.concatenate([e[k].ravel() for e in ends]) for k in (0, 1))
        for owner, at in spread(low, high):
            out += np.bincount(owner // per % n * self.width + self.codes[at], minlength=out.size).reshape(out.shape)
        return out[:, :-1]

    def rows_at_once(self) -> int:
        return max(1, CELLS // self.width)


def percentiles(values: np.ndarray, counts: np.ndarray, at: tuple[float, ...]) -> list[np.ndarray]:
    """For each row of counts (a column for each of the values, in order) the interpolated percentiles, NaN without any."""
    if not len(values):
        return [np.full(len(counts), np.nan) for _ in at]
    below, out = np.cumsum(counts, axis=1), []
    total = below[:, -1]
    for q in at:
        place = (total - 1) * q
        low, high = np.floor(place), np.ceil(place)
        a, b = (values[np.minimum((below <= x[:, None]).sum(axis=1), len(values) - 1)] for x in (low, high))
        out.append(np.where(total == 0, np.nan, np.where(a == b, a, (high - place) * a + (place - low) * b)))
    return out


def means(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=1)
    return np.where(total == 0, np.nan, counts @ values / np.maximum(total, 1))


def modes(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row the mode of its positive values, as ``coverage.distribution_mode`` has it, NaN without any."""
    out = np.full(len(counts), np.nan)
    counts = counts[:, values > 0]
    y, some = np.log(values[values > 0]), np.flatnonzero(counts.any(axis=1))
    if not len(some):
        return out
    counts = counts[some]
    q1, q3 = percentiles(y, counts, (0.25, 0.75))
    row, column = np.nonzero(counts)  # row by row, and in a row by value
    heads = np.flatnonzero(np.diff(row, prepend=-1))
    low, high, total = y[column[heads]], y[column[np.append(heads[1:], len(row)) - 1]], counts.sum(axis=1)
    width = 2 * (q3 - q1) / np.power(total, 1 / 3)
    edges = np.where(width > 0, np.floor((high - low) / np.where(width > 0, width, 1)), np.minimum(50, np.floor(np.sqrt(total))))
    bins = np.maximum(edges, 10) - 1
    step = (high - low) / bins
    number = np.floor(np.round((y[column] - low[row]) / np.where(step > 0, step, 1)[row], 9))
    number = np.where(step[row] > 0, np.minimum(number, bins[row] - 1), 0)
    heads = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(number, prepend=-1) != 0))
    filled, row, number = np.add.reduceat(counts[row, column], heads), row[heads], number[heads]
    order = np.lexsort((number, -filled, row))
    first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
    out[some] = np.exp(low + (number[first] + 0.5) * step)
    return out


#: By method: of (values in order, counts).
AVERAGES = {"median": lambda v, n: percentiles(v, n, (0.5,))[0], "mean": means, "mode": modes}
