"""Cutting-stock column generation over a histogram of lengths.

The linear program covers the counts of each length by patterns, multisets of lengths
that fill a sequence exactly; what no pattern covers goes to a pool at the cost of its
share of a sequence (there it may be cut). Patterns are columns that a knapsack dynamic
program prices from the duals: for each length, the best filling that holds it. The
program has one row per length, so its size depends on the sequence length alone.
Rounded patterns leave some counts, for which the program is solved again.
"""

from __future__ import annotations

import numpy as np

#: Cost of an item of a pattern, times its scarcity: of equally good fillings those of few and common lengths are taken.
ITEM_COST = 1e-4
#: Columns taken from one pass of the dynamic program, and passes at most: any state of the program is a solution.
COLUMNS, PASSES = 64, 40
#: Programs solved one after the other for what rounding has left, and the share of tokens that may stay in the pool.
ROUNDS, GAP = 8, 0.02


def fillings(lengths: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of a filling of each capacity, and the item put in last; lengths descend."""
    best, item = np.full(size + 1, -np.inf), np.full(size + 1, -1)
    best[0] = 0.0
    starts = np.searchsorted(-lengths, -np.arange(size + 1), side="left")  # the first length that fits
    for room in range(1, size + 1):
        first = starts[room]
        if first < len(lengths):
            reached = best[room - lengths[first:]] + values[first:]
            at = int(np.argmax(reached))
            best[room], item[room] = reached[at], first + at
    return best, item


def patterns_of(lengths: np.ndarray, counts: np.ndarray, size: int, gap: float) -> list[tuple[dict[int, int], float]]:
    """Patterns (number of items by index of length) and how often the relaxed program takes each.

    It stops when the pool holds at most the share ``gap`` of all tokens or no column helps.
    """
    n = len(lengths)
    # Slightly uneven counts: ties between them would let the program turn on the spot.
    uneven = 1e-3 * ((np.arange(1, n + 1) * 0.6180339887498949) % 1.0)
    inverse, amount, share = np.eye(n), counts * (1.0 + uneven) + uneven, lengths / size
    item_cost = ITEM_COST * np.clip(counts.mean() / counts, 0.1, 100.0)
    dual, basis = share.copy(), [None] * n  # the pool of each length at first
    total = float(share @ counts)

    def enter(column: dict[int, int], gain: float, kept: dict[int, int] | None) -> bool:
        nonlocal amount, dual
        direction = sum(a * inverse[:, i] for i, a in column.items())
        rows = np.flatnonzero(direction > 1e-9)
        if not len(rows):
            return False
        ratio = amount[rows] / direction[rows]
        leaving, step = int(rows[np.argmin(ratio)]), ratio.min()
        pivot = inverse[leaving] / direction[leaving]
        touched, filled = np.flatnonzero(np.abs(direction) > 1e-12), np.flatnonzero(np.abs(pivot) > 1e-14)
        inverse[np.ix_(touched, filled)] -= np.outer(direction[touched], pivot[filled])
        inverse[leaving] = pivot
        amount = np.maximum(amount - step * direction, 0.0)
        amount[leaving] = step
        dual = dual - gain * pivot
        basis[leaving] = kept
        return True

    for _ in range(PASSES):
        pooled = total - sum(amount[i] for i in range(n) if basis[i] is not None)
        if pooled <= gap * total:
            break
        best, item = fillings(lengths, dual - item_cost, size)
        with_item = dual - item_cost + best[size - lengths]
        entered, used = 0, set()
        for first in np.argsort(-with_item, kind="stable"):
            if with_item[first] <= 1e-7 or entered >= COLUMNS:
                break
            if first in used:  # columns of one pass should differ
                continue
            column, room = {int(first): 1}, size - int(lengths[first])
            while room:
                column[int(item[room])] = column.get(int(item[room]), 0) + 1
                room -= int(lengths[item[room]])
            gain = sum(a * (dual[i] - item_cost[i]) for i, a in column.items())
            if gain > 1e-7:  # an earlier column of this pass may have changed the duals
                entered += enter(column, gain, column)
                used.update(column)
        for i in np.argsort(share - dual, kind="stable")[:COLUMNS]:  # lengths worth more than their pool costs
            gain = float(dual[i] - share[i])
            if gain > 1e-7:
                entered += enter({int(i): 1}, gain, None)
        if not entered:
            break
    return [(column, float(amount[i])) for i, column in enumerate(basis) if column is not None and amount[i] > 1e-9]


def rounded(found: list[tuple[dict[int, int], float]], counts: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Whole numbers of patterns within the counts: rounded down, then once more by falling fraction where items are left."""
    left, out = counts.astype(np.int64).copy(), []
    for column, amount in found:
        times = int(min([amount + 1e-6, *(left[i] // a for i, a in column.items())]))
        for i, a in column.items():
            left[i] -= a * times
        out.append([column, times])
    for nth in sorted(range(len(found)), key=lambda k: -(found[k][1] - out[k][1])):
        column = out[nth][0]
        if all(left[i] >= a for i, a in column.items()):
            out[nth][1] += 1
            for i, a in column.items():
                left[i] -= a
    return [(column, times) for column, times in out if times]


def solve(histogram: dict[int, int], size: int) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Patterns (number of items by length) with how often each is used, and the counts left for the pool."""
    left, used = {n: c for n, c in histogram.items() if c}, []
    total = sum(n * c for n, c in left.items())
    for _ in range(ROUNDS):
        if sum(n * c for n, c in left.items()) <= GAP * total:
            break
        lengths = np.array(sorted(left, reverse=True))
        counts = np.array([left[n] for n in lengths.tolist()])
        now = [({int(lengths[i]): a for i, a in column.items()}, times) for column, times in rounded(patterns_of(lengths, counts, size, GAP / 4), counts)]
        if not now:
            break
        used += now
        for column, times in now:
            for n, a in column.items():
                left[n] -= a * times
        left = {n: c for n, c in left.items() if c}
    return used, left
