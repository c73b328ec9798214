"""Simple tree matching of two ordered trees, without recursion.

Two trees match in their roots if these have one label; the children of matched nodes
are matched in order, so that as many nodes as possible match. Among such matchings
that of the most equal texts is taken, so a constant block meets its like, not
a neighbour of the same label.

A ``Tree`` lists its nodes level by level: label, text and the numbers of the children.
The time is the product of the children of matched candidates; ``bounded`` keeps one side small.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

#: A matched node counts for more than any number of equal texts.
MATCH = 1 << 32


class Tree(NamedTuple):
    labels: list[str]
    texts: list[str]
    children: list[list[int]]


def bounded(tree: Tree, nodes: int, alike: int) -> Tree:
    """The first ``nodes`` nodes by level, and of the children of a node with one label half of ``alike`` from either end."""
    kept, at, parents = [0], {0: 0}, [-1]
    for k in kept:
        by_label: dict[str, list[int]] = {}
        for c in tree.children[k]:
            by_label.setdefault(tree.labels[c], []).append(c)
        ends = {c for same in by_label.values() for c in (same if len(same) <= alike else same[: alike // 2] + same[-(alike // 2) :])}
        for c in tree.children[k]:
            if c in ends and len(kept) < nodes:
                at[c] = len(kept)
                kept.append(c)
                parents.append(at[k])
    children: list[list[int]] = [[] for _ in kept]
    for k, parent in enumerate(parents):
        if parent >= 0:
            children[parent].append(k)
    return Tree([tree.labels[k] for k in kept], [tree.texts[k] for k in kept], children)


def packed(tree: Tree) -> str:
    return json.dumps(tree)


def unpacked(said: str) -> Tree:
    return Tree(*json.loads(said))


def matching(one: Tree, two: Tree) -> list[tuple[int, int]]:
    """Matched nodes of both trees, parents before children."""
    if one.labels[0] != two.labels[0]:
        return []
    weights: dict[tuple[int, int], int] = {}
    candidates = [(0, 0)]
    for a, b in candidates:
        by_label: dict[str, list[int]] = {}
        for x in one.children[a]:
            if one.children[x]:
                by_label.setdefault(one.labels[x], []).append(x)
        if by_label:
            candidates += [(x, y) for y in two.children[b] if two.children[y] for x in by_label.get(two.labels[y], ())]

    def own(a: int, b: int) -> int:
        return MATCH + (one.texts[a] == two.texts[b])

    def rows(a: int, b: int) -> Iterator[list[int]]:
        """Best weights of the first children of ``b`` (by row) and of ``a`` (by column)."""
        ahead = one.children[a]
        last = [0] * (len(ahead) + 1)
        yield last
        for y in two.children[b]:
            label, row, best = two.labels[y], [0], 0
            for k, x in enumerate(ahead):
                if last[k + 1] > best:
                    best = last[k + 1]
                if one.labels[x] == label:
                    both = last[k] + (weights.get((x, y)) or own(x, y))
                    if both > best:
                        best = both
                row.append(best)
            yield row
            last = row

    for a, b in reversed(candidates):
        for row in rows(a, b):
            best = row[-1]
        weights[a, b] = own(a, b) + best
    found = [(0, 0)]
    for a, b in found:
        if not one.children[a] or not two.children[b]:
            continue
        table = list(rows(a, b))
        i, j, met = len(two.children[b]), len(one.children[a]), []
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                met.append((one.children[a][j], two.children[b][i]))
        found += reversed(met)
    return found
