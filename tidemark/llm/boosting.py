"""Gradient-boosted trees over a bounded table of cells.

A cell is one combination of small categorical features, with the number of
candidates in it and how many of them are positive.  The counts come from a Spark
aggregate over all candidates; the number of cells is bounded by the product of
the features' levels, so they may be fitted in one place.  The fitted trees
are Spark expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Tree = float | tuple[str, int, "Tree", "Tree"]      # a leaf, or (feature, value, where equal, elsewhere)


@dataclass(frozen=True)
class Trees:
    start: float
    trees: tuple[Tree, ...]

    def score(self, cell: dict[str, int]) -> float:
        total = self.start
        for t in self.trees:
            while not isinstance(t, float):
                t = t[2] if cell[t[0]] == t[1] else t[3]
            total += t
        return float(1 / (1 + np.exp(-total)))

    def column(self, feature) -> Column:
        """The probability as an expression; ``feature`` gives the column of a name."""
        def of(t: Tree) -> Column:
            if isinstance(t, float):
                return F.lit(t)
            return F.when(feature(t[0]) == t[1], of(t[2])).otherwise(of(t[3]))

        total = F.lit(self.start)
        for t in self.trees:
            total = total + of(t)
        return 1 / (1 + F.exp(-total))


def fit(cells: Sequence[dict], features: Sequence[str], rounds: int = 20, depth: int = 3,
        rate: float = 0.4, ridge: float = 1.0) -> Trees:
    """``cells`` have the features, ``n`` and ``positive``.  Ties go to the first feature and smallest value."""
    if not cells:
        return Trees(0.0, ())
    x = {f: np.array([c[f] for c in cells]) for f in features}
    n = np.array([c["n"] for c in cells], dtype=float)
    y = np.array([c["positive"] for c in cells], dtype=float)
    rate_all = (y.sum() + 1) / (n.sum() + 2)
    start = float(np.log(rate_all / (1 - rate_all)))
    total = np.full(len(cells), start)
    tests = [(f, int(v), x[f] == v) for f in features for v in np.unique(x[f])]
    trees = []

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        pull, weight = y - n * p, n * p * (1 - p)

        def gain(at):
            return pull[at].sum() ** 2 / (weight[at].sum() + ridge)

        def grow(at, left):
            best, chosen = 1e-9, None
            if left:
                whole = gain(at)
                for f, v, same in tests:
                    yes = at & same
                    if yes.any() and (at & ~same).any():
                        g = gain(yes) + gain(at & ~same) - whole
                        if g > best * (1 + 1e-9):
                            best, chosen = g, (f, v, yes, at & ~same)
            if chosen is None:
                step = float(np.clip(rate * pull[at].sum() / (weight[at].sum() + ridge), -4, 4))
                total[at] += step
                return step
            f, v, yes, no = chosen
            return f, v, grow(yes, left - 1), grow(no, left - 1)

        trees.append(grow(np.ones(len(cells), dtype=bool), depth))
    return Trees(start, tuple(trees))


def threshold(cells: Sequence[dict], scores: Sequence[float], precision: float) -> float:
    """The smallest score from which the cells above hold at least this share of positives; 2 if none does.

    One positive and one negative are added to each share, so that a few candidates by themselves prove nothing.
    """
    order = sorted(range(len(cells)), key=lambda i: -scores[i])
    n = positive = 0
    found = 2.0
    for k, i in enumerate(order):
        n, positive = n + cells[i]["n"], positive + cells[i]["positive"]
        last = k + 1 == len(order) or scores[order[k + 1]] < scores[i]
        if last and positive + 1 >= precision * (n + 2):
            found = scores[i]
    return found
