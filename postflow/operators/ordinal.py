"""Ordinal regression: scores of ordered classes, learned from labelled rows.

The proportional odds model: a row of features x belongs to class k or a lower one with the
probability ``sigmoid(t_k - w x)``. Newton's method needs sums over rows of a few numbers for each
step, which Spark adds up; the driver holds a matrix of as many rows as there are parameters.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 30
TOLERANCE = 1e-8
# A weak pull to zero keeps weights finite where features separate the classes.
PENALTY = 1e-3


@dataclass(frozen=True)
class Ordinal:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]
    loss: float

    def position(self) -> Column:
        """Where a row lies among the thresholds."""
        return sum((F.col(f) * w for f, w in zip(self.features, self.weights)), F.lit(0.0))

    def expected_class(self) -> Column:
        """The mean of the classes by their probabilities, from 0 to the highest class."""
        x = self.position()
        return sum((1 / (1 + F.exp(F.lit(t) - x)) for t in self.thresholds), F.lit(0.0))

    def likeliest_class(self) -> Column:
        """The class of the largest probability; of equally likely ones the lowest."""
        x = self.position()
        up_to = [1 / (1 + F.exp(x - F.lit(t))) for t in self.thresholds]
        parts = [b - a for a, b in zip([F.lit(0.0), *up_to], [*up_to, F.lit(1.0)])]
        best = F.array_max(F.array(*[F.struct(p.alias("p"), F.lit(-k).alias("k")) for k, p in enumerate(parts)]))
        return -best["k"]


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _sums(rows: DataFrame, features, label: str, weights, gaps) -> tuple[float, np.ndarray, np.ndarray, float]:
    """Loss, gradient and a positive curvature of the weights and thresholds, over all rows."""
    thresholds = np.cumsum(np.concatenate([[gaps[0]], np.exp(gaps[1:])]))
    n = len(thresholds)
    x = sum((F.col(f) * float(w) for f, w in zip(features, weights)), F.lit(0.0))
    y = F.col(label)
    low = F.lit(None).cast("double")
    high = F.lit(None).cast("double")
    for k, t in enumerate(thresholds):
        low = F.when(y == k + 1, F.lit(float(t)) - x).otherwise(low)
        high = F.when(y == k, F.lit(float(t)) - x).otherwise(high)
    a = F.coalesce(_sigmoid(F.col("_low")), F.lit(0.0))
    b = F.coalesce(_sigmoid(F.col("_high")), F.lit(1.0))
    p = F.greatest(F.col("_b") - F.col("_a"), F.lit(1e-12))
    da, db = F.col("_a") * (1 - F.col("_a")), F.col("_b") * (1 - F.col("_b"))
    made = rows.select(*features, label, low.alias("_low"), high.alias("_high"))
    made = made.select(*features, label, a.alias("_a"), b.alias("_b"))
    made = made.select(*features, label, p.alias("_p"), da.alias("_da"), db.alias("_db"), F.col("_a"), F.col("_b"))
    # Derivatives of ln p by x, and by the threshold below and above.
    by_x = (F.col("_da") - F.col("_db")) / F.col("_p")
    by = [by_x * F.col(f) for f in features]
    for k in range(n):
        below = F.when(F.col(label) == k + 1, -F.col("_da") / F.col("_p")).otherwise(0.0)
        above = F.when(F.col(label) == k, F.col("_db") / F.col("_p")).otherwise(0.0)
        by.append(below + above)
    size = len(by)
    made = made.select(F.col("_p"), *[g.alias(f"g{i}") for i, g in enumerate(by)])
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]
    found = made.agg(
        F.count("*"),
        F.sum(-F.log("_p")),
        *[F.sum(f"g{i}") for i in range(size)],
        *[F.sum(F.col(f"g{i}") * F.col(f"g{j}")).alias(f"h{i}_{j}") for i, j in pairs],
    ).first()
    count, loss = found[0], found[1] or 0.0
    gradient = -np.array([v or 0.0 for v in found[2 : 2 + size]])
    curve = np.zeros((size, size))
    for (i, j), v in zip(pairs, found[2 + size :]):
        curve[i, j] = curve[j, i] = v or 0.0
    # From thresholds to the logarithms of their gaps, which keep them in order.
    turn = np.eye(size)
    for k in range(n):
        for g in range(n):
            turn[len(features) + k, len(features) + g] = 0.0 if g > k else 1.0 if g == 0 else float(np.exp(gaps[g]))
    return float(loss), turn.T @ gradient, turn.T @ curve @ turn, float(count)


def fit_ordinal(
    rows: DataFrame, features, label: str = "label", classes: int | None = None, rounds: int = ROUNDS, penalty: float = PENALTY
) -> Ordinal:
    """Fit weights and thresholds on stored rows, whose ``label`` is a class from 0.

    ``classes`` is one more than the largest label by default. Rows with a null label or feature
    are left out. Each round is one pass; a step that raises the loss is halved.
    """
    features = tuple(features)
    known = rows.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("int").alias(label)).dropna()
    if classes is None:
        classes = (known.agg(F.max(label)).first()[0] or 0) + 1
    if classes < 2:
        return Ordinal(features, (0.0,) * len(features), (), 0.0)
    n = classes - 1
    at = np.zeros(len(features) + n)
    at[len(features)] = -(n - 1) / 2

    def look(at):
        loss, gradient, curve, count = _sums(known, features, label, at[: len(features)], at[len(features) :])
        scale = penalty * max(count, 1.0)
        return loss + scale * (at @ at) / 2, gradient + scale * at, curve + scale * np.eye(len(at))

    loss, gradient, curve = look(at)
    for _ in range(rounds):
        step, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-4:
            new = look(at - size * step)
            if new[0] <= loss:
                break
            size /= 2
        else:
            break
        gain, at = loss - new[0], at - size * step
        loss, gradient, curve = new
        if gain <= TOLERANCE * max(loss, 1.0):
            break
    gaps = at[len(features) :]
    thresholds = np.cumsum(np.concatenate([[gaps[0]], np.exp(gaps[1:])]))
    return Ordinal(features, tuple(map(float, at[: len(features)])), tuple(map(float, thresholds)), loss)
