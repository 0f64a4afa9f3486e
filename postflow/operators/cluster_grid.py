"""k-means for a whole grid of k in shared passes over the points.

A round is one scan: each row keeps, for every k, its cluster, an upper bound of the distance to
that centre and a lower bound of the distance to all others (Hamerly, "Making k-means even
faster"). When centres move, the bounds move with them by the triangle inequality, and a row whose
bounds don't cross needs no distance. The scan writes the rows with their new bounds and, beside
them, the sums of its tasks' clusters, which make the next centres. Rows live in stored tables, so
a lost executor costs a part of a round.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.sources.storage import remove, shared_dir
from postflow.values import K_GRID, KMEANS_SEED

ROUNDS = 20
TOLERANCE = 1e-4
# Bounds are sums of rounded numbers: they must be apart by more than that.
SLACK = 1e-9

_ROWS = "point array<double>, cluster array<int>, upper array<double>, lower array<double>"
_SUMS = "k int, c int, n long, total array<double>, cost double, computed long"


@dataclass
class Grid:
    """``centres (k, cluster, centre)``, the cost of each k, and the distances that each round took."""

    centres: DataFrame
    wssse: dict[int, float]
    rows: DataFrame
    computed: list[int] = field(default_factory=list)


def start_centres(points: DataFrame, grid=K_GRID, seed: int = KMEANS_SEED, key: str = "id", features: str = "features") -> DataFrame:
    """``(k, cluster, centre)``: for each k the first rows by a hash of ``key`` and ``seed``.

    Every k begins with a part of the same few rows.
    """
    hashed = F.xxhash64(F.lit(seed), F.col(key))
    rows = points.select(hashed.alias("h"), vector_to_array(features).alias("centre"))
    first = [r["centre"] for r in rows.orderBy("h", "centre").limit(max(grid)).collect()]
    made = [(k, i, c) for k in sorted(set(grid)) for i, c in enumerate(first[:k])]
    return points.sparkSession.createDataFrame(made, "k int, cluster int, centre array<double>")


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    far = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2 * x @ centres.T
    return np.maximum(far, 0)


def _assign(x, cluster, upper, lower, centres, moved):
    """Nearest centres of ``x`` by the bounds, in place; the number of distances taken."""
    if len(centres) == 1:
        cluster[:], upper[:], lower[:] = 0, np.sqrt(_squared(x, centres)[:, 0]), np.inf
        return len(x)
    if moved is None:
        open_ = np.arange(len(x))
        taken = 0
    else:
        upper += moved[cluster]
        # The farthest that another centre has come.
        order = np.argsort(moved)
        lower -= np.where(cluster == order[-1], moved[order[-2]], moved[order[-1]])
        apart = np.sqrt(_squared(centres, centres))
        np.fill_diagonal(apart, np.inf)
        safe = np.maximum(lower, apart.min(axis=1)[cluster] / 2)
        open_ = np.flatnonzero(upper * (1 + SLACK) + SLACK >= safe)
        upper[open_] = np.sqrt(((x[open_] - centres[cluster[open_]]) ** 2).sum(axis=1))
        taken = len(open_)
        open_ = open_[upper[open_] * (1 + SLACK) + SLACK >= safe[open_]]
    if len(open_):
        far = _squared(x[open_], centres)
        best = far.argmin(axis=1)
        two = np.partition(far, 1, axis=1)[:, :2]
        cluster[open_] = best
        upper[open_], lower[open_] = np.sqrt(two[:, 0]), np.sqrt(two[:, 1])
        taken += far.size
    return taken


def _matrix(batch: pa.RecordBatch, name: str, width: int | None, kind) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name))
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(values), -1 if width is None else width)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))


def _round(batches, sets: list[np.ndarray], moved: list | None, begun: bool):
    """Rows with new clusters and bounds, and after them the sums of this task."""
    ks = len(sets)
    totals = [np.zeros_like(c) for c in sets]
    counts = [np.zeros(len(c), np.int64) for c in sets]
    costs, computed = np.zeros(ks), np.zeros(ks, np.int64)
    names = ["kind", *[part.split()[0] for part in f"{_ROWS}, {_SUMS}".split(", ")], "row"]
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        x = _matrix(batch, "point", None, np.float64)
        if begun:
            cluster, upper, lower = (
                _matrix(batch, name, ks, kind).copy() for name, kind in (("cluster", np.int32), ("upper", float), ("lower", float))
            )
        else:
            cluster, upper, lower = np.zeros((n, ks), np.int32), np.zeros((n, ks)), np.zeros((n, ks))
        for i, centres in enumerate(sets):
            own = cluster[:, i].copy(), upper[:, i].copy(), lower[:, i].copy()
            computed[i] += _assign(x, *own, centres, moved[i] if begun else None)
            cluster[:, i], upper[:, i], lower[:, i] = own
            np.add.at(totals[i], own[0], x)
            counts[i] += np.bincount(own[0], minlength=len(centres))
            costs[i] += ((x - centres[own[0]]) ** 2).sum()
        row = batch.column(batch.schema.get_field_index("row"))
        nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.int64())]
        columns = [pa.array(["rows"] * n), *[_lists(m) for m in (x, cluster, upper, lower)], *nothing, row]
        yield pa.RecordBatch.from_arrays(columns, names=names)
    for i, centres in enumerate(sets):
        n = len(centres)
        nothing = [pa.nulls(n, t) for t in (*[pa.list_(pa.float64())], pa.list_(pa.int32()), *[pa.list_(pa.float64())] * 2)]
        first = np.arange(n) == 0
        columns = [
            pa.array(["sums"] * n),
            *nothing,
            pa.array(np.full(n, i, np.int32)),
            pa.array(np.arange(n, dtype=np.int32)),
            pa.array(counts[i]),
            _lists(totals[i]),
            pa.array(np.where(first, costs[i], 0.0)),
            pa.array(np.where(first, computed[i], 0)),
            pa.nulls(n, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def lloyd_grid(
    points: DataFrame,
    start: DataFrame,
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
    key: str = "id",
    features: str = "features",
    folder: str | None = None,
) -> Grid:
    """Lloyd's algorithm from ``start (k, cluster, centre)``, for all its k in the same scans.

    ``key`` is a long column. A k is settled once no centre of it moves by more than
    ``tolerance``; the rounds end when all are, or after ``rounds`` ones. A cluster without points
    keeps its centre; of equally near centres the first wins. The centres are on the driver and in
    each task, as the model that they are; a task's sums are as many numbers. The result's ``rows
    (key, point, cluster)`` have a cluster for each k in ascending order, by the final centres.
    """
    spark = points.sparkSession
    folder = folder or shared_dir(spark, "kmeans_grid")
    given: dict[int, dict[int, list[float]]] = {}
    for r in start.collect():
        given.setdefault(r["k"], {})[r["cluster"]] = r["centre"]
    ks = sorted(given)
    sets = [np.array([given[k][c] for c in sorted(given[k])], float) for k in ks]
    rows = points.select(F.col(key).cast("long").alias("row"), vector_to_array(features).alias("point"))
    moved, settled, computed, last = None, np.zeros(len(ks), bool), [], None
    for number in range(rounds + 1):
        begun = moved is not None
        # The function is shipped with its task, so it must not change afterwards.
        now, shift = [c.copy() for c in sets], None if moved is None else [m.copy() for m in moved]
        made = rows.mapInArrow(
            lambda batches, now=now, shift=shift, begun=begun: _round(batches, now, shift, begun),
            f"kind string, {_ROWS}, {_SUMS}, row long",
        )
        path = f"{folder}/{number}"
        made.write.mode("overwrite").partitionBy("kind").parquet(path)
        # The kinds are folders, so each is read without the other.
        written = spark.read.schema(made.schema).parquet(path)
        sums = written.filter("kind = 'sums'")
        costs = sums.groupBy("k").agg(F.sum("cost").alias("cost"), F.sum("computed").alias("computed"))
        costs = {r["k"]: r for r in costs.collect()}
        computed.append(sum(r["computed"] for r in costs.values()))
        rows = written.filter("kind = 'rows'").select("row", "point", "cluster", "upper", "lower")
        if last is not None:
            remove(spark, last)
        last = path
        if number == rounds or settled.all():
            break
        parts = sums.select("k", "c", "n", F.posexplode("total").alias("dim", "x"))
        parts = parts.groupBy("k", "c", "dim").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        new = [c.copy() for c in sets]
        for r in parts.filter("n > 0").collect():
            if not settled[r["k"]]:
                new[r["k"]][r["c"], r["dim"]] = r["x"] / r["n"]
        moved = [np.sqrt(((a - b) ** 2).sum(axis=1)) for a, b in zip(sets, new)]
        settled |= np.array([m.max() <= tolerance for m in moved])
        sets = new
    wssse = {k: float(costs[i]["cost"]) if i in costs else 0.0 for i, k in enumerate(ks)}
    table = [(k, i, c.tolist()) for k, centres in zip(ks, sets) for i, c in enumerate(centres)]
    centres = spark.createDataFrame(table, "k int, cluster int, centre array<double>")
    return Grid(centres, wssse, rows.select(F.col("row").alias(key), "point", "cluster"), computed)

