import math
import random

import pytest
from pyspark.sql import functions as F

from postflow.operators import metrics as E
from postflow.sources.storage import shared_dir, store
from tests.conftest import plan_of

SCHEMA = "label int, class int, p double"


def made(rng, n, values=None):
    p = (lambda: rng.choice(values)) if values else rng.random
    return [(rng.randrange(3), c, p()) for _ in range(n) for c in range(3)]


def auc(rows, c):
    pos = [p for label, k, p in rows if k == c and label == c]
    neg = [p for label, k, p in rows if k == c and label != c]
    if not pos or not neg:
        return len(pos), len(neg), None
    won = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    return len(pos), len(neg), won / (len(pos) * len(neg))


@pytest.mark.parametrize("values", [None, [0.0, 0.25, 0.5, 1.0], [0.5]])
def test_auc_with_ties(spark, values):
    rows = made(random.Random(1), 80, values)
    got = E.one_vs_rest_auc(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["class"]: (r["positives"], r["negatives"], pytest.approx(r["auc"])) for r in got} == {
        c: auc(rows, c) for c in range(3)
    }


def test_auc_of_one_side_is_null_and_no_rows_give_none(spark):
    (row,) = E.one_vs_rest_auc(spark.createDataFrame([(1, 1, 0.5), (1, 1, 0.6)], SCHEMA)).collect()
    assert (row["positives"], row["negatives"], row["auc"]) == (2, 0, None)
    none = spark.createDataFrame([], SCHEMA)
    assert E.one_vs_rest_auc(none).count() == E.calibration(none).count() == 0
    assert tuple(E.log_loss(none).first()) == (0, None)


def test_loss_and_bins(spark):
    rows = made(random.Random(2), 50) + [(0, 0, 0.0), (1, 1, 1.0)]
    table = spark.createDataFrame(rows, SCHEMA)
    loss = [-math.log(max(p, 1e-15)) for label, c, p in rows if label == c]
    n, mean = E.log_loss(table).first()
    assert n == len(loss) and mean == pytest.approx(sum(loss) / n)
    for r in E.calibration(table, 4).collect():
        own = [(label == c, p) for label, c, p in rows if c == r["class"] and min(int(p * 4), 3) == r["bin"]]
        assert r["n"] == len(own)
        assert r["mean_p"] == pytest.approx(sum(p for _, p in own) / len(own))
        assert r["share"] == pytest.approx(sum(y for y, _ in own) / len(own))


def test_ranks_over_many_ranges(spark):
    rows = [(g, x, (x * 7) % 11) for g in "ab" for x in range(500)]
    table = spark.createDataFrame(rows, "g string, x int, v long").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = E.with_rank_below(table, "v", "g", "x").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(ranked) == len(rows)
    for r in ranked:
        assert r["below"] == sum((x * 7) % 11 for x in range(r["x"]))


def test_no_task_holds_a_class(spark):
    stored = store(spark.createDataFrame(made(random.Random(3), 9), SCHEMA), shared_dir(spark, "scored"))
    plan = plan_of(E.one_vs_rest_auc(stored).filter(F.col("class") >= 0))
    assert "SinglePartition" not in plan and "Python" not in plan
