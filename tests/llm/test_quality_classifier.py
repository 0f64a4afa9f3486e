import zlib

import numpy as np
import pyarrow as pa

from postflow.llm import quality_classifier as C
from postflow.llm import tokens as K
from postflow.llm.queries import table
from tests.llm.helpers import docs, empty, odd
from tests.llm.test_quality_rules import planted


def test_held_out_accuracy(spark):
    given, labels = planted(spark, 1000)
    found = C.score_documents(given, labels).join(labels, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)


def test_held_out_labels_are_not_used(spark):
    given, labels = planted(spark, 300)
    from pyspark.sql import functions as F

    other = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 0).otherwise(F.col("quality"))
    )
    a = {r["doc_id"]: r["score"] for r in C.score_documents(given, labels).collect()}
    assert a == {r["doc_id"]: r["score"] for r in C.score_documents(given, other).collect()}


def test_odd_documents(spark):
    given, none = odd(spark), table(spark, "/root/testdata/sf0.001", "labels").limit(0)
    assert {(r["score"], r["predicted"]) for r in C.score_documents(given, none).collect()} == {(0.5, 1)}
    assert C.score_documents(given, none).count() == given.count()
    assert C.score_documents(empty(spark), none).count() == 0
    documents, labels = planted(spark, 400)
    both = documents.unionByName(docs(spark, [(9001, None), (9002, ""), (None, "x")]))
    scores = {r["doc_id"]: r["score"] for r in C.score_documents(both, labels).collect()}
    assert scores[9001] == scores[9002] and len(scores) == 403


def test_the_sample_is_bounded(spark):
    _, labels = planted(spark, 500)
    assert C.sample_of(labels, 10_000).count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(500))
    assert C.sample_of(labels, 50).count() <= 50


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 6))
    y = (rng.random(4000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    model = C.Network(x[:3000], y[:3000], epochs=60)
    p = model.probability(x[3000:])
    for low in (0.1, 0.3, 0.5, 0.7):
        part = (p >= low) & (p < low + 0.2)
        assert abs(p[part].mean() - y[3000:][part].mean()) < 0.1


def test_shapes_tell_capitals_from_small_letters():
    batch = pa.RecordBatch.from_arrays([pa.array(["abc ABC!! abd 12 abd", None])], names=["text"])
    for _, data, offsets in K.slices(iter([batch])):
        row, word, shape = C.cells(data, offsets)
        assert row.tolist() == [0] * 5 and word[0] == word[0] and word[2] == word[4]
        assert shape[0] == shape[2] == shape[4] != shape[1] != shape[3]
