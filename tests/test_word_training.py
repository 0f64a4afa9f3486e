import heapq
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from postflow.operators import text as W
from postflow.operators import word_training as T
from postflow.sources.storage import shared_dir, store


def topics(spark, rows=600):
    """Rows of the words of one of two topics, words seen once, rows without words, ids that repeat."""
    draw = random.Random(3)
    made = [[f"{'ab'[i % 2]}{draw.randrange(12)}" for _ in range(30)] + [f"once{i}"] for i in range(rows)]
    made = [(i // 2, words) for i, words in enumerate(made)] + [(-1, []), (None, ["", "a1"])]
    return store(spark.createDataFrame(made, "id long, filtered_words array<string>"), shared_dir(spark, "topics"))


def test_tree_is_a_huffman_tree():
    draw = np.random.default_rng(0)
    for _ in range(60):
        weights = np.sort(draw.choice(60, draw.integers(1, 9), replace=False) + 1)
        many = draw.integers(1, 30, len(weights))
        tree = T.Tree(weights, many)
        leaves = np.repeat(weights, many)
        paths = [[] for _ in leaves]
        for which, nodes, codes in tree.paths(np.arange(len(leaves))):
            for i, node, code in zip(which, nodes, codes):
                paths[i].append((node, code))
        assert len({tuple(reversed([c for _, c in path])) for path in paths}) == len(leaves)
        if len(leaves) > 1:
            assert sum(0.5 ** len(path) for path in paths) == 1
            assert sum(w * len(path) for w, path in zip(leaves.tolist(), paths)) == huffman_cost(leaves.tolist())


def huffman_cost(weights):
    cost = 0
    heapq.heapify(weights)
    while len(weights) > 1:
        both = heapq.heappop(weights) + heapq.heappop(weights)
        cost += both
        heapq.heappush(weights, both)
    return cost


def test_a_vocabulary_too_large_for_the_driver_is_a_table(spark):
    """each word has a vector, and each row the mean of those of its words."""
    df = topics(spark)
    model = W.fit_word_vectors(df, size=3, driver_words=10)
    assert isinstance(model, T.WordVectorTable) and model.getVectorSize() == 3
    vectors = {r["word"]: r["vector"] for r in model.vectors.collect()}
    words = {w for r in df.collect() for w in r["filtered_words"]}
    assert vectors.keys() == words and len(words) == 600 + 24 + 1
    assert len({tuple(v) for v in vectors.values()}) == len(words)
    got = sorted((r["id"] is None, r["id"], r["filtered_words"], r["v"]) for r in model.transform(df).select("*", vector_to_array("features").alias("v")).collect())
    rows = sorted((r["id"] is None, r["id"], r["filtered_words"]) for r in df.collect())
    assert [r[:3] for r in got] == rows
    for _, _, held, value in got:
        mean = np.mean([vectors[w] for w in held], axis=0) if held else np.zeros(3)
        assert value == pytest.approx(mean.tolist(), abs=1e-6)
    again = {r["word"]: r["vector"] for r in W.fit_word_vectors(df, size=3, driver_words=10).vectors.collect()}
    assert again == vectors
    often = W.fit_word_vectors(df, size=3, min_count=2, driver_words=10).getVectors()
    assert {r["word"] for r in often.collect()} == {w for w in words if not w.startswith("once")} - {""}


def test_words_of_a_topic_are_alike(spark):
    df = topics(spark, 6000)
    vectors = T.train_word_vectors(df, "filtered_words", 5, 2, 1, chunk_words=100_000)
    held = {r["word"]: np.array(r["vector"]) for r in vectors.collect()}
    unit = {w: v / np.linalg.norm(v) for w, v in held.items() if w}
    alike = {same: np.mean([unit[a] @ unit[b] for a in unit for b in unit if a < b and (a[0] == b[0]) == same]) for same in (True, False)}
    assert alike[True] > alike[False] + 0.3, alike


def test_chunks_hold_each_row_once(spark):
    df = topics(spark).withColumn("row", F.monotonically_increasing_id())
    chunks = T.chunks_of(df, "filtered_words", "row", limit=500)
    rows, total = [], 0
    for chunk in chunks.collect():
        sizes = np.frombuffer(chunk["sizes"], np.int32)
        assert sizes.sum() <= 500
        codes, row = np.frombuffer(chunk["codes"], np.int32), np.frombuffer(chunk["rows"], np.int64)
        words = [chunk["words"][c] for c in codes]
        for i, (start, size) in enumerate(zip(np.cumsum(sizes) - sizes, sizes)):
            rows.append((int(row[i]), words[start : start + size]))
        total += sum(chunk["counts"])
    expected = sorted((r["row"], r["filtered_words"]) for r in df.collect())
    assert sorted(rows) == expected and total == sum(len(w) for _, w in expected)
    assert chunks.select("chunk").distinct().count() == chunks.count() > 30


def test_a_row_longer_than_a_chunk_and_null_rows(spark):
    rows = [(0, ["a", "b"] * 40), (1, None), (2, ["a", None])]
    df = store(spark.createDataFrame(rows, "id long, filtered_words array<string>").coalesce(1), shared_dir(spark, "long"))
    chunks = T.chunks_of(df, "filtered_words", limit=10).collect()
    assert sorted(len(np.frombuffer(c["codes"], np.int32)) for c in chunks) == [2, 80]
    vectors = T.train_word_vectors(df, "filtered_words", 2, 0, 1, chunk_words=10)
    assert {r["word"] for r in vectors.collect()} == {"a", "b"}


def test_a_saved_table_of_vectors(spark, tmp_path):
    df = topics(spark, 20)
    model = PipelineModel(stages=[W.fit_word_vectors(df, size=2, driver_words=0)])
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    rows = lambda m: sorted(r["v"] for r in m.transform(df).select(vector_to_array("features").alias("v")).collect())
    assert rows(loaded) == rows(model)
