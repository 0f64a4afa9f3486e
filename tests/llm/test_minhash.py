import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from postflow.llm import minhash as M
from postflow.llm import tokens as K
from postflow.llm.common import components
from tests.llm.helpers import docs, empty, odd, terms


def weights(text):
    w = terms(text)
    if not w:
        return {}
    c = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    return {k: v / sum(c.values()) for k, v in c.items()}


def similarity(x, y):
    keys = set(x) | set(y)
    return sum(
        1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in set(x) & set(y)
    )


def made(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return next((data, offsets) for _, data, offsets in K.slices(iter([batch])))


def variants(seed, n, base_words=60, edits=(0, 1, 2, 6, 20)):
    rng = random.Random(seed)
    bases = [[f"v{rng.randint(0, 400)}" for _ in range(base_words)] for _ in range(6)]
    out = []
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice(edits)):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 10**6)}"
        out.append(" ".join(words))
    return out


def test_similarities():
    texts = variants(1, 40) + ["a b a b a b a b a b a", "a b a b a b c", "x", "", "a b c"]
    left, right = texts, texts[1:] + texts[:1]
    got = M.similarities(M.weights(*made(left)), M.weights(*made(right)), len(texts))
    for a, b, s in zip(left, right, got):
        assert s == pytest.approx(similarity(weights(a), weights(b)))


def test_signatures_estimate_the_similarity():
    a, b = "p q r s t u v w x y " * 3, "p q r s t u v w x y " * 2 + "k l m n o p q r s t"
    row, shingle, weight = M.weights(*made([a, b, "one word", ""]))
    names = M.signatures(row, shingle, weight, 4, 4000)
    exact = similarity(weights(a), weights(b))
    assert (names[0] == names[1]).mean() == pytest.approx(exact, abs=0.04)
    assert len(set(names[2].tolist())) == 1 and not names[3].any()
    shares = Counter(names[0].tolist())
    top = dict(zip(shingle[row == 0].tolist(), weight[row == 0].tolist()))
    assert all(shares[k] / 4000 == pytest.approx(v, abs=0.04) for k, v in top.items())


def classes(rows, least=0.8):
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    w = {i: weights(t) for i, t in rows}
    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x == y or similarity(w[a], w[b]) >= least:
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {i: top(i) for i, _ in rows}


@pytest.mark.parametrize("block", [512, 7])
def test_classes_against_brute_force(spark, block):
    rows = list(enumerate(variants(2, 90)))
    found = M.near_duplicates(docs(spark, rows), block=block).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == classes(rows)


def test_odd_documents(spark):
    given = odd(spark)
    found = M.near_duplicates(given).collect()
    by_id = {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None}
    assert by_id == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8}
    assert sorted(str(r["class_id"]) for r in found if r["doc_id"] is None) == ["5", "None"]
    kept = M.keep_one_of_each(given)
    assert kept.columns == given.columns
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == ["1", "3", "4", "5", "7", "8", "None"]
    assert M.near_duplicates(empty(spark)).count() == 0 and M.keep_one_of_each(empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_bands_depend_on_their_place():
    same = np.full((1, 10), 7, np.uint64)
    keys = M.bands_of(same, 5, 2)
    assert len(set(keys[0].tolist())) == 5
