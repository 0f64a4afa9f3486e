import random

import numpy as np

from postflow.llm import decontaminate as D
from tests.llm.helpers import docs, empty, odd, odd_rows, terms


def brute(rows, items, window):
    out = []
    for doc_id, text, *_ in rows:
        w = terms(text)
        hit, found = set(), set()
        for item_id, t in items:
            own = terms(t)
            k = min(window, len(own))
            grams = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in grams:
                    hit |= set(range(i, i + k))
                    found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def random_case(seed):
    rng = random.Random(seed)
    words = ["a", "B", "c", "é", "42"]
    line = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, line(rng.randint(0, 9))) for i in range(12)] + [(99, None), (98, "--")]
    rows = [(i, line(rng.randint(0, 40))) for i in range(60)] + odd_rows()
    return rows, items


def found(df):
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in df.collect()), key=str
    )


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows, items = random_case(seed)
        table = spark.createDataFrame(items, "item_id long, text string")
        result = D.contamination(docs(spark, rows), table, window=4)
        assert found(result) == brute(rows, items, 4)
        row = result.filter("n_hit > 0").first()
        assert row["contaminated"] and row["n_items"] == len(row["items"])


def test_a_large_benchmark_goes_in_parts(spark):
    rows, items = random_case(3)
    table = spark.createDataFrame(items, "item_id long, text string")
    parts = D.with_matches(docs(spark, rows).select("doc_id", "text"), table, 4, chunk_words=12)
    got = sorted(((r["doc_id"], r["_n_words"], r["_n_hit"], tuple(r["_items"])) for r in parts.collect()), key=str)
    assert len(D.benchmark_chunks(table, 4, 12)) > 2
    assert got == brute(rows, items, 4)


def test_longest_matches(spark):
    table = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    row = D.contamination(docs(spark, [(1, "zero two three four nine five six")]), table).first()
    assert [tuple(m) for m in row["longest"]] == [("1", 1, 3)]
    assert not row["contaminated"]


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    for n, kinds in ((1, 1), (50, 2), (400, 3)):
        word = rng.integers(1, kinds + 1, n).astype(np.uint64)
        array = D.suffix_array(word, np.arange(n), 1 << 20)
        assert array.tolist() == sorted(range(n), key=lambda i: word[i:].tolist())


def test_removal_keeps_columns(spark):
    table = spark.createDataFrame([(1, "lazy dog and runs far away")], "item_id long, text string")
    given = odd(spark)
    kept = D.remove_contaminated(given, table)
    assert kept.columns == given.columns and kept.count() == given.count() - 4
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.remove_contaminated(given, none).count() == given.count()
    assert D.remove_contaminated(empty(spark), table).count() == 0
