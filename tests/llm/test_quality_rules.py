import random

from pyspark.sql import functions as F

from postflow.llm import quality_rules as Q
from tests.llm.helpers import WORD, docs, empty, odd, odd_rows

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    hit = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    return (
        len(w),
        sum(map(len, w)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(hit),
    )


def test_statistics(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices(["a", "b", " ", "\n", "#x", " é ", "a b c "], k=rng.randint(0, 40)))) for i in range(100)]
    rows += [(200 + i, r[1]) for i, r in enumerate(odd_rows())]
    expected = {r[0]: brute(r[1]) for r in rows}
    got = Q.with_statistics(docs(spark, rows), ["doc_id"]).select("doc_id", *COUNTS).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == expected


def planted(spark, n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [f"{rng.choice('abcdefgh')}{rng.randint(0, 999)}" for _ in range(80)]
        rows.append((i, " ".join(w.upper() + "!!" if bad else w for w in words)))
        labels.append((i, 0 if bad else 1, 0))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rules_find_what_is_bad(spark):
    documents, labels = planted(spark)
    found, rules = Q.quality_verdicts(documents, labels)
    assert rules and all(1 <= len(r) <= 4 for r in rules)
    assert {(r["bad"], r["kept"]) for r in found.select((F.col("doc_id") % 4 == 0).alias("bad"), "kept").distinct().collect()} == {
        (True, False), (False, True)
    }
    assert Q.filter_quality(documents, labels).count() == 450


def test_no_labels_no_rules(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    given = odd(spark)
    found, rules = Q.quality_verdicts(given, none)
    assert rules == [] and found.count() == given.count()
    assert found.filter("kept = base_failed").isEmpty()
    kept = Q.filter_quality(given, none)
    assert kept.columns == given.columns and [r["doc_id"] for r in kept.collect()] == [4]
    assert Q.quality_verdicts(empty(spark), none)[0].count() == 0
    good = spark.createDataFrame([(4, 1, None), (None, 0, 1), (4, None, 1)], "doc_id long, quality int, toxic int")
    assert Q.quality_verdicts(given, good)[1] == []


def test_the_list_is_ordered_and_native(spark):
    documents, labels = planted(spark, 200)
    found, _ = Q.quality_verdicts(documents, labels)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    one = Q.Condition("n_words", True, 10.0)
    rules = [(one,), (one, Q.Condition("word_length", False, 5.0))]
    row = spark.createDataFrame([(20, 4.0), (5, 4.0)], "n_words int, word_length double")
    assert [r[0] for r in row.select(Q.first_rule(rules)).collect()] == [1, 0]
