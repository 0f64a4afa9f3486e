import random
import re
import zlib
from collections import Counter

import pytest

from postflow.llm import spelling as S
from tests.llm.helpers import LOWER, docs, empty, odd, odd_rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def counts(rows, least_length=6, least_count=5):
    total = Counter()
    for r in rows:
        for run in RUN.findall(r[1] or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(words, ratio=5):
    form, near = {}, {}
    for w in words:
        others = [x for x in words if one_edit(w, x)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, near[w], words.get(form[w])) for w, n in words.items()}


def found(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def variants(seed, least, most):
    rng = random.Random(seed)
    words = {}
    for _ in range(12):
        base = "".join(rng.choices("abé", k=rng.randint(least, most)))
        n = rng.choice([5, 500, 4000])
        words[base] = n
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.pop(at), lambda: w.insert(at, "ç"), lambda: w.__setitem__(at, "b")])()
            if len(w) >= least:
                words["".join(w)] = rng.choice([5, 6, 30, 100])
    return words


@pytest.mark.parametrize("least, most", [(4, 6), (6, 9), (9, 20)])
def test_all_near_words_are_found(spark, least, most):
    words = variants(least, least, most)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(S.spelling_variants(table, least_length=least)) == brute(words)


def test_chains_end_at_the_most_frequent(spark):
    words = {"aaaaaa": 6**9, "aaaaab": 6**7, "aaaabb": 6**5, "aaabbb": 6**4, "aabbbb": 30, "abbbbb": 5, "cccccc": 9}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = found(S.spelling_variants(table))
    assert got == brute(words)
    assert {r[0] for r in got if r[2] == "aaaaaa"} == set(words) - {"cccccc"}


def test_words_of_documents(spark):
    rng = random.Random(4)
    pool = ["letters", "Letters", "lettters", "Été×ä", "ÉtéÀéé", "word", "x1y2", "naïveté", "naïvete", "naivete"]
    rows = [(rng.choice([None, i]), rng.choice(["", " ", "\n"]).join(rng.choices(pool, k=20))) for i in range(400)]
    rows += odd_rows() + [(i, " ".join(["abcdefgh"] * 9)) for i in range(3000)]
    got = S.word_counts(docs(spark, rows))
    expected = counts(rows)
    assert {r["word"]: r["n"] for r in got.collect()} == expected
    assert any(one_edit(w, "abcdefgh") for w in expected)
    assert found(S.document_variants(docs(spark, rows))) == brute(expected)


def test_odd_rows_and_empty_tables(spark):
    assert found(S.document_variants(odd(spark))) == brute(counts(odd_rows()))
    assert S.document_variants(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        S.near_words(empty(spark), 3)
