import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postflow.llm import line_dedup as L
from tests.llm.helpers import docs, empty, odd


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, line, edits):
    line = list(line)
    for _ in range(edits):
        at = rng.randrange(len(line))
        rng.choice(
            [lambda: line.pop(at), lambda: line.insert(at, "x"), lambda: line.__setitem__(at, "ü")]
        )()
    return "".join(line)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choices("abü", k=rng.randint(8, 24)))
        b = edited(rng, a, rng.randint(0, edits + 2))
        if abs(len(a) - len(b)) <= edits:
            pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", L.banded_distance(F.col("a"), F.col("b"), edits).alias("d")).collect()
    for r in got:
        exact = distance(r["a"], r["b"])
        assert (r["d"] == exact) if exact <= edits else r["d"] > edits, r


def folded(line):
    return re.sub(r"[\s\xa0]+", " ", line.lower()).strip(" ")


def brute(rows, edits, least):
    lines = [
        (doc, pos, folded(line))
        for doc, text in rows
        for pos, line in enumerate((text or "").split("\n"))
        if len(line) >= least and len(folded(line)) >= least
    ]
    distinct = sorted({x[2] for x in lines})
    parent = {x: x for x in distinct}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                parent[top(a)] = top(b)
    first = {}
    for doc, pos, line in sorted(lines):
        first.setdefault(top(line), (doc, pos))
    out = defaultdict(list)
    for doc, pos, line in lines:
        if first[top(line)] != (doc, pos):
            out[doc].append((pos, *first[top(line)]))
    return {doc: sorted(v) for doc, v in out.items()}


@pytest.mark.parametrize("edits", [1, 2])
def test_report_against_brute_force(spark, edits):
    rng = random.Random(10 + edits)
    base = ["".join(rng.choices("abcdé ", k=rng.randint(12, 30))) for _ in range(12)]
    rows = [
        (i, "\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2])) for _ in range(rng.randint(0, 6))))
        for i in range(40)
    ]
    report = L.line_report(docs(spark, rows), edits, 12).collect()
    assert len(report) == 40
    expected = brute(rows, edits, 12)
    for r in report:
        assert [tuple(x) for x in r["dropped"]] == expected.get(r["doc_id"], []), r["doc_id"]


@pytest.mark.parametrize("edits", [1, 2])
def test_crowded_segments_lose_no_link(spark, edits):
    rng = random.Random(20 + edits)
    base = "".join(rng.choices("abcdefgh ", k=40))
    lines = sorted({folded(edited(rng, base, rng.randint(0, 3))) for _ in range(120)})
    table = spark.createDataFrame([(i, 0, x) for i, x in enumerate(lines)], "h long, g long, line string")
    expected = {
        (i, j) for j in range(len(lines)) for i in range(j) if distance(lines[i], lines[j]) <= edits
    }
    for bucket in (1, 1000):
        got = L.close_lines(table, edits, bucket).collect()
        links = {tuple(sorted((r["a"]["h"], r["b"]["h"]))) for r in got}
        assert links <= expected
        assert groups(links, len(lines)) == groups(expected, len(lines))


def groups(links, n):
    root = list(range(n))
    for a, b in sorted(links):
        old, new = root[b], root[a]
        root = [new if x == old else x for x in root]
    return {frozenset(i for i in range(n) if root[i] == r) for r in root}


@pytest.mark.parametrize("least, most", [(2, 6), (8, 12)])
def test_stars_of_one_edit_join_all(spark, least, most):
    rng = random.Random(least)
    lines = sorted({"".join(rng.choices("aé", k=rng.randint(least, most))) for _ in range(150)})
    table = spark.createDataFrame([(i, 0, x) for i, x in enumerate(lines)], "h long, g long, line string")
    got = {tuple(sorted((r["ha"], r["hb"]))) for r in L.one_edit_stars(table).collect()}
    expected = {(i, j) for j in range(len(lines)) for i in range(j) if distance(lines[i], lines[j]) <= 1}
    assert got <= expected and groups(got, len(lines)) == groups(expected, len(lines))


def test_a_crowd_makes_as_many_links_as_lines(spark):
    """A thousand lines that differ at one place, and a thousand with a letter more somewhere."""
    base = "the lines of a crowd are all alike but for a letter"
    lines = [base[:9] + chr(0x4E00 + i) + base[10:] for i in range(1000)]
    lines += [base[:20] + chr(0x4E00 + i) + base[20:] for i in range(1000)] + [base]
    table = spark.createDataFrame([(i, 0, x) for i, x in enumerate(lines)], "h long, g long, line string")
    got = L.close_lines(table, 1).collect()
    assert len(got) < 3 * len(lines)
    assert len(groups({(r["a"]["h"], r["b"]["h"]) for r in got}, len(lines))) == 1


def test_dropping(spark):
    given = odd(spark)
    kept = L.drop_repeated_lines(given)
    assert kept.columns == given.columns
    rows = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect()), key=str)
    # 5 stays, twice as it is twice; 6 and the one without an id said nothing else.
    assert [r[0] for r in rows].count(5) == 2 and 6 not in [r[0] for r in rows]
    assert (1, None, 0) in rows and (2, "", 0) in rows and len(rows) == given.count() - 2
    assert L.drop_repeated_lines(empty(spark)).count() == 0
    part = L.drop_repeated_lines(docs(spark, [(1, "a line of more than twenty"), (2, "kept\nA line  of more than twenty\nalso")]))
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in part.select("doc_id", "text", "n_chars").collect()} == {
        (1, "a line of more than twenty", 26), (2, "kept\nalso", 9)
    }


def test_the_path_is_native(spark):
    plan = L.line_report(docs(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_copies_go_and_near_short_lines_stay(spark):
    rows = [(1, "and ornd.\nyes\n--\nrow 12"), (2, "And  ornd.\nno\n--\nrow 13"), (3, "other\nYES \n\n}")]
    kept = L.drop_repeated_lines(docs(spark, rows)).select("doc_id", "text").collect()
    assert {tuple(r) for r in kept} == {
        (1, "and ornd.\nyes\n--\nrow 12"), (2, "no\n--\nrow 13"), (3, "other\n\n}")
    }
