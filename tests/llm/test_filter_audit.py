import random
from itertools import permutations

import pytest

from postflow.llm import filter_audit as A
from tests.llm.helpers import WORD, docs, empty, odd, odd_rows

LABELS = "doc_id long, quality int, toxic int"
NAMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(rows):
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    for r in rows:
        t = r[1] or ""
        w = WORD.findall(t)
        fails = set()
        if len(w) < 200:
            fails.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t):
            fails.add("C")
        if set(t) & set("#$%&*|"):
            fails.add("D")
        if r[0] is not None and r[0] > first[t]:
            fails.add("E")
        yield r[0], (r[2] if len(r) > 2 else "s") or "", fails


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    given = list(failures(rows))
    out = {}
    for part in {p for _, p, _ in given}:
        own = [(i, f) for i, p, f in given if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in f for _, f in own) - len(gone),
                    sum(f == {letter} for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), x in out.items():
            if p == part:
                x.append(shapley[order[step - 1]])
    return out


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in NAMES] for r in df.collect()}


def varied(seed):
    rng = random.Random(seed)
    texts = [
        " ".join(rng.choices([f"w{i}" for i in range(rng.choice([20, 400]))], k=rng.choice([5, 250])))
        + rng.choice(["", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEF"])
        for _ in range(40)
    ]
    rows = [(rng.randrange(90), rng.choice(texts), rng.choice(["a", "b", None, ""])) for _ in range(120)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 90, 2)]
    return rows, [*labels, (0, 1, 0), (0, 0, 1), (None, 1, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_orders_walked(spark, seed):
    rows, labels = varied(seed)
    got = A.audit_filters(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    assert found(got) == brute(rows, labels)


def test_odd_rows_and_empty_tables(spark):
    labels = [(5, 1, 0), (6, None, 1)]
    table = spark.createDataFrame(labels, LABELS)
    assert found(A.audit_filters(odd(spark), table)) == brute(odd_rows(), labels)
    assert A.audit_filters(empty(spark), table).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert found(A.audit_filters(odd(spark), none)) == brute(odd_rows(), [])


def test_intervals_cover_each_order_once():
    for n in (1, 3, 4):
        orders = list(permutations(range(n)))
        assert [A.lehmer_rank(x, n) for x in orders] == list(range(len(orders)))
        ends = A.mask_ends(n)
        for mask in range(1, 1 << n):
            for rank, order in enumerate(orders):
                at = [s for s in range(1, n + 1) if sum(c for m, t, r, c in ends if (m, t) == (mask, s) and r <= rank)]
                assert at == [next(s for s, x in enumerate(order, 1) if mask >> x & 1)]


def test_the_plan_has_one_scan_of_texts(spark):
    counts = A.document_masks(docs(spark, [(1, "x")]), spark.createDataFrame([], LABELS))
    assert "text" not in counts._jdf.queryExecution().executedPlan().toString()
