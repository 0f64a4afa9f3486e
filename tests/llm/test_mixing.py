from collections import Counter, defaultdict

import numpy as np
import pytest

from postflow.llm import mixing as M
from tests.llm.helpers import WORD, docs, empty, odd, odd_rows


def test_targets_fill_up_to_the_most():
    assert M.targets([100, 100, 100], [3, 1, 2]) == pytest.approx([200.0, 250 / 3, 500 / 3])
    assert M.targets([10, 1000, 1000], [3, 1, 2]) == pytest.approx([20.0, 2995 / 3, 5990 / 3])
    assert M.targets([0, 0], [1, 1]) == [0.0, 0.0]
    assert M.targets([5], [3]) == pytest.approx([7.5])


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutations(size):
    index, sizes = np.arange(size), np.full(size, size)
    a = M.permuted(index, sizes, np.full(size, 1))
    assert sorted(a) == list(range(size))
    if size > 90:
        assert list(a) != list(M.permuted(index, sizes, np.full(size, 2)))


def test_draws_add_up_and_vary():
    counts = M.draw([1000, 300, 0, 77], 16, 3)
    assert counts.sum(axis=0).tolist() == [1000, 300, 0, 77]
    assert len(set(counts[:, 0].tolist())) > 1
    assert abs(counts.sum(axis=1).max() - counts.sum(axis=1).min()) <= 1
    assert M._hypergeometric(np.random.default_rng(1), 2_000_000_000, 10, 5) <= 5


def check(spark, rows, report, block):
    sizes = Counter((r[0], len(WORD.findall(r[1] or "")), r[2]) for r in rows)
    found = [r.asDict() for r in report.collect()]
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in found) == sizes
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in found:
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        assert r["source_size"] == sum(x["size"] for x in found if x["source"] == r["source"])
    names = sorted(size, key=lambda s: (s is None, s or ""))
    wanted = M.targets([size[n] for n in names], [M.WEIGHTS[i % 3] for i in range(len(names))])
    assert [target[n] for n in names] == pytest.approx(wanted)
    for name in names:
        assert abs(taken[name] - target[name]) <= block
    return found


def test_odd_documents(spark):
    plain = odd(spark).select("doc_id", "text", "source")
    found = check(spark, odd_rows(), M.Mix(plain, block=16).report(), 16)
    again = M.Mix(plain.repartition(5), block=16).report()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, (r.values() for r in found))) == sorted(map(key, again.collect()))


def test_blocks_hold_the_words_of_their_documents(spark):
    rows = [(i, " ".join(f"d{i}.{j}" for j in range(5 + 13 * i % 70)), f"s{i % 3}") for i in range(40)]
    blocks = M.mix_blocks(docs(spark, rows), block=16, shards=4).collect()
    report = {r["doc_id"]: r["taken"] for r in M.Mix(docs(spark, rows), block=16, shards=4).report().collect()}
    counts = Counter()
    for b in blocks:
        words = b["text"].split(" ")
        assert len(words) == b["n_words"] <= 16
        own = [int(w[1:].split(".")[0]) for w in words]
        assert sorted(set(own)) == sorted(set(b["doc_ids"])) and all(f"s{i % 3}" == b["source"] for i in own)
        counts.update(own)
        for i in set(own):
            places = [int(w.split(".")[1]) for w in words if w.startswith(f"d{i}.")]
            assert places == list(range(places[0], places[0] + len(places)))
    assert {i: counts[i] for i in report} == report
    assert len({b["slot"] for b in blocks}) == len(blocks) and len({b["shard"] for b in blocks}) == 4


def test_nothing_to_mix(spark):
    assert M.Mix(empty(spark).select("doc_id", "text", "source")).report().count() == 0
    assert M.mix_blocks(empty(spark)).count() == 0
    assert [r["taken"] for r in M.Mix(docs(spark, [(1, None), (2, "")])).report().collect()] == [0, 0]
