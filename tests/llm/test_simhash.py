import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from postflow.llm import simhash as H
from postflow.llm.common import components
from tests.llm.helpers import docs, empty, odd, odd_rows


def prose(rng, words=120):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(words))


def bits(text):
    (lanes,) = H.of_texts(pa.array([text]))
    return "".join(f"{x:016x}" for x in lanes.tolist())


def same_bits(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / H.BITS


def expected(rows):
    """doc_id, n_chars, edited digest, fingerprints and likeness, by id, for distinct ids."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for r, after in zip(ordered, [*ordered[1:], ordered[0]]):
        a, b = r[1] or "", after[1] or ""
        half = len(a) // 2
        new = a[: len(a) - half] + b[:half]
        own, other = bits(a), bits(new)
        yield (
            r[0], len(a), hashlib.sha256(new.encode()).hexdigest(), own, other,
            same_bits(own, other), same_bits(own, bits(b)),
        )


def found(df):
    return [tuple(r)[:7] for r in df.collect()]


def test_votes_by_hand():
    texts = ["one two two three", "Ünï wörd-word", "", None, "!?", "x"]
    got = H.of_texts(pa.array(texts))
    for text, lanes in zip(texts, got):
        row, term, weight = H.terms(
            np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())])
        )
        votes = [0] * H.BITS
        for t, w in zip(term.tolist(), weight.tolist()):
            for lane in range(H.LANES):
                (h,) = H.K.mixed(np.array([t], np.uint64) + H._SEEDS[lane]).tolist()
                for i in range(64):
                    votes[64 * lane + i] += w if h >> i & 1 else -w
        assert lanes.tolist() == [sum((votes[64 * j + i] > 0) << i for i in range(64)) for j in range(H.LANES)]
    _, _, weight = H.terms(np.frombuffer(b"aa b aa", np.uint8), np.array([0, 7]))
    assert sorted(weight.tolist()) == [16, round(16 * (1 + math.log(2)) * 2)]


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = prose(random.Random(1), 900)
    whole = bits(text)
    monkeypatch.setattr(H, "TERMS", 17)
    assert bits(text) == whole


@pytest.mark.parametrize("rows_of_batch", [1, 7, 1000])
def test_against_a_walk_through_all(spark, monkeypatch, rows_of_batch):
    rng = random.Random(rows_of_batch)
    monkeypatch.setattr("postflow.llm.common.BATCH_ROWS", rows_of_batch)
    rows = [(i, rng.choice([None, "", "é", prose(rng, rng.randint(1, 60))])) for i in rng.sample(range(10**6), 83)]
    given = docs(spark, rows).repartition(5)
    assert sorted(found(H.fingerprint_report(given))) == sorted(expected(rows))


def test_edits_are_nearer_than_other_texts(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng)) for i in range(60)]
    got = found(H.fingerprint_report(docs(spark, rows)))
    assert min(r[5] for r in got) > max(r[6] for r in got) - 0.05
    assert sum(r[5] > r[6] for r in got) >= 59


def test_odd_rows_and_empty_tables(spark):
    got = H.fingerprint_report(odd(spark)).collect()
    assert len(got) == len(odd_rows())
    same = [r for r in got if r["doc_id"] in (5, 6)]
    assert len(same) == 3 and {r["class_id"] for r in same} == {5}
    # Two rows repeat id and text: one is followed by the other.
    assert sorted(r["near_next"] == 1 for r in same) == [False, True, True]
    assert H.fingerprint_report(empty(spark)).count() == 0
    (one,) = H.fingerprint_report(docs(spark, [(4, "a b c d")])).collect()
    assert (one["near_next"], one["edited_sha256"]) == (1, hashlib.sha256(b"a b a b").hexdigest())
    assert (one["class_id"], len(one["fingerprint"])) == (4, 64)


def test_masks_cut_the_bits():
    for radius, kept in ((3, 1), (8, 1), (4, 2)):
        masks = H.block_masks(radius, kept)
        assert len(masks) == math.comb(radius + kept, kept)
        together = [sum(m[lane] >> i & 1 for m in masks) for lane in range(H.LANES) for i in range(64)]
        assert set(together) == {math.comb(radius + kept - 1, kept - 1)}
    with pytest.raises(ValueError):
        H.block_masks(300, 1)


@pytest.mark.parametrize("radius, kept, block", [(8, 1, 2048), (3, 1, 2), (5, 2, 3)])
def test_links_join_all_within_the_radius(spark, radius, kept, block):
    rng = random.Random(radius)
    prints = set()
    for _ in range(6):
        base = rng.getrandbits(H.BITS)
        prints.add(base)
        for _ in range(30):
            x = rng.choice([base, rng.choice(sorted(prints))])
            for i in rng.sample(range(H.BITS), rng.randint(0, radius + 2)):
                x ^= 1 << i
            prints.add(x)
    prints = sorted(prints)
    lanes = lambda x: [v - 2**64 if (v := x >> 64 * j & (2**64 - 1)) >= 2**63 else v for j in range(H.LANES)]
    nodes = spark.createDataFrame([(i, *lanes(x)) for i, x in enumerate(prints)], ["node", *H.WORDS])
    links = H.near_fingerprints(nodes, radius, kept, block)
    pairs = {(r["a"], r["b"]) for r in links.collect()}
    assert all((prints[a] ^ prints[b]).bit_count() <= radius for a, b in pairs)
    parent = list(range(len(prints)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= radius:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    assert [roots.get(i, i) for i in range(len(prints))] == [top(i) for i in range(len(prints))]
