"""Language identification and LM scoring."""

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postflow.llm import language_id as I
from postflow.llm import language_model as L
from postflow.llm.queries import table
from tests.conftest import SF_DIR
from tests.llm.helpers import LOWER, SCHEMA, WORD, docs, empty, odd, odd_rows


def test_held_out_languages(spark):
    given = table(spark, SF_DIR, "documents")
    found = I.identify(given).join(given.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95


def test_a_mixture_has_two_languages(spark):
    given = table(spark, SF_DIR, "documents")
    names, logs = I.learn(given)
    text = {r["lang"]: r["text"][:600] for r in given.orderBy("n_chars").collect()}
    both = docs(spark, [(1, text["de"] + "\n" + text["fr"]), (2, text["en"])])
    rows = {r["doc_id"]: dict(zip(names, r["mixture"])) for r in I.predict(both, names, logs).collect()}
    assert rows[1]["de"] > 0.3 and rows[1]["fr"] > 0.3 and rows[1]["es"] < 0.05
    assert rows[2]["en"] > 0.9


def test_odd_languages(spark):
    given = odd(spark)
    assert {(r["lang_pred"], r["score"]) for r in I.identify(given).collect()} == {("und", 0.0)}
    named = given.withColumn("lang", F.when(F.col("doc_id") < 6, "xx").otherwise(F.lit("yy")))
    found = {r["doc_id"]: r for r in I.identify(named).collect()}
    assert found[1]["lang_pred"] == found[2]["lang_pred"] == found[3]["lang_pred"] == "und"
    assert found[4]["lang_pred"] in ("xx", "yy") and 0 < found[4]["score"] <= 1
    assert I.identify(empty(spark)).count() == 0


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("chunk", [200, 3_000_000])
def test_base_scores(spark, chunk):
    rows = [r[:2] for r in odd_rows()] + [(i, f"the cat {i % 7} sat on The mat {i}") for i in range(20, 80)]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    found = L.score_documents(docs(spark, rows), chunk_words_=chunk).collect()
    expected = sorted(
        (
            (str(i), held(i), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]), n,
             round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(t), None]), 6))
            for i, t in rows
        )
    )
    got = sorted(
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in found
    )
    assert got == expected
    assert all(r["score"] < 0 for r in found)


def test_the_model_beats_the_base_on_held_out_text(spark):
    found = L.score_documents(table(spark, SF_DIR, "documents")).filter("held_out")
    row = found.agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > row[1]


def test_chunks_do_not_change_scores(spark):
    given = table(spark, SF_DIR, "documents")
    a = {r["doc_id"]: r["score"] for r in L.score_documents(given, chunk_words_=5000).collect()}
    b = {r["doc_id"]: r["score"] for r in L.score_documents(given).collect()}
    assert a == pytest.approx(b)


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(1)
    frequent, counts = np.arange(5, dtype=np.uint64), rng.integers(5, 50, 5)
    units = len(frequent) + L.ENDINGS + 1
    bigrams = rng.integers(0, 4, (units, units)).astype(float)
    # ending 0: words seen 1, 1, 2 and 4 times; the other endings have none
    model = L.Model(frequent, counts, {0: (8, 4, 2, 1)}, bigrams, 9, counts.sum() + 8, 9, 6)
    assert np.allclose((10.0**model.step).sum(axis=1), 1)
    for c in range(6):
        own = [i for i in range(5) if model.of[i] == c]
        total = sum(10 ** model.emitted(np.array([i]), counts[i : i + 1])[0] for i in own)
        if model.of[5] == c:
            total += sum(10 ** model.emitted(np.array([5]), np.array([n]))[0] for n in (1, 1, 2, 4))
        if model.of[-1] == c:
            total += 10 ** model.emitted(np.array([units - 1]), np.array([9]))[0]
        if own or model.of[5] == c or model.of[-1] == c:
            assert total + 10 ** model.unseen[c] == pytest.approx(1)


def likelihood(bigrams, of, classes):
    one = np.eye(classes)[of]
    pair = one.T @ bigrams @ one
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return f(pair) - f(pair.sum(axis=0)) - f(pair.sum(axis=1))


def test_exchange_finds_the_classes():
    # Units 0-3 follow 4-7 and the other way round; the last is the end.
    bigrams = np.zeros((9, 9))
    bigrams[:4, 4:8] = bigrams[4:8, :4] = 10
    of = L.exchange(bigrams, 3)
    assert len(set(of[:4])) == len(set(of[4:8])) == 1 and of[0] != of[4] and of[8] == 0
    rng = np.random.default_rng(2)
    random_ = rng.integers(0, 5, (30, 30)).astype(float)
    start = np.array([1 + i % 5 for i in range(29)] + [0])
    assert likelihood(random_, L.exchange(random_, 6), 6) > likelihood(random_, start, 6)


def test_lm_without_training(spark):
    rows = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    found = L.score_documents(docs(spark, rows)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found} == {(0, 0, 0.0, 0.0)}
    assert L.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_gains_are_those_of_the_likelihood():
    rng = np.random.default_rng(4)
    units, classes = 14, 5
    bigrams = rng.poisson(1.5, (units, units)).astype(float)
    of = rng.integers(0, classes, units)

    def pairs(of):
        one = np.eye(classes)[of]
        return one.T @ bigrams @ one

    one = np.eye(classes)[of]
    found = L.gains(bigrams @ one, bigrams.T @ one, np.diag(bigrams), of, pairs(of))
    for unit in range(units):
        for c in range(classes):
            moved = of.copy()
            moved[unit] = c
            expected = L.likelihood(pairs(moved)) - L.likelihood(pairs(of))
            assert abs(found[unit, c] - found[unit, of[unit]] - expected) < 1e-6


def test_words_that_are_not_frequent_have_classes_of_their_own(spark):
    # Words of both kinds end alike, and each is under a thousandth of all; what stands before tells.
    rng = np.random.default_rng(6)
    first, second = ([f"{k}{i:03d}" for i in range(700)] * 6 for k in "ab")
    rng.shuffle(first)
    rng.shuffle(second)
    pairs = list(zip(first, second))
    is_held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    train = [i for i in range(1000) if not is_held(i)][:210]
    rows = [(i, " ".join(f"the {a} of {b}" for a, b in pairs[20 * k : 20 * k + 20])) for k, i in enumerate(train)]
    right, wrong = [i for i in range(1000) if is_held(i)][:2]
    rows.append((right, " ".join(f"the {a} of {b}" for a, b in pairs[::100])))
    rows.append((wrong, " ".join(f"the {b} of {a}" for a, b in pairs[::100])))
    score = {r["doc_id"]: r["score"] for r in L.score_documents(docs(spark, rows)).collect()}
    assert score[right] > score[wrong] + 20


@pytest.mark.parametrize("batch", [1, 3, 100])
def test_packed_counts_add_up(batch):
    rng = np.random.default_rng(batch)
    rows = []
    for _ in range(60):
        keys = np.sort(rng.choice(97, rng.integers(1, 6), replace=False))
        rows.append((int(rng.integers(0, 3)), int(rng.integers(-4, 4)), 7, keys, rng.integers(1, 9, len(keys)), 1))
    rows.sort(key=lambda r: r[:2])
    expected = {}
    for kind, word, _, keys, n, _ in rows:
        for k, x in zip(keys.tolist(), n.tolist()):
            expected[kind, word, k] = expected.get((kind, word, k), 0) + x

    def batches():
        for low in range(0, len(rows), batch):
            part = rows[low : low + batch]
            ends = np.cumsum([0, *[len(r[3]) for r in part]])
            near = L._packed_entries(np.concatenate([r[3] for r in part]), np.concatenate([r[4] for r in part]), ends)
            ints = [pa.array([r[i] for r in part]) for i in (0, 1, 2, 5)]
            yield pa.RecordBatch.from_arrays(
                [ints[0], ints[1], ints[2], near, ints[3]], names=["kind", "word", "own", "near", "part"]
            )
            yield pa.RecordBatch.from_arrays(
                [x.slice(0, 0) for x in (ints[0], ints[1], ints[2], near, ints[3])],
                names=["kind", "word", "own", "near", "part"],
            )

    found, units = {}, []
    for b in L._summed(batches()):
        entries, ends = L._entries(b.column(3))
        for i in range(b.num_rows):
            unit = (b.column(0)[i].as_py(), b.column(1)[i].as_py())
            units.append(unit)
            for e in entries[ends[i] : ends[i + 1]]:
                found[(*unit, int(e["key"]))] = int(e["n"])
    assert found == expected and len(units) == len(set(units))
    assert list(L._summed(iter([]))) == []


def test_neighbours_of_a_chunk_take_few_bytes_a_word():
    """Numbers of a chunk's words have 32 bits, and its pairs are sorted where they lie."""
    rng = np.random.default_rng(1)
    words, places, texts = 20_000, 400_000, 1_000
    ids = np.minimum((words ** rng.random(places)).astype(np.int64), words - 1)
    chunk = pa.table(
        {
            "chunk": [3],
            "lengths": [[places // texts] * texts],
            "held": [[i % 7 == 2 for i in range(texts)]],
            "ids": [L._packed(ids)],
            "words": [np.arange(words, dtype="<u8").tobytes()],
            "endings": [(np.arange(words) % L.ENDINGS).astype(np.uint8).tobytes()],
        }
    )
    answers = pa.table({"number": np.arange(words), "class": np.arange(words) % 47 + 1})
    of_ending = np.ones(L.ENDINGS, int)
    tracemalloc.start()
    try:
        made = L._neighbours((3,), chunk, answers, of_ending, 48, np.array([0]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 55 * places
    entries, ends = L._entries(made["near"].combine_chunks())
    at = np.repeat(np.arange(made.num_rows), np.diff(ends))
    held = np.repeat([i % 7 == 2 for i in range(texts)], places // texts + 1)
    number = np.insert(ids, np.arange(1, texts + 1) * (places // texts), words)
    kept = number[~held]
    word = np.flatnonzero((made["word"].to_numpy() == 1) & (made["kind"].to_numpy() == L.WORD))[0]
    key = entries["key"]
    after, before = [
        entries["n"][(at == word) & (key >= side) & (key < side + 48)].sum() for side in (0, 48)
    ]
    assert before == after == (kept == 1).sum() > 0
