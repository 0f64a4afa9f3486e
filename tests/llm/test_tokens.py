import random

import numpy as np
import pyarrow as pa

from postflow.llm import tokens as K
from tests.llm.helpers import LOWER, TERM, WORD, terms


def texts(seed, n=300):
    rng = random.Random(seed)
    alphabet = "aB9 \n\t-é漢_" + chr(0xA0)
    return [None if rng.random() < 0.05 else "".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(n)]


def test_words_are_those_of_the_patterns(monkeypatch):
    monkeypatch.setattr(K, "SLICE_BYTES", 200)
    given = texts(1)
    batch = pa.RecordBatch.from_arrays([pa.array(given), pa.array(range(len(given)))], names=["text", "n"])
    for inside, pattern in ((K.UNBLANK, WORD), (K.ALNUM, TERM)):
        seen = {}
        for rows, data, offsets in K.slices(iter([batch.slice(0, 7), batch.slice(7)])):
            numbers = rows.column(1).to_pylist()
            row, start, end = K.word_spans(data, offsets, inside)
            for r, a, b in zip(row, start, end):
                seen.setdefault(numbers[r], []).append(bytes(data[a:b]).decode())
        lower = str if inside is K.UNBLANK else lambda t: t.translate(LOWER)
        cut = [seen.get(i, []) for i in range(len(given))]
        assert [[lower(w) for w in words] for words in cut] == [pattern.findall(lower(t or "")) for t in given]


def test_equal_words_have_equal_hashes_and_others_not():
    given = texts(2)
    batch = pa.RecordBatch.from_arrays([pa.array(given)], names=["text"])
    found = {}
    for _, data, offsets in K.slices(iter([batch])):
        row, hashed = K.words(data, offsets, K.ALNUM)
        words = [w for t in given for w in terms(t)]
        assert len(words) == len(hashed)
        for word, value in zip(words, hashed.tolist()):
            assert found.setdefault(word, value) == value
    assert len(set(found.values())) == len(found)


def test_mixed_is_a_bijection_on_a_sample():
    assert len(np.unique(K.mixed(np.arange(100_000, dtype=np.uint64)))) == 100_000
