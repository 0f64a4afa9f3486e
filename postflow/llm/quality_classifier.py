"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network.

Every word has a fixed sparse random vector; the vector of a word is the sum of its neighbours'
random vectors over the whole corpus, added to its own. Words share a fixed number of cells by
hash, so the table of vectors has one size for any corpus. The shape of a word (its runs of
capitals, small letters, digits and signs) is a second word with vectors of its own. A document
is the mean of its word and shape vectors. The network is fitted on a bounded sample of labelled
documents, and a temperature fitted on a part it has not seen calibrates its probabilities.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm import tokens as K
from postflow.llm.common import remainder, small_batches

WORD_CELLS, SHAPE_CELLS = 1 << 14, 1 << 12
SIZE = 48
NONZERO = 4
WINDOW = 2
SAMPLE_ROWS = 20_000
HIDDEN = 32
EPOCHS = 40
THRESHOLD = 0.3

# Byte classes of a shape: small letters and all non-ASCII, capitals, digits; others as they are.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple:
    """``(row, word cell, shape cell)`` of each word; shape cells follow the word cells."""
    row, start, end = K.word_spans(data, offsets, K.UNBLANK)
    if not len(row):
        return row, row, row
    word = K.span_hashes(K.LOWER[data], start, end)
    kind = _CLASS[data]
    change = np.ones(len(kind), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[start] = True
    change &= K.UNBLANK[data]
    kept = np.cumsum(change)
    last = kept[end - 1]
    first = np.concatenate([[0], last[:-1]])
    shape = K.span_hashes(kind[change], first, last)
    # A word that repeats the one before has another shape.
    again = np.zeros(len(row), bool)
    again[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    shape = K.mixed(shape + again.astype(np.uint64))
    word_cell = (word % np.uint64(WORD_CELLS)).astype(np.int64)
    shape_cell = (shape % np.uint64(SHAPE_CELLS)).astype(np.int64) + WORD_CELLS
    return row, word_cell, shape_cell


def random_vectors() -> tuple[np.ndarray, np.ndarray]:
    """``(cells, NONZERO)`` places and signs of each cell's random vector."""
    seed = np.arange(WORD_CELLS + SHAPE_CELLS, dtype=np.uint64)[:, None] * np.uint64(NONZERO)
    noise = K.mixed(seed + np.arange(NONZERO, dtype=np.uint64)[None, :] + np.uint64(99))
    return (noise % np.uint64(SIZE)).astype(np.int64), np.where(noise >> np.uint64(63), 1, -1)


def _contexts(batches):
    total = np.zeros((WORD_CELLS + SHAPE_CELLS) * SIZE, np.int64)
    places, signs = random_vectors()
    for _, data, offsets in K.slices(batches):
        row, *streams = cells(data, offsets)
        for cell in streams:
            for step in range(1, WINDOW + 1):
                same = row[step:] == row[:-step]
                for own, other in ((cell[step:], cell[:-step]), (cell[:-step], cell[step:])):
                    own, other = own[same] * SIZE, other[same]
                    for k in range(NONZERO):
                        np.add.at(total, own + places[other, k], signs[other, k])
    table = total.reshape(-1, SIZE)
    used = np.flatnonzero(table.any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), *[pa.array(table[used, k]) for k in range(SIZE)]],
            names=["cell", *[f"v{k}" for k in range(SIZE)]],
        )


def _unit(table: np.ndarray) -> np.ndarray:
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """``(cells, SIZE)`` vectors from all texts of ``docs``; the driver gets a row for each cell."""
    small_batches(docs.sparkSession)
    names = [f"v{k}" for k in range(SIZE)]
    schema = ", ".join(["cell long", *[f"{n} long" for n in names]])
    sums = docs.select("text").mapInArrow(_contexts, schema).groupBy("cell").agg(
        *[F.sum(n).alias(n) for n in names]
    )
    found = sums.toPandas()
    context = np.zeros((WORD_CELLS + SHAPE_CELLS, SIZE))
    context[found["cell"].to_numpy(dtype=int)] = found[names].to_numpy(dtype=float)
    places, signs = random_vectors()
    own = np.zeros_like(context)
    np.add.at(own, (np.arange(len(own))[:, None], places), signs)
    return (_unit(context) + _unit(own)).astype(np.float32)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """``(rows, 2 * SIZE)``: means of word and of shape vectors; zeros without words."""
    rows = len(offsets) - 1
    row, *streams = cells(data, offsets)
    out = np.zeros((rows, 2 * SIZE))
    for part, cell in enumerate(streams):
        into = out[:, part * SIZE : (part + 1) * SIZE]
        for low in range(0, len(row), 1 << 16):
            own = row[low : low + (1 << 16)]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            sums = np.add.reduceat(vectors[cell[low : low + (1 << 16)]], first, axis=0)
            into[own[first]] += sums
    return out / np.maximum(np.bincount(row, minlength=rows), 1)[:, None]


def _pool(batches, vectors):
    for rows, data, offsets in K.slices(batches):
        made = pooled(data, offsets, vectors)
        lists = K.list_array(pa.array(made.reshape(-1)), np.arange(len(made) + 1) * 2 * SIZE)
        yield pa.RecordBatch.from_arrays(
            [rows.column(rows.schema.get_field_index("label")), lists], names=["label", "x"]
        )


def sample_of(labels: DataFrame, sample_rows: int) -> DataFrame:
    """``(doc_id, label)``: about ``sample_rows`` labelled rows by a hash of the id, never more."""
    given = labels.filter(F.col("quality").isNotNull()).select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    given = given.filter(F.coalesce(remainder("doc_id", 5) != 0, F.lit(False)))
    share = min(1.0, sample_rows / max(1, given.count()))
    steps = 1_000_000
    near = F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < int(share * steps)
    return given.filter(near).limit(sample_rows)


class Network:
    """Two layers in numpy, a temperature for its logits, and the scale of its input."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 3):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        x, y = x[order], y[order]
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        apart = max(1, len(x) // 5)
        held = slice(0, apart)
        z = (x - self.mean) / self.scale
        fit_x, fit_y = z[apart:], y[apart:]
        width = z.shape[1]
        self.layers = [
            rng.normal(0, (2 / width) ** 0.5, (width, hidden)),
            np.zeros(hidden),
            rng.normal(0, (2 / hidden) ** 0.5, (hidden, 1)),
            np.zeros(1),
        ]
        first = [np.zeros_like(p) for p in self.layers]
        second = [np.zeros_like(p) for p in self.layers]
        turn = 0
        for _ in range(epochs):
            shuffled = rng.permutation(len(fit_x))
            for low in range(0, len(shuffled), 256):
                batch = shuffled[low : low + 256]
                turn += 1
                for i, slope in enumerate(self._slopes(fit_x[batch], fit_y[batch])):
                    # Adam, with a little weight decay.
                    slope = slope + 1e-4 * self.layers[i]
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope**2
                    step = first[i] / (1 - 0.9**turn)
                    step = step / (np.sqrt(second[i] / (1 - 0.999**turn)) + 1e-8)
                    self.layers[i] = self.layers[i] - 2e-3 * step
        self.temperature = 1.0
        logits, truth = self.logits(x[held]), y[held]
        losses = []
        for temperature in np.geomspace(0.25, 16, 61):
            p = 1 / (1 + np.exp(-np.clip(logits / temperature, -30, 30)))
            losses.append((-np.mean(np.log(np.where(truth > 0.5, p, 1 - p) + 1e-12)), temperature))
        self.temperature = float(min(losses)[1])

    def _slopes(self, x, y):
        a, b, c, d = self.layers
        inner = np.maximum(x @ a + b, 0)
        p = 1 / (1 + np.exp(-np.clip((inner @ c + d)[:, 0], -30, 30)))
        error = ((p - y) / len(x))[:, None]
        back = (error @ c.T) * (inner > 0)
        return x.T @ back, back.sum(axis=0), inner.T @ error, error.sum(axis=0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        inner = np.maximum(((x - self.mean) / self.scale) @ a + b, 0)
        return (inner @ c + d)[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


class Constant:
    """Stands in where the labels are all alike or missing."""

    def __init__(self, y: np.ndarray):
        self.value = float((y.sum() + 1) / (len(y) + 2))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample_rows: int = SAMPLE_ROWS):
    """A model from a sample of at most ``sample_rows`` labelled rows, which bounds the broadcast."""
    sample = sample_of(labels, sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "text")
    # Ids that repeat in docs may make more rows; the bound holds for the rows as well.
    made = rows.mapInArrow(partial(_pool, vectors=vectors), "label double, x array<double>")
    found = made.limit(2 * sample_rows).toPandas()
    y = found["label"].to_numpy(dtype=float)
    if len(y) < 50 or y.min() == y.max():
        return Constant(y)
    x = np.stack(found["x"].to_numpy())
    # Rows come in any order; the fit must not depend on it.
    order = np.lexsort((*x.T[:8], y))
    return Network(x[order], y[order])


def _score(batches, vectors, model):
    for rows, data, offsets in K.slices(batches):
        kept = [c for c in rows.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [
                *[rows.column(rows.schema.get_field_index(c)) for c in kept],
                pa.array(model.probability(pooled(data, offsets, vectors))),
            ],
            names=[*kept, "score"],
        )


def score_documents(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Labels of rows whose crc32 of the id modulo 5 is 0 are held out, and of null ids are not
    used. A null text counts as empty; texts without words all get one score. Without labels of
    both kinds every score is their smoothed mean.
    """
    small_batches(docs.sparkSession)
    vectors = word_vectors(docs)
    model = fit(docs, labels, vectors, sample_rows)
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    made = docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        partial(_score, vectors=vectors, model=model), "doc_id long, held_out boolean, score double"
    )
    return made.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
