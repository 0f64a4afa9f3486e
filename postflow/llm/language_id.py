"""Language identification by mixture inference.

Each language has a table of n-gram probabilities (three bytes inside a word, hashed to a fixed
number of cells). A document is a mixture: each word comes from one of the languages, and
expectation-maximisation estimates their proportions. The languages of a document are the set
with the best penalised likelihood among the nested sets of its likeliest ones.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm import tokens as K
from postflow.llm.common import remainder, small_batches

CELLS = 1 << 16
SMOOTHING = 0.5
ROUNDS = 10
PENALTY = 2.0


def word_grams(data: np.ndarray, offsets: np.ndarray) -> tuple:
    """``(row of each word, first cell of each word, cell of each byte of a word)``.

    A byte's n-gram is itself and up to two bytes before it in its word.
    """
    data = K.LOWER[data]
    row, start, end = K.word_spans(data, offsets, K.ALNUM)
    length = end - start
    first = np.cumsum(length) - length
    inner = np.arange(int(length.sum())) - np.repeat(first, length)
    at = inner + np.repeat(start, length)
    gram = data[at].astype(np.uint64)
    for back in (1, 2):
        there = np.where(inner >= back, data[np.maximum(at - back, 0)], 0)
        gram |= there.astype(np.uint64) << np.uint64(8 * back)
    cell = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    return row, first, cell.astype(np.int64) % CELLS


def _count(batches):
    counts: dict[str, np.ndarray] = {}
    for rows, data, offsets in K.slices(batches):
        names = rows.column(rows.schema.get_field_index("lang")).to_pylist()
        row, first, cell = word_grams(data, offsets)
        if not len(first):
            continue
        known = {name: i for i, name in enumerate(sorted(set(names)))}
        number = np.array([known[name] for name in names])
        of_byte = np.repeat(number[row], np.diff(np.append(first, len(cell))))
        found = np.bincount(of_byte * CELLS + cell, minlength=len(known) * CELLS)
        for name, i in known.items():
            part = found[i * CELLS : (i + 1) * CELLS]
            counts[name] = counts[name] + part if name in counts else part
    for name, part in counts.items():
        cells = np.flatnonzero(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(cells)), pa.array(cells), pa.array(part[cells])],
            names=["lang", "cell", "n"],
        )


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and ``(cells, languages)`` log probabilities, from ``docs (text, lang)``.

    Rows with a null language are left out. Counts cover all rows; the driver gets a row for each
    language and cell.
    """
    small_batches(docs.sparkSession)
    rows = docs.filter(F.col("lang").isNotNull()).select("lang", "text")
    counted = rows.mapInArrow(_count, "lang string, cell long, n long")
    table = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(table["lang"].unique())
    counts = np.full((CELLS, len(names)), SMOOTHING)
    column = table["lang"].map({name: i for i, name in enumerate(names)}).to_numpy(dtype=int)
    counts[table["cell"].to_numpy(), column] += table["n"].to_numpy()
    return names, np.log(counts / counts.sum(axis=0)).astype(np.float32) if names else counts


def proportions(
    likelihood: np.ndarray, row: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Language proportions of each document by expectation-maximisation, and its log likelihood.

    ``likelihood``: words by languages, scaled so that the best is 1; ``first``: where each
    document's words begin; ``allowed``: documents by languages.
    """
    count = np.diff(np.append(first, len(row)))[:, None]
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        part = likelihood * share[row]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
        share = np.add.reduceat(part, first, axis=0) / count
    total = (likelihood * share[row]).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-30)), first)


def choose(likelihood: np.ndarray, row: np.ndarray, rows: int, rounds: int, penalty: float) -> np.ndarray:
    """``(rows, languages)`` proportions under the language set that each document chooses.

    Sets are the likeliest 1, 2, ... languages of a document by the proportions of all; a
    language more must gain ``penalty * log(words)`` in log likelihood. Rows without words get
    zeros.
    """
    out = np.zeros((rows, likelihood.shape[1]))
    present = np.flatnonzero(np.bincount(row, minlength=rows))
    if not len(present):
        return out
    first = np.searchsorted(row, present)
    number = np.searchsorted(present, row)
    words = np.diff(np.append(first, len(row)))
    languages = likelihood.shape[1]
    every = np.ones((len(present), languages), dtype=np.float32)
    full, gained = proportions(likelihood, number, first, every, rounds)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    best = gained - penalty * np.log(words + 1) * (languages - 1)
    share = full
    for k in range(languages - 1, 0, -1):
        # Documents whose smaller set has nothing to lose by its last language go on.
        allowed = (rank < k).astype(np.float32)
        now, gained = proportions(likelihood, number, first, allowed, rounds if k > 1 else 0)
        score = gained - penalty * np.log(words + 1) * (k - 1)
        better = score >= best
        share = np.where(better[:, None], now, share)
        best = np.where(better, score, best)
    out[present] = share
    return out


def _identify(batches, names, table, rounds, penalty):
    languages = len(names)
    for rows, data, offsets in K.slices(batches):
        n = rows.num_rows
        row, first, cell = word_grams(data, offsets)
        if len(first):
            logs = np.add.reduceat(table[cell], first, axis=0)
            logs -= logs.max(axis=1, keepdims=True)
            share = choose(np.exp(logs), row, n, rounds, penalty)
        else:
            share = np.zeros((n, languages))
        best = share.argmax(axis=1)
        kept = [c for c in rows.schema.names if c != "text"]
        mixture = pa.ListArray.from_arrays(
            pa.array(np.arange(n + 1) * languages, pa.int32()), pa.array(share.reshape(-1))
        )
        yield pa.RecordBatch.from_arrays(
            [
                *[rows.column(rows.schema.get_field_index(c)) for c in kept],
                pa.array([names[i] for i in best], pa.string()),
                pa.array(share[np.arange(n), best]),
                mixture,
            ],
            names=[*kept, "lang_pred", "score", "mixture"],
        )


def predict(
    docs: DataFrame, names: list[str], table: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY
) -> DataFrame:
    """``docs`` less ``text``, with ``lang_pred``, its proportion ``score``, and ``mixture``.

    ``mixture`` has the proportion of each of ``names``. ``und`` with score 0 where the text is
    null or has no letter, and everywhere if no language was learned.
    """
    small_batches(docs.sparkSession)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    marked = docs.withColumn("_letters", lettered)
    if not names:
        none = marked.drop("text", "_letters")
        return none.withColumns(
            {
                "lang_pred": F.lit("und"),
                "score": F.lit(0.0),
                "mixture": F.array().cast("array<double>"),
            }
        )
    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields if f.name != "text"
    )
    made = marked.mapInArrow(
        partial(_identify, names=names, table=table, rounds=rounds, penalty=penalty),
        f"{fields}, lang_pred string, score double, mixture array<double>",
    )
    return made.withColumns(
        {
            "lang_pred": F.when(F.col("_letters"), F.col("lang_pred")).otherwise("und"),
            "score": F.when(F.col("_letters"), F.least("score", F.lit(1.0))).otherwise(0.0),
        }
    ).drop("_letters")


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs``.

    Learns from rows that are not held out (crc32 of the id modulo 4 is 2) and name a language; a
    null id is not held out.
    """
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), "lang", "text")
    names, table = learn(rows.filter(~F.col("held_out")))
    found = predict(rows.select("doc_id", "held_out", "text"), names, table)
    return found.select("doc_id", "held_out", "lang_pred", "score")
