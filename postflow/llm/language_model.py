"""LM scoring with a class-based n-gram model (Brown et al., clusters by exchange).

A text's probability is the product over its words of p(class | class before) and
p(word | class). Every word seen ``LEAST_COUNT`` times or more is a unit of its own; rarer and
unseen words belong to the unit of their ending. The exchange algorithm (Martin, Liermann and Ney)
moves units between classes while the likelihood of the class bigrams grows. It starts on the
driver, with the words that have at least ``SHARE`` of all words (at most ``1 / SHARE`` in any
corpus) and the endings of all others; then all units move in parallel, by halves, each by the
counts of its neighbours' classes, while the likelihood of the whole grows.

Texts are cut into chunks of a bounded number of words. A chunk stores its distinct words once and
its texts as numbers; word counts travel as (word, count) once for each chunk, and come back as
counts of a chunk's words. So what is shuffled is far smaller than the text, and no task holds
more than a chunk.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm import tokens as K
from postflow.llm.common import keep_table, remainder, small_batches
from postflow.sources.storage import remove, shared_dir, store

CHUNK_WORDS = 3_000_000
SHARE = 0.001
LEAST_COUNT = 3
ENDINGS = 64
CLASSES = 48
ROUNDS = 8
HALVES = 4
# Parts in which the rows of frequent words are added up before they meet.
PARTS = 16
PRIOR = 5.0

CHUNK = (
    "chunk long, doc_ids array<long>, held array<boolean>, lengths array<long>, "
    "ids binary, words binary, trained binary, endings binary"
)


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, compressed: the upper planes are nearly empty."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _unpacked(data: bytes, count: int) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(data, 4 * count, asbytes=True) if count else b""
    planes = np.frombuffer(raw, np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int32)


def _endings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number below ``ENDINGS`` from the last two bytes of each word."""
    last = data[end - 1].astype(np.uint64)
    before = np.where(end - start > 1, data[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    return (K.mixed(last * np.uint64(256) + before) % np.uint64(ENDINGS)).astype(np.uint8)


def _chunks(batches, chunk_words: int):
    task = TaskContext.get().partitionId()
    made, held_back, waiting = 0, [], 0

    def chunk():
        nonlocal made
        hashes = np.concatenate([p[2] for p in held_back])
        ending = np.concatenate([p[3] for p in held_back])
        lengths = np.concatenate([p[4] for p in held_back])
        held = np.concatenate([p[1] for p in held_back])
        ids = [i for p in held_back for i in p[0]]
        words, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        train = np.repeat(~held, lengths)
        trained = np.bincount(number[train], minlength=len(words))
        # Frequent words get the small numbers, which pack best.
        order = np.argsort(-np.bincount(number, minlength=len(words)), kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        made += 1
        return pa.RecordBatch.from_pylist(
            [
                {
                    "chunk": task * 1_000_000 + made,
                    "doc_ids": ids,
                    "held": held.tolist(),
                    "lengths": lengths.tolist(),
                    "ids": _packed(place[number]),
                    "words": words[order].astype("<u8").tobytes(),
                    "trained": trained[order].astype("<i8").tobytes(),
                    "endings": ending[first][order].tobytes(),
                }
            ],
            schema=pa.schema(
                [
                    ("chunk", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())),
                    ("held", pa.list_(pa.bool_())),
                    ("lengths", pa.list_(pa.int64())),
                    ("ids", pa.binary()),
                    ("words", pa.binary()),
                    ("trained", pa.binary()),
                    ("endings", pa.binary()),
                ]
            ),
        )

    for rows, data, offsets in K.slices(batches):
        data = K.LOWER[data]
        row, start, end = K.word_spans(data, offsets, K.UNBLANK)
        held_back.append(
            (
                rows.column(0).to_pylist(),
                rows.column(1).to_numpy(zero_copy_only=False),
                K.span_hashes(data, start, end),
                _endings(data, start, end),
                np.bincount(row, minlength=rows.num_rows),
            )
        )
        waiting += len(row)
        if waiting >= chunk_words:
            yield chunk()
            held_back, waiting = [], 0
    if held_back:
        yield chunk()


def chunk_table(docs: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """The texts of ``docs (doc_id, held_out, text)`` as numbers, a row for each chunk."""
    small_batches(docs.sparkSession)
    made = docs.select("doc_id", "held_out", "text").mapInArrow(
        partial(_chunks, chunk_words=chunk_words), CHUNK
    )
    return keep_table(made, "lm_chunks")


def _chunk_words(batches):
    for batch in batches:
        for chunk, words, trained, endings in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            hashes = np.frombuffer(words, "<u8").view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes),
                    pa.array(np.full(len(hashes), chunk)),
                    pa.array(np.arange(len(hashes), dtype=np.int32)),
                    pa.array(np.frombuffer(trained, "<i8")),
                    pa.array(np.frombuffer(endings, np.uint8).astype(np.int32)),
                ],
                names=["word", "chunk", "number", "n", "ending"],
            )


def chunk_words(chunks: DataFrame) -> DataFrame:
    """``(word, chunk, number, n, ending)``: each distinct word of each chunk, and its training count."""
    return chunks.select("chunk", "words", "trained", "endings").mapInArrow(
        _chunk_words, "word long, chunk long, number int, n long, ending int"
    )


def _units(words: np.ndarray, endings: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Unit of each word: its place among the frequent words, else the unit of its ending."""
    unit = len(frequent) + endings.astype(np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
        unit = np.where(frequent[at] == words, at, unit)
    return unit


def _texts(row: dict) -> tuple:
    """Word numbers with the end of each text put in as the number after the last."""
    lengths = np.array(row["lengths"], dtype=np.int64)
    words = np.frombuffer(row["words"], "<u8")
    ids = _unpacked(row["ids"], int(lengths.sum()))
    document = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
    number = np.full(len(document), len(words), np.int32)
    number[np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)] = ids
    return number, document, words


def _bigrams(batches, frequent: np.ndarray):
    units = len(frequent) + ENDINGS + 1
    total: dict[int, int] = {}
    for batch in batches:
        for row in batch.to_pylist():
            number, document, words = _texts(row)
            unit = np.append(
                _units(words, np.frombuffer(row["endings"], np.uint8), frequent), units - 1
            )[number]
            before = np.concatenate([[units - 1], unit[:-1]])
            train = ~np.array(row["held"], dtype=bool)[document]
            pairs, counts = np.unique(before[train] * units + unit[train], return_counts=True)
            for pair, count in zip(pairs.tolist(), counts.tolist()):
                total[pair] = total.get(pair, 0) + count
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
            names=["pair", "n"],
        )


def _f(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange(bigrams: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """A class for each unit; the last unit, the end of text, is alone in class 0.

    The most frequent units start with a class each, the others share the last.
    A unit leaves its class for the one that gives the class bigrams the largest likelihood,
    sum of n log n over pairs less the sums over first and over second classes, until a round
    moves none.
    """
    units = len(bigrams)
    weight = bigrams.sum(axis=0) + bigrams.sum(axis=1)
    of = np.zeros(units, dtype=int)
    order = [u for u in np.argsort(-weight, kind="stable") if u != units - 1]
    for place, unit in enumerate(order):
        of[unit] = min(1 + place, classes - 1)
    one = np.eye(classes)[of]
    pair = one.T @ bigrams @ one
    after, before = bigrams @ one, (bigrams.T @ one)
    diagonal = np.diag(bigrams)
    # Class counts as first and as second of a pair: they don't depend on the other's class.
    outs, ins = bigrams.sum(axis=1), bigrams.sum(axis=0)
    first, second = one.T @ outs, one.T @ ins

    f = _f
    for _ in range(rounds):
        moved = 0
        for unit in order:
            if not weight[unit]:
                continue
            own, right, left, self_ = of[unit], after[unit].copy(), before[unit].copy(), diagonal[unit]
            # The classes without this unit.
            right[own] -= self_
            left[own] -= self_
            pair[own, :] -= right
            pair[:, own] -= left
            pair[own, own] -= self_
            out, into = outs[unit], ins[unit]
            first[own] -= out
            second[own] -= into
            rows = f(pair + right[None, :]) - f(pair)
            columns = f(pair + left[:, None]) - f(pair)
            corner = np.diag(pair)
            gain = (
                rows.sum(axis=1)
                + columns.sum(axis=0)
                - (f(corner + right) - f(corner))
                - (f(corner + left) - f(corner))
                + f(corner + right + left + self_)
                - f(corner)
                - (f(first + out) - f(first))
                - (f(second + into) - f(second))
            )
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + 1e-9:
                best = own
            pair[best, :] += right
            pair[:, best] += left
            pair[best, best] += self_
            first[best] += out
            second[best] += into
            if best != own:
                moved += 1
                of[unit] = best
                after[:, own] -= bigrams[:, unit]
                after[:, best] += bigrams[:, unit]
                before[:, own] -= bigrams[unit, :]
                before[:, best] += bigrams[unit, :]
        if not moved:
            break
    return of


def likelihood(pair: np.ndarray) -> float:
    """Log likelihood of class bigrams, but for what no class changes."""
    return float(_f(pair).sum() - _f(pair.sum(axis=0)).sum() - _f(pair.sum(axis=1)).sum())


def gains(right, left, self_, own, pair) -> np.ndarray:
    """``(units, classes)``: what :func:`exchange` gains by a unit in a class, over one in none.

    ``right`` and ``left`` are counts of the classes after and before each unit, ``self_`` of the
    unit after itself, which both hold too; ``pair`` are the class bigrams with the unit in ``own``.
    """
    units, classes = np.arange(len(own)), np.arange(pair.shape[0])
    right, left = right.astype(float), left.astype(float)
    self_ = self_.astype(float)
    out, into = right.sum(axis=1), left.sum(axis=1)
    right[units, own] -= self_
    left[units, own] -= self_
    gain = np.zeros(right.shape)
    for side, other, table in ((right, left, pair), (left, right, pair.T)):
        unit, near = np.nonzero(side)
        at = own[unit]
        # The classes without this unit.
        base = table[:, near].T - (near == at)[:, None] * other[unit]
        mine = np.arange(len(unit))
        base[mine, at] -= side[unit, near] + (near == at) * self_[unit]
        np.add.at(gain, unit, _f(base + side[unit, near][:, None]) - _f(base))
    is_own = classes[None, :] == own[:, None]
    both = right + left
    corner = np.diag(pair)[None, :] - is_own * (both + self_[:, None])
    gain += (
        _f(corner + both + self_[:, None]) + _f(corner) - _f(corner + right) - _f(corner + left)
    )
    for total, count in ((pair.sum(axis=1), out), (pair.sum(axis=0), into)):
        rest = total[None, :] - is_own * count[:, None]
        gain -= _f(rest + count[:, None]) - _f(rest)
    return gain


def _choose(batches, pair: np.ndarray, half: int):
    """The class of each unit; units of one half, by a hash, go where the gain is largest."""
    classes = pair.shape[0]
    for batch in batches:
        own = batch.column(2).to_numpy().astype(int)
        entries, ends = _entries(batch.column(3))
        row = np.repeat(np.arange(len(own)), np.diff(ends))
        counts = np.zeros((len(own), 2 * classes + 1))
        counts[row, entries["key"]] = entries["n"]
        gain = gains(counts[:, :classes], counts[:, classes:-1], counts[:, -1], own, pair)
        gain[:, 0] = -np.inf
        best = gain.argmax(axis=1)
        mine = np.arange(len(own))
        turn = K.mixed(batch.column(1).to_numpy().view(np.uint64)) & np.uint64(1) == np.uint64(half)
        best = np.where(turn & (gain[mine, best] > gain[mine, own] + 1e-9), best, own)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(best.astype(np.int32))],
            names=["kind", "word", "class"],
        )


WORD, ENDING, END = 0, 1, 2


def _classes(row: dict, words: np.ndarray, answers: pa.Table, of_ending: np.ndarray) -> tuple:
    """Class of each word of a chunk and of the end of text, and which have one by their ending."""
    of = of_ending[np.frombuffer(row["endings"], np.uint8)]
    rare = np.ones(len(words), bool)
    found = answers["class"].to_numpy()
    known = ~np.isnan(found)
    number = answers["number"].to_numpy()[known]
    of[number] = found[known].astype(int)
    rare[number] = False
    return np.append(of, 0), np.append(rare, False)


def _sequence(row: dict) -> tuple:
    number, document, words = _texts(row)
    before = np.concatenate([[len(words)], number[:-1]])
    train = ~np.array(row["held"], dtype=bool)[document]
    return before[train], number[train], words


def _pairs(key, chunks: pa.Table, answers: pa.Table, of_ending: np.ndarray, classes: int):
    total = np.zeros(classes * classes, np.int64)
    for row in chunks.to_pylist():
        before, number, words = _sequence(row)
        of, _ = _classes(row, words, answers, of_ending)
        total += np.bincount(of[before] * classes + of[number], minlength=len(total))
    used = np.flatnonzero(total)
    return pa.table({"own": used // classes, "key": used % classes, "n": total[used]})


def _neighbours(key, chunks: pa.Table, answers: pa.Table, of_ending: np.ndarray, classes: int, hot: np.ndarray):
    """For each unit the classes after it, those before it, and itself after itself.

    ``hot`` are words found in most chunks: their rows, and those of the endings and the end of
    text, carry a ``part`` from 1 by their chunk.
    """
    made = [pa.table({n: pa.array([], t) for n, t in NEIGHBOURS})]
    for row in chunks.to_pylist():
        before, number, words = _sequence(row)
        of, rare = _classes(row, words, answers, of_ending)
        endings = np.frombuffer(row["endings"], np.uint8).astype(np.int64)
        unit = np.arange(len(words) + 1)
        unit[rare] = len(words) + 1 + endings[rare[:-1]]
        keys = 2 * classes + 1
        # A code for each place and side, sorted where it lies: half the bytes unless a text is huge.
        width = np.int32 if (len(unit) + ENDINGS) * keys < 2**31 else np.int64
        unit, near = unit.astype(width), of.astype(width)
        first, second = unit[before], unit[number]
        twice, places = first[first == second], len(number)
        codes = np.empty(2 * places + len(twice), width)
        np.multiply(first, keys, out=codes[:places])
        codes[:places] += near[number]
        np.multiply(second, keys, out=codes[places : 2 * places])
        codes[places : 2 * places] += near[before] + classes
        codes[2 * places :] = twice * keys + 2 * classes
        del first, second, twice, before, number
        codes.sort()
        starts = np.flatnonzero(np.diff(codes, prepend=width(-1)))
        codes, counts = codes[starts], np.diff(starts, append=len(codes))
        begin = np.flatnonzero(np.diff(codes // keys, prepend=-1))
        who = codes[begin] // keys
        kind = np.where(who < len(words), WORD, np.where(who == len(words), END, ENDING))
        names = np.concatenate([words.view(np.int64), [0], np.arange(ENDINGS)])
        often = np.isin(names[who], hot) | (kind != WORD)
        made.append(
            pa.table(
                {
                    "kind": pa.array(kind.astype(np.int32)),
                    "word": pa.array(names[who]),
                    "own": pa.array(np.concatenate([of, of_ending])[who].astype(np.int32)),
                    "near": _packed_entries(codes % keys, counts, np.append(begin, len(codes))),
                    "part": pa.array(np.where(often, 1 + row["chunk"] % PARTS, 0).astype(np.int32)),
                }
            )
        )
    return pa.concat_tables(made)


NEIGHBOURS = [
    ("kind", pa.int32()), ("word", pa.int64()), ("own", pa.int32()), ("near", pa.binary()), ("part", pa.int32()),
]

# A class beside a unit and how often, in nine bytes.
ENTRY = np.dtype([("key", "u1"), ("n", "<i8")])


def _packed_entries(keys: np.ndarray, counts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Entries ``ends[i]`` to ``ends[i + 1]`` as the i-th value."""
    entries = np.empty(len(keys), ENTRY)
    entries["key"], entries["n"] = keys, counts
    offsets = pa.py_buffer((ends * ENTRY.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(entries.tobytes())])


def _entries(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The entries of all values, one after the other, and where each value ends."""
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    data = packed.buffers()[2]
    raw = data[int(offsets[0]) : int(offsets[-1])] if data is not None and len(packed) else b""
    return np.frombuffer(raw, ENTRY), (offsets - offsets[0]) // ENTRY.itemsize


def _summed(batches):
    """Rows sorted by kind and word to one row for each: entries of one key are added.

    A batch's last unit may go on in the next one; that unit's sum is all that is kept between.
    """
    names = ["kind", "word", "own", "near", "part"]

    def batch_of(kind, word, own, keys, counts, ends, parts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(word), pa.array(own), _packed_entries(keys, counts, ends), pa.array(parts)], names=names
        )

    waiting = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        kind, word, own, part = (batch.column(i).to_numpy() for i in (0, 1, 2, 4))
        entries, ends = _entries(batch.column(3))
        size = np.diff(ends)
        keys, counts = entries["key"].astype(np.int64), entries["n"].astype(np.int64)
        if waiting is not None:
            kind, word, own, part = (np.concatenate([w, x]) for w, x in zip(waiting[:4], (kind, word, own, part)))
            keys, counts = np.concatenate([waiting[4], keys]), np.concatenate([waiting[5], counts])
            size = np.concatenate([[len(waiting[4])], size])
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (kind[1:] != kind[:-1])
        unit = np.cumsum(new) - 1
        codes, inverse = np.unique(np.repeat(unit, size) * 256 + keys, return_inverse=True)
        total = np.zeros(len(codes), np.int64)
        np.add.at(total, inverse, counts)
        ends = np.searchsorted(codes, np.arange(unit[-1] + 2) * 256)
        first = np.flatnonzero(new)
        last = ends[-2]
        waiting = (kind[first[-1:]], word[first[-1:]], own[first[-1:]], part[first[-1:]], codes[last:] % 256, total[last:])
        if len(first) > 1:
            f = first[:-1]
            yield batch_of(kind[f], word[f], own[f], codes[:last] % 256, total[:last], ends[:-1], part[f])
    if waiting is not None:
        kind, word, own, part, keys, counts = waiting
        yield batch_of(kind, word, own, keys, counts, np.array([0, len(keys)]), part)


def _pair_sums(batches, classes: int):
    """``(own, key, n)``: how often a class stands before another, of a task's units."""
    total = np.zeros(classes * classes, np.int64)
    for batch in batches:
        if batch.num_rows:
            own = batch.column(0).to_numpy().astype(np.int64)
            entries, ends = _entries(batch.column(1))
            code = np.repeat(own, np.diff(ends)) * classes + entries["key"]
            after = entries["key"] < classes
            np.add.at(total, code[after], entries["n"][after])
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used // classes), pa.array(used % classes), pa.array(total[used])], names=["own", "key", "n"]
    )


def _matrix(rows: list, classes: int) -> np.ndarray:
    pair = np.zeros((classes, classes))
    for own, key, n in rows:
        pair[own, key] = n
    return pair


def all_classes(
    chunks: DataFrame, units: DataFrame, of_ending: np.ndarray, classes: int, hot: np.ndarray, halves: int = HALVES
):
    """``(units, of_ending, pair)`` after exchange of all units in parallel.

    ``units (word, class)`` are the words that are units, ``of_ending`` the classes of the others.
    Half of the units move at a time, by counts taken before any of them did. A turn that lowers
    the likelihood is taken back and ends the exchange. A unit's counts in a chunk are one packed
    row; rows of one unit meet sorted and are added as they pass. Those of the ``hot`` words, of
    the endings and of the end of text are in every chunk, so they are added in parts before.
    """
    if 2 * classes + 1 > 256:
        raise ValueError("a class beside a unit has one byte: 127 classes at most")
    spark = chunks.sparkSession
    each = chunk_words(chunks).filter("n > 0").select("word", "chunk", "number")
    rows = chunks.select("chunk", "held", "lengths", "ids", "words", "endings").groupBy("chunk")
    best = None
    for turn in range(halves + 1):
        answers = each.join(units, "word").select(
            "chunk", "number", F.col("class").cast("double").alias("class")
        )
        both = rows.cogroup(answers.groupBy("chunk"))

        def counted(fn, of=of_ending):
            return lambda key, left, right: fn(key, left, right, of_ending=of, classes=classes)

        if turn == halves:
            made = both.applyInArrow(counted(_pairs), "own long, key long, n long")
        else:
            packed = "kind int, word long, own int, near binary, part int"
            made = both.applyInArrow(counted(partial(_neighbours, hot=hot)), packed)
            made = made.repartition("word", "part").sortWithinPartitions("kind", "word")
            folder = shared_dir(spark, "lm_parts")
            parts = store(made.mapInArrow(_summed, packed), folder)
            met = parts.filter("part > 0").repartition("word").sortWithinPartitions("kind", "word")
            near = parts.filter("part = 0").unionByName(met.mapInArrow(_summed, packed))
            made = near.select("own", "near").mapInArrow(partial(_pair_sums, classes=classes), "own long, key long, n long")
        pair = _matrix(made.groupBy("own", "key").agg(F.sum("n")).collect(), classes)
        value = likelihood(pair)
        if best and value <= best[0]:
            if turn < halves:
                remove(spark, folder)
            break
        best = value, units, of_ending, pair
        if turn < halves:
            chosen = near.filter(F.col("kind") != END).select("kind", "word", "own", "near").mapInArrow(
                partial(_choose, pair=pair, half=turn % 2), "kind int, word long, class int"
            )
            chosen = keep_table(chosen, "lm_classes")
            units = chosen.filter(F.col("kind") == WORD).select("word", "class")
            of_ending = of_ending.copy()
            for r in chosen.filter(F.col("kind") == ENDING).collect():
                of_ending[r["word"]] = r["class"]
            remove(spark, folder)
    return best[1:]


class Model:
    """Class of each starting unit, and log10 tables by class; all of a size that the corpus doesn't change.

    Made from the frequent words and the endings; :meth:`refine` gives it the classes of all units.
    """

    def __init__(self, frequent, frequent_counts, endings, bigrams, texts, words, distinct, classes):
        """``endings``: ending -> (words, distinct words, words seen once, words seen twice)."""
        self.total = int(words + texts)
        self.distinct = int(distinct + (texts > 0))
        self.texts = int(texts)
        units = len(frequent) + ENDINGS + 1
        self.of = exchange(bigrams, classes) if bigrams.sum() else np.zeros(units, dtype=int)
        one = np.eye(classes)[self.of]
        emitted = [(c, n, 1, 0, 0) for c, n in zip(self.of, frequent_counts)]
        emitted += [(self.of[len(frequent) + e], *n) for e, n in endings.items()]
        self.refine(self.of[len(frequent) : -1], one.T @ bigrams @ one, emitted)

    def refine(self, of_ending, pair, emitted) -> None:
        """``emitted``: rows of class, words, distinct words, words seen once, words seen twice."""
        classes = len(pair)
        self.of_ending = of_ending
        share = (pair.sum(axis=0) + 1) / (pair.sum() + classes)
        self.step = np.log10(
            (pair + PRIOR * share[None, :]) / (pair.sum(axis=1, keepdims=True) + PRIOR)
        )
        # Absolute discounting: what is taken from seen words is left to one unseen word.
        mass, kinds, once, twice = (np.zeros(classes) for _ in range(4))
        for c, n, v, n1, n2 in emitted:
            mass[c] += n
            kinds[c] += v
            once[c] += n1
            twice[c] += n2
        mass[self.of[-1]] += self.texts
        kinds[self.of[-1]] += 1
        self.cut = np.where(once > 0, np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9), 0.5)
        # Unseen words have the class of their ending, so other classes leave nothing to them.
        self.cut[np.setdiff1d(np.arange(classes), of_ending)] = 0
        self.mass = np.maximum(mass, 1)
        unseen = self.cut * np.maximum(kinds, 1) / self.mass
        self.unseen = np.log10(np.clip(unseen, 1e-300, 1))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.total + self.distinct + 1))

    def emitted(self, units: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.emitted_by(self.of[units], counts)

    def emitted_by(self, of: np.ndarray, counts: np.ndarray) -> np.ndarray:
        seen = np.log10(np.maximum(counts - self.cut[of], 0.05) / self.mass[of])
        return np.where(counts > 0, seen, self.unseen[of])


def _score(key, chunks: pa.Table, answers: pa.Table, model: Model):
    out = []
    for row in chunks.to_pylist():
        number, document, words = _texts(row)
        counts = np.zeros(len(words), np.int64)
        counts[answers["number"].to_numpy()] = answers["c"].to_numpy()
        counts = np.append(counts, model.texts)
        of, _ = _classes(row, words, answers, model.of_ending)
        base, own = model.base(counts), model.emitted_by(of, counts)
        at = of[number]
        before = np.concatenate([[0], at[:-1]])
        score = own[number] + model.step[before, at]
        n = len(row["doc_ids"])
        base_score = np.bincount(document, base[number], n)
        out.append(
            pa.table(
                {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "held_out": pa.array(row["held"], pa.bool_()),
                    "n_tokens": pa.array(np.bincount(document, minlength=n)),
                    "n_known": pa.array(
                        np.bincount(document, counts[number] > 0, n).astype(np.int64)
                    ),
                    "train_tokens": pa.array(np.full(n, model.total)),
                    "base_score": pa.array(base_score),
                    "score": pa.array(
                        np.bincount(document, score, n) if model.total else base_score
                    ),
                }
            )
        )
    return pa.concat_tables(out) if out else SCORES.empty_table()


SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def score_documents(
    docs: DataFrame,
    share: float = SHARE,
    classes: int = CLASSES,
    chunk_words_: int = CHUNK_WORDS,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` by document.

    ``held_out`` are rows whose crc32 of the id modulo 7 is 2; a null id is not. ``base_score``
    is the log10 probability under add-one word counts, ``score`` under the class model; both
    cover the words and one end of text, and treat an unseen word as one word more. A null text
    counts as empty: it has the end only. Without training rows ``score`` is ``base_score``.
    """
    spark = docs.sparkSession
    held = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    texts = rows.filter(~F.col("held_out")).count()
    chunks = chunk_table(rows, chunk_words_)
    each = chunk_words(chunks)
    counts = each.filter("n > 0").groupBy("word", "ending").agg(F.sum("n").alias("c"))
    counts = keep_table(counts, "lm_counts")
    words, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    words, distinct = words or 0, distinct or 0
    least = max(1, share * (words + texts))
    # Each of these has a share of at least ``share``, so there are at most 1 / share.
    top = counts.filter(F.col("c") >= least).select("word", "c").collect()
    found = sorted((r["word"] % 2**64, r["c"]) for r in top)
    frequent = np.array([w for w, _ in found], dtype=np.uint64)
    frequent_counts = np.array([c for _, c in found], dtype=np.int64)
    rare = counts.filter(F.col("c") < least)
    once, twice = [F.sum((F.col("c") == k).cast("long")) for k in (1, 2)]
    endings = {
        r[0]: tuple(r)[1:]
        for r in rare.groupBy("ending").agg(F.sum("c"), F.count("*"), once, twice).collect()
    }
    pairs = (
        chunks.select("held", "lengths", "ids", "words", "endings")
        .mapInArrow(partial(_bigrams, frequent=frequent), "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    units = len(frequent) + ENDINGS + 1
    bigrams = np.zeros(units * units)
    bigrams[pairs["pair"].to_numpy(dtype=int)] = pairs["n"].to_numpy(dtype=float)
    model = Model(
        frequent, frequent_counts, endings, bigrams.reshape(units, units), texts, words, distinct, classes
    )
    # Words that are units start in the class that their place among the frequent or ending has.
    own = counts.filter(F.col("c") >= min(LEAST_COUNT, least))
    given = [(int(w), int(c)) for w, c in zip(frequent.view(np.int64), model.of)]
    named = spark.createDataFrame(given, "word long, own int")
    starts = F.element_at(F.array(*[F.lit(int(c)) for c in model.of_ending]), F.col("ending") + 1)
    own = own.join(F.broadcast(named), "word", "left").select(
        "word", F.coalesce("own", starts).alias("class")
    )
    own = keep_table(own, "lm_classes")
    classed = counts.withColumn("class", F.lit(None).cast("int"))
    if bigrams.any():
        own, of_ending, pair = all_classes(chunks, own, model.of_ending, classes, frequent.view(np.int64))
        classed = keep_table(counts.join(own, "word", "left").select("word", "ending", "c", "class"), "lm_classed")
        other = F.element_at(F.array(*[F.lit(int(c)) for c in of_ending]), F.col("ending") + 1)
        sums = classed.groupBy(F.coalesce("class", other).alias("class")).agg(
            F.sum("c"), F.count("*"), once, twice
        )
        model.refine(of_ending, pair, sums.collect())
    answers = each.select("word", "chunk", "number").join(classed, "word").select(
        "chunk", "number", "c", F.col("class").cast("double").alias("class")
    )
    names = ["chunk", "doc_ids", "held", "lengths", "ids", "words", "endings"]
    together = chunks.select(*names).groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return together.applyInArrow(
        lambda key, left, right: _score(key, left, right, model),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
