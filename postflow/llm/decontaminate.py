"""Benchmark decontamination by suffix arrays of the training text.

Documents are scanned in shards of some megabytes. The words of a shard (64-bit hashes, with a
stop between documents) get a suffix array, and all suffixes of the benchmark items are looked up
in it at once by binary search, one more word at a time; a range of the array that survives its
item's window length gives all places of that window, and the deepest range the longest verbatim
match. A shard is a part of one task's input, so nothing is shuffled and no task holds more than
one shard. Only suffixes whose first word occurs in some item enter the array: the others match
nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm import tokens as K
from postflow.llm.common import by_position, small_batches

WINDOW = 10
CHUNK_WORDS = 1_000_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Items:
    """Benchmark items as words: ``word[begin[i]:begin[i + 1]]`` are those of item i."""

    ids: np.ndarray
    word: np.ndarray
    begin: np.ndarray
    window: int

    @staticmethod
    def of(rows: list[tuple], window: int) -> Items:
        """From ``(item_id, text)``; items without words are left out."""
        text = pa.array([r[1] or "" for r in rows], pa.string())
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        words, counts = [], []
        for part, data, offsets in K.slices(iter([batch])):
            row, word = K.words(data, offsets, K.ALNUM)
            words.append(word)
            counts.append(np.bincount(row, minlength=part.num_rows))
        count = np.concatenate(counts) if counts else np.zeros(0, int)
        ids = np.array([str(r[0]) if r[0] is not None else None for r in rows], dtype=object)
        begin = np.concatenate([[0], np.cumsum(count[count > 0])]).astype(np.int64)
        word = np.concatenate(words) if words else np.zeros(0, np.uint64)
        return Items(ids[count > 0], word, begin, window)


def suffix_array(word: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``word`` at ``starts``, sorted by their first ``depth`` words at least.

    Prefix doubling: suffixes are ranked by twice as many words in each round, and only those
    that still share a rank are sorted again.
    """
    n = len(word)
    _, rank = np.unique(word, return_inverse=True)
    rank = rank.astype(np.int64) + 1  # 0: past the end
    order = np.argsort(rank, kind="stable")
    # A rank is 1 + the place of its group's first suffix, so groups never overlap as they split.
    sorted_ = rank[order]
    first = np.ones(n, bool)
    first[1:] = sorted_[1:] != sorted_[:-1]
    begins = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = begins + 1
    done = 1
    while done < depth:
        shared = np.ones(n, bool)
        shared[:-1] = ~(first[:-1] & first[1:])
        shared[-1] = not first[-1]
        places = np.flatnonzero(shared)
        if not len(places):
            break
        at = order[places]
        follow = np.where(at + done < n, rank[np.minimum(at + done, n - 1)], 0)
        again = np.lexsort((follow, rank[at]))
        at, follow, group = at[again], follow[again], rank[at][again]
        order[places] = at
        new = np.ones(len(places), bool)
        new[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        first[places] |= new
        begins = np.maximum.accumulate(np.where(new, places, 0))
        rank[at] = begins + 1
        done *= 2
    wanted = np.zeros(n, bool)
    wanted[starts] = True
    return order[wanted[order]]


def narrowed(word, array, low, high, depth: int, wanted) -> tuple:
    """For each ``(low, high)`` range of ``array``, the part whose word at ``depth`` is wanted."""

    def bound(strict: bool) -> np.ndarray:
        a, b = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                return a
            mid = (a[open_] + b[open_]) >> 1
            there = array[mid] + depth
            value = word[np.minimum(there, len(word) - 1)]
            ended = there >= len(word)
            less = ended | (value <= wanted[open_] if strict else value < wanted[open_])
            a[open_[less]] = mid[less] + 1
            b[open_[~less]] = mid[~less]

    return bound(False), bound(True)


def search(word: np.ndarray, items: Items, stop: np.uint64) -> tuple:
    """``(places, sizes, item, longest, where)`` in one shard.

    ``places`` are word positions at which a window of ``sizes`` words of ``item`` stands;
    ``longest`` and ``where`` give, for each item, its longest match in words and one place of it.
    """
    lengths = np.diff(items.begin)
    none = np.zeros(0, np.int64)
    longest, where = np.zeros(len(lengths), np.int64), np.full(len(lengths), -1, np.int64)
    known = np.unique(items.word)
    if not len(word) or not len(known):
        return none, none, none, longest, where
    starts = np.flatnonzero(np.isin(word, known) & (word != stop))
    if not len(starts):
        return none, none, none, longest, where
    # Runs of known words are all that can match: the rest of the shard is cut out around them.
    keep = np.zeros(len(word) + 1, bool)
    keep[starts] = True
    keep[starts + 1] = True
    source = np.flatnonzero(keep[:-1])
    text = word[source].copy()
    text[~np.isin(source, starts, assume_unique=True)] = stop
    starts = np.flatnonzero(text != stop)
    array = suffix_array(text, starts, int(lengths.max()))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(items.word))
    left = items.begin[1:][owner] - at
    need = np.minimum(items.window, lengths)[owner]
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(array), np.int64)
    places, sizes, whose = [none], [none], [none]
    depth = 0
    while len(at):
        low, high = narrowed(text, array, low, high, depth, items.word[at + depth])
        depth += 1
        alive = low < high
        at, left, need, owner = at[alive], left[alive], need[alive], owner[alive]
        low, high = low[alive], high[alive]
        better = longest[owner] < depth
        longest[owner[better]] = depth
        where[owner[better]] = source[array[low[better]]]
        full = need == depth
        if full.any():
            count = (high - low)[full]
            first = np.cumsum(count) - count
            inner = np.arange(int(count.sum())) - np.repeat(first, count)
            places.append(source[array[inner + np.repeat(low[full], count)]])
            sizes.append(np.repeat(need[full], count))
            whose.append(np.repeat(owner[full], count))
        more = left > depth
        at, left, need, owner = at[more], left[more], need[more], owner[more]
        low, high = low[more], high[more]
    return np.concatenate(places), np.concatenate(sizes), np.concatenate(whose), longest, where


def _strings(groups: list, offsets) -> pa.ListArray:
    return K.list_array(pa.array(groups, pa.string()), offsets)


def _scan(batches, items: Items, first_pass: bool):
    stop = np.uint64(0)
    for rows, data, offsets in K.slices(batches):
        n = rows.num_rows
        row, hashed = K.words(data, offsets, K.ALNUM)
        # A stop after each document.
        count = np.bincount(row, minlength=n)
        begin = np.concatenate([[0], np.cumsum(count)])
        spot = np.arange(len(hashed)) + row
        word = np.full(len(hashed) + n, stop, np.uint64)
        word[spot] = hashed
        document = np.repeat(np.arange(n), count + 1)
        places, sizes, item, longest, where = search(word, items, stop)
        marks = np.zeros(len(word) + 1, np.int64)
        np.add.at(marks, places, 1)
        np.add.at(marks, places + sizes, -1)
        hit = np.cumsum(marks)[:-1] > 0
        edges = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
        low, high = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        span_row = document[low] if len(low) else low
        base = begin[span_row] + span_row
        spans = np.stack([low - base, high - base], axis=1) if len(low) else np.zeros((0, 2), int)
        found = np.unique(np.stack([document[places], item], axis=1), axis=0) if len(places) else np.zeros((0, 2), int)
        best = np.flatnonzero(longest > 0)
        best_row = document[where[best]] if len(best) else best
        order = np.argsort(best_row, kind="stable")
        best, best_row = best[order], best_row[order]
        span_lists = pa.ListArray.from_arrays(
            pa.array(K.first_of_rows(span_row, n), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(spans[:, 0], pa.int64()), pa.array(spans[:, 1], pa.int64())],
                names=["start", "end"],
            ),
        )
        item_lists = _strings(items.ids[found[:, 1]].tolist(), K.first_of_rows(found[:, 0], n))
        where_row = best_row
        match_lists = pa.ListArray.from_arrays(
            pa.array(K.first_of_rows(where_row, n), pa.int32()),
            pa.StructArray.from_arrays(
                [
                    pa.array(items.ids[best].tolist(), pa.string()),
                    pa.array(where[best] - (begin[where_row] + where_row), pa.int64()),
                    pa.array(longest[best], pa.int64()),
                ],
                names=["item_id", "start", "words"],
            ),
        )
        new = {"n_words": pa.array(count, pa.int64()), "spans": span_lists, "items": item_lists, "longest": match_lists}
        if not first_pass:
            for name in ("spans", "items", "longest"):
                old = rows.column(rows.schema.get_field_index(f"_{name}"))
                new[name] = pa.array(
                    [[*a, *b] for a, b in zip(old.to_pylist(), new[name].to_pylist())],
                    new[name].type,
                )
        plain = [c for c in rows.schema.names if c not in ("_n_words", "_spans", "_items", "_longest")]
        yield pa.RecordBatch.from_arrays(
            [*[rows.column(rows.schema.get_field_index(c)) for c in plain], *new.values()],
            names=[*plain, *[f"_{c}" for c in new]],
        )


RESULT = (
    "_n_words long, _spans array<struct<start:long,end:long>>, _items array<string>, "
    "_longest array<struct<item_id:string,start:long,words:long>>"
)


def benchmark_chunks(benchmark: DataFrame, window: int, chunk_words: int) -> list[Items]:
    """The items in chunks of about ``chunk_words`` words, which bounds what a task holds."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    spread = F.xxhash64("item_id", "text")
    words = items.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    chunks = max(1, -(-words // chunk_words))
    numbered = items.withColumn("chunk", F.pmod(spread, F.lit(chunks)))
    return [
        Items.of([(r["item_id"], r["text"]) for r in numbered.filter(F.col("chunk") == i).collect()], window)
        for i in range(chunks)
    ]


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """``docs`` with ``_n_words``, ``_spans``, ``_items`` and ``_longest``, row by row.

    ``_spans`` are word ranges that windows of items cover, ``_items`` the items with such
    windows, ``_longest`` the longest verbatim match of an item within a shard, at its place. A
    window is ``window`` consecutive words of an item, or all words of a shorter one. A null text
    has no words; an item without words matches nothing, nor does an empty benchmark. A benchmark
    of more than ``chunk_words`` words takes a further pass over the rows for each such part.
    """
    small_batches(docs.sparkSession)
    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields
    )
    found = docs
    for i, items in enumerate(benchmark_chunks(benchmark, window, chunk_words)):
        found = found.mapInArrow(partial(_scan, items=items, first_pass=i == 0), f"{fields}, {RESULT}")
    # Spans and items of several passes may touch or repeat.
    merged = F.aggregate(
        F.sort_array("_spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct(
            (
                acc["n"]
                + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(acc["end"], s["start"]))
            ).alias("n"),
            F.greatest(acc["end"], s["end"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    return found.withColumns(
        {"_n_hit": merged, "_items": F.array_sort(F.array_distinct("_items"))}
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items, spans, longest, contaminated)`` by document."""
    found = with_matches(docs.select("doc_id", "text"), benchmark, window)
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.col("_items").alias("items"),
        F.col("_spans").alias("spans"),
        F.col("_longest").alias("longest"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that hold no window of an item, columns as they are."""
    whole = by_position(docs)
    found = with_matches(whole, benchmark, window)
    return found.filter("_n_hit = 0").select(*whole.columns).toDF(*docs.columns)
