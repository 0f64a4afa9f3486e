"""Near-duplicate documents: ProbMinHash signatures, banding, verification, components.

A document is its multiset of five-word shingles, weighed by count; the similarity is the
probability Jaccard of the weights (the plain Jaccard where no shingle repeats):
the sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i). A text of fewer words is one
shingle; a text without words has none and is like no other text, only like its exact copies.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm import tokens as K
from postflow.llm.common import by_position, components, join_null_safe, keep_table, small_batches, text_id

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
BLOCK = 512

_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple:
    """``(row, shingle, count)`` of the distinct shingles of each row, in no order by row."""
    row, word = K.words(data, offsets, K.ALNUM)
    total, n = np.zeros(len(row), np.uint64), len(row)
    whole = np.ones(n, bool)
    factor = np.ones(1, np.uint64)
    for j in range(size):
        same = np.zeros(n, bool)
        same[: n - j] = row[j:] == row[: n - j]
        part = np.zeros(n, np.uint64)
        part[: n - j] = word[j:]
        total += np.where(same, part, np.uint64(0)) * factor
        whole &= same
        factor = factor * _STEP
    first = K.first_of_rows(row, len(offsets) - 1)
    short = (first[1:] > first[:-1]) & (first[1:] - first[:-1] < size)
    whole[first[:-1][short]] = True
    row, shingle = row[whole], K.mixed(total[whole])
    _, index, count = np.unique(
        shingle ^ K.mixed(row.astype(np.uint64) + _STEP), return_index=True, return_counts=True
    )
    return row[index], shingle[index], count


def weights(data: np.ndarray, offsets: np.ndarray) -> tuple:
    """``(row, shingle, weight)``: the weights of a row add up to 1."""
    row, shingle, count = shingles(data, offsets)
    total = np.bincount(row, count, len(offsets) - 1)
    return row, shingle, count / total[row]


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, size: int):
    """``(rows, size)`` signature of shingles.

    Each shingle is a Poisson process whose rate is its weight; an arrival picks a component, and
    the earliest arrival of a component names it. A shingle stops once its time has passed the
    latest component of its row, so the work is near ``size * log(size)`` arrivals beyond one for
    each shingle.
    """
    times = np.full(rows * size, np.inf)
    names = np.zeros(rows * size, np.uint64)
    base, seed, rate = row.astype(np.int64) * size, shingle, weight
    at = np.zeros(len(row))
    done = 0
    while len(base):
        # Several arrivals at once where few shingles are left.
        block = int(min(64, max(1, 100_000 // len(base))))
        turn = np.arange(done, done + block, dtype=np.uint64)
        noise = K.mixed(seed[:, None] + (turn * _STEP)[None, :] + np.uint64(1))
        gap = -np.log1p(-(noise >> np.uint64(11)).astype(float) * 2.0**-53)
        when = at[:, None] + np.cumsum(gap / rate[:, None], axis=1)
        place = base[:, None] + (K.mixed(noise) % np.uint64(size)).astype(np.int64)
        early = when < times[place]
        if early.any():
            spot, moment = place[early], when[early]
            np.minimum.at(times, spot, moment)
            won = times[spot] == moment
            names[spot[won]] = np.broadcast_to(seed[:, None], early.shape)[early][won]
        done += block
        last = times.reshape(rows, size).max(axis=1)
        open_ = when[:, -1] < last[base // size]
        base, seed, rate, at = base[open_], seed[open_], rate[open_], when[open_, -1]
    return names.reshape(rows, size)


def bands_of(names: np.ndarray, bands: int, each: int) -> np.ndarray:
    """A 64-bit key for each row and band."""
    keys = np.zeros((len(names), bands), np.uint64)
    parts = names.reshape(len(names), bands, each)
    for j in range(each):
        keys = K.mixed(keys * _STEP + parts[:, :, j])
    return K.mixed(keys + np.arange(bands, dtype=np.uint64)[None, :] * _STEP)


def _sign(batches, bands: int, each: int):
    for rows, data, offsets in K.slices(batches):
        row, shingle, weight = weights(data, offsets)
        n = rows.num_rows
        keys = bands_of(signatures(row, shingle, weight, n, bands * each), bands, each)
        full = np.bincount(row, minlength=n) > 0
        lists = K.list_array(
            pa.array(keys[full].view(np.int64).reshape(-1)),
            np.concatenate([[0], np.cumsum(full * bands)]),
        )
        yield pa.RecordBatch.from_arrays(
            [*rows.drop_columns("text").columns, lists],
            names=[*[c for c in rows.schema.names if c != "text"], "bands"],
        )


def similarities(left: tuple, right: tuple, rows: int) -> np.ndarray:
    """Probability Jaccard, row by row, of two results of :func:`weights`."""
    row = np.concatenate([left[0], right[0]])
    shingle = np.concatenate([left[1], right[1]])
    side = np.repeat([0, 1], [len(left[0]), len(right[0])])
    weight = np.concatenate([left[2], right[2]])
    order = np.lexsort((side, shingle, row))
    row, shingle, side, weight = row[order], shingle[order], side[order], weight[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    group = np.cumsum(new) - 1
    n = int(new.sum())
    x = np.bincount(group, np.where(side == 0, weight, 0), n)
    y = np.bincount(group, np.where(side == 1, weight, 0), n)
    row = row[new]
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = y / x
        order = np.lexsort((ratio, row))
        row, x, y, ratio = row[order], x[order], y[order], ratio[order]
        first = K.first_of_rows(row, rows)
        up_to_x = np.cumsum(x) - np.concatenate([[0], np.cumsum(x)])[first[row]]
        up_to_y = np.cumsum(y) - np.concatenate([[0], np.cumsum(y)])[first[row]]
        total_y = np.bincount(row, y, rows)
        term = x / (up_to_x + (total_y[row] - up_to_y) / ratio)
    return np.bincount(row, np.where((x > 0) & (y > 0), term, 0), rows)


def _verify(batches, least: float):
    for rows, data, offsets in K.slices(batches, "text_a"):
        left = weights(data, offsets)
        other = [x for x in K.slices(iter([rows]), "text_b")]
        at = 0
        for part, data_b, offsets_b in other:
            n = part.num_rows
            own = (left[0] >= at) & (left[0] < at + n)
            score = similarities(
                (left[0][own] - at, left[1][own], left[2][own]), weights(data_b, offsets_b), n
            )
            at += n
            kept = pa.array(score >= least - 1e-9)
            yield part.select(["a", "b"]).filter(kept)


def _sorted_by_row(parts: list[tuple]) -> tuple:
    row = np.concatenate([p[0] for p in parts])
    order = np.argsort(row, kind="stable")
    return row[order], *[np.concatenate([p[i] for p in parts])[order] for i in (1, 2)]


def _common_mass(number: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """``[u, v]``: the weight in u of the shingles that u and v share; ``number`` is ascending."""
    total = np.zeros((rows, rows), np.float32)
    last = int(number[-1]) + 1 if len(number) else 0
    for low in range(0, last, 4096):
        a, b = np.searchsorted(number, [low, low + 4096])
        heavy = np.zeros((rows, 4096), np.float32)
        heavy[row[a:b], number[a:b] - low] = weight[a:b]
        total += heavy @ (heavy > 0).astype(np.float32).T
    return total


def _forest(nodes, roots, row, shingle, weight, least: float) -> list[tuple[int, int]]:
    """Links between documents of one cell, as many as join what is apart."""
    rows = len(nodes)
    _, number, count = np.unique(shingle, return_inverse=True, return_counts=True)
    shared = count[number] > 1
    _, number = np.unique(number[shared], return_inverse=True)
    order = np.argsort(number, kind="stable")
    p = _common_mass(number[order], row[shared][order], weight[shared][order], rows).astype(float)
    q = p.T
    # With common weights p and q the similarity is at most this; it is this for plain sets.
    bound = np.triu(p * q / np.maximum(p + q - p * q, 1e-12), 1)
    bound[roots[:, None] == roots[None, :]] = 0
    u, v = np.nonzero(bound >= least - 1e-4)
    first = K.first_of_rows(row, rows)
    parent = {r: r for r in roots.tolist()}

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for i in np.argsort(-bound[u, v], kind="stable"):
        a, b = top(int(roots[u[i]])), top(int(roots[v[i]]))
        if a != b:
            pair = [
                (np.zeros(first[x + 1] - first[x], int), shingle[first[x] : first[x + 1]], weight[first[x] : first[x + 1]])
                for x in (u[i], v[i])
            ]
            if similarities(*pair, 1)[0] >= least - 1e-9:
                parent[a] = b
                links.append(tuple(sorted((int(nodes[u[i]]), int(nodes[v[i]])))))
    return links


def _compare_cells(batches, least: float):
    """Rows sorted by ``cell`` to the links of :func:`_forest`, cell by cell."""

    def links(table: pa.Table):
        cell = table["cell"].to_numpy()
        nodes, roots = table["node"].to_numpy(), table["root"].to_numpy()
        parts, base = [], 0
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for rows, data, offsets in K.slices(iter([batch])):
                row, shingle, weight = weights(data, offsets)
                parts.append((row + base, shingle, weight))
                base += rows.num_rows
        row, shingle, weight = _sorted_by_row(parts)
        begin = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1))
        for low, high in zip(begin, np.append(begin[1:], len(cell))):
            a, b = np.searchsorted(row, [low, high])
            yield from _forest(
                nodes[low:high], roots[low:high], row[a:b] - low, shingle[a:b], weight[a:b], least
            )

    def batch_of(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cell = batch.column(batch.schema.get_field_index("cell")).to_numpy()
        # The last cell may go on in the next batch.
        last = int(np.searchsorted(cell != cell[-1], False)) if cell[0] == cell[-1] else int(
            np.flatnonzero(cell != cell[-1])[-1] + 1
        )
        begun = waiting and waiting[-1].column(0)[-1].as_py() != cell[0]
        if last or begun:
            yield batch_of(list(links(pa.Table.from_batches([*waiting, batch.slice(0, last)]))))
            waiting = []
        waiting.append(batch.slice(last))
    if waiting:
        yield batch_of(list(links(pa.Table.from_batches(waiting))))


def signature_table(docs: DataFrame, bands: int = BANDS, each: int = ROWS) -> DataFrame:
    """``(doc_id, h, g, bands)``: text identity and band keys, a row for each document."""
    small_batches(docs.sparkSession)
    slim = docs.select("doc_id", text_id(F.col("text")).alias("i"), "text")
    return slim.select("doc_id", "i.h", "i.g", "text").mapInArrow(
        partial(_sign, bands=bands, each=each), "doc_id long, h long, g long, bands array<long>"
    )


def near_duplicates(
    docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, each: int = ROWS, block: int = BLOCK
) -> DataFrame:
    """``(doc_id, h, g, root, class_id, copies)``: a row for each distinct (doc_id, text).

    ``class_id`` is the smallest ``doc_id`` of the documents linked with this one, directly or
    through others; links join texts that share a band and are at least ``least`` similar. Exact
    copies are merged first. ``copies`` counts the rows with this doc_id and text. A class whose
    documents all have a null id has a null ``class_id``; ``root`` numbers the class within this
    result.

    Each bucket first compares its members with one of them only. What a bucket still holds apart
    is then compared in cells of at most two blocks of ``block`` members, which give no more
    links than join them; so no pair of a bucket is left open, and a large bucket makes neither
    its pairs into rows nor a large task.
    """
    signed = keep_table(signature_table(docs, bands, each), "signatures")
    rows = signed.groupBy("doc_id", "h", "g").agg(F.count("*").alias("copies"))
    same = signed.groupBy("h", "g").agg(F.min("doc_id").alias("rep"))
    nodes = (
        signed.join(same, ["h", "g"])
        .filter(F.col("doc_id").eqNullSafe(F.col("rep")))
        .dropDuplicates(["h", "g"])
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = keep_table(nodes.select("node", "h", "g", "rep", "bands"), "nodes")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = shared.filter("lo < hi").select("key")
    members = keep_table(keyed.join(shared, "key"), "members")

    asked = members.select("node").distinct().join(nodes.drop("bands"), "node")
    texts = docs.select(text_id(F.col("text")).alias("i"), F.col("doc_id").alias("rep"), "text")
    texts = texts.select("i.h", "i.g", "rep", "text")
    match = [texts[c].eqNullSafe(asked[c]) for c in ("h", "g", "rep")]
    texts = texts.join(asked, match).select("node", "text").dropDuplicates(["node"])
    texts = keep_table(texts, "node_texts")

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(
            texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"
        ).join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        checked = both.select("a", "b", "text_a", "text_b").mapInArrow(
            partial(_verify, least=least), "a long, b long"
        )
        return keep_table(checked, "links")

    # Each bucket compares its members with one of them.
    centre = members.groupBy("key").agg(F.min("node").alias("a"))
    pairs = members.join(centre, "key").filter("node != a").select("a", F.col("node").alias("b"))
    links = verified(pairs.distinct())

    # Nodes with one label are linked, though not all linked nodes have one label yet: the
    # smallest neighbour, and its own smallest neighbour.
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
    next_ = near.select(F.col("node").alias("label"), F.col("label").alias("next"))
    near = near.join(next_, "label").select("node", F.least("label", "next").alias("label"))
    labelled = members.join(near, "node", "left")
    labelled = labelled.select("node", "key", F.coalesce("label", "node").alias("root"))
    labelled = keep_table(labelled, "labelled")

    apart = labelled.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")
    )
    # The two members of a bucket of two have met already.
    apart = apart.filter("lo < hi and n > 2")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = labelled.join(apart.select("key", blocks.alias("blocks")), "key")
    spread = spread.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    cell = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    cells = spread.select(cell.alias("cell"), "node", "root").join(texts, "node")
    cells = cells.select("cell", "node", "root", "text").repartition("cell").sortWithinPartitions("cell")
    found = cells.mapInArrow(partial(_compare_cells, least=least), "a long, b long")
    links = links.unionByName(keep_table(found, "links"))

    roots = components(links)
    named = join_null_safe(nodes, roots, ["node"], "left").select(
        "h", "g", "rep", F.coalesce("root", "node").alias("root")
    )
    named = keep_table(named, "named")
    classes = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    return rows.join(named.join(classes, "root"), ["h", "g"]).select(
        "doc_id", "h", "g", "root", "class_id", "copies"
    )


def keep_one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class: the one whose id names the class; columns stay as they are.

    Of rows that repeat id and text one stays, and one of those with a null id if all have none.
    """
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "g", "copies")
    chosen = near_duplicates(docs, least).groupBy("root").agg(F.min(first).alias("_first"))
    chosen = keep_table(chosen.select("_first"), "chosen")
    plain = by_position(docs)
    whole = plain.withColumn("_own", text_id(F.col("text")))
    match = whole["doc_id"].eqNullSafe(chosen["_first.doc_id"])
    for part in ("h", "g"):
        match &= whole[f"_own.{part}"] == chosen[f"_first.{part}"]
    kept = whole.join(chosen, match)
    single = kept.filter("_first.copies = 1").select(*plain.columns)
    repeated = kept.filter("_first.copies > 1").dropDuplicates(["doc_id", "_own"])
    return single.unionByName(repeated.select(*plain.columns)).toDF(*docs.columns)
