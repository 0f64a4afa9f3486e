"""Document fingerprints: SimHash, and all fingerprints within a Hamming radius.

The distinct words of a text vote on the bits of its fingerprint: each word's hash has a sign for
each bit, and its weight is ``(1 + ln count) * bytes``, in sixteenths, so that sums are exact and
equal texts have equal fingerprints. Long words weigh more as they tell texts apart better.

Near fingerprints are found with permuted block tables (Manku et al., "Detecting near-duplicates
for web crawling"): the bits are cut into ``radius + kept`` blocks, and as fingerprints within
the radius differ in ``radius`` blocks at most, they agree on some ``kept`` of them. Each choice
of ``kept`` blocks is a table; fingerprints that share a key there are compared in full.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postflow.llm import tokens as K
from postflow.llm.common import components, join_null_safe, keep_table, small_batches, text_id

BITS = 256
LANES = BITS // 64
RADIUS = 8
KEPT = 1
BLOCK = 2048
TERMS = 1 << 11

WORDS = [f"w{i}" for i in range(LANES)]
EDITED = [f"e{i}" for i in range(LANES)]
_SEEDS = np.arange(1, LANES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple:
    """``(row, term, weight)`` of the distinct words of each row, ascending by row."""
    lower = K.LOWER[data]
    row, start, end = K.word_spans(lower, offsets, K.ALNUM)
    term = K.span_hashes(lower, start, end)
    order = np.lexsort((term, row))
    row, term, size = row[order], term[order], (end - start)[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(row)))
    return row[first], term[first], np.rint(16 * (1 + np.log(count)) * size[first]).astype(np.int64)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``(rows, LANES)`` fingerprints; rows without a word have no bit set."""
    row, term, weight = terms(data, offsets)
    rows = len(offsets) - 1
    votes = np.zeros((rows, BITS), np.int64)
    # Two thousand terms at a time stay in the cache, and a very long text needs no more memory.
    for low in range(0, len(row), TERMS):
        r, t, w = (x[low : low + TERMS] for x in (row, term, weight))
        begin = np.flatnonzero(np.diff(r, prepend=-1))
        for lane in range(LANES):
            hashes = K.mixed(t + _SEEDS[lane])
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            signed = (2 * bits.astype(np.int64) - 1) * w[:, None]
            votes[r[begin], 64 * lane : 64 * lane + 64] += np.add.reduceat(signed, begin)
    return np.packbits(votes > 0, axis=1, bitorder="little").view(np.uint64).reshape(rows, LANES)


def of_texts(texts: pa.Array) -> np.ndarray:
    """Fingerprints of an Arrow array of texts; null counts as empty."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = [fingerprints(data, offsets) for _, data, offsets in K.slices(iter([batch]))]
    return np.concatenate([np.zeros((0, LANES), np.uint64), *parts])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bits, row by row."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _rows(ids: pa.Array, texts: list, prints: np.ndarray, nexts: list, next_prints: np.ndarray) -> list:
    """The columns of finished rows: all but what joins the parts of the order."""
    new = pa.array([edited(t, n) for t, n in zip(texts, nexts)], pa.large_string())
    new_prints = of_texts(new)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in new.to_pylist()]
    return [
        ids,
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array(digests, pa.string()),
        *[pa.array(prints[:, i].view(np.int64)) for i in range(LANES)],
        *[pa.array(new_prints[:, i].view(np.int64)) for i in range(LANES)],
        pa.array(likeness(prints, new_prints)),
        pa.array(likeness(prints, next_prints)),
    ]


ROW_SCHEMA = ", ".join(
    ["doc_id long, n_chars long, edited_sha256 string"]
    + [f"{name} long" for name in WORDS + EDITED]
    + ["near_edited double, near_next double"]
)
ROW_NAMES = [field.split()[0] for field in ROW_SCHEMA.split(", ")]


def _consecutive(batches):
    """Sorted rows to finished ones; the last row of a partition waits for the next partition.

    ``part`` is the partition, ``first`` and ``open`` mark its first and last row, which alone
    keep their text; an open row has its id and text only.
    """
    part = TaskContext.get().partitionId()
    names = [*ROW_NAMES, "part", "first", "open", "text"]

    def batch_of(columns: list, first: bool, open_: bool, own: list) -> pa.RecordBatch:
        n = len(columns[0])
        firsts = [first, *[False] * (n - 1)]
        text = [own[0] if first or open_ else None, *[None] * (n - 1)]
        marks = [pa.array([part] * n, pa.int32()), pa.array(firsts), pa.array([open_] * n), pa.array(text, pa.string())]
        return pa.RecordBatch.from_arrays([*columns, *marks], names=names)

    first = True
    ids, texts, prints = pa.array([], pa.int64()), [], np.zeros((0, LANES), np.uint64)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        text = batch.column(batch.schema.get_field_index("text")).fill_null("")
        new_ids = batch.column(batch.schema.get_field_index("doc_id"))
        ids = pa.concat_arrays([ids, new_ids])
        texts = [*texts, *text.to_pylist()]
        prints = np.concatenate([prints, of_texts(text)])
        if len(texts) > 1:
            columns = _rows(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
            yield batch_of(columns, first, False, texts)
            first = False
        ids, texts, prints = ids[-1:], texts[-1:], prints[-1:]
    if texts:
        nothing = [pa.nulls(1, kind) for kind in (pa.int64(), pa.string(), *[pa.int64()] * 2 * LANES, *[pa.float64()] * 2)]
        yield batch_of([ids, *nothing], first, True, texts)


def _close(batches):
    for batch in batches:
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        text, following = column("text").fill_null(""), column("following").fill_null("")
        columns = _rows(
            column("doc_id"), text.to_pylist(), of_texts(text), following.to_pylist(), of_texts(following)
        )
        yield pa.RecordBatch.from_arrays(columns, names=ROW_NAMES)


def with_next(docs: DataFrame) -> DataFrame:
    """A row of :data:`ROW_SCHEMA` for each row of ``docs``, beside the next document.

    Documents follow one another by id (null last), then by a hash of the text; the last one is
    followed by the first. A row that repeats id and text is followed by its copy. The order is
    cut into ranges, in which a row meets the next; what is left over is one row for each range.
    """
    small_batches(docs.sparkSession)
    # The position tells copies apart, so that many of them don't fall into one range.
    rows = docs.select("doc_id", text_id(F.col("text")).alias("i"), F.monotonically_increasing_id().alias("at"), "text")
    order = [F.col("doc_id").asc_nulls_last(), F.col("i.h").asc(), F.col("i.g").asc(), F.col("at").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    made = rows.select("doc_id", "text").mapInArrow(
        _consecutive, f"{ROW_SCHEMA}, part int, first boolean, open boolean, text string"
    )
    made = keep_table(made, "consecutive")
    waiting = made.filter("open").select("part", "doc_id", "text")
    begins = made.filter("first").select(F.col("part").alias("next"), F.col("text").alias("following"))
    # A row for each range of the order, without texts.
    every = Window.orderBy("part")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = waiting.select("part").select(
        "part", F.coalesce(F.lead("part").over(every), F.min("part").over(whole)).alias("next")
    )
    pairs = waiting.join(parts, "part").join(begins, "next").select("doc_id", "text", "following")
    closed = pairs.mapInArrow(_close, ROW_SCHEMA)
    return made.filter("not open").select(*ROW_NAMES).unionByName(closed)


def distance(a: list[Column], b: list[Column]) -> Column:
    """Bits in which two fingerprints differ."""
    total = F.lit(0)
    for x, y in zip(a, b):
        total = total + F.bit_count(x.bitwiseXOR(y))
    return total


def block_masks(radius: int, kept: int, lanes: int = LANES) -> list[list[int]]:
    """A mask for each table: for each lane, the bits of the chosen blocks."""
    bits, blocks = 64 * lanes, radius + kept
    if not 0 < blocks <= bits:
        raise ValueError("more blocks than bits")
    ends = [bits * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), kept):
        mask = sum((1 << ends[i + 1]) - (1 << ends[i]) for i in chosen)
        masks.append([(mask >> 64 * lane) & (2**64 - 1) for lane in range(lanes)])
    return masks


def table_keys(words: list[Column], radius: int, kept: int) -> Column:
    """An array with the key of a fingerprint in each table."""
    keys = []
    for number, mask in enumerate(block_masks(radius, kept, len(words))):
        signed = [m - 2**64 if m >= 2**63 else m for m in mask]
        parts = [w.bitwiseAND(F.lit(m).cast("long")) for w, m in zip(words, signed) if m]
        keys.append(F.xxhash64(F.lit(number), *parts))
    return F.array(*keys)


def _links_of_cell(cell: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Links between fingerprints of a cell, as many as join what is apart."""
    words = cell[WORDS].to_numpy(np.int64).view(np.uint64)
    node, root = cell["node"].to_numpy(), cell["root"].to_numpy()
    parent = {r: r for r in root.tolist()}

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for i in range(len(words) - 1):
        near = np.bitwise_count(words[i + 1 :] ^ words[i]).sum(axis=1) <= radius
        for j in np.flatnonzero(near) + i + 1:
            a, b = top(root[i]), top(root[j])
            if a != b:
                parent[a] = b
                links.append((min(node[i], node[j]), max(node[i], node[j])))
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def near_fingerprints(nodes: DataFrame, radius: int = RADIUS, kept: int = KEPT, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links between nodes within ``radius`` bits, which join all that are within it.

    ``nodes`` is a stored table with distinct ``node`` (long) and fingerprint ``w0`` to ``w3``.
    A key of any table first compares its members with its least one. Where that leaves a key's
    members apart, they are compared in cells of two blocks of ``block`` members at most; a cell
    gives only links that join something. So a crowd of near fingerprints makes a link for each,
    not one for each pair, and no pair that shares a key is left open.
    """
    keys = table_keys([F.col(w) for w in WORDS], radius, kept)
    keyed = nodes.select("node", F.explode(keys).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z")
    members = keep_table(keyed.join(shared.select("key", "a"), "key"), "members")

    prints = lambda name: nodes.select(F.col("node").alias(name), F.struct(*WORDS).alias(f"p{name}"))
    pairs = members.filter("node != a").select("a", F.col("node").alias("b")).distinct()
    both = pairs.join(prints("a"), "a").join(prints("b"), "b")
    fields = lambda name: [F.col(f"p{name}.{w}") for w in WORDS]
    links = keep_table(both.filter(distance(fields("a"), fields("b")) <= radius).select("a", "b"), "print_links")

    label = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    labelled = members.select("key", "node").join(label, "node", "left")
    labelled = keep_table(labelled.select("key", "node", F.coalesce("root", "node").alias("root")), "print_labels")
    apart = labelled.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")
    )
    # The two members of a key of two have met already.
    apart = apart.filter("lo < hi and n > 2").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    spread = labelled.join(apart, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell")
    cells = spread.select(cell, "node", "root").join(nodes.select("node", *WORDS), "node")
    found = cells.groupBy("cell").applyInPandas(
        lambda pdf: _links_of_cell(pdf, radius), "a long, b long"
    )
    return links.unionByName(keep_table(found, "cell_links"))


def with_classes(rows: DataFrame, radius: int = RADIUS, kept: int = KEPT) -> DataFrame:
    """``rows`` (stored; ``doc_id`` and fingerprint ``w0`` to ``w3``) with ``class_id``.

    That is the smallest id of the documents whose fingerprints are within ``radius`` bits,
    directly or through others; null if all of them have none. Equal fingerprints merge first.
    """
    nodes = rows.groupBy(*WORDS).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    nodes = keep_table(nodes.withColumn("node", F.monotonically_increasing_id()), "prints")
    roots = components(near_fingerprints(nodes, radius, kept))
    named = keep_table(join_null_safe(nodes, roots, ["node"], "left"), "named_prints")
    ids = named.groupBy("root").agg(F.min("rep").alias("least")).filter("root is not null")
    # A fingerprint of one document without near ones is its own class.
    named = named.filter("n > 1 or root is not null").join(ids, "root", "left")
    named = named.select(*WORDS, F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("least")).alias("_class"), F.lit(True).alias("_known"))
    joined = rows.join(named, WORDS, "left")
    found = F.when(F.col("_known"), F.col("_class")).otherwise(F.col("doc_id")).alias("class_id")
    return joined.select(*[rows[c] for c in rows.columns], found)


def hex_of(words: list[str]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(F.col(w)), 16, "0") for w in words]))


def fingerprint_report(docs: DataFrame, radius: int = RADIUS, kept: int = KEPT) -> DataFrame:
    """Fingerprints of the texts of ``docs`` and of their edited texts, a row for each row.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    class_id)``: fingerprints are 64 hexadecimal digits, the edited text is :func:`edited` with the
    next document of :func:`with_next`, and likeness is the share of equal bits. ``class_id`` is
    that of :func:`with_classes`.

    Null texts count as empty; texts without a letter or digit have the fingerprint 0. A single
    document follows itself; an empty table gives no rows. Other columns are not looked at.
    """
    rows = keep_table(with_next(docs.select("doc_id", "text")), "fingerprints")
    return with_classes(rows, radius, kept).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_of(WORDS).alias("fingerprint"),
        hex_of(EDITED).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "class_id",
    )
