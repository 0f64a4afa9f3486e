"""Mixing sources to target weights in fixed-length blocks of words.

The words of a source, its documents one after the other, are cut into blocks. The output is a
number of shards of slots; each shard draws how many of its slots go to which source, and slot j
of a source takes block ``permutation(j mod blocks)`` of it, so a source is used evenly: every
block once before any is used twice. Slots and blocks then meet in a join by (source, block).

The order of documents inside a source is a hash order, found with two sums: one over buckets of
a source, and one inside each bucket. So no task holds a whole source, however large.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postflow.llm import tokens as K
from postflow.llm.common import by_position, keep_table
from postflow.llm.quality_rules import let

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 128
SHARDS = 64
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BUCKET_ROWS = 2000


def targets(
    sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST
) -> list[float]:
    """Words wanted from each source: ``share`` of all words, divided by weight.

    A target stops at ``most`` times its source's size; what is over goes to the others by
    weight, until none is above.
    """
    wanted = [0.0] * len(sizes)
    open_ = {i for i, size in enumerate(sizes) if size > 0 and weights[i] > 0}
    left = share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / total >= most * sizes[i]}
        if not full:
            for i in open_:
                wanted[i] = left * weights[i] / total
            break
        for i in full:
            wanted[i] = most * sizes[i]
        left -= sum(wanted[i] for i in full)
        open_ -= full
    return wanted


def draw(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """``(shards, sources)`` slot counts: a multinomial draw for each shard.

    The draws are made without replacement from the slots that are left, which is a multinomial
    draw given the totals: the counts vary from shard to shard, their sums are as asked.
    """
    rng = np.random.default_rng(seed)
    left = np.array(slots, dtype=np.int64)
    counts = np.zeros((shards, len(left)), dtype=np.int64)
    for k in range(shards):
        size = int(left.sum()) // (shards - k)
        rest = size
        # One source after the other: a hypergeometric count given what the others have left.
        for s in range(len(left)):
            others = int(left[s + 1 :].sum())
            if rest:
                counts[k, s] = _hypergeometric(rng, int(left[s]), others, rest)
                rest -= counts[k, s]
        left -= counts[k]
    return counts


def _hypergeometric(rng, good: int, bad: int, size: int) -> int:
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, size)) if good + bad else 0
    # Beyond numpy's range: the binomial it converges to, within what is there.
    drawn = int(rng.binomial(size, good / (good + bad)))
    return max(size - bad, min(drawn, good, size))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of ``range(size)``, one for each ``key``, at ``index``.

    A four-round Feistel network over the next even number of bits; results outside the range
    walk on through the network until they are inside.
    """
    bits = np.maximum(1, np.ceil(np.ceil(np.log2(np.maximum(size, 2))) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        b, m, k = bits[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = out[todo] >> b, out[todo] & m
        for turn in range(4):
            noise = K.mixed(right + (k << np.uint64(3)) + np.uint64(turn)) & m
            left, right = right, left ^ noise
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _slots(frames, ends, starts, sources, jumps, blocks, seed):
    """Slot numbers to ``(shard, slot, source, block)``; the arrays have a cell per shard and source."""
    cells = len(ends)
    for frame in frames:
        t = frame["id"].to_numpy()
        cell = np.searchsorted(ends, t, "right")
        cell = np.minimum(cell, cells - 1)
        source = sources[cell]
        j = jumps[cell] + (t - starts[cell])
        size = blocks[source]
        block = permuted(j % size, size, source + np.int64(seed) * 1_000_003)
        yield pd.DataFrame(
            {
                "shard": cell // len(blocks),
                "slot": t,
                "source_no": source,
                "block": block,
            }
        )


def _ordered(rows: DataFrame) -> DataFrame:
    """Adds ``start``: the words of the source that come before this row, in hash order."""
    total = rows.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    rows = rows.withColumn("_bucket", F.pmod("_h", F.lit(buckets)))
    sums = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    # A source has a row for each bucket, so the sums over buckets go in two steps as well: over
    # ranges of buckets and inside a range, each of about the square root of their number.
    ranges = max(1, int(buckets**0.5))
    sums = sums.withColumn("_range", F.floor(F.col("_bucket") / F.lit(ranges)))
    outer = sums.groupBy("source", "_range").agg(F.sum("_sum").alias("_range_sum"))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    outer = outer.select(
        "source", "_range", F.coalesce(F.sum("_range_sum").over(before), F.lit(0)).alias("_base")
    )
    inner = Window.partitionBy("source", "_range").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = sums.withColumn("_within", F.coalesce(F.sum("_sum").over(inner), F.lit(0)))
    sums = sums.withColumnRenamed("source", "_s").withColumnRenamed("_range", "_r").withColumnRenamed("_bucket", "_b")
    match = sums["_s"].eqNullSafe(outer["source"]) & (sums["_r"] == outer["_range"])
    offsets = sums.join(outer, match).select("_s", "_b", (F.col("_within") + F.col("_base")).alias("_before"))
    own = Window.partitionBy("source", "_bucket").orderBy("_h", "_g", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    rows = rows.withColumn("_own", F.coalesce(F.sum("size").over(own), F.lit(0)))
    match = rows["source"].eqNullSafe(offsets["_s"]) & (rows["_bucket"] == offsets["_b"])
    placed = rows.join(offsets, match)
    return placed.withColumn("start", F.col("_own") + F.col("_before")).drop(
        "_bucket", "_own", "_before", "_s", "_b", "_h", "_g"
    )


class Mix:
    """A mix of the sources of ``docs (doc_id, text, source)``.

    ``weights`` go to the sources in code-point order, null last, and repeat. A null source is a
    source of its own; documents without words belong to a source but give it nothing. Rows that
    repeat are documents of their own. The same rows give the same mix, whatever their order.
    The driver holds a row for each source, which a mixture sets weights for.
    """

    def __init__(
        self,
        docs: DataFrame,
        weights: tuple[float, ...] = WEIGHTS,
        share: float = SHARE,
        most: float = MOST,
        block: int = BLOCK,
        shards: int = SHARDS,
        seed: int = 1,
        texts: bool = False,
    ):
        self.spark, self.block, self.shards, self.seed = docs.sparkSession, block, shards, seed
        rows = docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            # Spread by id and text, so that equal ids or equal texts don't meet in one bucket.
            F.xxhash64("doc_id", "text").alias("_h"),
            F.xxhash64("text", "doc_id").alias("_g"),
            *(["text"] if texts else []),
        )
        self.documents = keep_table(_ordered(rows), "mix_documents")
        sizes = self.documents.groupBy("source").agg(F.sum("size").alias("size")).collect()
        sizes.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        self.names = [r["source"] for r in sizes]
        self.sizes = [r["size"] for r in sizes]
        given = [weights[i % len(weights)] for i in range(len(sizes))]
        self.targets = targets(self.sizes, given, share, most)
        self.blocks = [-(-size // block) for size in self.sizes]
        # A source's mean block is a little shorter than the others: its last one is not full.
        self.slots = [
            round(target * n / size) if size else 0
            for target, n, size in zip(self.targets, self.blocks, self.sizes)
        ]

    def sources(self) -> DataFrame:
        """``(source, source_no, source_size, target)``."""
        rows = list(zip(self.names, range(len(self.names)), self.sizes, self.targets))
        return self.spark.createDataFrame(
            rows, "source string, source_no long, source_size long, target double"
        )

    def slot_table(self) -> DataFrame:
        """``(shard, slot, source_no, block)``: the output slots and the blocks they take."""
        total = sum(self.slots)
        schema = "shard long, slot long, source_no long, block long"
        if not total:
            return self.spark.createDataFrame([], schema)
        counts = draw(self.slots, self.shards, self.seed)
        ends = np.cumsum(counts.reshape(-1))
        starts = ends - counts.reshape(-1)
        jumps = (np.cumsum(counts, axis=0) - counts).reshape(-1)
        sources = np.tile(np.arange(len(self.slots)), self.shards)
        make = partial(
            _slots,
            ends=ends,
            starts=starts,
            sources=sources,
            jumps=jumps,
            blocks=np.array(self.blocks, dtype=np.int64),
            seed=self.seed,
        )
        parts = max(1, -(-total // 500_000))
        return self.spark.range(0, total, 1, parts).mapInPandas(make, schema)

    def _numbered(self) -> DataFrame:
        """Documents with the number of their source."""
        own = self.sources().select(F.col("source").alias("_name"), "source_no")
        match = self.documents["source"].eqNullSafe(own["_name"])
        return self.documents.join(F.broadcast(own), match).drop("_name")

    def pieces(self, texts: bool = False) -> DataFrame:
        """A row for each block that a document with words has a part in.

        ``doc_id``, ``source_no``, ``start`` (of the document in its source), ``block``, and
        ``low``, ``high``: the words of the document that stand in the block; with ``texts`` also
        those ``words``, joined by a blank.
        """
        size, zero = F.lit(self.block).cast("long"), F.lit(0).cast("long")
        start = F.col("start")

        def part(block, words=None):
            low = F.greatest(block * size - start, zero)
            high = F.least((block + 1) * size - start, F.col("size"))
            fields = [block.alias("block"), low.alias("low"), high.alias("high")]
            if words is not None:
                own = F.slice(words, (low + 1).cast("int"), (high - low).cast("int"))
                fields.append(F.array_join(own, " ").alias("words"))
            return F.struct(*fields)

        first = F.expr(f"start div {self.block}")
        last = F.expr(f"(start + size - 1) div {self.block}")
        blocks = F.sequence(first, last)
        if texts:
            split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
            parts = let(split, lambda words: F.transform(blocks, lambda b: part(b, words)))
        else:
            parts = F.transform(blocks, lambda b: part(b))
        docs = self._numbered().filter("size > 0")
        return docs.select("doc_id", "source_no", "start", F.explode(parts).alias("p")).select(
            "doc_id", "source_no", "start", "p.*"
        )

    def mixed(self) -> DataFrame:
        """The mix: a row for each piece of each slot, with ``shard`` and ``slot``."""
        return self.slot_table().join(self.pieces(), ["source_no", "block"])

    def taken(self) -> DataFrame:
        """``(doc_id, source_no, start, taken)`` of the documents that the mix takes words of."""
        uses = self.slot_table().groupBy("source_no", "block").agg(F.count("*").alias("uses"))
        used = self.pieces().select(
            "source_no", "block", "start", (F.col("high") - F.col("low")).alias("words")
        )
        used = used.join(uses, ["source_no", "block"])
        return used.groupBy("source_no", "start").agg(
            F.sum(F.col("words") * F.col("uses")).alias("taken")
        )

    def report(self) -> DataFrame:
        """``(doc_id, source, size, source_size, target, taken)`` for every row of ``docs``."""
        docs = self._numbered()
        taken = self.taken().withColumn("size_", F.lit(True))
        # Documents without words share a start with the next one; they take nothing.
        empty = F.col("size") > 0
        docs = docs.withColumn("_full", empty)
        match = (
            (docs["source_no"] == taken["source_no"])
            & (docs["start"] == taken["start"])
            & (docs["_full"] == taken["size_"])
        )
        found = docs.join(taken, match, "left").select(
            docs["doc_id"], docs["source_no"], docs["size"], F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
        )
        return found.join(F.broadcast(self.sources()), "source_no").select(
            "doc_id", "source", "size", "source_size", "target", "taken"
        )

    def blocks_of_words(self) -> DataFrame:
        """``(shard, slot, source, block, n_words, doc_ids, text)``, a row for each output slot.

        ``text`` joins the words of the block by a blank. Needs ``texts=True``. A block is at most
        ``block`` words, so no group grows.
        """
        whole = self.pieces(texts=True)
        whole = whole.groupBy("source_no", "block").agg(
            F.sort_array(F.collect_list(F.struct("start", "doc_id", "words"))).alias("parts"),
            F.sum(F.col("high") - F.col("low")).alias("n_words"),
        )
        slots = self.slot_table().join(whole, ["source_no", "block"])
        return slots.join(F.broadcast(self.sources()), "source_no").select(
            "shard",
            "slot",
            "source",
            "block",
            "n_words",
            F.col("parts.doc_id").alias("doc_ids"),
            F.array_join("parts.words", " ").alias("text"),
        )


def mix_blocks(docs: DataFrame, **settings) -> DataFrame:
    """The blocks of a :class:`Mix` of ``docs``; extra columns are left behind."""
    plain = by_position(docs, ("doc_id", "text", "source")).select("doc_id", "text", "source")
    return Mix(plain, texts=True, **settings).blocks_of_words()
