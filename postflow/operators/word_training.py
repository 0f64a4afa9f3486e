"""Skip-gram word vectors with hierarchical softmax for a vocabulary that no machine holds.

The same model as ``pyspark.ml``'s Word2Vec trains, whose vocabulary, codes and vectors are all on
the driver and in every task. Here they are tables by word. The rows are cut into chunks of a
bounded number of words, which stay where they are as numbers into a dictionary of their own; only
the dictionaries meet the vocabulary. A chunk is trained by one task, which holds the vectors and
the tree paths of its own words, and a word's vector is the mean over the chunks that hold it.

The Huffman tree is never written out. Words of equal counts are a run, and so are the inner nodes
made of them, so the tree is a short list of runs by which a task finds the path of any word.
"""

from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.base import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postflow.operators.joins import lookup_join
from postflow.sources.storage import remove, shared_dir, store

# Words of a chunk, about; a single longer row is a chunk of its own.
CHUNK_WORDS = 1_000_000
# As in pyspark.ml: the places next to a word, the longest sentence, the first rate of learning
# and its last share, and the products beyond which the sigmoid counts as flat.
WINDOW, SENTENCE, RATE, LAST, FLAT = 5, 1000, 0.025, 1e-4, 6.0
# Words sorted by the length of their paths at a time, words trained at once, by one drawn window,
# and the steps that one vector takes of these at most: more of them together would overshoot.
SORTED, AT_ONCE, STEPS = 8192, 512, 64
# Counts up to this one have many words each, so that their numbers are dealt by buckets.
COMMON, BUCKETS = 64, 64

_CHUNKS = "chunk long, rows binary, sizes binary, codes binary, words array<string>, counts array<long>"


def _coded(batches, limit: int, with_rows: bool):
    """A row for each chunk: its rows' ids, their numbers of words, the words by dictionary, this and its counts."""
    parts, held, made = [], 0, 0
    task = TaskContext.get().partitionId() << 32

    def chunk():
        lists = pa.chunked_array([p.column(0) for p in parts])
        found = lists.combine_chunks()
        found = pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found
        coded = found.flatten().dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        sizes = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int32)
        counts = np.bincount(codes[codes >= 0], minlength=len(coded.dictionary))
        rows = np.concatenate([p.column(1).to_numpy(zero_copy_only=False) for p in parts]) if with_rows else np.empty(0, np.int64)
        binary = [pa.array([x.tobytes()], pa.binary()) for x in (rows.astype(np.int64), sizes, codes)]
        whole = pa.array([0, len(counts)], pa.int32())
        lists = [pa.ListArray.from_arrays(whole, x) for x in (coded.dictionary.cast(pa.string()), pa.array(counts.astype(np.int64)))]
        names = ["chunk", "rows", "sizes", "codes", "words", "counts"]
        return pa.RecordBatch.from_arrays([pa.array([task + made], pa.int64()), *binary, *lists], names=names)

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = int(np.searchsorted(ends, before + limit - held, "right"))
            end = max(end, start if parts else start + 1)
            if end > start:
                parts.append(batch.slice(start, end - start))
                held += int(ends[end - 1] - before)
                start = end
            if start < batch.num_rows or held >= limit:
                yield chunk()
                parts, held, made = [], 0, made + 1
    if parts:
        yield chunk()


def chunks_of(df: DataFrame, words: str, row: str | None = None, limit: int = CHUNK_WORDS) -> DataFrame:
    """Stored chunks of the rows of ``df``, with the long column ``row`` of each. Nothing is shuffled."""
    columns = [F.col(words).alias("words")] + ([F.col(row).cast("long").alias("row")] if row else [])
    made = df.select(*columns).mapInArrow(lambda batches: _coded(batches, limit, row is not None), _CHUNKS)
    folder = shared_dir(df.sparkSession, "chunks")
    # A reader takes many rows of a file at once, and a row is a whole chunk.
    made.write.option("maxRecordsPerFile", 2).parquet(folder)
    return df.sparkSession.read.schema(made.schema).parquet(folder)


def listed_words(chunks: DataFrame) -> DataFrame:
    """``(chunk, at, word, n)``: the dictionaries of the chunks."""
    zipped = F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")
    return chunks.select("chunk", zipped).select("chunk", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))


def numbered_words(counts: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``(word, leaf)`` of stored ``(word, n)``, and the counts with their numbers of words.

    Leaves are numbered by ascending count. Of each count there is a row on the driver: as counts
    that differ add up, there are at most as many as the root of twice the words of the text.
    """
    bucket = F.when(F.col("n") <= COMMON, F.pmod(F.xxhash64("word"), F.lit(BUCKETS))).otherwise(0).cast("int")
    dealt = counts.withColumn("bucket", bucket)
    groups = dealt.groupBy("n", "bucket").agg(F.count("*").alias("words")).collect()
    groups = np.array(sorted(tuple(g) for g in groups), np.int64).reshape(-1, 3)
    first = np.cumsum(groups[:, 2]) - groups[:, 2]
    table = pa.table({"n": groups[:, 0], "bucket": groups[:, 1].astype(np.int32), "first": first})
    firsts = F.broadcast(counts.sparkSession.createDataFrame(table))
    place = F.row_number().over(Window.partitionBy("n", "bucket").orderBy("word"))
    leaves = dealt.withColumn("place", place).join(firsts, ["n", "bucket"])
    weights, at = np.unique(groups[:, 0], return_inverse=True)
    many = np.zeros(len(weights), np.int64)
    np.add.at(many, at, groups[:, 2])
    return leaves.select("word", (F.col("first") + F.col("place") - 1).alias("leaf")), weights, many


class Tree:
    """A Huffman tree of ``many`` leaves of each of the ascending ``weights``.

    The two lightest nodes are joined, again and again: so inner node ``t`` has the nodes that are
    taken as number ``2 t`` and ``2 t + 1``. Nodes of equal weight are taken one after the other, so a
    run of them needs only its first node and its first place. The root is the last inner node.
    """

    def __init__(self, weights, many):
        leaves = deque((int(w), int(m)) for w, m in zip(weights, many))
        inner: deque = deque()
        self.leaves = sum(m for _, m in leaves)
        runs: dict[bool, list[tuple[int, int]]] = {True: [], False: []}
        taken, next_, waiting = 0, {True: 0, False: 0}, None

        def join(weight: int, times: int) -> None:
            if inner and inner[-1][0] == weight:
                weight, earlier = inner.pop()
                times += earlier
            if times:
                inner.append((weight, times))

        while taken < 2 * self.leaves - 2:
            leaf = bool(leaves) and (not inner or leaves[0][0] <= inner[0][0])
            weight, run = (leaves if leaf else inner).popleft()
            runs[leaf].append((next_[leaf], taken))
            next_[leaf] += run
            taken += run
            if waiting is not None:
                join(waiting + weight, 1)
                run, waiting = run - 1, None
            join(2 * weight, run // 2)
            waiting = weight if run % 2 else None
        self.runs = {leaf: np.array(runs[leaf], np.int64).reshape(-1, 2) for leaf in runs}

    def _taken(self, nodes: np.ndarray, leaf: bool) -> np.ndarray:
        run = self.runs[leaf]
        at = run[np.searchsorted(run[:, 0], nodes, "right") - 1]
        return at[:, 1] + nodes - at[:, 0]

    def paths(self, leaves: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(which of the leaves, inner node, code)`` of each step from the leaves up to the root."""
        steps, which = [], np.arange(len(leaves))
        if self.leaves < 2:
            return steps
        taken = self._taken(leaves, True)
        while len(which):
            node = taken >> 1
            steps.append((which, node, (taken & 1).astype(np.float32)))
            below = node != self.leaves - 2
            which = which[below]
            taken = self._taken(node[below], False)
        return steps


def start_vectors(leaves: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Numbers from -0.5 to 0.5, over ``size``, by a hash of the leaf: the same in each chunk."""
    x = (leaves.astype(np.uint64) * np.uint64(size))[:, None] + np.arange(size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(40)).astype(np.float64) / (1 << 24) - 0.5).astype(np.float32) / np.float32(size)


def _bounds(sizes: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end place of the sentence of each kept word; long ones are cut."""
    row = np.repeat(np.arange(len(sizes)), sizes)[kept]
    many = np.bincount(row, minlength=len(sizes))
    ends = np.cumsum(many)
    at = np.arange(len(row))
    first = (ends - many)[row]
    first = first + (at - first) // SENTENCE * SENTENCE
    return first, np.minimum(first + SENTENCE, ends[row])


def _add(table: np.ndarray, hits: np.ndarray, at: np.ndarray, changes: np.ndarray, times: np.ndarray) -> None:
    """Add the changes of rows that may repeat, ``STEPS`` times their mean where there are more."""
    at = at.reshape(-1)
    np.add.at(hits, at, times.reshape(-1))
    share = STEPS / np.maximum(hits[at], STEPS)
    hits[at] = 0
    for i in range(table.shape[1]):
        np.add.at(table[:, i], at, changes[:, :, i].reshape(-1) * share)


def train_chunk(codes: np.ndarray, sizes: np.ndarray, leaves: np.ndarray, tree: Tree, size: int, seed: int) -> np.ndarray:
    """The vectors of ``leaves``, ascending, after one pass over rows of ``sizes`` words; -1 is no word."""
    kept = np.flatnonzero(codes >= 0)
    first, end = _bounds(sizes, kept)
    codes = codes[kept]
    vectors = start_vectors(leaves, size, seed)
    steps = tree.paths(leaves)
    if not steps or not len(codes):
        return vectors
    nodes, local = np.unique(np.concatenate([node for _, node, _ in steps]), return_inverse=True)
    # The last node stands for the steps that a shorter path doesn't have.
    path = np.full((len(leaves), len(steps)), len(nodes), np.int32)
    code = np.zeros(path.shape, np.float32)
    lengths, done = np.zeros(len(leaves), np.int64), 0
    for i, (which, node, bit) in enumerate(steps):
        path[which, i], code[which, i] = local[done : done + len(node)], bit
        lengths[which] = i + 1
        done += len(node)
    inner = np.zeros((len(nodes) + 1, size), np.float32)
    hit, inner_hit = np.zeros(len(leaves), np.float32), np.zeros(len(inner), np.float32)
    random = np.random.default_rng([seed, len(codes), int(leaves[0])])
    for begin in range(0, len(codes), SORTED):
        rate = np.float32(RATE * max(1 - begin / len(codes), LAST))
        some = np.arange(begin, min(begin + SORTED, len(codes)))
        some = some[np.argsort(lengths[codes[some]], kind="stable")]
        for at in range(0, len(some), AT_ONCE):
            places = some[at : at + AT_ONCE]
            words = codes[places]
            reach = int(random.integers(1, WINDOW + 1))
            near = places[:, None] + np.array([d for d in range(-reach, reach + 1) if d])
            held = (near >= first[places, None]) & (near < end[places, None])
            near = codes[np.where(held, near, 0)]
            most = int(lengths[words].max())
            up, held = path[words, :most].astype(np.intp), held.astype(np.float32)
            x, y = vectors[near], inner[up]
            product = np.matmul(x, y.transpose(0, 2, 1))
            step = np.exp(-np.clip(product, -FLAT, FLAT))
            step = (1 - code[words, :most])[:, None, :] - 1 / (1 + step)
            step *= np.abs(product) < FLAT
            step *= held[:, :, None] * rate
            step *= (up < len(nodes))[:, None, :]
            to_inner = np.matmul(step.transpose(0, 2, 1), x)
            _add(vectors, hit, near.astype(np.intp), np.matmul(step, y), held)
            _add(inner, inner_hit, up, to_inner, np.repeat(held.sum(axis=1), most))
    return vectors


def _chunk(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, sizes, codes)`` of the one row of a group of chunks."""
    kinds = (("rows", np.int64), ("sizes", np.int32), ("codes", np.int32))
    return tuple(np.frombuffer(chunk[name][0].as_py(), kind) for name, kind in kinds)


def _known(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``codes`` by the places of ``at``, where they are listed, else -1."""
    number = np.full(max(codes.max(initial=-1), at.max(initial=-1)) + 2, -1, np.int32)
    number[at] = np.arange(len(at), dtype=np.int32)
    return number[codes]


def train_word_vectors(
    df: DataFrame, words: str, size: int, min_count: int, seed: int, chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """Stored ``(word, vector array<float>)`` of the words of ``df`` with ``min_count`` occurrences."""
    spark = df.sparkSession
    chunks = chunks_of(df, words, limit=chunk_words)
    listed = listed_words(chunks)
    folders = [shared_dir(spark, name) for name in ("word_counts", "leaves", "trained")]
    counts = store(listed.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), folders[0])
    leaves, weights, many = numbered_words(counts)
    leaves = store(leaves, folders[1])
    tree = Tree(weights, many)
    columns = [f"v{i}" for i in range(size)]

    def train(chunk: pa.Table, own: pa.Table) -> pa.Table:
        order = np.argsort(own["leaf"].to_numpy())
        leaf, at = own["leaf"].to_numpy()[order], own["at"].to_numpy()[order]
        if not len(leaf):
            made = np.empty((0, size), np.float32)
        else:
            _, sizes, codes = _chunk(chunk)
            made = train_chunk(_known(codes, at), sizes, leaf, tree, size, seed)
        return pa.table([pa.array(leaf, pa.int64()), *[pa.array(made[:, i].copy()) for i in range(size)]], names=["leaf", *columns])

    own = listed.join(leaves, "word").select(F.col("chunk").alias("_chunk"), "at", "leaf")
    kept = chunks.select("chunk", "rows", "sizes", "codes").groupBy("chunk")
    schema = "leaf long, " + ", ".join(f"{c} float" for c in columns)
    trained = store(kept.cogroup(own.groupBy("_chunk")).applyInArrow(train, schema), folders[2])
    means = trained.groupBy("leaf").agg(*[F.avg(c).cast("float").alias(c) for c in columns])
    vectors = leaves.join(means, "leaf").select("word", F.array(*columns).alias("vector"))
    vectors = store(vectors, shared_dir(spark, "word_vectors"))
    for folder in (*folders, *folders_of(chunks)):
        remove(spark, folder)
    return vectors


def folders_of(stored: DataFrame) -> list[str]:
    """The folders of a stored table's files."""
    return sorted({name.rsplit("/", 1)[0] for name in stored.inputFiles()})


class WordVectorTable(Model, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """Word vectors in a stored table ``(word, vector array<float>)``, used as a ``Word2VecModel``."""

    vectorSize = Param(Params._dummy(), "vectorSize", "the dimension of a vector", TypeConverters.toInt)

    def __init__(self, vectors: DataFrame | None = None, size: int = 0, input_col: str = "", output_col: str = ""):
        super().__init__()
        self.vectors = vectors
        self._set(vectorSize=size, inputCol=input_col, outputCol=output_col)

    def getVectorSize(self) -> int:
        return self.getOrDefault(self.vectorSize)

    def getVectors(self) -> DataFrame:
        """``(word, vector)``."""
        return self.vectors.select("word", array_to_vector("vector").alias("vector"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Add the mean of the vectors of a row's words; words without one add zeros.

        The rows are stored with a number each. A chunk's dictionary meets the vectors, not its rows'
        words.
        """
        spark, size = dataset.sparkSession, self.getVectorSize()
        numbered = dataset.withColumn("_row", F.monotonically_increasing_id())
        rows = store(numbered, shared_dir(spark, "rows"))
        chunks = chunks_of(rows, self.getInputCol(), "_row")

        def means(chunk: pa.Table, own: pa.Table) -> pa.Table:
            row, sizes, codes = _chunk(chunk)
            vectors = own["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            known = _known(codes, own["at"].to_numpy())
            of = np.repeat(np.arange(len(sizes)), sizes)[known >= 0]
            known = known[known >= 0]
            sums = [np.bincount(of, weights=vectors[known, i], minlength=len(sizes)) for i in range(size)]
            made = np.stack(sums, axis=1) / np.maximum(sizes, 1)[:, None]
            return pa.table([pa.array(row), pa.FixedSizeListArray.from_arrays(pa.array(made.reshape(-1)), size).cast(pa.list_(pa.float64()))], names=["_row", "_mean"])

        own = listed_words(chunks).join(self.vectors, "word").select(F.col("chunk").alias("_chunk"), "at", "vector")
        kept = chunks.select("chunk", "rows", "sizes", "codes").groupBy("chunk")
        found = kept.cogroup(own.groupBy("_chunk")).applyInArrow(means, "_row long, _mean array<double>")
        found = store(found, shared_dir(spark, "row_vectors"))
        for folder in folders_of(chunks):
            remove(spark, folder)
        return lookup_join(rows, found, "_row").select(*dataset.columns, array_to_vector("_mean").alias(self.getOutputCol()))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: WordVectorTable):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.vectors.write.parquet(f"{path}/vectors")


class _Reader(MLReader):
    def load(self, path: str) -> WordVectorTable:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = WordVectorTable()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.vectors = self.sparkSession.read.schema("word string, vector array<float>").parquet(f"{path}/vectors")
        return model
