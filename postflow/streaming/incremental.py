"""Live analysis that keeps up: each window adds its sums, and models come from all sums so far.

:func:`postflow.streaming.jobs.analyse_live` fits anew on each window and forgets the earlier
ones. Here a window costs its own posts and one read of the sums, whatever came before.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from postflow.operators import statistics as M
from postflow.operators.clean import dedup_posts, flatten_posts
from postflow.operators.cluster import with_part
from postflow.operators.sentiment import Lexicon, label_posts
from postflow.plans.curate import clean_live, with_words
from postflow.sources.storage import committed, remove, store
from postflow.streaming.jobs import run_batches

COMPACT_EVERY = 24


@dataclass
class StatisticsStore:
    """Statistics below ``root``, one table for each batch, summed up now and then.

    ``delta/<batch>`` holds the sums of one batch, ``base/<batch>`` those of all batches up to it.
    A table counts from when its writing has ended. A batch that runs again replaces its delta,
    so it is counted once; and as its predecessors' sums stay until the next base but one is
    written, it finds the same state as the first time, wherever it was interrupted. A window
    writes only its own delta; every ``compact_every`` ones a base is written.
    """

    spark: SparkSession
    root: str
    compact_every: int = COMPACT_EVERY

    def _ids(self, kind: str) -> list[int]:
        return sorted(int(name) for name in committed(self.spark, f"{self.root}/{kind}"))

    def _table(self, kind: str, batch_id: int) -> DataFrame:
        return self.spark.read.schema(M.SCHEMA).parquet(f"{self.root}/{kind}/{batch_id}")

    def read(self, before: int | None = None) -> DataFrame:
        """The sums of all batches, or of those ``before`` a batch."""
        counts = lambda ids: [i for i in ids if before is None or i < before]
        bases = counts(self._ids("base"))
        since = bases[-1] if bases else -1
        parts = [self._table("base", since)] if bases else [M.no_statistics(self.spark)]
        parts += [self._table("delta", i) for i in counts(self._ids("delta")) if i > since]
        return M.merge(*parts)

    def add(self, batch_id: int, statistics: DataFrame) -> None:
        """Set the sums of a batch; batches come in ascending order, some of them twice."""
        store(statistics, f"{self.root}/delta/{batch_id}")
        bases = [i for i in self._ids("base") if i < batch_id]
        since = bases[-1] if bases else -1
        if sum(since < i <= batch_id for i in self._ids("delta")) >= self.compact_every:
            self.compact(batch_id)

    def compact(self, batch_id: int) -> None:
        """Write the sums up to a batch as one table, and drop what the base before it replaced."""
        older = [i for i in self._ids("base") if i < batch_id]
        store(self.read(batch_id + 1), f"{self.root}/base/{batch_id}")
        if older:
            for kind, last in (("delta", older[-1]), ("base", older[-1] - 1)):
                for i in self._ids(kind):
                    if i <= last:
                        remove(self.spark, f"{self.root}/{kind}/{i}")


def learn_batch(
    batch: DataFrame, batch_id: int, out_dir: str, sums: StatisticsStore, lexicon: Lexicon
) -> None:
    """Label a window's posts, add the sums of its training part, and predict its test part.

    The predictions go to ``classes`` below the window's ``batch_id=`` folder; they are made with
    the sums of this window and all earlier ones.
    """
    spark, folder = batch.sparkSession, f"{out_dir}/batch_id={batch_id}"
    words = batch.transform(dedup_posts).transform(with_words)
    rows = f"{folder}/scored_rows"
    labelled = store(with_part(label_posts(words, lexicon, rows)), f"{folder}/labelled")
    remove(spark, rows)
    sums.add(batch_id, M.post_statistics(labelled.filter("part = 'train'")))
    state = store(sums.read(batch_id + 1), f"{folder}/sums")
    classes, terms = M.bayes_of(state)
    classes = store(classes, f"{folder}/bayes_classes")
    terms = store(terms, f"{folder}/bayes_terms")
    test = labelled.filter("part = 'test'")
    predicted = M.predict_bayes(test.dropDuplicates(["id"]), classes, terms)
    predicted.write.mode("overwrite").parquet(f"{folder}/classes")
    for name in ("sums", "bayes_terms"):
        remove(spark, f"{folder}/{name}")


def learn_live(
    stream: DataFrame,
    out_dir: str,
    checkpoint: str,
    interval: str | None,
    lexicon: Lexicon,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Learn from each window of a stream of posts and predict with all windows so far.

    The sums are below ``out_dir/_sums``; a :class:`StatisticsStore` there gives them to others.
    """
    sums = StatisticsStore(stream.sparkSession, f"{out_dir}/_sums", compact_every)

    def write(batch: DataFrame, batch_id: int) -> None:
        learn_batch(batch, batch_id, out_dir, sums, lexicon)

    clean = stream.transform(flatten_posts).transform(clean_live)
    return run_batches(clean, write, checkpoint, interval)
