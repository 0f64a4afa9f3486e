"""Sentence and post sentiment."""

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.functions import sentiment as S
from postflow.functions.text import sentences as split_sentences
from postflow.functions.text import terms
from postflow.operators.joins import BROADCAST_ROWS, fits_broadcast
from postflow.sources.storage import shared_dir, store


def sentences(df: DataFrame, key: str = "id") -> DataFrame:
    """``(key, pos, sentence)``, one row per sentence."""
    return df.select(
        key, F.posexplode(split_sentences(F.col("text"))).alias("pos", "sentence")
    )


def sentence_scores(
    parts: DataFrame,
    lexicon: Mapping[str, float] | None = None,
    scorer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add ``score`` (0..4) and ``length`` to the rows of :func:`sentences`.

    ``scorer`` maps the sentence column to a score column, such as a pandas UDF around a model;
    by default the words of ``lexicon`` are averaged.
    """
    if scorer is None:
        def scorer(sentence):
            return S.sentence_score(sentence, lexicon)
    return parts.withColumns(
        {"score": scorer(F.col("sentence")), "length": F.length("sentence")}
    )


def sentence_scores_by_table(
    parts: DataFrame, lexicon: DataFrame, key: str = "id", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``(key, pos, score, length)`` of :func:`sentences`, for a lexicon in a stored ``(word, score)``.

    Only words, positions and lengths are shuffled, never text; and if the lexicon is too large to
    send to all tasks, each word of some thousand sentences once, with their places. Sentences that
    share key and position stay apart, by their place in ``parts``: these must come from stored
    rows, as the join reads them more than once.
    """
    rows = parts.select(
        key,
        "pos",
        F.length("sentence").alias("length"),
        F.monotonically_increasing_id().alias("_part"),
        terms(F.col("sentence")).alias("words"),
    )
    score = F.coalesce(F.avg("score"), F.lit(S.NEUTRAL_SCORE)).alias("score")
    if fits_broadcast(lexicon, broadcast_rows):
        words = rows.select(key, "pos", "length", "_part", F.explode_outer("words").alias("word"))
        found = words.join(F.broadcast(lexicon), "word", "left")
        return found.groupBy("_part", key, "pos", "length").agg(score).select(key, "pos", "score", "length")
    # Stored without the text, which the join below then reads once only, for the words.
    places = store(rows.select(key, "pos", "length", "_part"), shared_dir(parts.sparkSession, "places"))
    words = rows.select("_part", "words").mapInArrow(_words_of_batch, "word string, _first long, places array<int>")
    # A word has a row for a batch at most, so none is a hot key. Whole batches go to a task, which
    # adds up their sentences without a further shuffle.
    found = words.join(lexicon.select("word", "score"), "word").select("_first", "score", "places")
    found = found.repartition("_first").select("_first", "score", F.explode("places").alias("_place"))
    means = found.groupBy("_first", "_place").agg(F.avg("score").alias("score"))
    means = means.select((F.col("_first") + F.col("_place")).alias("_part"), "score")
    scored = places.join(means, "_part", "left")
    return scored.select(
        key, "pos", F.coalesce("score", F.lit(S.NEUTRAL_SCORE)).alias("score"), "length"
    )


def _words_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of a batch of sentences once, with the first one's ``_part`` and the places after it."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        parts, words = batch.column("_part").to_numpy(), batch.column("words")
        sizes = words.value_lengths().fill_null(0).to_numpy()
        known = words.flatten().dictionary_encode()
        codes = known.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        places = np.repeat((parts - parts[0]).astype(np.int32), sizes)[order]
        ends = np.cumsum(np.bincount(codes, minlength=len(known.dictionary)))
        ends = np.concatenate(([0], ends)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(places))
        first = pa.array(np.full(len(known.dictionary), parts[0]))
        yield pa.RecordBatch.from_arrays([known.dictionary, first, lists], names=["word", "_first", "places"])


Lexicon = Mapping[str, float] | DataFrame | Callable[[Column], Column]


def post_sentiment(df: DataFrame, lexicon: Lexicon, folder: str | None = None) -> DataFrame:
    """Add ``score``, ``mean_score`` and ``main_score``.

    ``lexicon`` is a mapping of words to scores, which needs no shuffle; or a stored table
    ``(word, score)``; or a scorer that maps a sentence column to a score column, such as a
    pandas UDF around a model. The last two aggregate by row, and store the rows in ``folder``
    first, so that row numbers hold.
    """
    if isinstance(lexicon, Mapping):
        scored = df.withColumn("_scored", S.scored_sentences(F.col("text"), lexicon))
        return scored.withColumns(
            {
                "score": S.weighted_score(F.col("_scored")),
                "mean_score": S.mean_score(F.col("_scored")),
                "main_score": S.main_score(F.col("_scored")),
            }
        ).drop("_scored")
    if folder is None:
        raise ValueError("a lexicon table or a scorer needs a folder for the rows")
    rows = store(df.withColumn("_row", F.monotonically_increasing_id()), folder)
    parts = sentences(rows, "_row")
    if isinstance(lexicon, DataFrame):
        scored = sentence_scores_by_table(parts, lexicon, "_row")
    else:
        scored = sentence_scores(parts, scorer=lexicon)
    return post_sentiment_of(rows, scored, "_row").drop("_row")


def post_sentiment_of(df: DataFrame, scored: DataFrame, key: str = "id") -> DataFrame:
    """:func:`post_sentiment` from the rows of any :func:`sentence_scores`, by a unique ``key``."""
    totals = scored.groupBy(key).agg(
        (F.sum(F.col("score") * F.col("length")) / F.sum("length")).alias("score"),
        F.avg("score").alias("mean_score"),
        F.max_by("score", F.struct("length", -F.col("pos"))).alias("main_score"),
    )
    names = ["score", "mean_score", "main_score"]
    return df.join(totals, key, "left").na.fill(S.NO_SENTENCE, subset=names)


def with_sentiment(df: DataFrame, score: str = "score") -> DataFrame:
    """Add the class name ``sentiment`` and its ``label``."""
    named = df.withColumn("sentiment", S.sentiment_class(F.col(score)))
    return named.withColumn("label", S.sentiment_label(F.col("sentiment")))


def label_posts(df: DataFrame, lexicon: Lexicon, folder: str | None = None) -> DataFrame:
    """Add ``sentiment`` and ``label`` scored from the text as :func:`post_sentiment` does."""
    if isinstance(lexicon, Mapping):
        score = S.weighted_score(S.scored_sentences(F.col("text"), lexicon))
        return with_sentiment(df.withColumn("_score", score), "_score").drop("_score")
    scored = post_sentiment(df, lexicon, folder)
    return with_sentiment(scored).drop("score", "mean_score", "main_score")
