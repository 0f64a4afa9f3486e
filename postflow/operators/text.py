"""Text features: tokens, stop words, term weights and document vectors."""

from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    HashingTF,
    IDFModel,
    RegexTokenizer,
    StopWordsRemover,
    Word2Vec,
    Word2VecModel,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.functions import text as X
from postflow.operators.joins import BROADCAST_ROWS, lookup_join
from postflow.operators.word_training import WordVectorTable, train_word_vectors
from postflow.values import TERM_BUCKETS, VECTOR_SIZE, WORD_VECTOR_TASKS

# Words whose vectors the driver may hold: about half a kilobyte each while they are trained.
DRIVER_WORDS = 200_000


def with_hashtags(df: DataFrame) -> DataFrame:
    return df.withColumn("hashtags", X.hashtags(F.col("text")))


def track_filter(df: DataFrame, phrases) -> DataFrame:
    """Keep posts that hold all terms of at least one of ``phrases``."""
    return df.filter(X.matches_phrase(F.col("text"), phrases))


def tokenize(
    df: DataFrame, pattern: str | None = None, gaps: bool = True, min_length: int = 1
) -> DataFrame:
    """Add ``words``. With a ``pattern``, it separates the words (or matches them: ``gaps=False``)."""
    if pattern is None:
        return df.withColumn("words", X.tokens(F.col("text")))
    safe = df.withColumn("_text", F.coalesce("text", F.lit("")))
    splitter = RegexTokenizer(
        inputCol="_text", outputCol="words", pattern=pattern, gaps=gaps, minTokenLength=min_length
    )
    return splitter.transform(safe).drop("_text")


def remove_stop_words(
    df: DataFrame, language: str = "english", words=None, lowered: bool = False
) -> DataFrame:
    """Add ``filtered_words``: ``words`` less the stop words of ``language`` (or the given list).

    ``lowered`` says that ``words`` are in lower case already, as :func:`tokenize` leaves them;
    they are then compared as they are.
    """
    dropped = StopWordsRemover.loadDefaultStopWords(language) if words is None else list(words)
    return df.withColumn("filtered_words", X.without(F.col("words"), dropped, lowered))


def hashing_tf(
    df: DataFrame,
    buckets: int = TERM_BUCKETS,
    input_col: str = "filtered_words",
    output_col: str = "rawFeatures",
) -> DataFrame:
    stage = HashingTF(inputCol=input_col, outputCol=output_col, numFeatures=buckets)
    return stage.transform(df)


def fit_idf(
    df: DataFrame, input_col: str = "rawFeatures", output_col: str = "bayes_features"
) -> IDFModel:
    return IDF(inputCol=input_col, outputCol=output_col).fit(df)


def counted_features(
    df: DataFrame, vocabulary, input_col: str = "filtered_words", output_col: str = "rawFeatures"
) -> DataFrame:
    """Exact term counts over a given vocabulary, where buckets must not collide."""
    stage = CountVectorizerModel.from_vocabulary(
        list(vocabulary), inputCol=input_col, outputCol=output_col
    )
    return stage.transform(df)


def _counted(words: Column) -> Column:
    """``array<struct<term, tf>>`` of the words of a row: sorted, equal words are neighbours."""

    def starts(ordered: Column) -> Column:
        n = F.size(ordered)
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        first = F.filter(
            places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )
        return F.transform(F.array(first), lambda at: counts(ordered, at))[0]

    def counts(ordered: Column, at: Column) -> Column:
        ends = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(ordered)))
        return F.transform(
            F.filter(F.arrays_zip(at.alias("a"), ends.alias("b")), lambda x: x["a"].isNotNull()),
            lambda x: F.struct(
                F.get(ordered, x["a"]).alias("term"), (x["b"] - x["a"]).cast("bigint").alias("tf")
            ),
        )

    # Wrapped in an array, a value becomes a lambda variable and is computed once per row.
    return F.transform(F.array(F.sort_array(words)), starts)[0]


def term_counts(df: DataFrame, key: str = "id", words: str = "filtered_words") -> DataFrame:
    """``(key, term, tf)`` of each row, without a shuffle; empty words are dropped.

    Rows that share a key stay apart: each has counts of its own.
    """
    counted = df.select(key, F.explode(_counted(F.filter(words, lambda word: word != ""))).alias("_c"))
    return counted.select(key, "_c.term", "_c.tf")


def idf_weights(
    df: DataFrame, words: str = "filtered_words", counts: DataFrame | None = None
) -> DataFrame:
    """``(term, df, idf)`` with ``idf = ln((m + 1) / (df + 1))`` over the m rows of ``df``.

    Both ``df`` and ``m`` count rows. Repeats within a row go by ``array_distinct`` before the
    shuffle, which then only carries one partial count per term and task, however common the
    term. Stored :func:`term_counts` of the same rows, given as ``counts``, save splitting the
    text again.
    """
    if counts is None:
        distinct = df.select(F.explode(F.array_distinct(words)).alias("term"))
        counts = distinct.filter(F.col("term") != "")
    posts = df.agg(F.count("*").alias("m"))
    idf = F.log((posts.scalar() + F.lit(1.0)) / (F.col("df") + 1.0))
    weights = counts.groupBy("term").agg(F.count("*").alias("df"))
    return weights.select("term", "df", idf.alias("idf"))


def tf_idf(
    counts: DataFrame, weights: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``(key, term, tf_idf)`` of :func:`term_counts` for the terms that have a weight.

    ``weights`` is the (stored) result of :func:`idf_weights`, on these posts or on others.
    """
    table = weights.select("term", "idf")
    joined = lookup_join(counts, table, "term", broadcast_rows=broadcast_rows)
    keys = [name for name in counts.columns if name not in ("term", "tf")]
    return joined.select(*keys, "term", (F.col("tf") * F.col("idf")).alias("tf_idf"))


def fit_word_vectors(
    df: DataFrame,
    size: int = VECTOR_SIZE,
    min_count: int = 0,
    seed: int = 1,
    tasks: int = WORD_VECTOR_TASKS,
    input_col: str = "filtered_words",
    output_col: str = "features",
    driver_words: int = DRIVER_WORDS,
) -> Word2VecModel | WordVectorTable:
    """Fit word vectors on stored rows.

    Up to ``driver_words`` words, the vocabulary and its vectors live on the driver and in every
    task. Training then runs on ``tasks`` tasks, whatever the input and the cluster, so equal input
    gives equal vectors. More words are trained by chunks of the stored files, the vectors are a
    table, and equal files give equal vectors.
    """
    occurs = df.select(F.explode(input_col).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    if occurs.filter(F.col("n") >= min_count).count() > driver_words:
        vectors = train_word_vectors(df, input_col, size, min_count, seed)
        return WordVectorTable(vectors, size, input_col, output_col)
    stage = Word2Vec(
        vectorSize=size,
        minCount=min_count,
        seed=seed,
        numPartitions=tasks,
        inputCol=input_col,
        outputCol=output_col,
    )
    return stage.fit(df)


def average_word_vectors(
    df: DataFrame,
    vectors: DataFrame,
    size: int,
    key: str = "id",
    words: str = "filtered_words",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(key, vector)`` of each row: the mean of the word vectors of its words.

    ``vectors`` is a stored ``(word, vector array<double>)``, such as ``model.getVectors()`` with
    arrays. A word without a vector adds nothing but counts in the mean; a row without words gets
    zeros. Rows that share a key stay apart.
    """
    # Every word of a row comes from one task, so the number holds for all of them. A row without
    # words keeps one row, whose word is null and has no vector.
    rows = df.select(key, F.monotonically_increasing_id().alias("_row"), words)
    counts = rows.select(
        key,
        "_row",
        F.size(words).alias("_words"),
        F.explode_outer(_counted(F.col(words))).alias("_c"),
    ).select(key, "_row", "_words", F.col("_c.term").alias("word"), F.col("_c.tf").alias("n"))
    joined = lookup_join(counts, vectors, "word", "left", broadcast_rows)
    sums = [
        F.coalesce(F.sum(F.col("n") * F.col("vector")[i]), F.lit(0.0))
        / F.greatest(F.first("_words"), F.lit(1))
        for i in range(size)
    ]
    return joined.groupBy("_row", key).agg(F.array(*sums).alias("vector")).drop("_row")
