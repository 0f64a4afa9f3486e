"""Expressions that score sentences and name the sentiment of a post."""

import json
from collections.abc import Mapping
from itertools import chain
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

from postflow.functions.text import sentences, terms
from postflow.values import SENTIMENT_LABELS

NEUTRAL_SCORE = 2.0
NO_SENTENCE = -1.0

# Words of a literal lexicon that share a bucket, on average.
BUCKET_WORDS = 2

# Words of a lexicon up to which each word of a text is first looked for in a set.
PROBED_WORDS = 2000


def word_score(word: Column, lexicon: Mapping[str, float]) -> Column:
    """Score of a word, null when unlisted.

    The lexicon is written into the plan as small maps, found by a hash of the word, so a word
    costs the same in a lexicon of any size and with any number of scores.
    """
    if not lexicon:
        raise ValueError("an empty lexicon")
    buckets: list[dict] = [{} for _ in range(-(-len(lexicon) // BUCKET_WORDS))]
    for listed, score in lexicon.items():
        buckets[crc32(listed.encode()) % len(buckets)][listed] = float(score)
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,double>>")
    own = F.get(table, (F.crc32(word.cast("binary")) % len(buckets)).cast("int"))
    return F.try_element_at(own, word)


def _mean(pairs: Column, otherwise: float) -> Column:
    """Weighted mean of ``array<struct<score, weight>>``, in a single pass over the array.

    The array is named only once: Spark does not share repeated subexpressions inside lambdas.
    """
    start = F.struct(F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("weight"))
    mean = F.aggregate(
        pairs,
        start,
        lambda acc, x: F.struct(
            (acc["score"] + x["score"] * x["weight"]).alias("score"),
            (acc["weight"] + x["weight"]).alias("weight"),
        ),
        lambda acc: F.when(acc["weight"] > 0, acc["score"] / acc["weight"]),
    )
    return F.coalesce(mean, F.lit(otherwise))


def sentence_score(sentence: Column, lexicon: Mapping[str, float]) -> Column:
    """Mean score of the listed words of a sentence, neutral when it has none."""
    words = terms(sentence)
    if len(lexicon) <= PROBED_WORDS:
        # Most words are unlisted, and a set tells so at less cost than the score's table.
        words = F.filter(words, lambda word: word.isin(list(lexicon)))
    scores = F.transform(words, lambda word: word_score(word, lexicon))
    one = F.lit(1).cast("bigint")
    pairs = F.transform(
        F.filter(scores, lambda score: score.isNotNull()),
        lambda score: F.struct(score.alias("score"), one.alias("weight")),
    )
    return _mean(pairs, NEUTRAL_SCORE)


def scored_sentences(text: Column, lexicon: Mapping[str, float]) -> Column:
    """``array<struct<score, length>>``, one element per sentence, in order."""
    return F.transform(
        sentences(text),
        lambda s: F.struct(
            sentence_score(s, lexicon).alias("score"), F.length(s).alias("length")
        ),
    )


def weighted_score(scored: Column) -> Column:
    """Mean sentence score weighted by sentence length; -1 without a sentence."""
    pairs = F.transform(
        scored,
        lambda s: F.struct(s["score"].alias("score"), s["length"].cast("bigint").alias("weight")),
    )
    return _mean(pairs, NO_SENTENCE)


def mean_score(scored: Column) -> Column:
    """Plain mean of the sentence scores; -1 without a sentence."""
    one = F.lit(1).cast("bigint")
    pairs = F.transform(
        scored, lambda s: F.struct(s["score"].alias("score"), one.alias("weight"))
    )
    return _mean(pairs, NO_SENTENCE)


def main_score(scored: Column) -> Column:
    """Score of the longest sentence, the first one on a tie; -1 without a sentence."""
    start = F.struct(F.lit(NO_SENTENCE).alias("score"), F.lit(0).alias("length"))
    longest = F.aggregate(
        scored,
        start,
        lambda acc, s: F.when(s["length"] > acc["length"], s).otherwise(acc),
        lambda acc: acc["score"],
    )
    return F.coalesce(longest, F.lit(NO_SENTENCE))


def sentiment_class(score: Column) -> Column:
    """Class name of a post score; ``NOT_UNDERSTOOD`` outside (0, 5)."""
    return (
        F.when((score <= 0) | (score >= 5) | score.isNull(), F.lit("NOT_UNDERSTOOD"))
        .when(score < 1, F.lit("VERY_NEGATIVE"))
        .when(score < 2, F.lit("NEGATIVE"))
        .when(score < 3, F.lit("NEUTRAL"))
        .when(score < 4, F.lit("POSITIVE"))
        .otherwise(F.lit("VERY_POSITIVE"))
    )


def sentiment_label(name: Column) -> Column:
    """Integer label of a class name; null for an unknown name."""
    labels = F.create_map(*[F.lit(x) for x in chain.from_iterable(SENTIMENT_LABELS.items())])
    return F.try_element_at(labels, name)
