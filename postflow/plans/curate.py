"""From raw posts to clean posts with hashtags and words."""

from pyspark.sql import DataFrame

from postflow.operators import clean as C
from postflow.operators import text as X
from postflow.values import DEVICES, MIN_REACH, MIN_REPOSTS


def clean_posts(
    df: DataFrame,
    lang: str = "en",
    devices=DEVICES,
    min_reposts: int = MIN_REPOSTS,
    min_reach: int = MIN_REACH,
) -> DataFrame:
    """Much-shared posts of one language from known devices, projected and filled."""
    return (
        df.transform(C.filter_lang, lang)
        .transform(C.filter_source_present)
        .transform(C.filter_repost_count, min_reposts)
        .transform(C.filter_author_reach, min_reach)
        .transform(C.filter_devices, devices)
        .transform(C.project_posts)
        .transform(C.fill_missing)
    )


def clean_live(flat: DataFrame, lang: str = "en", devices=DEVICES) -> DataFrame:
    """The live counterpart, on the rows of ``flatten_posts``: no repost or reach filter."""
    return (
        flat.transform(C.filter_lang, lang)
        .transform(C.filter_source_present)
        .transform(C.filter_devices, devices)
        .transform(C.project_posts_live)
        .transform(C.fill_missing)
    )


def with_words(df: DataFrame, language: str = "english") -> DataFrame:
    """Add ``hashtags``, ``words`` and ``filtered_words``."""
    return (
        df.transform(X.with_hashtags)
        .transform(X.tokenize)
        .transform(X.remove_stop_words, language, lowered=True)
    )


def curate_posts(df: DataFrame, language: str = "english", **filters) -> DataFrame:
    """Clean, unique posts with their words.

    Duplicates go before the word columns come: these follow from the text, so the rows are the
    same while the shuffle carries the plain columns only.
    """
    return clean_posts(df, **filters).transform(C.dedup_posts).transform(with_words, language)
