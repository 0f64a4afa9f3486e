"""Spelling variants: words one edit away from a much more frequent word.

Near words are found by asymmetric q-chunks (Qin et al., "Efficient exact edit similarity query
processing with the asymmetric signature scheme"). Of two near words the longer one, or either of
equally long ones, gives two disjoint chunks, its halves; the other gives positional grams of
their sizes. One edit leaves a half whole, at its place or one place off, so of all the grams
only those at the ends of a word can meet a chunk. A half alone would gather all words of a
common beginning or ending; so the half that holds the edit is cut in two again, of which one
part stays whole as well, and both together are the key. What meets is verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import keep_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"A-Za-z\x{C0}-\x{FF}"
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
TYPO_SHARE = 199


def mistyped(doc_id: Column, run: Column, share: int = TYPO_SHARE) -> Column:
    """``run`` without one code point where ``share`` divides the crc32 of ``doc_id:run``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    shorter = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
    return F.when(h % share == 0, shorter).otherwise(run)


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: the words of ``docs`` after :func:`mistyped`, with their occurrences.

    Words are maximal runs of letters A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased.
    Words of fewer than ``least_length`` code points or ``least_count`` occurrences are left out.
    Null texts have no words; a null id counts as an empty one. Counts merge on the map side.
    """
    # A pattern for long runs only still finds them whole: it begins at their first letter.
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    every = docs.select("doc_id", F.explode(runs).alias("run"))
    every = every.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    words = every.select(mistyped(F.col("doc_id"), F.col("run")).alias("word"))
    words = words.filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _edges(word: Column, length: Column) -> list[tuple[Column, Column]]:
    """The keys of a word of ``length`` as (beginning, ending) of ``word``.

    With halves A and B, cut in A1 A2 and B1 B2: A B1, A and B2, A1 and B, A2 B.
    """
    half = F.floor(length / 2)
    early = F.floor(half / 2)
    late = F.floor((length - half) / 2)
    n = F.length(word)

    def edge(first: Column, last: Column) -> tuple[Column, Column]:
        return word.substr(F.lit(1), first.cast("int")), word.substr((n - last + 1).cast("int"), last.cast("int"))

    zero = F.lit(0)
    return [
        edge(half + late, zero),
        edge(half, length - half - late),
        edge(early, length - half),
        edge(zero, length - early),
    ]


def _keys(word: Column, lengths: list[Column]) -> Column:
    return F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("number"), F.xxhash64(length, F.lit(i), *edge).alias("key"))
                for length in lengths
                for i, edge in enumerate(_edges(word, length))
            ]
        )
    )


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(a, n_a, b, n_b)``: each pair of words that differ by one inserted, deleted or replaced
    code point, once.

    ``words`` has distinct ``word`` of at least ``least_length`` >= 4 code points, and ``n``.
    """
    if least_length < 4:
        raise ValueError("words need four code points, one for each part")
    n = F.length("word")
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("n_a"), _keys(F.col("word"), [n]).alias("k"))
    grams = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"), _keys(F.col("word"), [n, n + 1]).alias("k"))
    chunks = chunks.select("k.key", "k.number", "a", "n_a")
    met = chunks.join(grams.select("k.key", "b", "n_b"), "key")
    # Equally long words meet in both directions.
    met = met.filter((F.length("a") > F.length("b")) | (F.col("a") < F.col("b")))
    near = met.filter(F.levenshtein("a", "b", 1) == 1)
    # A pair that meets by several keys counts by the first of them.
    own, other = _edges(F.col("a"), F.length("a")), _edges(F.col("b"), F.length("a"))
    first = F.lit(len(own))
    for i in reversed(range(len(own))):
        same = (own[i][0] == other[i][0]) & (own[i][1] == other[i][1])
        first = F.when(same, i).otherwise(first)
    return near.filter(F.col("number") == first).select("a", "n_a", "b", "n_b")


def last_forms(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: the end of the chain of forms that begins at a word.

    Each round doubles the steps taken, and each step multiplies the frequency; so a handful of
    rounds is enough for any corpus. Every round is a stored table.
    """
    roots = keep_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_ = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = keep_table(roots.join(next_, "root", "left").select("word", "root", "next"), "roots")
        roots = further.select("word", F.coalesce("next", "root").alias("root"))
        if further.filter("next is not null").isEmpty():
            return roots


def spelling_variants(words: DataFrame, ratio: int = RATIO, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``: a row for each row of ``words (word, n)``.

    ``form`` is the near word of largest ``n`` (ties: the smallest by code points), if that is
    ``ratio`` times the word's own at least, else null; ``root`` is where the forms end that begin
    at the word, or the word itself; ``n_near`` counts near words.
    """
    words = keep_table(words.select("word", "n"), "words")
    pairs = keep_table(near_words(words, least_length), "near_words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")
    )
    rows = words.join(best, "word", "left")
    is_form = -F.col("best.m") >= F.lit(ratio) * F.col("n")
    rows = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"),
        F.when(is_form, -F.col("best.m")).alias("form_n"),
    )
    rows = keep_table(rows, "forms")
    roots = last_forms(rows.filter("form is not null").select("word", "form"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def document_variants(docs: DataFrame) -> DataFrame:
    """:func:`spelling_variants` of the words of ``docs``.

    An empty table, or one without frequent words, gives no rows; rows that repeat count again;
    other columns are not looked at.
    """
    return spelling_variants(word_counts(docs))
