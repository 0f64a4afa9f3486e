"""Quality rules: an ordered decision list of threshold conjunctions, learned from labels.

Everything on the path is a DataFrame expression. The list is found by sequential covering: a
rule against bad documents grows one threshold at a time on two thirds of the labelled rows,
is pruned on the other third, and the rows it covers leave the table before the next rule.
Each growing step is one aggregate whose result has a row per statistic and threshold.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import by_position, keep_table

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = (
    "n_words", "word_length", "symbol_share", "capital_share", "mark_share", "digit_share",
    "dup_line_share", "repeat_share", "distinct_share", "line_words",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _covered(hashes: Column) -> Column:
    """Words in the 3-word windows that occur twice or more; ``hashes``: one per window."""
    n = F.size(hashes)
    placed = F.sort_array(F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(0), n - 1).alias("p")))

    def starts(windows: Column) -> Column:
        none = F.slice(windows, 1, 0)
        empty = F.transform(F.array(F.lit(0)), lambda _: F.get(none, F.lit(0)))
        before = F.concat(empty, F.slice(windows, F.lit(1), n - 1))
        after = F.concat(F.slice(windows, F.lit(2), n - 1), empty)
        triples = F.arrays_zip(windows.alias("w"), before.alias("b"), after.alias("a"))
        twice = F.filter(
            triples,
            lambda t: F.coalesce(t["w"]["h"] == t["b"]["h"], F.lit(False))
            | F.coalesce(t["w"]["h"] == t["a"]["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twice, lambda t: t["w"]["p"]))

    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    return F.aggregate(
        let(placed, starts),
        zero,
        lambda acc, p: F.struct(
            (acc["total"] + 3 - F.greatest(F.lit(0), acc["end"] - p)).alias("total"),
            (p + 3).alias("end"),
        ),
        lambda acc: acc["total"],
    )


def _word_statistics(words: Column) -> Column:
    windows = F.greatest(F.size(words) - 2, F.lit(0))
    triples = F.arrays_zip(
        F.slice(words, F.lit(1), windows),
        F.slice(words, F.lit(2), windows),
        F.slice(words, F.lit(3), windows),
    )
    repeats = let(
        F.transform(triples, lambda t: F.xxhash64(t)),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)),
    )
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.size(F.array_distinct(words)).cast("long").alias("distinct_words"),
        repeats.cast("long").alias("n_repeat_words"),
    )


def _line_statistics(lines: Column) -> Column:
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )


def text_statistics(text: Column) -> Column:
    """A struct of counts over the whole text; null counts as empty.

    Words are runs of other than ASCII blanks. ``n_repeat_words`` counts the words inside 3-word
    windows that occur at least twice (windows compare by a 64-bit hash), ``n_dup_lines`` the
    lines with a word that equal an earlier line.
    """

    def counts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(WORD))
        return F.struct(
            F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
            count_of(t, SYMBOLS).alias("n_symbols"),
            count_of(t, CAPITALS).alias("n_capitals"),
            count_of(t, "!?").alias("n_marks"),
            count_of(t, "0123456789").alias("n_digits"),
            let(lines, _line_statistics).alias("lines"),
            let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), _word_statistics).alias("words"),
        )

    return let(F.coalesce(text, F.lit("")), counts)


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, the counts of :func:`text_statistics` and the ratios in ``FEATURES``."""
    s = docs.select(*keep, text_statistics(F.col("text")).alias("_s"))
    s = s.select(*keep, "_s.*").select("*", "lines.*", "words.*")

    def share(part: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(part) / F.col(of)).otherwise(0.0)

    return s.select(
        *keep,
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("word_length"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_capitals", "word_chars").alias("capital_share"),
        share("n_marks", "word_chars").alias("mark_share"),
        share("n_digits", "word_chars").alias("digit_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("distinct_words", "n_words").alias("distinct_share"),
        share("n_words", "n_lines").alias("line_words"),
    )


def base_failed() -> Column:
    """Fixed rules: under 50 words, or more than half of the words repeated in windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value > self.cut if self.above else value <= self.cut


Rule = tuple[Condition, ...]


def rule_column(rule: Rule) -> Column:
    found = F.lit(True)
    for condition in rule:
        found = found & condition.column()
    return found


def first_rule(rules: list[Rule]) -> Column:
    """Number of the first rule (from 1) that holds, 0 when none does: one ``when`` chain."""
    chain = F
    for i, rule in enumerate(rules, 1):
        chain = chain.when(rule_column(rule), F.lit(i))
    return chain.otherwise(F.lit(0)) if rules else F.lit(0)


def learn_rules(
    labelled: DataFrame,
    features: tuple[str, ...] = FEATURES,
    cuts: int = 24,
    most_rules: int = 12,
    most_conditions: int = 4,
    least_covered: int = 5,
    precision: float = 0.9,
) -> list[Rule]:
    """Rules that find rows with ``bad`` = 1 among rows with ``features`` and ``part`` (0, 1, 2).

    A rule is kept while at least ``precision`` of what it covers on the pruning rows (part 2)
    is bad. Thresholds are ``cuts`` quantiles of each statistic. Without rows of both kinds there
    are no rules.
    """
    shares = [i / (cuts + 1) for i in range(1, cuts + 1)]
    asked = [
        F.percentile_approx(F.col(f).cast("double"), shares, 10_000).alias(f) for f in features
    ]
    # Quantiles of the bad rows too: they may be rarer than the distance of two quantiles of all.
    found = [labelled.agg(*asked).first(), labelled.filter("bad = 1").agg(*asked).first()]
    borders = {f: sorted({x for row in found for x in (row[f] or ())}) for f in features}

    def bin_of(feature: str) -> Column:
        value = F.col(feature).cast("double")
        return F.size(F.filter(F.lit(borders[feature]), lambda cut: cut < value))

    bins = [
        F.struct(F.lit(i).alias("f"), bin_of(f).alias("bin"))
        for i, f in enumerate(features)
        if borders[f]
    ]
    if not bins:
        return []
    rows = keep_table(labelled.withColumn("bins", F.array(*bins)), "labelled")

    def totals(where: DataFrame) -> tuple[int, int]:
        row = where.agg(F.sum("bad"), F.sum(1 - F.col("bad"))).first()
        return row[0] or 0, row[1] or 0

    def best(where: DataFrame, bad: int, good: int):
        """The threshold with the largest FOIL gain."""
        table = (
            where.select("bad", F.explode("bins").alias("b"))
            .groupBy("b.f", "b.bin")
            .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
            .collect()  # one row for each feature and threshold
        )
        start = math.log2(bad / (bad + good))
        choices = []
        for i, feature in enumerate(features):
            own = sorted((r["bin"], r["bad"], r["good"]) for r in table if r["f"] == i)
            for at, cut in enumerate(borders[feature]):
                low = [r for r in own if r[0] <= at]
                low_bad, low_good = sum(r[1] for r in low), sum(r[2] for r in low)
                for above, p, n in (
                    (False, low_bad, low_good),
                    (True, bad - low_bad, good - low_good),
                ):
                    if p >= least_covered and p + n < bad + good:
                        gain = p * (math.log2(p / (p + n)) - start)
                        choices.append((gain, p, -i, at, above, Condition(feature, above, cut)))
        return max(choices, key=lambda c: c[:5], default=None)

    rules: list[Rule] = []
    grow, prune = rows.filter("part < 2"), rows.filter("part = 2")
    while len(rules) < most_rules:
        left = first_rule(rules) == 0
        inside, rule = grow.filter(left), ()
        bad, good = totals(inside)
        while bad >= least_covered and good and len(rule) < most_conditions:
            choice = best(inside, bad, good)
            if not choice or choice[0] <= 0:
                break
            rule += (choice[-1],)
            inside = inside.filter(choice[-1].column())
            bad, good = totals(inside)
        if not rule:
            break
        # Reduced-error pruning: the prefix with the best balance on rows it wasn't grown on.
        prefixes = [rule[: i + 1] for i in range(len(rule))]
        counted = prune.filter(left).agg(
            *[F.sum(rule_column(p).cast("long") * F.col("bad")) for p in prefixes],
            *[F.sum(rule_column(p).cast("long") * (1 - F.col("bad"))) for p in prefixes],
        ).first()
        scored = []
        for i, prefix in enumerate(prefixes):
            p, n = counted[i] or 0, counted[i + len(prefixes)] or 0
            if p and p >= precision * (p + n):
                scored.append(((p - n) / (p + n), p, -i, prefix))
        if not scored:
            break
        rules.append(max(scored)[-1])
    return rules


def labelled_statistics(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of labelled documents that pass the fixed rules: ``bad`` and ``part``.

    Rows without a quality label are left out; a document labelled twice counts twice.
    """
    marked = labels.filter(F.col("quality").isNotNull()).select(
        "doc_id", (F.col("quality") == 0).cast("int").alias("bad")
    )
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3)).cast("int")
    return (
        stats.filter(~base_failed())
        .join(marked, "doc_id")
        .select("bad", part.alias("part"), *FEATURES)
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """Statistics, ``base_failed``, ``rule`` (first learned rule that holds, or 0) and ``kept``."""
    stats = keep_table(with_statistics(docs, ["doc_id"]), "statistics")
    rules = learn_rules(labelled_statistics(stats, labels))
    judged = stats.withColumns({"base_failed": base_failed(), "rule": first_rule(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)), rules


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the fixed and the learned rules, all columns as they are."""
    _, rules = quality_verdicts(docs, labels)
    whole = by_position(docs)
    judged = with_statistics(whole, whole.columns)
    kept = judged.filter(~base_failed() & (first_rule(rules) == 0))
    return kept.select(*whole.columns).toDF(*docs.columns)
