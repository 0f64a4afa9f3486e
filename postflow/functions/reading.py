"""Reading a sentence from left to right: negation, intensifiers and contrast.

One fold over the terms of a sentence keeps a small state: how far a negation still reaches, by
how much the next listed word counts, and whether a contrast has come. It gives sums of listed
words by the state they were met in; how much each sum matters is learned
(:mod:`postflow.operators.ordinal`), or taken from :data:`WEIGHTS`.
"""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from postflow.functions.sentiment import NEUTRAL_SCORE, PROBED_WORDS, word_score
from postflow.functions.text import terms

# Fixed word lists, for English.
NEGATIONS = ("not", "no", "never", "neither", "nor", "cannot", "without", "hardly")
INTENSIFIERS = {"very": 1.5, "really": 1.5, "so": 1.25, "too": 1.25, "extremely": 2.0, "slightly": 0.5, "somewhat": 0.75}
CONTRASTS = ("but", "however", "although", "yet")

SCOPE = 3
FEATURES = ("plain", "negated", "before", "after")
# Plain words count, negated ones turn round, and what follows a contrast outweighs what is before.
WEIGHTS = {"plain": 1.0, "negated": -0.75, "before": 0.5, "after": 1.5}


@dataclass(frozen=True)
class Grammar:
    """The words that change others, and the terms that a negation reaches (``scope``)."""

    negations: tuple = NEGATIONS
    intensifiers: Mapping[str, float] | None = None
    contrasts: tuple = CONTRASTS
    scope: int = SCOPE

    def factors(self) -> Mapping[str, float]:
        return INTENSIFIERS if self.intensifiers is None else self.intensifiers


def read_sentence(sentence: Column, lexicon: Mapping[str, float], grammar: Grammar = Grammar()) -> Column:
    """A struct of :data:`FEATURES` and ``listed``, from the terms of ``sentence`` in order.

    A listed word adds its score less the neutral one, times the factor of the intensifiers right
    before it, to ``negated`` if one of the ``scope`` terms before it is a negation, else to
    ``plain``. A contrast ends negations and moves what was read so far to ``before``; listed words
    after it add to ``after``, turned round if negated. ``listed`` counts listed words. A word of
    the grammar is not looked up in the lexicon. All zeros for null or no terms.
    """
    factors = grammar.factors()
    lit = F.lit
    named = [*grammar.negations, *grammar.contrasts, *factors]

    def step(s: Column, found: Column) -> Column:
        word = found["word"]
        value = F.coalesce(word_score(word, lexicon) - NEUTRAL_SCORE, lit(None).cast("double"))
        # The words left out since the last one use up a negation's reach and end a boost.
        skipped = found["at"] - s["at"] - 1
        token = F.struct(
            word.isin(list(grammar.negations)).alias("no"),
            word.isin(list(grammar.contrasts)).alias("but"),
            (word_score(word, factors) if factors else lit(None).cast("double")).alias("factor"),
            value.alias("value"),
            found["at"].alias("at"),
            F.greatest(s["reach"] - skipped, lit(0)).alias("reach"),
            F.when(skipped > 0, 1.0).otherwise(s["boost"]).alias("boost"),
        )
        return F.get(F.transform(F.array(token), lambda t: after(s, t)), lit(0))

    def after(s: Column, t: Column) -> Column:
        grammar_word = t["no"] | t["but"] | t["factor"].isNotNull()
        x = F.when(grammar_word, 0.0).otherwise(F.coalesce(t["value"], lit(0.0))) * t["boost"]
        hit = ~grammar_word & t["value"].isNotNull()
        reached = t["reach"] > 0
        seen = s["contrast"]
        plain = s["plain"] + F.when(~seen & ~reached, x).otherwise(0.0)
        negated = s["negated"] + F.when(~seen & reached, x).otherwise(0.0)
        later = s["after"] + F.when(seen, F.when(reached, -x).otherwise(x)).otherwise(0.0)
        moved = s["before"] + s["plain"] - s["negated"]
        return F.struct(
            F.when(t["but"], 0.0).otherwise(plain).alias("plain"),
            F.when(t["but"], 0.0).otherwise(negated).alias("negated"),
            # A second contrast outweighs all before it.
            F.when(t["but"], moved + s["after"]).otherwise(s["before"]).alias("before"),
            F.when(t["but"], 0.0).otherwise(later).alias("after"),
            (s["listed"] + F.when(hit, 1).otherwise(0)).alias("listed"),
            F.when(t["no"], lit(grammar.scope)).when(t["but"], 0).otherwise(F.greatest(t["reach"] - 1, lit(0))).alias("reach"),
            F.when(t["factor"].isNotNull(), t["boost"] * t["factor"]).otherwise(1.0).alias("boost"),
            (seen | t["but"]).alias("contrast"),
            t["at"].alias("at"),
        )

    def known(word: Column) -> Column:
        if len(lexicon) <= PROBED_WORDS:
            return word.isin([*named, *lexicon])
        return word.isin(named) | word_score(word, lexicon).isNotNull()

    def places(words: Column) -> Column:
        # Most words are unlisted: one probe of a set for each, and the fold sees the others only.
        marked = F.transform(words, lambda word, at: F.when(known(word), at))
        return F.transform(
            F.array_compact(marked), lambda at: F.struct(at.alias("at"), F.get(words, at).alias("word"))
        )

    zero = [lit(0.0).alias(name) for name in FEATURES]
    start = F.struct(
        *zero,
        lit(0).alias("listed"),
        lit(0).alias("reach"),
        lit(1.0).alias("boost"),
        lit(False).alias("contrast"),
        lit(-1).alias("at"),
    )
    words = F.coalesce(terms(sentence), F.array().cast("array<string>"))
    # Wrapped in an array, the words become a lambda variable and are computed once per row.
    found = F.get(F.transform(F.array(words), places), lit(0))
    return F.aggregate(found, start, step, lambda s: F.struct(*[s[name].alias(name) for name in (*FEATURES, "listed")]))


def reading_score(sentence: Column, lexicon: Mapping[str, float], grammar: Grammar = Grammar()) -> Column:
    """A score of 0 to 4 by :data:`WEIGHTS`: the weighted mean of the listed words beside neutral.

    A column function of a sentence, for the ``scorer`` arguments of ``operators.sentiment``.
    """

    def score(r: Column) -> Column:
        total = sum((r[name] * weight for name, weight in WEIGHTS.items()), F.lit(0.0))
        mean = F.when(r["listed"] > 0, total / r["listed"]).otherwise(0.0)
        return F.least(F.greatest(mean + NEUTRAL_SCORE, F.lit(0.0)), F.lit(4.0))

    return F.get(F.transform(F.array(read_sentence(sentence, lexicon, grammar)), score), F.lit(0))
