"""Expressions over post text: built-in, null-safe, and narrow (no shuffle)."""

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from postflow.values import BLANKS, WHITE, WHITE_LETTERS


def hashtags(text: Column) -> Column:
    """Words starting with ``#``, as written, in order, with repeats; null for null text."""
    return F.filter(F.split(text, " "), lambda word: word.startswith("#"))


def tokens(text: Column) -> Column:
    """Lower-cased words between single blanks.

    Inner and leading empty words stay, trailing ones go. Empty text is one empty word,
    all-blank or null text is no word.
    """
    none = F.array().cast("array<string>")
    words = F.split(F.rtrim(F.lower(text), F.lit(BLANKS)), f"[{BLANKS}]")
    return F.when(text.isNull() | text.rlike(f"^[{BLANKS}]+$"), none).otherwise(words)


def terms(text: Column) -> Column:
    """Lower-cased runs of letters, digits and underscores.

    Unlike :func:`tokens` this sets punctuation, ``#`` and ``@`` aside, so that ``#Tag`` and
    ``tag.`` both give ``tag``. Extraction compiles its pattern once per task, where a split
    would compile it for every string.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0))


def phrase_terms(phrase: str) -> list[str]:
    """The :func:`terms` of a phrase to track; a ``#`` or ``@`` right before a term stays on it."""
    found, lead = [""], ""
    for letter in phrase.lower():
        if letter == "_" or unicodedata.category(letter)[0] in "LMN":
            found[-1] += (lead if not found[-1] else "") + letter
        elif found[-1]:
            found.append("")
        lead = letter if letter in "#@" else ""
    return [term for term in found if term]


def without(words: Column, dropped, lowered: bool = False) -> Column:
    """``words`` less the given ones, compared without case (or as they are, if ``lowered``)."""
    dropped = [word.lower() for word in dropped]
    return F.filter(words, lambda word: ~(word if lowered else F.lower(word)).isin(dropped))


def matches_phrase(text: Column, phrases) -> Column:
    """True where all terms of at least one phrase occur in ``text``, in any order and case.

    Phrases are cut into terms as texts are, so ``e-mail`` stands for ``e`` and ``mail``. A term
    with a ``#`` or ``@`` before it matches words so tagged only, a plain term either.

    The words of the text are first cut down to those any phrase uses (one hash probe each), so
    a long phrase list is only compared with the few words that can matter.
    """
    needed = [phrase_terms(phrase) for phrase in phrases]
    if not needed or not all(needed):
        raise ValueError("no phrase to track, or one without a letter or digit")
    used = sorted({term for phrase in needed for term in phrase})
    wanted = F.from_json(F.lit(json.dumps(needed)), "array<array<string>>")
    words = terms(text)
    if any(term[0] in "#@" for term in used):
        tagged = F.regexp_extract_all(F.lower(text), F.lit(r"[#@][\p{L}\p{M}\p{N}_]+"), F.lit(0))
        words = F.concat(words, tagged)
    hits = F.filter(words, lambda word: word.isin(used))

    def any_phrase(found: Column) -> Column:
        return (F.size(found) > 0) & F.exists(
            wanted, lambda phrase: F.forall(phrase, lambda term: F.array_contains(found, term))
        )

    # Wrapped in an array, the hits become a lambda variable and are computed once per row.
    return F.coalesce(F.exists(F.array(hits), any_phrase), F.lit(False))


def sentences(text: Column) -> Column:
    """Sentences without white space around them; null for null text.

    Links are left out. Line ends, ``!`` and ``?`` end a sentence, ``.`` only before white space
    or at the end of the text. A part without a letter or digit is no sentence.
    """
    # Most texts have no link: to look for one costs half of what replacing does.
    links = F.regexp_replace(text, f"(?i)https?://[^{WHITE}]+", " ")
    plain = F.when(text.rlike("(?i)https?://"), links).otherwise(text)
    cut = F.regexp_replace(plain, rf"\.+([{WHITE}]|\z)", "\n$1")
    parts = F.transform(F.split(cut, r"[!?\r\n]+"), lambda p: F.btrim(p, F.lit(WHITE_LETTERS)))
    return F.filter(parts, lambda part: part.rlike(r"[\p{L}\p{N}]"))
