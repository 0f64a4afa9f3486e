"""A small general sentiment lexicon, for callers without one of their own.

Scores run from 0 (very negative) to 4 (very positive); unlisted words do not count.
"""

_BY_SCORE = {
    0.0: """
        abysmal appalling atrocious awful catastrophe catastrophic corrupt despicable disaster
        disastrous disgrace disgraceful disgusting dreadful evil hate hated hateful horrible
        horrific murder nightmare pathetic shameful terrible terror toxic tragedy tragic vile
        worst worthless
    """,
    1.0: """
        afraid angry annoying attack bad blame boring broken complain crisis criticism damage
        danger defeat difficult disappointed disappointing doubt fail failed failure fake fear
        fight fraud hurt lie lied loss lost mistake poor problem protest risk sad scam slow
        stupid sorry threat ugly unfair unhappy useless weak worried worse wrong
    """,
    3.0: """
        agree better calm clean clear easy effective enjoy fair fine fresh friendly fun gain
        glad good happy help helpful honest hope improve interesting kind like nice pleasant
        positive progress promise proud ready safe smart strong success support thank thanks
        trust useful welcome well win won
    """,
    4.0: """
        amazing awesome beautiful best brilliant celebrate delight delighted excellent
        exceptional fantastic glorious great inspiring love loved magnificent marvellous
        outstanding perfect remarkable splendid superb terrific thrilled triumph victory
        wonderful
    """,
}

ENGLISH = {word: score for score, words in _BY_SCORE.items() for word in words.split()}
