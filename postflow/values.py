"""Schemas and fixed values shared by every operator."""

from pyspark.sql import types as T

# The nested post record, as collected. ``createdAt`` is still text here.
POST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("createdAt", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("favoriteCount", T.LongType()),
        T.StructField("retweetCount", T.LongType()),
        T.StructField(
            "user",
            T.StructType(
                [
                    T.StructField("lang", T.StringType()),
                    T.StructField("location", T.StringType()),
                    T.StructField("followersCount", T.LongType()),
                ]
            ),
        ),
        T.StructField(
            "retweetedStatus",
            T.StructType(
                [
                    T.StructField("retweetCount", T.LongType()),
                    T.StructField("favoriteCount", T.LongType()),
                    T.StructField(
                        "user", T.StructType([T.StructField("followersCount", T.LongType())])
                    ),
                ]
            ),
        ),
        T.StructField("place", T.StructType([T.StructField("name", T.StringType())])),
    ]
)

# These must stay as they are for results to agree.

OTHER = "Other"

DEVICES = (
    "Twitter for iPhone",
    "Twitter for Android",
    "Twitter Web Client",
    "Twitter for iPad",
)

TRACK_PHRASES = (
    "Narendra Modi",
    "NarendraModi",
    "Rahul Gandhi",
    "RahulGandhi",
    "lok sabha elections",
    "loksabha elections",
    "lok sabha",
    "loksabha",
    "election 2019 india",
    "Bharatiya Janta Party",
    "BharatiyaJantaParty",
    "BJP",
    "Indian National Congress",
    "INC",
    "IndianNationalCongress",
    "Congress india",
)

MIN_REPOSTS = 100
MIN_REACH = 100

K_GRID = (20, 30, 40, 50, 60, 70, 80, 90, 100, 120, 140, 300)
K_GRID_LIVE = (5, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100, 120, 140)
ELBOW_SLOPE = -3.0
SPLIT_SEED = 1234
KMEANS_SEED = 1
VECTOR_SIZE = 5
WORD_VECTOR_TASKS = 4
TERM_BUCKETS = 20

SENTIMENT_LABELS = {
    "VERY_NEGATIVE": 0,
    "NEGATIVE": 1,
    "NEUTRAL": 2,
    "POSITIVE": 3,
    "VERY_POSITIVE": 4,
    "NOT_UNDERSTOOD": 5,
}

# Date texts: collected JSON, and the live record (after its weekday). Newer writers put a comma
# after the year, or a narrow blank before AM and PM; both are read as the first form.
COLLECTED_DATE = "MMM d, yyyy h:mm:ss a"
LIVE_DATE = "MMM dd HH:mm:ss zzz yyyy"

# The folder levels of a time slice.
SLICE_LEVELS = {
    "hour": ("year", "month", "day", "hour"),
    "minute": ("year", "month", "day", "hour", "minute"),
}

# What Java's \s matches; spelled out because SQL engines differ on it.
BLANKS = " \t\n\x0b\f\r"

# White space of all Unicode, as the inside of a character class.
WHITE = (
    r" \t\n\x0B\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# The same, letter by letter.
WHITE_LETTERS = (
    " \t\n\x0b\f\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
)
