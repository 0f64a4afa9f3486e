"""Test input derived from the given tables, in both SQL dialects, and fixed parameters."""

from pyspark.sql import DataFrame, SparkSession

_FIELDS = """
 text || case doc_id % 11 when 0 then ' Great.' || chr(13) || chr(10) || 'The end.' || chr(13) || chr(10)
   when 1 then ' Fine stuff. https://t.co/ab' || cast(doc_id as string) || '.x of'
   when 2 then ' Of 3.5 and v1.2, the end.' || chr(160)
   when 3 then ' @bob don''t e-mail U.S. offices' when 4 then chr(9) || chr(9) || chr(13) || chr(10)
   when 5 then '...' || chr(160) || '!' else '' end
  || ' #' || source || case when doc_id % 3 = 0 then ' #Tag' || cast(doc_id % 7 as string) else '' end as text, lang,
 case when doc_id % 17 = 0 then null when doc_id % 17 = 1 then 'plain'
  else '<a href="http://example.com/' || source || '" rel="nofollow">' || case doc_id % 6
   when 0 then 'Twitter for iPhone' when 1 then 'Twitter for Android' when 2 then 'Twitter Web Client'
   when 3 then 'Twitter for iPad' when 4 then 'BotPoster' else 'Scheduler' end || '</a>' end as source,
 (doc_id*13)%500 as favoriteCount, (doc_id*7)%50 as retweetCount,
"""

POSTS_SPARK = f"""
select doc_id as id,
 cast(timestamp_ntz'2019-01-12 00:00:00' as timestamp) + make_dt_interval(0,0,0,doc_id*37) as createdAt,
 {_FIELDS}
 named_struct('lang', lang,
  'location', case when doc_id%5=0 then null else 'loc' || cast(doc_id%9 as string) end,
  'followersCount', (doc_id*101)%5000) as user,
 case when doc_id%4=0 then null else named_struct('retweetCount', (doc_id*37)%400,
  'favoriteCount', (doc_id*11)%300,
  'user', named_struct('followersCount', (doc_id*53)%1000)) end as retweetedStatus,
 case when doc_id%3=0 then null else named_struct('name',
  case when doc_id%3=1 then null else 'City' || cast(doc_id%11 as string) end) end as place
from {{documents}}
"""

POSTS_DUCK = f"""
select doc_id as id,
 timestamp '2019-01-12 00:00:00' + to_seconds(doc_id*37) as createdAt,
 {_FIELDS}
 struct_pack(lang := lang,
  location := case when doc_id%5=0 then null else 'loc' || cast(doc_id%9 as string) end,
  followersCount := (doc_id*101)%5000) as "user",
 case when doc_id%4=0 then null else struct_pack(retweetCount := (doc_id*37)%400,
  favoriteCount := (doc_id*11)%300,
  "user" := struct_pack(followersCount := (doc_id*53)%1000)) end as retweetedStatus,
 case when doc_id%3=0 then null else struct_pack(name :=
  case when doc_id%3=1 then null else 'City' || cast(doc_id%11 as string) end) end as place
from documents
"""

# Fixed values of the checks.

PHRASES = (
    "the than", "thin EA", "tag3", "src1 erhe", "der und", "BJP",
    "#Tag5", "#the", "@bob", "e-mail", "U.S.", "don't", "#src2 una",
)

LEXICON = {
    "er": 0.0,
    "nd": 0.0,
    "un": 0.0,
    "ein": 0.0,
    "th": 1.0,
    "re": 1.0,
    "el": 1.0,
    "the": 3.0,
    "der": 3.0,
    "of": 4.0,
    "and": 4.0,
    "le": 4.0,
}

# As many words as a lexicon of its own may have, with many scores: no two words score alike often.
LARGE_LEXICON = {f"word{i}": (i % 500) / 125 for i in range(25_000)} | {
    word: (3 * i % 500) / 125 for i, word in enumerate(LEXICON)
}

# Words of the documents, standing for those of a grammar.
NEGATIONS, CONTRASTS = ("is", "it", "les", "un"), ("that", "que", "to")
INTENSIFIERS = {"in": 1.5, "be": 0.5, "de": 2.0}

VOCABULARY = (
    "er", "th", "nd", "re", "ed", "en", "ha", "es", "ea", "ti",
    "nt", "ing", "st", "ly", "ble", "ou", "wh", "sh", "thth", "tion",
)

CURVE_GRID = (2, 4, 6, 8, 10)


# Fixed times that cut the posts into three windows of arrival.
ARRIVALS = ("2019-01-12 00:40:00", "2019-01-12 01:20:00")

# Rows that share an id with another row.
REPEATED = """select id, text from {posts}
 union all select id, text || ' again the again' from {posts} where id % 10 = 0"""

# Lines that are no JSON record.
CORRUPT = """'{"id": ' || cast(doc_id as string) || ', "text": "cut of'"""

# A hundred phrases from each document at most: two or three of its longer words, or a tag and one.
_PHRASE = """case when j % 7 = 3 then concat('#', source, ' ', {0})
 when j % 5 = 0 then concat({0}, '+', {1}, ' ', {2}) else concat({0}, ' - ', {1}) end as phrase"""

PHRASES_SPARK = rf"""
select doc_id * 100 + j as phrase_id, {_PHRASE.format('get(ws, 2 * j)', 'get(ws, 2 * j + 1)', 'get(ws, 2 * j + 2)')}
from (select doc_id, source, ws, explode(sequence(0, 99)) as j from (select doc_id, source,
 filter(regexp_extract_all(lower(text), '[\\p{{{{L}}}}\\p{{{{M}}}}\\p{{{{N}}}}_]+', 0), w -> length(w) >= 6) as ws
 from {{documents}})) where 2 * j + 2 < size(ws)"""

PHRASES_DUCK = rf"""
select doc_id * 100 + j as phrase_id, {_PHRASE.format('ws[2 * j + 1]', 'ws[2 * j + 2]', 'ws[2 * j + 3]')}
from (select doc_id, source, ws, unnest(range(100)) as j from (select doc_id, source,
 list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}_]+'), lambda w: length(w) >= 6) as ws
 from documents)) where 2 * j + 2 < len(ws)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts made of the documents, one each."""
    return spark.sql(POSTS_SPARK, documents=table(spark, sf_dir, "documents"))


def phrase_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to a hundred phrases for each document."""
    return spark.sql(PHRASES_SPARK, documents=table(spark, sf_dir, "documents"))
