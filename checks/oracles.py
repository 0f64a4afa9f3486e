"""The same results in plain SQL, written for DuckDB and apart from the Spark code."""

import re

from checks.fixtures import (
    ARRIVALS,
    CONTRASTS,
    CORRUPT,
    CURVE_GRID,
    INTENSIFIERS,
    LARGE_LEXICON,
    LEXICON,
    NEGATIONS,
    PHRASES,
    PHRASES_DUCK,
    POSTS_DUCK,
    REPEATED,
    VOCABULARY,
)
from checks.stop_words import ENGLISH

SPACE = r"[ \t\n\x0B\f\r]"
# Text split into runs of letters, marks, digits and underscores.
TERMS = r"string_split_regex(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}_]+')"
DEVICE_TEST = (
    "(contains(source, 'Twitter for iPhone') or contains(source, 'Twitter for Android')"
    " or contains(source, 'Twitter Web Client') or contains(source, 'Twitter for iPad'))"
)
SOURCE_NAME = """case when {0} is null or not regexp_matches({0}, '>+[^>]')
 or regexp_matches(string_split({0}, '>')[2], '^<+$') then 'Other'
 else string_split(string_split({0}, '>')[2], '<')[1] end"""
HASHTAGS = "list_filter(string_split(text, ' '), lambda w: starts_with(w, '#'))"
TOKENS = f"""case when text is null or (regexp_replace(lower(text), '{SPACE}+$', '') = '' and text <> '')
 then []::varchar[]
 else string_split_regex(regexp_replace(lower(text), '{SPACE}+$', ''), '{SPACE}') end"""


def quoted(words) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


def without_stop_words(words: str) -> str:
    return f"list_filter({words}, lambda w: not list_contains([{quoted(ENGLISH)}], w))"


def bar(expr: str) -> str:
    return f"array_to_string({expr}, '|')"


POSTS = f"with posts as ({POSTS_DUCK})"
FLAT = """id, createdAt, text, lang, source, favoriteCount, retweetCount,
 "user".lang as userLang, "user".location as location, "user".followersCount as followersCount,
 retweetedStatus.retweetCount as reposts, retweetedStatus.favoriteCount as favorites,
 retweetedStatus."user".followersCount as reach, place.name as placeName"""
PROJECT = f"""createdAt, favoriteCount, retweetCount, {SOURCE_NAME.format('source')} as sourceName, id,
 "user".lang as lang, text, {{0}} as location, "user".followersCount as followersCount,
 retweetedStatus."user".followersCount as retweetedStatus_user_followersCount,
 retweetedStatus.favoriteCount as retweetedStatus_favoriteCount,
 retweetedStatus.retweetCount as retweetedStatus_retweetCount"""
PLACE = "coalesce(place.name, 'Other')"
SOURCE = SOURCE_NAME.format("source")

def words_from(posts: str) -> str:
    """Words and weights by row (r), of posts whose ids may repeat."""
    return f"""{POSTS},
rows as (select row_number() over () as r, id, text from ({posts})),
words as (select r, id, {without_stop_words(TOKENS)} as ws from rows),
tf as (select r, id, term, count(*) as tf from (select r, id, unnest(ws) as term from words)
 where term <> '' group by r, id, term),
idf as (select term, count(*) as df,
 ln(((select count(*) from rows) + 1.0) / (count(*) + 1.0)) as idf from tf group by term)"""


WORDS = words_from("posts")
ROWS = REPEATED.format(posts="posts")
ROW_WORDS = words_from(ROWS)


def tracked(phrases) -> str:
    tests = []
    for phrase in phrases:
        terms = re.findall(r"[#@]?\w+", phrase.lower())
        has = [
            f"list_contains(regexp_extract_all(lower(text), '[#@][\\p{{L}}\\p{{M}}\\p{{N}}_]+'), '{t}')"
            if t[0] in "#@"
            else f"list_contains({TERMS.format('text')}, '{t}')"
            for t in terms
        ]
        tests.append("(" + " and ".join(has) + ")")
    return " or ".join(tests)


TRACKED = f"({tracked(PHRASES)})"

WHITE = (
    r" \t\n\x0B\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def sentences_from(posts: str) -> str:
    """Sentences by row (r): links go, then dots before white space become line ends."""
    return f"""{POSTS},
split as (select r, id, list_filter(list_transform(string_split_regex(regexp_replace(
 regexp_replace(text, '(?i)https?://[^{WHITE}]+', ' ', 'g'), '\\.+([{WHITE}]|\\z)', chr(10) || '\\1', 'g'),
 '[!?\\r\\n]+'), lambda x: regexp_replace(x, '^[{WHITE}]+|[{WHITE}]+\\z', '', 'g')),
 lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')) as parts
 from (select row_number() over () as r, id, text from ({posts}))),
sentences as (select r, id, unnest(range(len(parts)))::integer as pos, unnest(parts) as sentence
 from split)"""


SENTENCES = sentences_from("posts")


def scores(lexicon: str, posts: str = "posts") -> str:
    return f"""{sentences_from(posts)},
lexicon as ({lexicon}),
hits as (select r, pos, avg(score) as score
 from (select r, pos, unnest({TERMS.format('sentence')}) as word from sentences)
 join lexicon using (word) group by r, pos),
scored as (select s.r, s.id, s.pos, coalesce(h.score, 2.0) as score, length(sentence)::integer as len
 from sentences s left join hits h on s.r = h.r and s.pos = h.pos)"""


def listed(lexicon) -> str:
    rows = ", ".join(f"('{word}', {score}::double)" for word, score in lexicon.items())
    return f"select * from (values {rows}) v(word, score)"


SCORED = scores(listed(LEXICON))
LARGE = scores(
    "select 'word' || i as word, (i % 500) / 125.0::double as score from range(25000) t(i) union all "
    + listed({word: LARGE_LEXICON[word] for word in LEXICON})
)
LENGTHS = f"""select word, (length(word) % 5)::double as score from (select distinct
 unnest({TERMS.format('text')}) as word from ({ROWS})) where word <> ''"""
BY_LENGTH = scores(LENGTHS, ROWS)
BY_SCORER = f"""{sentences_from(ROWS)},
scored as (select r, id, pos, (length(sentence) % 5)::double as score, length(sentence)::integer as len
 from sentences)"""


def totals(scored: str) -> str:
    """Scores by row, for rows with a sentence."""
    return f"""{scored},
rated as (select t.id, coalesce(score, -1.0) as score, coalesce(mean_score, -1.0) as mean_score,
 coalesce(main_score, -1.0) as main_score from split t left join
 (select r, sum(score * len order by pos) / sum(len) as score, avg(score) as mean_score,
 arg_max(score, len::bigint * 1000000000 - pos) as main_score from scored group by r) using (r))
select id, round(score, 6) as score, round(mean_score, 6) as mean_score,
 round(main_score, 6) as main_score from rated"""


def sentiment_from(scored: str) -> str:
    return f"""{scored},
totals as (select id, sum(score * len order by pos) / sum(len) as score, avg(score) as mean_score,
 arg_max(score, len::bigint * 1000000000 - pos) as main_score from scored group by id),
rated as (select p.id, p.text, coalesce(score, -1.0) as score, coalesce(mean_score, -1.0) as mean_score,
 coalesce(main_score, -1.0) as main_score from posts p left join totals t on p.id = t.id),
classed as (select *, case when score <= 0 or score >= 5 then 'NOT_UNDERSTOOD'
 when score < 1 then 'VERY_NEGATIVE' when score < 2 then 'NEGATIVE' when score < 3 then 'NEUTRAL'
 when score < 4 then 'POSITIVE' else 'VERY_POSITIVE' end as sentiment from rated),
labelled as (select *, case sentiment when 'VERY_NEGATIVE' then 0 when 'NEGATIVE' then 1
 when 'NEUTRAL' then 2 when 'POSITIVE' then 3 when 'VERY_POSITIVE' then 4 else 5 end as label
 from classed)"""


SENTIMENT = sentiment_from(SCORED)

PART = "case when ('0x' || substr(md5(id || '-1234'), 1, 8))::bigint % 1000 < 700 then 'train' else 'test' end"
VOCABULARY_ROWS = ", ".join(f"({i}, '{word}')" for i, word in enumerate(VOCABULARY))
BAYES = f"""{SENTIMENT},
parted as (select id, label, {PART} as part from labelled),
vocabulary as (select * from (values {VOCABULARY_ROWS}) v(feature, term)),
counts as (select id, feature, count(*) as n from
 (select id, unnest({without_stop_words(TOKENS)}) as term from posts) join vocabulary using (term)
 group by id, feature),
classes as (select label, count(*) as docs from parted where part = 'train' group by label),
sums as (select label, feature, coalesce(sum(n), 0) as n from classes cross join vocabulary
 left join (select label, feature, n from parted join counts using (id) where part = 'train') c
 using (label, feature) group by label, feature),
model as (select label, ln(docs + 1.0) - ln((select sum(docs) + count(*) from classes)) as prior,
 feature::integer as feature, ln(n + 1.0) - ln(sum(n) over (partition by label) + {len(VOCABULARY)}) as weight
 from sums join classes using (label)),
test as (select id, label from parted where part = 'test'),
posterior as (select t.id, m.label, any_value(m.prior) + sum(m.weight * coalesce(c.n, 0)) as p
 from test t cross join model m left join counts c on c.id = t.id and c.feature = m.feature
 group by t.id, m.label),
predicted as (select t.id, t.label, x.prediction_bayes from test t join
 (select id, label as prediction_bayes, row_number() over
 (partition by id order by round(p, 9) desc, label) as place from posterior) x
 on x.id = t.id and x.place = 1)"""
PROBABILITIES = f"""{BAYES},
odds as (select id, label, exp(p - max(p) over (partition by id)) as o from posterior),
rated_classes as (select t.label, o.label as class, round(o / sum(o) over (partition by o.id), 6) as p
 from odds o join test t on t.id = o.id)"""

# Phrases by counting: all terms of a phrase among those of a post.
MATCHES = f"""{POSTS},
phrases as ({PHRASES_DUCK}),
used as (select distinct phrase_id, term from (select phrase_id,
 unnest(regexp_extract_all(lower(phrase), '[#@]?[\\p{{L}}\\p{{M}}\\p{{N}}_]+')) as term from phrases)),
need as (select phrase_id, count(*) as need from used group by phrase_id),
held as (select distinct id, term from (select id, unnest(list_concat({TERMS.format('text')},
 regexp_extract_all(lower(text), '[#@][\\p{{L}}\\p{{M}}\\p{{N}}_]+'))) as term from posts)),
matches as (select id, phrase_id from held join used using (term) join need using (phrase_id)
 group by id, phrase_id, need having count(*) = need)"""

def mapped(values) -> str:
    return "map {" + ", ".join(f"'{word}': {x}::double" for word, x in values.items()) + "}"


# A step of the recursion reads the next term of every sentence.
READ = f"""{SENTENCES.replace("with posts", "with recursive posts", 1)},
fold as (select r, id, pos, list_filter({TERMS.format('sentence')}, lambda w: w <> '') as ws, 0 as i,
 0.0::double as plain, 0.0::double as negated, 0.0::double as before, 0.0::double as after,
 0 as listed, 0 as reach, 1.0::double as boost, false as contrast from sentences
 union all select r, id, pos, ws, i + 1,
 case when but then 0.0 else plain + case when contrast or reach > 0 then 0.0 else x end end,
 case when but then 0.0 else negated + case when contrast or reach = 0 then 0.0 else x end end,
 case when but then before + plain - negated + after else before end,
 case when but then 0.0 else after + case when not contrast then 0.0 when reach > 0 then -x else x end end,
 listed + hit, case when no then 3 when but then 0 else greatest(reach - 1, 0) end,
 case when factor is null then 1.0 else boost * factor end, contrast or but
 from (select *, coalesce(value, 0.0) * boost as x, case when value is null then 0 else 1 end as hit
 from (select *, case when not no and not but and factor is null then {mapped(LEXICON)}[w] - 2.0 end as value
 from (select *, w in ({quoted(NEGATIONS)}) as no, w in ({quoted(CONTRASTS)}) as but,
 {mapped(INTENSIFIERS)}[w] as factor from (select *, ws[i + 1] as w from fold where i < len(ws))))))"""

# Words next to each other or one apart, by place in the post.
PAIRS = f"""{WORDS},
placed as (select r, unnest(range(len(ws))) as i, unnest(ws) as w from words),
frequent as (select w from placed where w <> '' group by w having count(*) >= 20),
near as (select a.w as word, b.w as context, count(*) as n from placed a join placed b
 on a.r = b.r and a.i <> b.i and abs(a.i - b.i) <= 2
 where a.w in (from frequent) and b.w in (from frequent) group by all),
word_sums as (select word, sum(n) as m from near group by word),
weights as (select word, context, ln(n * (select sum(n)::double from near) / (a.m::double * b.m)) as weight
 from near join word_sums a using (word) join (select word as context, m from word_sums) b using (context))"""

# The public 32-bit Murmur3 hash of UTF-8 bytes with seed 42, in unsigned 64-bit arithmetic:
# whole little-endian blocks of four bytes, then the rest, then the final mix.
MASK = "4294967295::ubigint"


def times(x: str, factor: int) -> str:
    return f"(({x}) * {factor}::ubigint & {MASK})"


def rotate(x: str, bits: int) -> str:
    return f"({times(x, 2**bits)} | (({x}) >> {32 - bits}))"


def block_mix(k: str) -> str:
    return times(rotate(times(k, 0xCC9E2D51), 15), 0x1B873593)


def little_endian(size: int, at: str) -> str:
    pairs = " || ".join(f"substr(hex, {at} + {2 * i}, 2)" for i in reversed(range(size)))
    return f"('0x' || {pairs})::ubigint"


def tail(size: int) -> str:
    return f"when n % 4 = {size} then {block_mix(little_endian(size, '2 * (n - n % 4) + 1'))}"


STEP = f"({rotate('xor(h, k)', 13)} * 5::ubigint + {0xE6546B64}::ubigint) & {MASK}"
BUCKETS = f"""{WORDS},
bytes as (select term, hex(encode(term)) as hex, octet_length(encode(term)) as n
 from (select distinct unnest(ws) as term from words)),
mixed as (select term, n, list_reduce(list_transform(range(0, n // 4),
  lambda i: {block_mix(little_endian(4, "8 * i + 1"))}), lambda h, k: {STEP}, 42::ubigint) as h,
 case {tail(1)} {tail(2)} {tail(3)} else 0::ubigint end as rest from bytes),
started as (select term, xor(xor(h, rest), n::ubigint) as h from mixed),
half as (select term, {times('xor(h, h >> 16)', 0x85EBCA6B)} as h from started),
most as (select term, {times('xor(h, h >> 13)', 0xC2B2AE35)} as h from half),
hashed as (select term, xor(h, h >> 16)::bigint as h from most),
buckets as (select term,
 (((case when h >= 2147483648 then h - 4294967296 else h end) % 20 + 20) % 20)::integer as bucket
 from hashed),
bucket_counts as (select id, bucket, count(*) as n from
 (select id, unnest(ws) as term from words) join buckets using (term) group by id, bucket)"""

CENTRES = """with parts as (select vec_id, label, unnest(range(1, len(embedding) + 1)) as i,
 unnest(embedding)::double as x from embeddings),
centres as (select label as cid, list(x order by i) as c from
 (select label, i, avg(x) as x from parts group by label, i) group by label),
distances as (select vec_id, cid, list_sum(list_transform(range(1, len(c) + 1),
 lambda i: (embedding[i]::double - c[i]) * (embedding[i]::double - c[i]))) as d
 from embeddings cross join centres)"""
NEAREST = f"{CENTRES}, nearest as (select vec_id, arg_min(cid, d) as cluster, min(d) as d from distances group by vec_id)"
CURVE_ROWS = ", ".join(f"({k})" for k in CURVE_GRID)

WINDOW_COUNTS = """select date_trunc('hour', ts) as window_start,
 date_trunc('hour', ts) + interval 1 hour as window_end, event_type, count(*) as count
 from events group by all"""
KEPT = f"""lang = 'en' and source is not null and retweetedStatus.retweetCount > 100
 and retweetedStatus."user".followersCount > 100 and {DEVICE_TEST}"""
CURATED = f"""{POSTS}, kept as (select distinct {PROJECT.format("""coalesce("user".location, 'Other')""")} from posts
 where {KEPT})
select *, {bar(HASHTAGS)} as hashtags, {bar(TOKENS)} as words,
 {bar(without_stop_words(TOKENS))} as filtered_words from kept"""
LIVE = f"""{POSTS}, flat as (select id, createdAt, text, {SOURCE} as source, lang,
 "user".lang as userLang, retweetCount from posts),
kept as (select distinct createdAt, retweetCount, source, id, userLang, text from flat
 where lang = 'en' and source is not null and {DEVICE_TEST})
select *, {bar(HASHTAGS)} as hashtags, {bar(TOKENS)} as words,
 {bar(without_stop_words(TOKENS))} as filtered_words from kept"""

def classified(kept: str, sentiment: str = SENTIMENT) -> str:
    """The whole classification of the posts whose ids ``kept`` selects."""
    return f"""{BUCKETS}{sentiment.removeprefix(POSTS)},
parted as (select id, label, {PART} as part from labelled where id in ({kept})),
every as (select unnest(range(20))::integer as bucket),
train as (select id, label from parted where part = 'train'),
weights as (select bucket, ln(((select count(*) from train) + 1.0) / (count(c.id) + 1.0)) as w
 from every left join (select * from bucket_counts where id in (select id from train)) c
 using (bucket) group by bucket),
features as (select c.id, c.bucket, c.n * w.w as x from bucket_counts c join weights w using (bucket)),
classes as (select label, count(*) as docs from train group by label),
sums as (select c.label, e.bucket, coalesce(sum(f.x), 0.0) as x from classes c cross join every e
 left join (select t.label, f.bucket, f.x from train t join features f on f.id = t.id) f
 on f.label = c.label and f.bucket = e.bucket group by c.label, e.bucket),
model as (select label, ln(docs + 1.0) - ln((select sum(docs) + count(*) from classes)) as prior,
 bucket, ln(x + 1.0) - ln(sum(x) over (partition by label) + 20.0) as weight
 from sums join classes using (label)),
posterior as (select t.id, m.label, any_value(m.prior) + sum(m.weight * coalesce(f.x, 0.0)) as p
 from parted t cross join model m left join features f on f.id = t.id and f.bucket = m.bucket
 where t.part = 'test' group by t.id, m.label)
select id, label as prediction_bayes from
 (select id, label, row_number() over (partition by id order by round(p, 9) desc, label) as place
 from posterior) where place = 1"""


KEPT_IDS = f"select id from posts where {KEPT}"
LIVE_IDS = f"""select id from (select id, createdAt, lang, {SOURCE} as source from posts)
 where lang = 'en' and source is not null and {DEVICE_TEST} and {{0}}"""
WINDOWS = (
    f"createdAt < '{ARRIVALS[0]}'",
    f"createdAt >= '{ARRIVALS[0]}' and createdAt < '{ARRIVALS[1]}'",
    f"createdAt >= '{ARRIVALS[1]}'",
)
LIVE_CLASSIFIED = " union all ".join(
    f"select {i}::integer as batch_id, * from ({classified(LIVE_IDS.format(window))})"
    for i, window in enumerate(WINDOWS)
)


def learned(kept: str) -> str:
    """One fit of IDF and Naive Bayes over the training part of the live posts that ``kept`` holds."""
    return f"""{WORDS}{SENTIMENT.removeprefix(POSTS)},
train as (select id, label from labelled where {PART} = 'train' and id in ({LIVE_IDS.format(kept)})),
seen as (select label, term, sum(tf) as n, count(*) as posts from tf join train using (id) group by all),
known as (select term, sum(posts)::bigint as df,
 ln(((select count(*) from train) + 1.0) / (sum(posts) + 1.0)) as idf from seen group by term),
classes as (select label, count(*) as docs from train group by label),
masses as (select label, ln(coalesce(sum(n * idf), 0.0) + (select count(*) from known)) as whole
 from classes left join seen using (label) left join known using (term) group by label),
priors as (select label, ln(docs + 1.0) - ln((select sum(docs) + count(*) from classes)) as prior, whole
 from classes join masses using (label))"""


def predicted(window: int) -> str:
    """The test posts of a window by the model of all windows up to it."""
    so_far = "(" + " or ".join(f"({w})" for w in WINDOWS[: window + 1]) + ")"
    return f"""{learned(so_far)},
test as (select id from labelled where {PART} = 'test' and id in ({LIVE_IDS.format(WINDOWS[window])})),
held as (select id, term, tf * idf as x from tf join test using (id) join known using (term)),
sums as (select id, sum(x) as x from held group by id),
gains as (select id, label, sum(x * ln(n * idf + 1.0)) as gain from held join seen using (term)
 join known using (term) group by id, label),
posterior as (select t.id, p.label,
 prior - whole * coalesce(s.x, 0.0) + coalesce(gain, 0.0) as p from test t cross join priors p
 left join sums s on s.id = t.id left join gains g on g.id = t.id and g.label = p.label)
select {window}::integer as batch_id, id, label as prediction_bayes from (select id, label,
 row_number() over (partition by id order by round(p, 9) desc, label) as place from posterior)
where place = 1"""


LEARNED = learned("true")
LIVE_PREDICTED = " union all ".join(f"select * from ({predicted(i)})" for i in range(len(WINDOWS)))


def running_centres(windows: int, k: int) -> str:
    """Means of the points of each window at the centres of the windows before it."""
    steps = [f"""with points as (select vec_id, embedding::double[] as x from embeddings),
c0 as (select vec_id::integer as cluster, x as centre, [0.0 for i in x] as total, 0::bigint as n
 from points where vec_id < {k})"""]
    for w in range(windows):
        steps.append(f"""d{w} as (select p.vec_id, cluster, list_sum(list_transform(range(1, len(x) + 1),
 lambda i: (x[i] - centre[i]) * (x[i] - centre[i]))) as d from points p, c{w} where vec_id % {windows} = {w}),
near{w} as (select vec_id, arg_min(cluster, d) as cluster from d{w} group by vec_id),
parts{w} as (select cluster, i, sum(v) as v, count(*) as n from (select cluster,
 unnest(range(1, len(x) + 1)) as i, unnest(x) as v from points join near{w} using (vec_id)) group by all),
sums{w} as (select cluster, list(v order by i) as v, any_value(n) as n from parts{w} group by cluster),
both{w} as (select c.cluster, centre, [t + coalesce(s.v[i], 0.0) for t, i in c.total] as total,
 c.n + coalesce(s.n, 0) as n from c{w} c left join sums{w} s using (cluster)),
c{w + 1} as (select cluster, case when n > 0 then [t / n for t in total] else centre end as centre, total, n
 from both{w})""")
    return ",\n".join(steps) + f"""
select cluster, unnest(range(len(centre)))::integer as dim, round(unnest(centre), 6) as x from c{windows}"""


def plain_lloyd(rounds: int) -> str:
    """Lloyd's algorithm from the first vectors, every distance taken."""
    steps = [f"""with points as (select vec_id, embedding::double[] as x from embeddings),
c0 as (select k, vec_id::integer as cluster, x as centre from points, (values {CURVE_ROWS}) v(k) where vec_id < k)"""]
    for r in range(rounds):
        steps.append(f"""near{r} as (select k, vec_id, arg_min(cluster, d) as cluster from (select k, vec_id, cluster,
 list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - centre[i]) * (x[i] - centre[i]))) as d
 from points, c{r}) group by k, vec_id),
mean{r} as (select k, cluster, list(v order by i) as centre from (select k, cluster, i, avg(v) as v from
 (select k, cluster, unnest(range(len(x))) as i, unnest(x) as v from points join near{r} using (vec_id))
 group by all) group by k, cluster),
c{r + 1} as (select c.k, c.cluster, coalesce(m.centre, c.centre) as centre from c{r} c left join mean{r} m
 on m.k = c.k and m.cluster = c.cluster)""")
    return ",\n".join(steps) + f"""
select k, cluster, unnest(range(len(centre)))::integer as dim, round(unnest(centre), 6) as x from c{rounds}"""


UNIQUE = f"""{POSTS}, live as (select id, createdAt, text from posts
 where lang = 'en' and source is not null and {DEVICE_TEST}),
mark as (select max(createdAt) - interval 30 minute as mark from (select createdAt from live where {WINDOWS[1]}
 union all select createdAt + interval 20 minute from live where {WINDOWS[0]}))
select id, createdAt, text, {bar(without_stop_words(TOKENS))} as filtered_words from (select * from live union all
 select id, createdAt + interval 90 minute, text from live, mark
 where {WINDOWS[0]} and createdAt + interval 30 minute < mark)"""
BY_TABLE_CLASSIFIED = classified(KEPT_IDS, sentiment_from(scores(LENGTHS)))
CLOSED = """select date_trunc('hour', ts) as window_start,
 date_trunc('hour', ts) + interval 1 hour as window_end, event_type, count(*) as count
 from events, (select max(ts) - interval 12 day as mark from events
  where ts >= '2024-01-10' and ts < '2024-01-20')
 where not (event_id % 10 = 0 and ts < '2024-01-10')
  or mark is null or date_trunc('hour', ts) + interval 1 hour > mark group by all"""
LATE_POSTS = f"""{POSTS}, late as (select * replace (createdAt + interval 353 days + interval 1410 minutes as createdAt)
 from posts)"""

ORACLES = {
    "read_posts_json": f"""{POSTS} select {FLAT}, null as corrupt from posts union all
 select {", ".join(["null"] * 14)}, {CORRUPT} from documents where doc_id % 20 = 0""",
    "read_time_slice": f"""{POSTS} select id, createdAt, text, year(createdAt)::integer as year,
 month(createdAt)::integer as month, day(createdAt)::integer as day, hour(createdAt)::integer as hour
 from posts where hour(createdAt) = 1""",
    "read_range": f"""{LATE_POSTS} select id, createdAt, text, year(createdAt)::integer as year,
 hour(createdAt)::integer as hour from late
 where createdAt >= '2019-12-31 23:50:00' and createdAt < '2020-01-01 00:40:00'""",
    "compact_slices": f"""{LATE_POSTS} select year(createdAt)::integer as year, month(createdAt)::integer as month,
 day(createdAt)::integer as day, (id % 4)::bigint as batch_id, count(*) as posts,
 count(distinct id) as ids, sum(length(text))::bigint as chars from late group by all""",
    "stream_posts": f"{POSTS} select id, createdAt, text from posts where {TRACKED}",
    "phrase_matches": f"""{MATCHES} select id, count(*) as phrases, min(phrase_id) as least,
 max(phrase_id) as largest, sum(phrase_id % 1009)::bigint as checksum from matches group by id""",
    "track_phrases": f"""{MATCHES} select id, text from posts where id % 2 = 0 and id in
 (select id from matches where phrase_id % 200 >= 100)""",
    "track_filter": f"{POSTS} select id, text from posts where {TRACKED}",
    "posts_to_json": f"""{POSTS} select * replace (strftime(createdAt, '%b %-d, %Y %-I:%M:%S %p') as createdAt)
 from (select {FLAT} from posts)""",
    "sink_by_time": f"""{POSTS} select year(createdAt)::integer as year, month(createdAt)::integer as month,
 day(createdAt)::integer as day, hour(createdAt)::integer as hour, count(*) as posts,
 sum(length(text))::bigint as chars from posts group by all""",
    "files_per_batch": f"""{POSTS} select (case when {WINDOWS[0]} then 0 when {WINDOWS[1]} then 1 else 2 end)::bigint
 as batch_id, 3::bigint as files, count(*) as posts from posts group by 1""",
    "trigger_interval": f"""{POSTS} select hour(createdAt)::integer as hour, count(*) as posts
 from posts group by 1""",
    "skip_empty_window": f"""{POSTS} select count(*) as posts, max(id) as last from posts
 group by {WINDOWS[0]}""",
    "restart_collect": f"{POSTS} select id, 1::bigint as copies from posts",
    "write_stage": f"""{SENTIMENT} select id, text, {bar(HASHTAGS)} as hashtags, sentiment, label
 from labelled""",
    "filter_lang": f"{POSTS} select {FLAT} from posts where lang = 'en'",
    "filter_source_present": f"{POSTS} select {FLAT} from posts where source is not null",
    "filter_repost_count": f"{POSTS} select {FLAT} from posts where retweetedStatus.retweetCount > 100",
    "filter_author_reach": f"""{POSTS} select {FLAT} from posts
 where retweetedStatus."user".followersCount > 100""",
    "filter_devices": f"{POSTS} select {FLAT} from posts where {DEVICE_TEST}",
    "source_name": f"{POSTS} select id, source, {SOURCE} as sourceName from posts",
    "source_name_pages": f"""select page_id, pos, {SOURCE_NAME.format('anchor')} as sourceName from
 (select page_id, unnest(range(len(anchors)))::integer as pos, unnest(anchors) as anchor from
 (select page_id, regexp_extract_all(html, '<a [^>]*>[^<]*</a>') as anchors from pages))""",
    "place_name": f"{POSTS} select id, {PLACE} as place from posts",
    "project_posts": f"""{POSTS} select {PROJECT.format('"user".location')} from posts""",
    "project_posts_live": f"""{POSTS} select createdAt, retweetCount, {SOURCE} as source, id,
 "user".lang as userLang, text from posts""",
    "flatten_posts": f"""{POSTS} select id, createdAt, text, {SOURCE} as source, lang,
 "user".lang as userLang, {PLACE} as place, retweetCount from posts""",
    "fill_missing": f"""{POSTS} select id, coalesce("user".location, 'Other') as location,
 {PLACE} as place from posts""",
    "dedup_posts": f"""{POSTS} select {PROJECT.format('"user".location')} from posts
 union select {PROJECT.format('"user".location')} from posts""",
    "dedup_texts": "select distinct text, lang from documents",
    "device_distribution": f"""{POSTS} select {SOURCE} as sourceName, count(*) as count from posts
 group by 1 order by count desc, sourceName limit 15""",
    "parse_created_at": f"""{POSTS} select id, createdAt as collected, createdAt as live,
 createdAt as comma, createdAt as narrow, case when id % 2 = 0 then createdAt end as mixed,
 case when id % 2 = 1 then 'day ' || id end as mixedText from posts""",
    "hashtags": f"{POSTS} select id, {bar(HASHTAGS)} as hashtags from posts",
    "tokenize": f"{POSTS} select id, {bar(TOKENS)} as words from posts",
    "tokenize_pattern": f"""{POSTS} select id, {bar("list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: length(w) >= 3)")} as words
 from posts""",
    "remove_stop_words": f"{POSTS} select id, {bar(without_stop_words(TOKENS))} as filtered_words from posts",
    "doc_vectors": f"""{WORDS} select id, len(ws)::integer as words,
 (select count(distinct term) from (select unnest(ws) as term from words)) as vocabulary,
 0.0::double as gap from words""",
    "average_word_vectors": f"""{ROW_WORDS},
vectors as (select term, length(term)::double as v0, df::double as v1, idf as v2 from idf
 where length(term) > 2),
occurrences as (select r, unnest(ws) as term from words),
sums as (select r, sum(v0) as v0, sum(v1) as v1, sum(v2) as v2 from occurrences
 join vectors using (term) group by r)
select w.id, {", ".join(f"round(coalesce(s.v{i}, 0.0) / greatest(len(ws), 1), 6) as v{i}" for i in range(3))}
 from words w left join sums s on s.r = w.r""",
    "word_pairs": f"{PAIRS} select word, context, n from near",
    "ppmi": f"""{PAIRS} select word, context, round(weight, 6) as weight from weights
 where weight > 0.000001""",
    "count_vectors": f"""{PAIRS} select count(distinct word) as words, 0.0::double as gap from weights
 where weight > 0""",
    "read_sentence": f"""{READ} select id, pos, round(plain, 6) as plain, round(negated, 6) as negated,
 round(before, 6) as before, round(after, 6) as after, listed from fold where i = len(ws)""",
    "hashing_tf": f"""{BUCKETS} select w.id, string_agg(coalesce(n, 0)::varchar || '.0', ',' order by b.bucket) as rawFeatures
 from words w cross join (select unnest(range(20))::integer as bucket) b
 left join bucket_counts c on c.id = w.id and c.bucket = b.bucket group by w.id""",
    "idf_weights": f"{ROW_WORDS} select term, df, round(idf, 6) as idf from idf",
    "tf_idf": f"{ROW_WORDS} select id, term, round(tf * idf, 6) as tf_idf from tf join idf using (term)",
    "split_train_test": f"{POSTS} select id, {PART} as part from posts",
    "wssse": f"""{NEAREST} select (select count(*) from centres)::integer as k, round(sum(d), 6) as wssse
 from nearest""",
    "kmeans_grid": """select unnest([20, 30, 40, 50, 60, 70, 80, 90, 100, 120, 140, 300])::integer as k,
 (select count(*) from embeddings) as points, 0.0::double as gap""",
    "cluster_centres": """select 10::bigint as clusters, count(*) as points, 0.0::double as gap
 from embeddings""",
    "elbow_k": f"""{CENTRES},
grid as (select * from (values {CURVE_ROWS}) v(k)),
set_parts as (select k, label % k as cid, i, avg(x) as x from parts, grid group by k, label % k, i),
sets as (select k, cid, list(x order by i) as c from set_parts group by k, cid),
curve as (select k, sum(d) as wssse from (select k, vec_id, min(list_sum(list_transform(
 range(1, len(c) + 1), lambda i: (embedding[i]::double - c[i]) * (embedding[i]::double - c[i])))) as d
 from embeddings cross join sets group by k, vec_id) group by k),
slopes as (select k, (wssse - lag(wssse) over (order by k)) / (k - lag(k) over (order by k)) as slope
 from curve)
select coalesce(max(case when slope < -3 then k end), min(k))::integer as elbow_k from slopes""",
    "assign_clusters": f"{NEAREST} select vec_id, cluster, round(d, 6) as distance from nearest",
    "cluster_sizes": f"""{NEAREST} select cluster, count(*) as count from nearest group by cluster
 order by count desc, cluster limit 20""",
    "sentences": f"{SENTENCES} select id, pos, sentence from sentences",
    "sentence_scores": f"{SCORED} select id, pos, round(score, 6) as score, len as length from scored",
    "sentence_scores_by_table": f"""{BY_LENGTH} select id, pos, round(score, 6) as score, len as length
 from scored""",
    "sentence_scores_by_joined_table": f"""{BY_LENGTH} select id, pos, round(score, 6) as score,
 len as length from scored""",
    "post_sentiment_large_lexicon": totals(LARGE),
    "post_sentiment_by_table": totals(BY_LENGTH),
    "post_sentiment_by_scorer": totals(BY_SCORER),
    "post_sentiment": f"""{SENTIMENT} select id, round(score, 6) as score,
 round(mean_score, 6) as mean_score, round(main_score, 6) as main_score from rated""",
    "sentiment_class": f"{SENTIMENT} select id, sentiment from classed",
    "sentiment_label": f"{SENTIMENT} select id, sentiment, label from labelled",
    "bayes_model": f"""{BAYES} select label, round(prior, 6) as prior, feature, round(weight, 6) as weight
 from model""",
    "bayes_predict": f"{BAYES} select id, label, prediction_bayes from predicted",
    "confusion_counts": f"""{BAYES} select label, prediction_bayes as prediction, count(*) as count
 from predicted group by all""",
    "log_loss": f"""{PROBABILITIES} select count(*) as n, round(avg(-ln(greatest(p, 1e-15))), 6) as log_loss
 from rated_classes where label = class""",
    "one_vs_rest_auc": f"""{PROBABILITIES},
sides as (select class, count(*) filter (where label = class) as positives,
 count(*) filter (where label <> class) as negatives from rated_classes group by class),
won as (select a.class, sum(case when a.p > b.p then 1.0 when a.p = b.p then 0.5 else 0.0 end) as won
 from rated_classes a join rated_classes b on a.class = b.class where a.label = a.class and b.label <> b.class group by a.class)
select class, positives, negatives, round(won::double / (positives * negatives), 6) as auc
 from sides left join won using (class)""",
    "calibration": f"""{PROBABILITIES} select class, bin, count(*) as n, round(avg(p), 6) as mean_p,
 round(avg(case when label = class then 1.0 else 0.0 end), 6) as share
 from (select *, least(floor(p * 10), 9)::integer as bin from rated_classes) group by class, bin""",
    "window_counts": CLOSED,
    "batch_window_counts": WINDOW_COUNTS,
    "live_curate": LIVE,
    "curate_posts": CURATED,
    "classify_posts": classified(KEPT_IDS),
    "classify_posts_by_table": BY_TABLE_CLASSIFIED,
    "live_analyze": LIVE_CLASSIFIED,
    "live_unique": UNIQUE,
    "lloyd_grid": plain_lloyd(4),
    "live_idf": f"{LEARNED} select term, df, round(idf, 6) as idf from known",
    "live_bayes": f"""{LEARNED} select label, round(prior, 6) as prior, round(-whole, 6) as unseen, term,
 round(idf, 6) as idf, round(ln(n * idf + 1.0) - whole, 6) as weight
 from seen join known using (term) join priors using (label)""",
    "live_predict": LIVE_PREDICTED,
    "live_centres": running_centres(3, 5),
    "cluster_posts": f"""{POSTS} select id, 0.0::double as gap from posts
 where {KEPT} and {PART} = 'test'""",
}
