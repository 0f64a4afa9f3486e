"""One query per operator, each over whole tables."""

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

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
    REPEATED,
    VOCABULARY,
    phrase_list,
    posts,
    table,
)
from postflow.functions import posts as P
from postflow.functions import reading as R
from postflow.functions import text as X
from postflow.operators import classify as B
from postflow.operators import clean as C
from postflow.operators import cluster as K
from postflow.operators import cluster_grid as G
from postflow.operators import metrics as E
from postflow.operators import ordinal as O
from postflow.operators import sentiment as S
from postflow.operators import statistics as M
from postflow.operators import text as W
from postflow.operators import tracking as T
from postflow.operators import word_vectors as V
from postflow.plans.analyse import (
    classify_posts,
    cluster_posts,
    prepare_features,
)
from postflow.plans.curate import clean_live, clean_posts, curate_posts
from postflow.sources import readers, slices, writers
from postflow.sources.storage import shared_dir, store
from postflow.streaming import incremental, jobs
from postflow.streaming.windows import window_counts
from postflow.values import POST_SCHEMA

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name, less a ``_query`` ending where an operator has the name."""
    name = fn.__name__.removesuffix("_query")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = name
    QUERIES[name] = run
    return run


def joined(*names: str) -> list:
    """Array columns as text, so that any comparison tool can hash them."""
    return [F.array_join(name, "|").alias(name) for name in names]


def flat_posts(df: DataFrame, *more: str) -> DataFrame:
    """Posts without nesting."""
    return df.select(
        *more,
        "id",
        "createdAt",
        "text",
        "lang",
        "source",
        "favoriteCount",
        "retweetCount",
        F.col("user.lang").alias("userLang"),
        F.col("user.location").alias("location"),
        F.col("user.followersCount").alias("followersCount"),
        F.col("retweetedStatus.retweetCount").alias("reposts"),
        F.col("retweetedStatus.favoriteCount").alias("favorites"),
        F.col("retweetedStatus.user.followersCount").alias("reach"),
        F.col("place.name").alias("placeName"),
    )


def words_of(df: DataFrame) -> DataFrame:
    return df.transform(W.tokenize).transform(W.remove_stop_words, lowered=True)


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of which some share an id."""
    return spark.sql(REPEATED.format(posts="{posts}"), posts=posts(spark, sf_dir))


def slices_of(df: DataFrame, ts: str, borders) -> list[DataFrame]:
    """Rows before, between and after fixed times."""
    when = F.col(ts)
    times = [F.lit(b).cast("timestamp") for b in borders]
    low = [None, *times]
    high = [*times, None]
    return [
        df.filter((F.lit(True) if a is None else when >= a) & (F.lit(True) if b is None else when < b))
        for a, b in zip(low, high)
    ]


def arriving(spark: SparkSession, sf_dir: str, start: Callable, phrases=None, slices=None) -> str:
    """Feed posts in three windows cut at fixed times: ``start(stream)`` works off each in turn.

    The job starts again for every window, so it goes on from its checkpoint each time.
    """
    path = shared_dir(spark, "arrived")
    for part in slices or slices_of(posts(spark, sf_dir), "createdAt", ARRIVALS):
        writers.collected_record(part).write.mode("append").json(path)
        start(readers.stream_posts(spark, path, phrases)).awaitTermination()
    return path


# Sources and sinks


@query
def read_posts_json(spark, sf_dir):
    """Posts, and lines that are no record."""
    path = shared_dir(spark, "json")
    writers.write_stage(writers.collected_record(posts(spark, sf_dir)), path)
    lines = table(spark, sf_dir, "documents").filter("doc_id % 20 = 0")
    lines.select(F.expr(CORRUPT).alias("value")).write.mode("append").text(path)
    read = flat_posts(readers.read_posts_json(spark, path), readers.CORRUPT)
    return read.withColumnRenamed(readers.CORRUPT, "corrupt")


@query
def read_time_slice(spark, sf_dir):
    path = shared_dir(spark, "slices")
    writers.write_time_slices(posts(spark, sf_dir), path, "hour")
    return readers.read_time_slice(spark, path, "hour", hour=1).select(
        "id", "createdAt", "text", "year", "month", "day", "hour"
    )


def around_new_year(spark, sf_dir):
    """Posts from half an hour before a year's end on."""
    later = F.col("createdAt") + F.expr("interval 353 days 23 hours 30 minutes")
    return posts(spark, sf_dir).withColumn("createdAt", later)


@query
def read_range(spark, sf_dir):
    """A range across a year's end, by the manifest of hourly slices."""
    path = shared_dir(spark, "slices")
    writers.write_time_slices(around_new_year(spark, sf_dir), path, "hour")
    slices.refresh_manifest(spark, path, "hour")
    found = slices.read_range(spark, path, "2019-12-31 23:50:00", "2020-01-01 00:40:00", "hour")
    return found.select("id", "createdAt", "text", "year", "hour")


@query
def compact_slices(spark, sf_dir):
    """Minutes of three batches become about eight files for the days; a further batch
    arrives, and the replaced files go."""
    path = shared_dir(spark, "slices")
    rows = around_new_year(spark, sf_dir)
    for batch in range(3):
        writers.write_time_slices(rows.filter(F.col("id") % 4 == batch), path, "minute", batch_id=batch)
    slices.refresh_manifest(spark, path, "minute")
    size = slices.read_manifest(spark, path, "minute").agg(F.sum("bytes")).first()[0]
    slices.compact(spark, path, "minute", size // 8, by="day")
    writers.write_time_slices(rows.filter("id % 4 = 3"), path, "minute", batch_id=3)
    slices.refresh_manifest(spark, path, "minute")
    slices.vacuum(spark, path, "minute")
    read = slices.read_slices(spark, path, "minute")
    return read.groupBy("year", "month", "day", "batch_id").agg(
        F.count("*").alias("posts"), F.count_distinct("id").alias("ids"), F.sum(F.length("text")).alias("chars")
    )


@query
def stream_posts(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "tracked"), shared_dir(spark, "checkpoint")
    schema = None

    def start(stream):
        nonlocal schema
        schema = stream.schema
        writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start(out)

    arriving(spark, sf_dir, start, PHRASES)
    return spark.read.schema(schema).parquet(out).select("id", "createdAt", "text")


@query
def track_filter(spark, sf_dir):
    tracked = W.track_filter(posts(spark, sf_dir), PHRASES)
    return tracked.select("id", "text")


@query
def phrase_matches(spark, sf_dir):
    """Phrases of each post, of a list that grows with the documents."""
    found = T.phrase_matches(posts(spark, sf_dir).select("id", "text"), phrase_list(spark, sf_dir))
    return found.groupBy("id").agg(
        F.count("*").alias("phrases"),
        F.min("phrase_id").alias("least"),
        F.max("phrase_id").alias("largest"),
        F.sum(F.col("phrase_id") % 1009).alias("checksum"),
    )


@query
def track_phrases(spark, sf_dir):
    """Posts that hold a phrase of the other half of the documents."""
    half = phrase_list(spark, sf_dir).filter("phrase_id % 200 >= 100")
    return T.track_phrases(posts(spark, sf_dir).filter("id % 2 = 0"), half).select("id", "text")


@query
def posts_to_json(spark, sf_dir):
    text = writers.posts_to_json(posts(spark, sf_dir))
    return flat_posts(text.select(F.from_json("json", POST_SCHEMA).alias("p")).select("p.*"))


def collected(spark, sf_dir, grain="hour", files=None, interval=None, slices=None) -> str:
    """The folder that the collecting job writes."""
    out, checkpoint = shared_dir(spark, "slices"), shared_dir(spark, "checkpoint")

    class Done:
        def __init__(self, job):
            self.job = job

        def awaitTermination(self):
            if interval is None:
                return self.job.awaitTermination()
            try:
                self.job.processAllAvailable()
            finally:
                self.job.stop()

    def start(stream):
        return Done(jobs.collect_posts(stream, out, checkpoint, interval, grain, files))

    arriving(spark, sf_dir, start, slices=slices)
    return out


@query
def sink_by_time(spark, sf_dir):
    slices = readers.read_time_slice(spark, collected(spark, sf_dir), "hour")
    return slices.groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("posts"), F.sum(F.length("text")).alias("chars")
    )


@query
def files_per_batch(spark, sf_dir):
    """The tasks that wrote each window, and its posts."""
    out = collected(spark, sf_dir, files=3)
    task = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)
    rows = readers.read_time_slice(spark, out, "hour").withColumn("task", task)
    return rows.groupBy("batch_id").agg(
        F.count_distinct("task").alias("files"), F.count("*").alias("posts")
    )


@query
def trigger_interval(spark, sf_dir):
    """The same slices, by a job that wakes up at an interval."""
    out = collected(spark, sf_dir, interval="1 second")
    return readers.read_time_slice(spark, out, "hour").groupBy("hour").agg(
        F.count("*").alias("posts")
    )


@query
def skip_empty_window(spark, sf_dir):
    """Of three windows the middle one is empty; the job works on two."""
    out, checkpoint = shared_dir(spark, "windows"), shared_dir(spark, "checkpoint")

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.count("*").alias("posts"), F.max("id").alias("last")).write.mode(
            "append"
        ).parquet(out)

    first, empty, last = slices_of(posts(spark, sf_dir), "createdAt", (ARRIVALS[0], ARRIVALS[0]))
    arriving(
        spark,
        sf_dir,
        lambda stream: jobs.run_batches(stream, each, checkpoint, None),
        slices=[first, empty, last],
    )
    return spark.read.parquet(out)


@query
def restart_collect(spark, sf_dir):
    """A job that starts again, also with nothing new, writes each post once."""
    none = posts(spark, sf_dir).limit(0)
    first, second, third = slices_of(posts(spark, sf_dir), "createdAt", ARRIVALS)
    out = collected(spark, sf_dir, "minute", slices=[first, none, second, third, none])
    return readers.read_time_slice(spark, out, "minute").groupBy("id").agg(
        F.count("*").alias("copies")
    )


@query
def write_stage(spark, sf_dir):
    path = shared_dir(spark, "stage")
    stage = S.label_posts(posts(spark, sf_dir), LEXICON).transform(W.with_hashtags)
    stage = stage.select("id", "text", "hashtags", "sentiment", "label")
    writers.write_stage(stage, path)
    read = spark.read.schema(stage.schema).json(path)
    return read.select("id", "text", *joined("hashtags"), "sentiment", "label")


# Filters, projections, cleaning


@query
def filter_lang(spark, sf_dir):
    return flat_posts(C.filter_lang(posts(spark, sf_dir)))


@query
def filter_source_present(spark, sf_dir):
    return flat_posts(C.filter_source_present(posts(spark, sf_dir)))


@query
def filter_repost_count(spark, sf_dir):
    return flat_posts(C.filter_repost_count(posts(spark, sf_dir)))


@query
def filter_author_reach(spark, sf_dir):
    return flat_posts(C.filter_author_reach(posts(spark, sf_dir)))


@query
def filter_devices(spark, sf_dir):
    return flat_posts(C.filter_devices(posts(spark, sf_dir)))


@query
def source_name(spark, sf_dir):
    return C.with_source_name(posts(spark, sf_dir)).select("id", "source", "sourceName")


@query
def source_name_pages(spark, sf_dir):
    """The same over every anchor of whole HTML pages."""
    anchors = F.regexp_extract_all("html", F.lit("<a [^>]*>[^<]*</a>"), F.lit(0))
    found = table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(anchors).alias("pos", "anchor")
    )
    return found.select("page_id", "pos", P.source_name(F.col("anchor")).alias("sourceName"))


@query
def place_name(spark, sf_dir):
    return posts(spark, sf_dir).select("id", P.place_name(F.col("place")).alias("place"))


@query
def project_posts(spark, sf_dir):
    return C.project_posts(posts(spark, sf_dir))


@query
def project_posts_live(spark, sf_dir):
    return posts(spark, sf_dir).transform(C.flatten_posts).transform(C.project_posts_live)


@query
def flatten_posts(spark, sf_dir):
    return C.flatten_posts(posts(spark, sf_dir))


@query
def fill_missing(spark, sf_dir):
    gaps = posts(spark, sf_dir).select(
        "id", F.col("user.location").alias("location"), F.col("place.name").alias("place")
    )
    return C.fill_missing(gaps)


@query
def dedup_posts(spark, sf_dir):
    once = C.project_posts(posts(spark, sf_dir))
    return C.dedup_posts(once.unionAll(once))


@query
def dedup_texts(spark, sf_dir):
    """The copies the documents really hold."""
    return C.dedup_posts(table(spark, sf_dir, "documents").select("text", "lang"))


@query
def device_distribution(spark, sf_dir):
    return C.device_distribution(posts(spark, sf_dir))


@query
def parse_created_at(spark, sf_dir):
    """Both forms of a date, the newer ones, and what is no date."""
    plain = P.collected_date(F.col("createdAt"))
    comma = F.regexp_replace(plain, "(2019)", "$1,")
    texts = posts(spark, sf_dir).select(
        "id",
        plain.alias("collected"),
        F.date_format("createdAt", "EEE MMM dd HH:mm:ss zzz yyyy").alias("live"),
        comma.alias("comma"),
        F.regexp_replace(comma, " (AM|PM)", "\u202f$1").alias("narrow"),
        F.when(F.col("id") % 2 == 0, plain)
        .otherwise(F.concat(F.lit("day "), F.col("id").cast("string")))
        .alias("mixed"),
    )
    names = ("collected", "live", "comma", "narrow", "mixed")
    for name in names:
        texts = texts.transform(C.parse_created_at, name)
    return texts.select("id", *names, "mixedText")


# Text


@query
def hashtags(spark, sf_dir):
    return W.with_hashtags(posts(spark, sf_dir)).select("id", *joined("hashtags"))


@query
def tokenize(spark, sf_dir):
    return W.tokenize(posts(spark, sf_dir)).select("id", *joined("words"))


@query
def tokenize_pattern(spark, sf_dir):
    words = W.tokenize(posts(spark, sf_dir), "[a-z]+", gaps=False, min_length=3)
    return words.select("id", *joined("words"))


@query
def remove_stop_words(spark, sf_dir):
    return words_of(posts(spark, sf_dir)).select("id", *joined("filtered_words"))


def max_gap(a: str, b: str):
    """The largest difference of two vectors."""
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


@query
def doc_vectors(spark, sf_dir):
    """The model's vectors against the mean of the model's word vectors, taken apart from it."""
    words = store(
        words_of(posts(spark, sf_dir)).select("id", "filtered_words"), shared_dir(spark, "words")
    )
    model = W.fit_word_vectors(words)
    theirs = model.transform(words).select(
        "id", F.size("filtered_words").alias("words"), vector_to_array("features").alias("theirs")
    )
    table_ = model.getVectors().select("word", vector_to_array("vector").alias("vector"))
    stored = store(table_, shared_dir(spark, "vectors"))
    ours = W.average_word_vectors(words, stored, len(model.getVectors().first()["vector"]))
    vocabulary = stored.agg(F.count_distinct("word"))
    return theirs.join(ours, "id").select(
        "id",
        "words",
        vocabulary.scalar().alias("vocabulary"),
        F.round(max_gap("theirs", "vector"), 6).alias("gap"),
    )


@query
def average_word_vectors(spark, sf_dir):
    """Averaging over a table of word vectors that SQL can make too."""
    words = words_of(repeated(spark, sf_dir)).select("id", "filtered_words")
    known = W.idf_weights(words).filter(F.length("term") > 2)
    vectors = known.select(
        F.col("term").alias("word"),
        F.array(F.length("term").cast("double"), F.col("df").cast("double"), "idf").alias("vector"),
    )
    stored = store(vectors, shared_dir(spark, "vectors"))
    means = W.average_word_vectors(words, stored, 3)
    return means.select("id", *[F.round(F.col("vector")[i], 6).alias(f"v{i}") for i in range(3)])


# Words of the count vectors, and the places that count as near.
FREQUENT, NEAR = 20, 2


def frequent_pairs(spark, sf_dir):
    words = store(
        words_of(posts(spark, sf_dir)).select("id", "filtered_words"), shared_dir(spark, "words")
    )
    known = store(V.kept_words(words, FREQUENT), shared_dir(spark, "kept_words"))
    return store(V.word_pairs(words, NEAR, known=known), shared_dir(spark, "pairs"))


@query
def word_pairs(spark, sf_dir):
    return frequent_pairs(spark, sf_dir)


@query
def ppmi(spark, sf_dir):
    weights = V.ppmi(frequent_pairs(spark, sf_dir)).filter("weight > 0.000001")
    return weights.select("word", "context", F.round("weight", 6).alias("weight"))


@query
def count_vectors(spark, sf_dir):
    """Words with a vector, and how far the dimensions are from orthogonal."""
    words = store(
        words_of(posts(spark, sf_dir)).select("id", "filtered_words"), shared_dir(spark, "words")
    )
    vectors = V.fit_count_vectors(words, 3, NEAR, FREQUENT)
    product = lambda i, j: F.sum(F.col("vector")[i] * F.col("vector")[j])
    pairs = [(0, 1), (0, 2), (1, 2)]
    gap = F.greatest(*[F.abs(product(i, j)) / F.sqrt(product(i, i) * product(j, j)) for i, j in pairs])
    return vectors.agg(F.count("*").alias("words"), F.round(gap, 6).alias("gap"))


@query
def hashing_tf(spark, sf_dir):
    hashed = W.hashing_tf(words_of(posts(spark, sf_dir)))
    return hashed.select(
        "id", F.array_join(vector_to_array("rawFeatures"), ",").alias("rawFeatures")
    )


@query
def idf_weights(spark, sf_dir):
    weights = W.idf_weights(words_of(repeated(spark, sf_dir)))
    return weights.select("term", "df", F.round("idf", 6).alias("idf"))


@query
def tf_idf(spark, sf_dir):
    words = words_of(repeated(spark, sf_dir)).select("id", "filtered_words")
    counts = store(W.term_counts(words), shared_dir(spark, "counts"))
    weights = store(W.idf_weights(words, counts=counts), shared_dir(spark, "idf"))
    return W.tf_idf(counts, weights).select("id", "term", F.round("tf_idf", 6).alias("tf_idf"))


# Clustering


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", array_to_vector("embedding").alias("features")
    )


@query
def split_train_test(spark, sf_dir):
    return K.with_part(posts(spark, sf_dir)).select("id", "part")


@query
def kmeans_grid(spark, sf_dir):
    """For each k the rows assigned, and how far the cost lies from what the fit reported."""
    points = vectors(spark, sf_dir)
    models = K.kmeans_grid(points)
    reported = spark.createDataFrame(
        [(k, model.summary.trainingCost) for k, model in models.items()], "k int, reported double"
    )
    assigned = points
    for k, model in models.items():
        assigned = K.assign_clusters(assigned, model, f"c{k}")
    rows = [F.struct(F.lit(k).alias("k"), F.col(f"c{k}").alias("c")) for k in models]
    counted = assigned.select(F.explode(F.array(*rows)).alias("a")).groupBy("a.k").agg(
        F.count("a.c").alias("points")
    )
    costs = K.wssse(points, models).join(reported, "k").join(counted, "k")
    gap = F.abs(F.col("wssse") - F.col("reported")) / F.col("reported")
    return costs.select("k", "points", F.round(gap, 2).alias("gap"))


@query
def lloyd_grid(spark, sf_dir):
    """Four rounds for five k in shared scans, from the first vectors."""
    points = vectors(spark, sf_dir)
    ks = F.explode(F.array(*map(F.lit, CURVE_GRID))).alias("k")
    start = points.select(ks, "vec_id", vector_to_array("features").alias("centre")).filter("vec_id < k")
    start = start.select("k", F.col("vec_id").cast("int").alias("cluster"), "centre")
    done = G.lloyd_grid(points, start, 4, 0.0, "vec_id")
    return done.centres.select("k", "cluster", F.posexplode("centre").alias("dim", "x")).select(
        "k", "cluster", "dim", F.round("x", 6).alias("x")
    )


@query
def wssse(spark, sf_dir):
    points = vectors(spark, sf_dir)
    centres = K.centres_of(points, "label")
    cost = K.wssse_of(points, centres.withColumn("k", F.lit(10)))
    return cost.select("k", F.round("wssse", 6).alias("wssse"))


@query
def elbow_k(spark, sf_dir):
    """A curve over centre sets: the means of the labels modulo k."""
    points = vectors(spark, sf_dir)
    sets = None
    for k in CURVE_GRID:
        own = K.centres_of(points.withColumn("part", F.col("label") % k), "part")
        own = own.withColumn("k", F.lit(k))
        sets = own if sets is None else sets.unionByName(own)
    return K.elbow(K.wssse_of(points, sets))


@query
def cluster_centres(spark, sf_dir):
    """Settled centres against the means of the rows assigned to them."""
    points = vectors(spark, sf_dir)
    model = K.fit_kmeans(points, 10, maxIter=200, tol=0.0)
    rows = K.assign_clusters(points, model)
    means = K.centres_of(rows, "prediction").withColumnRenamed("centre", "mean")
    sizes = rows.groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"))
    both = K.cluster_centres(spark, model).join(means, "cluster").join(sizes, "cluster")
    return both.agg(
        F.count("*").alias("clusters"),
        F.sum("n").alias("points"),
        F.round(F.max(max_gap("centre", "mean")), 4).alias("gap"),
    )


def assigned(spark, sf_dir):
    points = vectors(spark, sf_dir)
    return K.nearest_centres(points, K.centres_of(points, "label"), output="cluster")


@query
def assign_clusters(spark, sf_dir):
    return assigned(spark, sf_dir).select(
        "vec_id", "cluster", F.round("distance", 6).alias("distance")
    )


@query
def cluster_sizes(spark, sf_dir):
    return K.cluster_sizes(assigned(spark, sf_dir), "cluster")


# Sentiment and classification


@query
def sentences(spark, sf_dir):
    return S.sentences(posts(spark, sf_dir))


@query
def sentence_scores(spark, sf_dir):
    scored = S.sentence_scores(S.sentences(posts(spark, sf_dir)), LEXICON)
    return scored.select("id", "pos", F.round("score", 6).alias("score"), "length")


GRAMMAR = R.Grammar(NEGATIONS, INTENSIFIERS, CONTRASTS)


def sentences_read(spark, sf_dir):
    parts = S.sentences(posts(spark, sf_dir))
    return parts.select("id", "pos", R.read_sentence(F.col("sentence"), LEXICON, GRAMMAR).alias("r")).select(
        "id", "pos", "r.*"
    )


@query
def read_sentence(spark, sf_dir):
    """Sums of the listed words by what stands before them."""
    rows = sentences_read(spark, sf_dir)
    return rows.select("id", "pos", *[F.round(name, 6).alias(name) for name in R.FEATURES], "listed")


@query
def ordinal_posts(spark, sf_dir):
    """Posts by classes learned from labelled ones: toxic, poor, good."""
    sums = [F.sum(name).alias(name) for name in R.FEATURES]
    rows = store(sentences_read(spark, sf_dir).groupBy("id").agg(*sums), shared_dir(spark, "read"))
    label = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2).alias("label")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), label)
    known = store(rows.join(labels, "id"), shared_dir(spark, "known"))
    model = O.fit_ordinal(known, R.FEATURES, classes=3)
    return rows.select("id", F.round(model.expected_class(), 4).alias("expected"), model.likeliest_class().alias("class"))


def lexicon_table(spark, sf_dir):
    """Every word in use gets a score by its length."""
    terms = X.terms(F.col("text"))
    words = repeated(spark, sf_dir).select(F.explode(terms).alias("word")).distinct()
    lexicon = words.select("word", (F.length("word") % 5).cast("double").alias("score"))
    return store(lexicon, shared_dir(spark, "lexicon"))


def by_table(spark, sf_dir, broadcast_rows):
    parts = S.sentences(repeated(spark, sf_dir))
    lexicon = lexicon_table(spark, sf_dir)
    scored = S.sentence_scores_by_table(parts, lexicon, broadcast_rows=broadcast_rows)
    return scored.select("id", "pos", F.round("score", 6).alias("score"), "length")


@query
def sentence_scores_by_table(spark, sf_dir):
    """The lexicon as a table small enough to send to all tasks."""
    return by_table(spark, sf_dir, 10_000_000)


@query
def sentence_scores_by_joined_table(spark, sf_dir):
    """The lexicon as a table that is joined by a shuffle."""
    return by_table(spark, sf_dir, 0)


def rounded_scores(scored):
    names = ("score", "mean_score", "main_score")
    return scored.select("id", *[F.round(name, 6).alias(name) for name in names])


@query
def post_sentiment(spark, sf_dir):
    return rounded_scores(S.post_sentiment(posts(spark, sf_dir), LEXICON))


@query
def post_sentiment_large_lexicon(spark, sf_dir):
    """25,000 words with 500 scores."""
    return rounded_scores(S.post_sentiment(posts(spark, sf_dir), LARGE_LEXICON))


@query
def post_sentiment_by_table(spark, sf_dir):
    folder = shared_dir(spark, "rows")
    scored = S.post_sentiment(repeated(spark, sf_dir), lexicon_table(spark, sf_dir), folder)
    return rounded_scores(scored)


@query
def post_sentiment_by_scorer(spark, sf_dir):
    """Any column function of a sentence."""
    folder = shared_dir(spark, "rows")
    scorer = lambda s: (F.length(s) % 5).cast("double")
    return rounded_scores(S.post_sentiment(repeated(spark, sf_dir), scorer, folder))


@query
def sentiment_class(spark, sf_dir):
    scored = S.post_sentiment(posts(spark, sf_dir), LEXICON)
    return S.with_sentiment(scored).select("id", "sentiment")


@query
def sentiment_label(spark, sf_dir):
    return S.label_posts(posts(spark, sf_dir), LEXICON).select("id", "sentiment", "label")


def bayes_input(spark, sf_dir):
    counted = W.counted_features(words_of(posts(spark, sf_dir)), VOCABULARY)
    labelled = S.label_posts(counted, LEXICON).select("id", "label", "rawFeatures")
    return K.split_train_test(store(labelled, shared_dir(spark, "labelled")))


@query
def bayes_model(spark, sf_dir):
    train, _ = bayes_input(spark, sf_dir)
    weights = B.bayes_weights(spark, B.fit_bayes(train, "rawFeatures"))
    return weights.select(
        "label",
        F.round("prior", 6).alias("prior"),
        F.posexplode("weights").alias("feature", "weight"),
    ).withColumn("weight", F.round("weight", 6))


@query
def bayes_predict(spark, sf_dir):
    train, test = bayes_input(spark, sf_dir)
    predicted = B.predict_bayes(B.fit_bayes(train, "rawFeatures"), test)
    return predicted.select("id", "label", "prediction_bayes")


@query
def confusion_counts(spark, sf_dir):
    train, test = bayes_input(spark, sf_dir)
    return B.confusion_counts(B.predict_bayes(B.fit_bayes(train, "rawFeatures"), test))


def bayes_scored(spark, sf_dir):
    """Probabilities of the test posts, rounded so that equal ones are equal for any engine."""
    train, test = bayes_input(spark, sf_dir)
    scored, labels = B.bayes_probabilities(B.fit_bayes(train, "rawFeatures"), test)
    long = E.long_probabilities(scored, labels).withColumn("p", F.round("p", 6))
    return store(long, shared_dir(spark, "probabilities"))


@query
def log_loss(spark, sf_dir):
    loss = E.log_loss(bayes_scored(spark, sf_dir))
    return loss.select("n", F.round("log_loss", 6).alias("log_loss"))


@query
def one_vs_rest_auc(spark, sf_dir):
    found = E.one_vs_rest_auc(bayes_scored(spark, sf_dir))
    return found.select("class", "positives", "negatives", F.round("auc", 6).alias("auc"))


@query
def calibration(spark, sf_dir):
    bins = E.calibration(bayes_scored(spark, sf_dir))
    return bins.select("class", "bin", "n", *[F.round(c, 6).alias(c) for c in ("mean_p", "share")])


# Streams and whole analyses


# Fixed times of the events: a tenth of the first slice arrives after the second one.
EVENT_BORDERS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
LATENESS = "12 days"
FAR = "2024-03-01 00:00:00"


@query
def window_counts_query(spark, sf_dir):
    """Closed windows of a stream with a late slice; a far later event closes the last ones."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first, second, third = slices_of(events, "ts", EVENT_BORDERS)
    late = F.col("event_id") % 10 == 0
    least = events.agg(F.min("event_id")).scalar()
    far = events.filter(F.col("event_id") == least).withColumn("ts", F.lit(FAR).cast("timestamp"))
    source, out = shared_dir(spark, "events"), shared_dir(spark, "windows")
    checkpoint = shared_dir(spark, "checkpoint")
    for part in (first.filter(~late), second, first.filter(late), third, far):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        counts = window_counts(stream, "1 hour", lateness=LATENESS, by=("event_type",))
        writer = counts.writeStream.outputMode("append").format("parquet")
        writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        writer.start(out).awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


@query
def batch_window_counts(spark, sf_dir):
    return window_counts(table(spark, sf_dir, "events"), "1 hour", by=("event_type",))


@query
def live_curate(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "live"), shared_dir(spark, "checkpoint")
    arriving(spark, sf_dir, lambda stream: jobs.curate_live(stream, out, checkpoint, None))
    return spark.read.parquet(out).select(
        "createdAt",
        "retweetCount",
        "source",
        "id",
        "userLang",
        "text",
        *joined("hashtags", "words", "filtered_words"),
    )


# How long a post is known, and by how much its copies come later, in the second and third window.
KNOWN, SOON, LATER = "30 minutes", "20 minutes", "90 minutes"


@query
def live_unique(spark, sf_dir):
    """Copies of the first window's posts come in the second window, when all of them are
    known, and in the third, when only the later ones are. The job starts again for each window."""
    out, checkpoint = shared_dir(spark, "unique"), shared_dir(spark, "checkpoint")
    first, second, third = slices_of(posts(spark, sf_dir), "createdAt", ARRIVALS)
    again = lambda after: first.withColumn("createdAt", F.col("createdAt") + F.expr(f"interval {after}"))
    slices = [first, second.unionByName(again(SOON)), third.unionByName(again(LATER))]
    arriving(
        spark,
        sf_dir,
        lambda stream: jobs.curate_unique(stream, out, checkpoint, None, KNOWN),
        slices=slices,
    )
    return spark.read.parquet(out).select("id", "createdAt", "text", *joined("filtered_words"))


@query
def live_analyze(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "live"), shared_dir(spark, "checkpoint")
    arriving(
        spark, sf_dir, lambda stream: jobs.analyse_live(stream, out, checkpoint, None, LEXICON)
    )
    stage = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*/classes")
    return stage.select("batch_id", "id", "prediction_bayes")


def learned(spark, sf_dir) -> tuple[str, incremental.StatisticsStore]:
    """Three windows learned from one after the other; the second is cut short once, in its middle
    and after its sums are written, and runs again."""
    out, checkpoint = shared_dir(spark, "learned"), shared_dir(spark, "checkpoint")
    sums = incremental.StatisticsStore(spark, f"{out}/_sums", compact_every=2)
    stopped = []

    def each(batch: DataFrame, batch_id: int) -> None:
        incremental.learn_batch(batch, batch_id, out, sums, LEXICON)
        if batch_id == 1 and not stopped:
            stopped.append(batch_id)
            raise RuntimeError("stopped on purpose")

    class Again:
        def __init__(self, stream):
            self.stream = stream

        def awaitTermination(self):
            clean = self.stream.transform(C.flatten_posts).transform(clean_live)
            try:
                jobs.run_batches(clean, each, checkpoint, None).awaitTermination()
            except StreamingQueryException:
                jobs.run_batches(clean, each, checkpoint, None).awaitTermination()

    arriving(spark, sf_dir, Again)
    return out, sums


@query
def live_idf(spark, sf_dir):
    """Weights of all windows' training posts together."""
    _, sums = learned(spark, sf_dir)
    return M.idf_of(sums.read()).select("term", "df", F.round("idf", 6).alias("idf"))


@query
def live_bayes(spark, sf_dir):
    """The classifier of all windows' training posts together."""
    _, sums = learned(spark, sf_dir)
    classes, terms = M.bayes_of(sums.read())
    rounded = lambda name: F.round(name, 6).alias(name)
    return terms.join(classes, "label").select(
        "label", rounded("prior"), rounded("unseen"), "term", rounded("idf"), rounded("weight")
    )


@query
def live_predict(spark, sf_dir):
    """Each window's test posts by the windows so far."""
    out, _ = learned(spark, sf_dir)
    stage = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*/classes")
    return stage.select("batch_id", "id", "prediction_bayes")


@query
def live_centres(spark, sf_dir):
    """Points of three windows go to the centres that the windows before them made."""
    points = vectors(spark, sf_dir)
    start = points.filter("vec_id < 5").select(
        F.col("vec_id").cast("int").alias("cluster"), vector_to_array("features").alias("centre")
    )
    start = store(start, shared_dir(spark, "start"))
    sums = incremental.StatisticsStore(spark, shared_dir(spark, "sums"))
    for window in range(3):
        centres = store(M.centres_of_statistics(sums.read(window), start), shared_dir(spark, "centres"))
        sums.add(window, M.centre_statistics(points.filter(F.col("vec_id") % 3 == window), centres))
    done = M.centres_of_statistics(sums.read(), start)
    return done.select("cluster", F.posexplode("centre").alias("dim", "x")).select(
        "cluster", "dim", F.round("x", 6).alias("x")
    )


@query
def curate_posts_query(spark, sf_dir):
    curated = curate_posts(posts(spark, sf_dir))
    arrays = ("hashtags", "words", "filtered_words")
    plain = [name for name in curated.columns if name not in arrays]
    return curated.select(*plain, *joined(*arrays))


@query
def cluster_posts_query(spark, sf_dir):
    """Held-out posts, and how far their centre is from the nearest one, found by expression."""
    out = shared_dir(spark, "analysis")
    _, features = prepare_features(clean_posts(posts(spark, sf_dir)), out)
    train, test = K.split_train_test(features)
    done = cluster_posts(train, test, features, out)
    own = K.with_distance(done.predictions, done.model).withColumnRenamed("distance", "own")
    nearest = K.nearest_centres(own, done.centres, output="nearest")
    return nearest.select("id", F.round(F.col("own") - F.col("distance"), 9).alias("gap"))


def classified(spark, sf_dir, lexicon):
    out = shared_dir(spark, "analysis")
    curated = store(curate_posts(posts(spark, sf_dir)), f"{out}/curated")
    train, test = K.split_train_test(curated)
    classes = classify_posts(train, test, out, lexicon)
    return classes.predictions.select("id", "prediction_bayes")


@query
def classify_posts_query(spark, sf_dir):
    return classified(spark, sf_dir, LEXICON)


@query
def classify_posts_by_table(spark, sf_dir):
    return classified(spark, sf_dir, lexicon_table(spark, sf_dir))
