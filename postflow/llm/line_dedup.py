"""Line dedup: lines within a few edits of an earlier line are dropped.

Everything on the path is a DataFrame expression. Equal lines (after folding case and blanks)
merge first, whatever their length. Lines within ``edits`` of each other
are found by segment partition (Li et al.,
"PASS-JOIN"): a line cut into ``edits + 1`` segments keeps one of them whole under that many
edits, so each line files its own segments by length, number and content, and probes the
segments of lines of its length or up to ``edits`` shorter, only at the positions that the
multi-match-aware rule leaves. Where many variants of a line share a segment, the cut is made
again in what is left: of ``2 * (edits + 1)`` segments all but ``edits`` stay whole, and lines
that file or probe such a segment meet by those instead. With one edit they don't meet in pairs
even then: lines that agree but for the character at one place are all within one edit of each
other, and lines that give one shorter line when they lose a character are within one edit of
that, so each such group is a star around one of its lines, and a crowd makes as many links as it
has lines. Pairs that meet are verified: first most of a finer cut must recur in place, then a
banded bit-parallel edit distance decides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import by_position, components, keep_table, text_id
from postflow.llm.quality_rules import let
from postflow.operators.joins import fits_broadcast, lookup_join

# Edits allowed between lines, the shorter of which has so many characters.
EDITS = ((20, 1),)
LEAST_LENGTH = 1
LEAST_WITHOUT_WORD = 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
FINE_SEGMENTS = 8
CROWD_PARTS, CROWD_LEVELS = 4, 2
BUCKET = 8
# Documents with lines to look at, up to which their ids go to all tasks.
ASKED_DOCUMENTS = 100_000


def folded(line: Column) -> Column:
    """Lower case, runs of blanks as one, none at the ends."""
    lower = F.lower(line)
    # Few lines have more than single blanks, and looking is cheaper than replacing.
    uneven = F.contains(lower, F.lit("  "))
    for blank in "\t\x0b\f\r\xa0":
        uneven = uneven | F.contains(lower, F.lit(blank))
    return F.trim(F.when(uneven, F.regexp_replace(lower, r"[\s\x{A0}]+", " ")).otherwise(lower))


def segment(length: Column, number: int, segments: int) -> tuple[Column, Column]:
    """``(start, size)`` of a segment (from 1) of an even cut; later segments get the rest."""
    size = F.floor(length / segments).cast("int")
    short = segments - (length % segments)
    start = 1 + (number - 1) * size + F.greatest(F.lit(0), number - 1 - short)
    return start.cast("int"), (size + F.when(number > short, 1).otherwise(0)).cast("int")


def segment_keys(line: Column, edits: int) -> list[Column]:
    """Keys under which ``line`` is found."""
    n = F.length(line)
    keys = []
    for i in range(1, edits + 2):
        start, size = segment(n, i, edits + 1)
        keys.append(F.xxhash64(n, F.lit(i), line.substr(start, size)))
    return keys


def probe_keys(line: Column, edits: int) -> list[Column]:
    """Keys of the segments that a line of equal length, or up to ``edits`` shorter, may share.

    The line's own :func:`segment_keys` belong to them, and are not given again.
    """
    keys = []
    for less in range(edits + 1):
        n = (F.length(line) - less).cast("int")
        for i in range(1, edits + 2):
            start, size = segment(n, i, edits + 1)
            low = max(-(i - 1), less - (edits + 1 - i))
            high = min(i - 1, less + (edits + 1 - i))
            for shift in range(low, high + 1):
                if (less, shift) != (0, 0):
                    keys.append(F.xxhash64(n, F.lit(i), line.substr(start + shift, size)))
    return keys


def left_out(edits: int) -> list[tuple[int, ...]]:
    """The sets of ``edits`` segments, of twice ``edits + 1``, that a key does without."""
    return list(combinations(range(1, 2 * (edits + 1) + 1), edits))


def _key(line: Column, length: Column, gone: tuple[int, ...], shifts: tuple[int, ...]) -> Column:
    """Hash of the runs of segments between those left out, each run at its shift."""
    segments = 2 * (len(gone) + 1)
    parts = []
    for run, (low, high) in enumerate(zip((0, *gone), (*gone, segments + 1))):
        if low + 1 < high:
            start, _ = segment(length, low + 1, segments)
            last, size = segment(length, high - 1, segments)
            parts.append(line.substr(start + shifts[run], last + size - start))
    return F.xxhash64(length, F.lit("".join(map(str, gone))), *parts)


def whole_keys(line: Column, edits: int) -> Column:
    """Keys of all segments but ``edits``, under which ``line`` is found."""
    none = (0,) * (edits + 1)
    return F.array(*[_key(line, F.length(line), gone, none) for gone in left_out(edits)])


def whole_probes(line: Column, edits: int) -> Column:
    """The :func:`whole_keys` that a line of equal length, or up to ``edits`` shorter, may share.

    The runs before the first and after the last edit lie at the line's ends, so their shifts are
    0 and the difference in length; between them all shifts that ``edits`` can cause are asked.
    """
    keys = []
    for less in range(edits + 1):
        for gone in left_out(edits):
            for inner in product(range(-edits, edits + 1), repeat=edits - 1):
                shifts = (0, *inner, less)
                if sum(abs(y - x) for x, y in zip(shifts, shifts[1:])) <= edits:
                    keys.append(_key(line, (F.length(line) - less).cast("int"), gone, shifts))
    return F.array(*keys)


def may_be_close(a: Column, b: Column, edits: int, segments: int = FINE_SEGMENTS) -> Column:
    """False only for lines further apart than ``edits``.

    Each edit touches one segment of a finer cut at most; the others recur in ``b`` no more than
    ``edits`` places away.
    """
    found = F.lit(0)
    for i in range(1, segments + 1):
        start, size = segment(F.length(a), i, segments)
        low = F.greatest(F.lit(1), start - edits)
        near = b.substr(low.cast("int"), (start + size + edits - low).cast("int"))
        found = found + F.when(F.contains(near, a.substr(start, size)), 1).otherwise(0)
    return found >= segments - edits


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of ``a`` and ``b``, exact up to ``edits``, larger than that otherwise.

    Hyyrö's bit-vector form of the dynamic programme: the ``2 * edits + 1`` cells of a column
    that lie in the band are the bits of one number, and a fixed number of bit operations gives
    the vertical differences of the next column. The lengths differ by ``edits`` at most.
    """
    band = 2 * edits + 1
    all_bits = (1 << band) - 1
    long = lambda x: F.lit(x).cast("long")

    def over(chars: Column) -> Column:
        rows, columns = chars["a"], chars["b"]
        m = F.size(rows)

        def step(state: Column, j: Column) -> Column:
            letter = F.get(columns, j)
            match = long(0)
            for bit in range(band):
                same = F.get(rows, j - edits + bit) == letter
                match = match.bitwiseOR(F.when(same, long(1 << bit)).otherwise(long(0)))

            def vectors(s: Column) -> Column:
                vp, vn, pm = s["vp"], s["vn"], s["pm"]
                d0 = (pm.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(pm).bitwiseOR(vn)
                return let(d0.bitwiseAND(long(all_bits)), lambda d: horizontal(s, d))

            def horizontal(s: Column, d0: Column) -> Column:
                both = F.struct(
                    s["vn"].bitwiseOR(d0.bitwiseOR(s["vp"]).bitwiseXOR(long(all_bits))).alias("hp"),
                    d0.bitwiseAND(s["vp"]).alias("hn"),
                    F.shiftright(d0, 1).alias("down"),
                    d0.alias("d0"),
                )
                return let(both, lambda h: after(s, h))

            def after(s: Column, h: Column) -> Column:
                # The distance follows the lowest diagonal of the band, then the last row.
                last = m - j - 1 + edits
                on_row = F.when(F.call_function("shiftright", h["hp"], last).bitwiseAND(long(1)) > 0, 1).when(
                    F.call_function("shiftright", h["hn"], last).bitwiseAND(long(1)) > 0, -1
                )
                on_diagonal = F.when(
                    h["d0"].bitwiseAND(long(1 << (band - 1))) == 0, 1
                )
                change = F.when(j < m - edits, on_diagonal).otherwise(on_row)
                keep = h["down"].bitwiseOR(h["hp"]).bitwiseXOR(long(all_bits))
                return F.struct(
                    h["hn"].bitwiseOR(keep).bitwiseAND(long(all_bits)).alias("vp"),
                    h["down"].bitwiseAND(h["hp"]).alias("vn"),
                    (s["d"] + F.coalesce(change, F.lit(0))).alias("d"),
                )

            return let(
                F.struct(
                    state["vp"].alias("vp"),
                    state["vn"].alias("vn"),
                    state["d"].alias("d"),
                    match.alias("pm"),
                ),
                vectors,
            )

        start = F.struct(
            long(((1 << (edits + 1)) - 1) << edits).alias("vp"),
            long(0).alias("vn"),
            F.lit(edits).alias("d"),
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(columns) - 1), start, step, lambda s: s["d"]
        )

    # The longer line gives the rows; the lengths are at least edits + 1.
    swap = F.length(a) < F.length(b)
    rows, columns = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b)
    chars = F.struct(F.split(rows, "").alias("a"), F.split(columns, "").alias("b"))
    return let(chars, over)


def line_table(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(doc_id, doc, pos, line, id)`` of the lines long enough to count, folded.

    Lines without a word count from ``LEAST_WITHOUT_WORD`` characters: short ones are brackets,
    rules and blanks, which belong to what stands around them.
    """
    lines = docs.select(
        "doc_id",
        text_id(F.col("text")).alias("doc"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "raw"),
    )
    lines = lines.filter(F.length("raw") >= least_length)
    # Exploded, a line is folded once; as a plain column each filter would fold it again.
    line = F.explode(F.array(folded(F.col("raw")))).alias("line")
    lines = lines.select("doc_id", "doc", "pos", "raw", line)
    lines = lines.filter(F.length("line") >= least_length)
    short = (F.length("line") < LEAST_WITHOUT_WORD) | (F.length("raw") < LEAST_WITHOUT_WORD)
    lines = lines.filter(~(short & ~F.col("line").rlike(WORD))).drop("raw")
    return lines.withColumn("id", text_id(F.col("line")))


def _finer(rows: DataFrame) -> DataFrame:
    """``(h, g, line, less, low, high)`` with the range of each row cut in ``CROWD_PARTS``.

    The range is where an edit may lie: all before ``low`` and after ``high`` stays whole. Only
    parts go on whose whole rest another row shares, among them one that is not a line to be
    shortened (``less``).
    """
    size = F.col("high") - F.col("low") + 1 - F.col("less")

    def part(i: Column) -> Column:
        start = F.col("low") + F.floor(size * i / CROWD_PARTS).cast("int")
        end = F.col("low") + F.floor(size * (i + 1) / CROWD_PARTS).cast("int") - 1 + F.col("less")
        return F.struct(start.alias("low"), end.alias("high"))

    cut = F.explode(F.transform(F.sequence(F.lit(0), F.lit(CROWD_PARTS - 1)), part)).alias("r")
    rows = rows.select("h", "g", "line", "less", cut).select("h", "g", "line", "less", "r.*")
    n = F.length("line")
    rest = (F.col("line").substr(F.lit(1), F.col("low") - 1), F.col("line").substr(F.col("high") + 1, n))
    rows = keep_table(rows.withColumn("key", F.xxhash64(n - F.col("less"), "low", *rest)), "ranges")
    shared = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("less").alias("least"))
    return rows.join(shared.filter("n > 1 and least = 0").select("key"), "key").drop("key")


def one_edit_stars(crowd: DataFrame) -> DataFrame:
    """``(ha, ga, hb, gb)``: links that join all lines of ``crowd (h, g, line)`` within one edit.

    A line goes on with the ranges of characters without which it reads as another line, and only
    the places in them are tried: without the character there, what is left of lines of one length
    names a group around its least line; what is left of a line that is one longer names a group
    around the line that reads so.
    """
    n = F.length("line")
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("less")
    near = crowd.select("h", "g", "line", both).withColumns({"low": F.lit(1), "high": n})
    for _ in range(CROWD_LEVELS):
        near = _finer(near)
    places = near.filter("low <= high").select(
        "h", "g", "line", "less", F.explode(F.sequence("low", "high")).alias("at")
    )
    rest = F.concat(
        F.col("line").substr(F.lit(1), F.col("at") - 1), F.col("line").substr(F.col("at") + 1, n)
    )
    group = F.when(F.col("less") == 0, F.xxhash64(n, "at", rest)).otherwise(F.xxhash64(F.lit("less"), rest))
    grouped = places.select(group.alias("group"), F.col("less").alias("role"), "h", "g")
    short = near.filter("less = 0").select(
        F.xxhash64(F.lit("less"), "line").alias("group"), F.lit(0).alias("role"), "h", "g"
    )
    grouped = keep_table(grouped.unionByName(short).distinct(), "one_edit")
    centre = F.min(F.struct("role", "h", "g")).alias("c")
    centres = grouped.groupBy("group").agg(F.count("*").alias("n"), centre).filter("n > 1 and c.role = 0")
    centres = centres.select("group", F.col("c.h").alias("ha"), F.col("c.g").alias("ga"))
    met = grouped.join(centres, "group").select("ha", "ga", F.col("h").alias("hb"), F.col("g").alias("gb"))
    return met.filter("ha != hb or ga != gb")


@dataclass
class Step:
    """Lines of ``low`` to ``high`` characters (None: no end) meet within ``edits``."""

    edits: int
    low: int
    high: int | None

    def holds(self, line: Column) -> Column:
        n = F.length(line)
        inside = n >= max(self.low, self.edits + 1)
        # The longer line of a pair may reach into the next step.
        return inside if self.high is None else inside & (n < self.high + self.edits)


def steps_of(edits: int | tuple, least_length: int = LEAST_LENGTH) -> list[Step]:
    """``edits`` as pairs of a length and the edits allowed from there on, or one number for all."""
    pairs = ((least_length, edits),) if isinstance(edits, int) else edits
    ends = [*[low for low, _ in pairs[1:]], None]
    return [Step(allowed, low, high) for (low, allowed), high in zip(pairs, ends)]


def key_columns(line: Column, steps: list[Step]) -> dict[str, Column]:
    """The segment keys (``f``, by step and number) and probe keys (``p``) of a line, as longs."""
    columns = {}
    for s, step in enumerate(steps):
        inside = step.holds(line)
        for kind, keys in (("f", segment_keys(line, step.edits)), ("p", probe_keys(line, step.edits))):
            for i, key in enumerate(keys):
                columns[f"{kind}{s}_{i}"] = F.when(inside, key)
    return columns


def close_pairs(
    keyed: DataFrame, texts: Callable[[DataFrame], DataFrame], steps: list[Step], bucket: int = BUCKET
) -> DataFrame:
    """``(a, b)``: ids of different lines within the edits of a step.

    ``keyed (h, g, ...)`` is a stored table with the :func:`key_columns` of distinct lines, and
    ``texts`` gives ``(h, g, line)`` of the lines whose ``h`` a table holds: only lines that share a
    segment with another one are asked for, so the other lines' text never moves.

    The links join all lines that are within the edits, directly or through others; not every pair
    has one. A segment that more than ``bucket`` lines file is not looked at by itself.
    """
    names = [name for name in keyed.columns if name not in ("h", "g")]
    keys = [
        F.struct(F.lit(int(name[1 : name.index("_")])).alias("step"), F.lit(name[0] == "f").alias("filed"), F.col(name).alias("key"))
        for name in names
    ]
    every = keyed.select("h", "g", F.explode(F.array(*keys)).alias("k")).select("h", "g", "k.*")
    every = every.filter("key is not null")
    sizes = every.groupBy("step", "key").agg(
        F.sum(F.col("filed").cast("int")).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")
    )
    shared = sizes.filter("n > 0 and lo < hi").select("step", "key", "n")
    members = keep_table(every.join(shared, ["step", "key"]), "members")
    known = keep_table(texts(keep_table(members.select("h").distinct(), "asked")), "line_texts")

    def named(rows: DataFrame, side: str) -> DataFrame:
        return rows.select("step", "key", F.col("h").alias(f"h{side}"), F.col("g").alias(f"g{side}"))

    few = members.filter(F.col("n") <= bucket)
    met = named(few.filter("filed"), "a").join(named(few, "b"), ["step", "key"]).drop("key")
    for s, step in enumerate(steps):
        crowd = members.filter((F.col("n") > bucket) & (F.col("step") == s)).select("h", "g").distinct()
        crowd = keep_table(known.join(crowd, ["h", "g"]), "crowd")
        more = one_edit_stars(crowd) if step.edits == 1 else crowd_pairs(crowd, step.edits)
        met = met.unionByName(more.withColumn("step", F.lit(s)))
    met = met.filter("ha != hb or ga != gb")
    # Of two lines of equal length either may have asked; distinct() keeps a pair once.
    turned = F.struct("ha", "ga") > F.struct("hb", "gb")
    pairs = met.select(
        "step",
        *[
            F.when(turned, F.col(x)).otherwise(F.col(y)).alias(z)
            for x, y, z in (("hb", "ha", "ha"), ("gb", "ga", "ga"), ("ha", "hb", "hb"), ("ga", "gb", "gb"))
        ],
    ).distinct()
    side = lambda x: known.select(*[F.col(c).alias(f"{c[0]}{x}") for c in ("h", "g", "line")])
    both = pairs.join(side("a"), ["ha", "ga"]).join(side("b"), ["hb", "gb"])
    links = None
    for s, step in enumerate(steps):
        close = both.filter(F.col("step") == s).filter(may_be_close(F.col("la"), F.col("lb"), step.edits))
        close = close.filter(banded_distance(F.col("la"), F.col("lb"), step.edits) <= step.edits)
        links = close if links is None else links.unionByName(close)
    return links.select(
        F.struct(F.col("ha").alias("h"), F.col("ga").alias("g")).alias("a"),
        F.struct(F.col("hb").alias("h"), F.col("gb").alias("g")).alias("b"),
    )


def crowd_pairs(crowd: DataFrame, edits: int) -> DataFrame:
    """``(ha, ga, hb, gb)`` of lines that share all segments but ``edits``, for any ``edits``."""
    key = lambda keys: F.explode(keys(F.col("line"), edits)).alias("key")
    filed = crowd.select(F.col("h").alias("ha"), F.col("g").alias("ga"), key(whole_keys))
    asked = crowd.select(F.col("h").alias("hb"), F.col("g").alias("gb"), key(whole_probes))
    return filed.join(asked, "key").drop("key")


def close_lines(distinct: DataFrame, edits: int | tuple, bucket: int = BUCKET) -> DataFrame:
    """:func:`close_pairs` of a table of distinct lines ``(h, g, line)``."""
    steps = steps_of(edits)
    keyed = distinct.select("h", "g", *[k.alias(n) for n, k in key_columns(F.col("line"), steps).items()])
    texts = lambda asked: distinct.select("h", "g", "line").join(asked, "h")
    return close_pairs(keep_table(keyed, "keyed"), texts, steps, bucket)


def repeated_lines(
    docs: DataFrame, edits: int | tuple = EDITS, least_length: int = LEAST_LENGTH
) -> DataFrame:
    """``(doc_id, doc, pos, first)``: the lines to drop, and the line of their class that stays.

    Classes are the components of the links, exact copies included. The first line by doc_id,
    text and position stays (a null doc_id comes last); ``first`` holds its place. Lines shorter
    than ``least_length`` characters are no business of this operator. ``edits`` are pairs of a
    length and the edits allowed from there on, or one number for all lines; lines below the first
    length meet as exact copies only. Rows that repeat both doc_id and text are one document: they
    keep the same lines.
    """
    lines = line_table(docs, least_length)
    steps = steps_of(edits, least_length)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc", "pos").alias("place")
    keys = key_columns(F.col("line"), steps)
    # One pass over the texts gives places and keys, without the texts.
    rows = lines.select("id.h", "id.g", place, *[key.alias(name) for name, key in keys.items()])
    rows = keep_table(rows, "lines")
    places = rows.select("h", "g", "place")
    counted = places.groupBy("h", "g").agg(
        F.min("place").alias("first"), F.max("place").alias("last")
    )
    keyed = rows.groupBy("h", "g").agg(*[F.min(name).alias(name) for name in keys])

    def texts(asked: DataFrame) -> DataFrame:
        # Documents with such a line first, so that the others are not cut again.
        held = lookup_join(rows.select("h", F.col("place.doc.h").alias("d")), asked, "h")
        held = keep_table(held.select("d").distinct(), "asked_documents")
        again = lines
        if fits_broadcast(held, ASKED_DOCUMENTS):
            some = docs.select("doc_id", "text", text_id(F.col("text"))["h"].alias("d"))
            again = line_table(some.join(F.broadcast(held), "d"), least_length)
        found = lookup_join(again.select("id.h", "id.g", "line"), asked, "h")
        return found.groupBy("h", "g").agg(F.first("line").alias("line"))

    links = keep_table(close_pairs(keep_table(keyed, "keyed"), texts, steps), "line_links")
    roots = keep_table(components(links), "line_classes")
    near = counted.join(
        roots.select("node.h", "node.g", "root"), ["h", "g"]
    )
    firsts = near.groupBy("root").agg(F.min("first").alias("best"))
    near = near.join(firsts, "root").select("h", "g", "best")
    # Lines with copies and no near line; the others have nothing to drop.
    copied = counted.filter("first != last").join(near, ["h", "g"], "left_anti")
    classes = keep_table(
        near.unionByName(copied.select("h", "g", F.col("first").alias("best"))), "line_firsts"
    )
    dropped = places.join(classes, ["h", "g"]).filter("place != best")
    return dropped.select(
        "place.doc_id", "place.doc", "place.pos", F.col("best").alias("first")
    )


def _by_document(dropped: DataFrame) -> DataFrame:
    """The dropped lines of a document in one row; a row per document keeps its own lines only."""
    line = F.struct("pos", F.col("first.doc_id").alias("first_doc"), F.col("first.pos").alias("first_pos"))
    return dropped.distinct().groupBy("doc_id", "doc").agg(
        F.sort_array(F.collect_list(line)).alias("dropped")
    )


def line_report(
    docs: DataFrame, edits: int | tuple = EDITS, least_length: int = LEAST_LENGTH
) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, dropped)``, a row for each row of ``docs``.

    ``dropped`` holds structs of a line's position, and the doc_id and position of the line of
    its class that stays.
    """
    dropped = _by_document(repeated_lines(docs, edits, least_length))
    rows = docs.select(
        "doc_id",
        text_id(F.col("text")).alias("doc"),
        F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
    )
    match = rows["doc_id"].eqNullSafe(dropped["doc_id"]) & (rows["doc"] == dropped["doc"])
    lines = F.coalesce("dropped", F.array().cast(dropped.schema["dropped"].dataType))
    return rows.join(dropped, match, "left").select(
        rows["doc_id"], "n_lines", F.size(lines).cast("long").alias("n_dropped"), lines.alias("dropped")
    )


def drop_repeated_lines(
    docs: DataFrame, edits: int | tuple = EDITS, least_length: int = LEAST_LENGTH
) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one, columns as they are.

    ``n_chars``, where there is such a column, follows the text. A document that loses lines and
    has no word left goes: all it said stands elsewhere. Other documents stay, null texts too.
    """
    whole = by_position(docs, ("doc_id", "text", "n_chars"))
    names = whole.columns
    dropped = _by_document(repeated_lines(docs, edits, least_length)).select(
        F.col("doc_id").alias("_id"), F.col("doc").alias("_doc"), F.col("dropped.pos").alias("_gone")
    )
    whole = whole.withColumn("_own", text_id(F.col("text")))
    match = whole["doc_id"].eqNullSafe(dropped["_id"]) & (whole["_own"] == dropped["_doc"])
    joined = whole.join(dropped, match, "left")
    left = F.array_join(
        F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n"
    )
    changed = F.col("_gone").isNotNull()
    text = F.when(changed, left).otherwise(F.col("text"))
    new = joined.withColumn("text", text).filter(~changed | F.col("text").rlike(r"[^\s]"))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn(
            "n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return new.select(*names).toDF(*docs.columns)
