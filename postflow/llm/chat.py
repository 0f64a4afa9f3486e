"""Chat formatting: cumulative snapshots of a conversation collapse into the longest one.

A service that logs a conversation after each exchange leaves every prefix of it as a
conversation of its own. Each turn gets a rolling hash of the turns up to it, a running sum of
turn hashes mixed with their position. A conversation is dropped when its last hash stands at an inner
turn of another (a proper prefix of it), or at the last turn of an equal one with a smaller id;
both are anti-joins. What stays is rendered turn by turn.

Positions and running sums come in two steps, over runs of turns and inside a run, so a
conversation that holds a third of all turns is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postflow.llm.common import join_null_safe, keep_table

RUN_TURNS = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turn_hash(seed: int) -> Column:
    role, text = F.col("role").isNull(), F.col("text").isNull()
    return F.xxhash64(F.lit(seed), F.col("n"), role, F.col("role"), text, F.col("text"))


def _half(value: Column) -> Column:
    """The upper and lower half of 64 bits; sums of halves can't overflow a long."""
    return F.struct(
        F.shiftright(value, 32).alias("hi"), value.bitwiseAND(F.lit(0xFFFFFFFF)).alias("lo")
    )


def _before(part: list[str], order: list[str]):
    return Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def numbered(turns: DataFrame, run_turns: int = RUN_TURNS) -> DataFrame:
    """``turns`` with ``n``, the position in the conversation from 1, and its ``run``.

    Turns are ordered by ``turn`` (null first), then role and text; repeated rows stay, one after
    the other. A run is a range of ``turn`` numbers; turns that all share one number are one run.
    """
    runs = turns.withColumn("run", F.coalesce(F.floor(F.col("turn") / run_turns), F.lit(-1)).cast("long"))
    runs = runs.withColumn("run", F.when(F.col("turn").isNull(), F.lit(None)).otherwise(F.col("run")))
    sizes = runs.groupBy("conv_id", "run").agg(F.count("*").alias("size"))
    # One row for each run: the window over them is run_turns times smaller than the turns.
    sizes = sizes.withColumn(
        "base", F.coalesce(F.sum("size").over(_before(["conv_id"], ["run"])), F.lit(0))
    )
    sizes = sizes.drop("size")
    own = Window.partitionBy("conv_id", "run").orderBy("turn", "role", "text")
    runs = runs.withColumn("_own", F.row_number().over(own))
    joined = join_null_safe(runs, sizes, ["conv_id", "run"])
    return joined.withColumn("n", (F.col("_own") + F.col("base")).cast("long")).drop("base", "_own")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``numbered`` turns with ``prefix``, which stands for the turns up to this one.

    Two sums of two halves: 128 bits of hash that depend on each turn and its position.
    """
    halves = turns.withColumns({"_a": _half(_turn_hash(1)), "_b": _half(_turn_hash(2))})
    fields = ["_a.hi", "_a.lo", "_b.hi", "_b.lo"]
    names = ["a1", "a0", "b1", "b0"]
    sums = halves.groupBy("conv_id", "run").agg(*[F.sum(f).alias(n) for f, n in zip(fields, names)])
    earlier = _before(["conv_id"], ["run"])
    sums = sums.select(
        "conv_id",
        "run",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}") for n in names],
    )
    own = Window.partitionBy("conv_id", "run").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    halves = halves.withColumns({n: F.sum(f).over(own) for f, n in zip(fields, names)})
    prefix = F.struct("n", *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in names])
    joined = join_null_safe(halves, sums, ["conv_id", "run"])
    return joined.select("conv_id", "run", "n", "role", "text", prefix.alias("prefix"))


def maximal(prefixes: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, kept, kept_in)``: a row for each conversation.

    ``kept_in`` is the smallest id of the kept conversations that begin with this one; its own
    where it is kept.
    """
    length = prefixes.groupBy("conv_id").agg(F.max("n").alias("n_turns"))
    ended = length.withColumnRenamed("n_turns", "n")
    last = join_null_safe(prefixes, ended, ["conv_id", "n"], "left_semi")
    last = last.select("conv_id", F.col("n").alias("n_turns"), "prefix")
    ends = last.groupBy("prefix").agg(F.min("conv_id").alias("conv_id"))
    inner = join_null_safe(prefixes, ended, ["conv_id", "n"], "left_anti")
    whole = ends.join(inner.select("prefix").distinct(), "prefix", "left_anti")
    whole = keep_table(whole.select("conv_id"), "maximal")
    stay = join_null_safe(prefixes, whole, ["conv_id"], "left_semi")
    into = stay.groupBy("prefix").agg(F.min("conv_id").alias("kept_in"))
    found = last.join(into, "prefix").select("conv_id", "n_turns", "kept_in")
    found = join_null_safe(found, whole.withColumn("kept", F.lit(True)), ["conv_id"], "left")
    kept = F.coalesce("kept", F.lit(False))
    return found.select(
        "conv_id",
        "n_turns",
        kept.alias("kept"),
        F.when(kept, F.col("conv_id")).otherwise(F.col("kept_in")).alias("kept_in"),
    )


def rendered(role: Column, text: Column) -> Column:
    """A turn in chat markup; null role and text count as empty.

    Markup inside a text is broken up, so that no text can pose as a turn.
    """
    safe = [
        F.regexp_replace(F.coalesce(x, F.lit("")), r"<\|(im_start|im_end)\|>", "<| $1 |>")
        for x in (role, text)
    ]
    return F.concat(F.lit(OPEN), safe[0], F.lit("\n"), safe[1], F.lit(CLOSE + "\n"))


def collapse(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The verdict of :func:`maximal`, and the rendered text of the conversations that stay.

    The text has a row for each run of turns: ``(conv_id, run, n_turns, text)``, so no task holds a
    conversation without bound; the runs of a conversation in order are its text. Extra columns
    are left behind; rows with a null ``conv_id`` are one conversation.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    prefixes = keep_table(prefix_hashes(numbered(turns)), "prefixes")
    verdict = keep_table(maximal(prefixes), "verdicts")
    stay = join_null_safe(prefixes, verdict.filter("kept").select("conv_id"), ["conv_id"], "left_semi")
    part = F.floor((F.col("n") - 1) / RUN_TURNS).alias("run")
    line = F.struct("n", rendered(F.col("role"), F.col("text")).alias("line"))
    texts = stay.select("conv_id", part, line.alias("line")).groupBy("conv_id", "run").agg(
        F.count("*").alias("n_turns"), F.sort_array(F.collect_list("line")).alias("lines")
    )
    return verdict, texts.select("conv_id", "run", "n_turns", F.array_join("lines.line", "").alias("text"))
