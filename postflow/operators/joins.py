"""Joining many rows to a table that is unique on its key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64
HOT_SHARE = 0.001


def fits_broadcast(table: DataFrame, rows: int, most: int = BROADCAST_BYTES) -> bool:
    """Whether ``table`` stays within ``rows`` rows and a size any executor can hold.

    The size is that of its rows as JSON text, summed where they are stored.
    """
    width = F.octet_length(F.to_json(F.struct(*table.columns)))
    found = table.agg(F.count("*").alias("rows"), F.sum(width).alias("bytes")).first()
    return found["rows"] <= rows and (found["bytes"] or 0) <= most


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of the rows, so at most ``1 / share`` of them.

    Rows merge on the map side: a key reaches the shuffle once for each task. All rows are those
    of the counts together, so ``rows`` are made once.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("n")).persist()
    try:
        least = share * (counts.agg(F.sum("n")).first()[0] or 0)
        found = counts.filter((F.col("n") > least) & F.col(key).isNotNull()).collect()
    finally:
        counts.unpersist()
    return [r[key] for r in found]


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``rows`` to ``table`` on ``key``, whichever way the size of ``table`` allows.

    A table measured to be small is broadcast. Otherwise both sides are shuffled on the key, and
    the few hot keys on a salt as well, with their rows of ``table`` repeated once per salt: a key
    holding a third of all rows is spread over ``salts`` tasks, and all other rows of ``table``
    move once. Pass a stored ``table`` (not a long plan): it is read once to be measured and once
    for the join; ``rows`` are read once to find the hot keys and once for the join.
    """
    if fits_broadcast(table, broadcast_rows, broadcast_bytes):
        return rows.join(F.broadcast(table), key, how)
    hot = hot_keys(rows, key)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    # A hash of the row, not a random number: a task that runs again must send it the same way.
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    salted = rows.withColumn("_salt", F.when(is_hot, salt).otherwise(0))
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = table.withColumn("_salt", F.explode(every))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
