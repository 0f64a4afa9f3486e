"""Expressions over the fields of a post."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from postflow.values import COLLECTED_DATE, DEVICES, LIVE_DATE, OTHER


def source_name(source: Column) -> Column:
    """Device name inside an HTML anchor; ``Other`` when there is none."""
    inner = F.get(F.split(source, ">"), F.lit(1))
    has_inner = source.rlike(">+[^>]") & ~inner.rlike("^<+$")
    return F.when(has_inner, F.substring_index(inner, "<", 1)).otherwise(F.lit(OTHER))


def place_name(place: Column) -> Column:
    return F.coalesce(place["name"], F.lit(OTHER))


def from_device(source: Column, devices=DEVICES) -> Column:
    """True where ``source`` mentions one of ``devices`` (case-sensitive)."""
    return reduce(or_, [source.contains(device) for device in devices])


def parse_created_at(text: Column) -> Column:
    """Timestamp of either date text; null for anything else.

    The two formats are told apart by shape, so a row is parsed only once: a failed parse
    costs a JVM exception.
    """
    # As newer writers have it: "Jan 12, 2019, 5:03:09 PM", with a narrow blank before the "PM".
    plain = F.regexp_replace(F.translate(text, "\u202f\u00a0", "  "), r"^(\w{3} \d+, \d+),", "$1")
    collected = F.try_to_timestamp(plain, F.lit(COLLECTED_DATE))
    live = F.try_to_timestamp(text.substr(F.lit(5), F.length(text)), F.lit(LIVE_DATE))
    return F.when(text.rlike(r"^[A-Z][a-z]{2} \d"), collected).when(
        text.rlike(r"^[A-Z][a-z]{2} [A-Z]"), live
    )


def collected_date(created_at: Column) -> Column:
    """The date text of collected JSON."""
    return F.date_format(created_at, COLLECTED_DATE)


def slice_columns(ts: Column, levels) -> list[Column]:
    """Integer ``year``, ``month``, ... columns naming the time slice of ``ts``."""
    parts = {"year": F.year, "month": F.month, "day": F.day, "hour": F.hour, "minute": F.minute}
    return [parts[level](ts).alias(level) for level in levels]
