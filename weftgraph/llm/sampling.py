"""A bounded share of a long text that is drawn from all of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spread(text: Column, limit: int, piece: int) -> Column:
    """Binary ``text`` as it is up to ``limit`` bytes; of a longer one so many bytes, in pieces of ``piece``
    bytes, those whose places have the smallest hashes, in the order of the text. Null stays null."""
    size = F.length(text)
    places = F.sequence(F.lit(0).cast("long"), F.ceil(size / piece) - 1)
    hashed = F.transform(places, lambda at: F.struct(F.xxhash64(at, size).alias("h"), at.alias("at")))
    chosen = F.array_sort(F.transform(F.slice(F.array_sort(hashed), 1, max(1, limit // piece)), lambda x: x["at"]))
    part = lambda at: F.substring(text, (at * piece + 1).cast("int"), F.lit(piece))
    joined = F.aggregate(chosen, F.lit("").cast("binary"), lambda found, at: F.concat(found, part(at)))
    return F.when(size <= limit, text).otherwise(joined)
