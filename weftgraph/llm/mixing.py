"""Sources mixed to target weights by weighted fair queueing, in DataFrame operations alone.

Each source is a queue of its documents in shuffled order, repeated up to ``most`` times. A
document's virtual finish time is the words its source has sent by its end over the source's
target. The queues of all sources are one, range-sorted by finish time, then by source and place;
a running total over it finds where the budget, the sum of all sizes, is used up. What is in front
is the mix. The document that stands across its source's target is queued in packets, a word each up to
65,536 words, so that the cut is fine however long it is; no source waits for a long document.

The queue is narrow, and its cut is one row. The rows themselves are then compared with the cut.

Running words inside a source are taken in two steps, over buckets of the shuffled order and then
inside a bucket, so that a source with any share of the rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from weftgraph.llm.ordered import first_beyond, numbered
from weftgraph.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
_BUCKET_ROWS = 20_000
_MOST_PACKETS = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, target, rank) from (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes by
    weight; none gets more than ``most`` times its size, what is over goes to the others by weight.
    """
    ranked = numbered(sizes, F.col("source").asc_nulls_last(), position="rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = cut_lineage(ranked.select("source", "source_size", "rank", weight.alias("weight"), (F.col("source_size") * most).alias("cap")))
    # Each round raises the share of one weight, as some sources meet their cap; two sums come back.
    level = 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        total, spent, free = ranked.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("cap")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        raised = (total - spent) / free if free else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"), "rank")


def _finish(end: Column) -> Column:
    return end.cast("double") / F.col("target")


def _packets(size: Column) -> tuple[Column, Column]:
    """Words of a packet of a document cut by its source's target, and the number of packets."""
    words = F.ceil(size / _MOST_PACKETS).cast("long")
    return words, F.ceil(size / F.greatest(words, F.lit(1))).cast("int")


def _cut(queue: DataFrame, most: int, budget: int) -> Row | None:
    """Where the range-sorted queue of all sources has used up the budget."""
    turns = queue.where("size > 0 AND target > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("turn"))
    turns = turns.withColumn("start", F.col("turn") * F.col("source_size") + F.col("before")).where("start < target")
    whole = _finish(F.col("start") + F.col("size")) <= 1
    words, count = _packets(F.col("size"))
    at = F.when(whole, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), count - 1))
    step = F.when(whole, F.col("size")).otherwise(words)
    parts = turns.select("size", "target", "rank", "start", step.alias("step"), F.explode(at).alias("p"))
    sent = F.least(F.col("step"), F.col("size") - F.col("p") * F.col("step"))
    parts = parts.select("rank", (F.col("start") + F.col("p") * F.col("step")).alias("from"), sent.alias("words"), "target")
    parts = parts.select("rank", "from", "words", _finish(F.col("from") + F.col("words")).alias("finish"))
    return first_beyond(parts, "words", budget, F.col("finish"), F.col("rank"), F.col("from")) if budget else None


def schedule(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", most: int = 3, seed: int = 17) -> DataFrame:
    """Each row of ``docs`` as (rest, size, source_size, target, entries).

    ``rest`` is a struct of the row. ``entries`` are its places in the source's queue: an array of
    (pass, finish, words), where ``words`` is what the mix takes of it then, all of the document in
    front of the cut, the packets in front of it of the one across its source's target, and 0 beyond. The sum
    over all sources is the sum of all sizes, a source's differs from its target by a packet at most. The shuffle is a hash of the id and the row's other columns, so reruns agree; rows equal in
    everything share their places in any order. Rows without words take none; a null source is a
    source, a null size counts as 0; an empty table gives an empty table.
    """
    size = F.coalesce(F.col(f"`{size_col}`"), F.lit(0)).cast("long")
    every = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.col(f"`{source_col}`").alias("source"), size.alias("size"), F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed)).alias("at"), F.xxhash64(*every).alias("tie"), F.struct(*every).alias("rest"),
    )
    narrow = cut_lineage(rows.select("source", "size", "at", "id", "tie"))
    goals = cut_lineage(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), most))
    buckets = max(64, narrow.count() // _BUCKET_ROWS)
    bucket = F.pmod(F.shiftrightunsigned("at", 20), F.lit(buckets)).alias("bucket")
    sums = narrow.groupBy("source", bucket).agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start"))
    starts = starts.join(goals, starts.source.eqNullSafe(goals.source)).drop(goals.source)
    starts = starts.withColumnsRenamed({"source": "_source", "bucket": "_bucket"})

    inside = Window.partitionBy("source", "bucket").orderBy("at", "id", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def places(frame: DataFrame) -> DataFrame:
        placed = frame.withColumn("bucket", bucket).withColumn("upto", F.sum("size").over(inside))
        placed = placed.join(starts, placed.source.eqNullSafe(F.col("_source")) & (placed.bucket == F.col("_bucket")))
        return placed.withColumn("before", F.col("bucket_start") + F.col("upto") - F.col("size"))

    queue = places(rows)
    budget = narrow.agg(F.sum("size")).first()[0] or 0
    cut = _cut(places(narrow), most, budget)

    def in_front(place: Column, words: Column) -> Column:
        """Of the words from a place of the source's queue on, how many the cut leaves."""
        if cut is None:
            return words
        finish = _finish(place + words)
        same = (finish == F.lit(cut["finish"])) & (F.col("rank") == cut["rank"]) & (place == cut["from"])
        ahead = F.struct(finish, F.col("rank").cast("long"), place) < F.struct(F.lit(cut["finish"]), F.lit(cut["rank"]).cast("long"), F.lit(cut["from"]).cast("long"))
        return F.when(same, F.least(words, F.lit(budget - cut["_before"]))).when(ahead, words).otherwise(F.lit(0))

    def entry(turn: Column) -> Column:
        start = (turn * F.col("source_size") + F.col("before")).cast("long")
        finish = F.when(F.col("target") > 0, _finish(start + F.col("size")))
        step, count = _packets(F.col("size"))
        part = lambda n, p: n + in_front(start + p * step, F.least(step, F.col("size") - p * step))
        across = F.aggregate(F.sequence(F.lit(0), count - 1), F.lit(0).cast("long"), part)
        words = F.when((F.col("size") == 0) | (F.col("target") <= start), F.lit(0)).when(finish <= 1, in_front(start, F.col("size"))).otherwise(across)
        return F.struct(turn.alias("pass"), finish.alias("finish"), words.cast("long").alias("words"))

    entries = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), entry)
    return queue.select("rest", "size", "source_size", "target", entries.alias("entries"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = 3) -> DataFrame:
    """``docs`` mixed: a row for each time a document is taken, in the order of finish.

    A document at the cut keeps its first words. Same columns as ``docs``.
    """
    sized = docs.withColumn("_size", word_count(F.col(f"`{text_col}`")))
    queue = schedule(sized, id_col, source_col, "_size", most)
    taken = queue.select("rest", "size", F.explode("entries").alias("entry")).where("entry.words > 0")
    # Spaces before a word go with it.
    leading = F.regexp_extract_all(F.col("rest").getField(text_col), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(leading, F.lit(1), F.col("entry.words").cast("int")), "")
    text = F.when(F.col("entry.words") < F.col("size"), cut).otherwise(F.col("rest").getField(text_col))
    columns = [text.alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns]
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = taken.repartitionByRange(ranges, "entry.finish").sortWithinPartitions("entry.finish")
    return ordered.select(*columns)
