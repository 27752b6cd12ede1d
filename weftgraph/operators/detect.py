"""Find what changed: keyed snapshots compared, or history read past a watermark.

A snapshot is any frame with a *group* (schema and table), a *member* (column) and values
(data type). Nothing here assumes that it is small.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.sets import absent_keys
from weftgraph.specs import ScopeRule

# Change types.
NEW_COLUMN = "NEW_COLUMN"
DROPPED_COLUMN = "DROPPED_COLUMN"
TYPE_CHANGED = "TYPE_CHANGED"
NEW_TABLE = "NEW_TABLE"

# The start of the first run, before which nothing is known.
FIRST_WATERMARK = datetime(1970, 1, 1)


# ---------------------------------------------------------------- scope


def scope_predicate(
    rules: Sequence[ScopeRule],
    schema_col: str = "table_schema",
    table_col: str = "table_name",
    catalog_col: str | None = None,
) -> Column:
    """True for rows that match an INCLUDE rule and no EXCLUDE rule.

    A plain filter: Spark turns the simple patterns into prefix tests and pushes them to
    the scan. LIKE keeps its meaning, so ``_`` matches any one character. A null name
    matches no rule; the predicate is then false or null, both of which drop the row.
    """

    def like(name: str, pattern: str) -> Column:
        column = F.col(name)
        return column.isNotNull() if pattern == "%" else column.like(pattern)

    def matches(kind: str) -> Column:
        hit = F.lit(False)
        for rule in rules:
            if (rule.filter_type or "").upper() != kind or None in (rule.schema_pattern, rule.table_pattern):
                continue
            test = like(schema_col, rule.schema_pattern) & like(table_col, rule.table_pattern)
            if catalog_col is not None:
                test = test & like(catalog_col, rule.catalog_pattern)
            hit = hit | test
        return hit

    return matches("INCLUDE") & ~F.coalesce(matches("EXCLUDE"), F.lit(False))


def in_scope(
    df: DataFrame,
    rules: Sequence[ScopeRule] | DataFrame,
    schema_col: str = "table_schema",
    table_col: str = "table_name",
    catalog_col: str | None = None,
) -> DataFrame:
    """Keep the rows in scope. Rules come as a list, or as a frame with the columns
    ``filter_type``, ``schema_pattern`` and ``table_pattern`` (and ``catalog_pattern`` when
    a catalog column is named).

    A list becomes a filter that reaches the scan. A frame, however long, stays a frame: its
    rules are joined with the distinct names, and the surviving names select the rows. Rules
    with a null type or pattern match nothing.
    """
    if not isinstance(rules, DataFrame):
        return df.where(scope_predicate(rules, schema_col, table_col, catalog_col))

    names = {"schema_pattern": schema_col, "table_pattern": table_col}
    if catalog_col is not None:
        names["catalog_pattern"] = catalog_col
    rules = rules.select("filter_type", *names)
    columns = list(names.values())
    distinct = df.select(*columns).distinct()
    included = _names_matching(distinct, rules, "INCLUDE", names)
    excluded = _names_matching(distinct, rules, "EXCLUDE", names)
    kept = included.join(excluded, columns, "left_anti")
    return df.join(kept, columns, "left_semi").select(*df.columns)


# What a rule is looked up by: the first of these texts that is not empty. The literal start or
# end of a pattern is one that every matching name has as well, and so is a gram of a literal inside.
_LITERALS = (
    ("table_pattern", "start"),
    ("table_pattern", "end"),
    ("schema_pattern", "start"),
    ("schema_pattern", "end"),
    ("table_pattern", "inside"),
    ("schema_pattern", "inside"),
)
_GRAM = 3
_OPEN_PARTS = 64


def _names_matching(
    distinct: DataFrame, rules: DataFrame, kind: str, names: dict[str, str]
) -> DataFrame:
    """Names matched by some rule of the kind, by an equality join and no broadcast."""
    keyed, wanted = _keyed_names_and_rules(distinct, rules, kind, names)
    like = F.lit(True)
    for pattern, name in names.items():
        like = like & F.expr(f"`{name}` LIKE {pattern}")
    same = (F.col("_at") == F.col("_by")) & (F.col("_key") == F.col("_text"))
    hits = keyed.join(wanted, same & like, "left_semi")
    return hits.select(*names.values()).distinct()


def _keyed_names_and_rules(
    distinct: DataFrame, rules: DataFrame, kind: str, names: dict[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Names with the keys (_at, _key) they can be found by, and rules with their one key (_by, _text).

    A rule's key says which literal it is looked up by, and that literal; of a literal inside a
    pattern (``%x%``) it is the gram of up to three characters with the fewest pairs of names and rules
    holding it. Names offer only starts, ends and grams of lengths that occur among the rules. Rules
    without any literal (``%``) are copied to ``_OPEN_PARTS`` parts and the names dealt out over them.
    """
    wanted = rules.where(F.upper("filter_type") == kind).select(*names)
    for pattern, name in names.items():
        wanted = wanted.where(F.col(pattern).isNotNull())
        distinct = distinct.where(F.col(name).isNotNull())
    runs = lambda p: F.regexp_extract_all(p, F.lit(r"[^%_\\]+"), F.lit(0))
    literal = {
        "start": lambda p: F.regexp_extract(p, r"^[^%_\\]*", 0),
        "end": lambda p: F.regexp_extract(p, r"[^%_\\]*$", 0),
        # Only its length counts, up to the size of a gram.
        "inside": lambda p: F.left(F.array_max(F.transform(runs(p), lambda r: F.repeat(F.lit("x"), F.length(r)))), F.lit(_GRAM)),
    }
    by, text = F.lit(len(_LITERALS)), F.lit("")
    for number, (pattern, side) in reversed(list(enumerate(_LITERALS))):
        own = F.coalesce(literal[side](F.col(pattern)), F.lit(""))
        by, text = F.when(own != "", number).otherwise(by), F.when(own != "", own).otherwise(text)
    wanted = wanted.distinct().withColumn("_by", by).withColumn("_text", text)
    inside = [n for n, (_, side) in enumerate(_LITERALS) if side == "inside"]
    size = F.length("_text").cast("int").alias("_size")
    closed = wanted.where(F.col("_by") < len(_LITERALS))
    lengths = closed.agg(F.collect_set(F.struct(F.col("_by").alias("_at"), size))).scalar()
    open_ = F.struct(F.lit(len(_LITERALS)).alias("_at"), F.lit(0).alias("_size"))
    keyed = distinct.select(*names.values(), F.inline(F.concat(lengths, F.array(open_))))
    keys = F.array(F.pmod(F.xxhash64(*names.values()), F.lit(_OPEN_PARTS)).cast("string"))
    for number, (pattern, side) in enumerate(_LITERALS):
        name, size = F.col(names[pattern]), F.col("_size")
        if side == "inside":
            found = _grams(F.array(name), size)
        else:
            cut = F.left(name, size) if side == "start" else F.right(name, size)
            found = F.when(F.length(name) >= size, F.array(cut))
        keys = F.when(F.col("_at") == number, found).otherwise(keys)
    keyed = keyed.select("*", F.explode(keys).alias("_key"))

    # Each rule with a literal inside goes to the cheapest of its grams.
    offered = wanted.where(F.col("_by").isin(inside)).select(*names, "_by", F.length("_text").alias("_size"))
    literals = runs(F.col(_LITERALS[inside[-1]][0]))
    for number in inside[:-1]:
        literals = F.when(F.col("_by") == number, runs(F.col(_LITERALS[number][0]))).otherwise(literals)
    offered = offered.select(*names, "_by", F.explode(_grams(literals, F.col("_size"))).alias("_text"))
    in_names = keyed.where(F.col("_at").isin(inside)).groupBy(F.col("_at").alias("_by"), F.col("_key").alias("_text"))
    in_rules = offered.groupBy("_by", "_text").agg(F.count(F.lit(1)).alias("_rules"))
    costs = in_rules.join(in_names.agg(F.count(F.lit(1)).alias("_names")), ["_by", "_text"], "left")
    cost = F.coalesce("_names", F.lit(0)) * F.col("_rules")
    cheapest = (
        offered.join(costs, ["_by", "_text"])
        .groupBy(*names, "_by")
        .agg(F.min_by("_text", F.struct(cost, "_text")).alias("_text"))
    )
    part = F.explode(F.array(*(F.lit(str(i)) for i in range(_OPEN_PARTS))))
    outer = wanted.where(~F.col("_by").isin(*inside, len(_LITERALS)))
    spread = wanted.where(F.col("_by") == len(_LITERALS)).withColumn("_text", part)
    return keyed, outer.unionByName(cheapest).unionByName(spread)


def _grams(texts: Column, size: Column) -> Column:
    """The different substrings of ``size`` characters of the texts."""

    def of(text: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
        return F.transform(starts, lambda at: F.substring(text, at, size))

    return F.array_distinct(F.filter(F.flatten(F.transform(texts, of)), lambda g: F.length(g) == size))


# ---------------------------------------------------------------- snapshots


def snapshot_diff(
    current: DataFrame,
    previous: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    labels: tuple[str, str, str] = (NEW_COLUMN, DROPPED_COLUMN, TYPE_CHANGED),
) -> DataFrame:
    """Keys that are new, gone or hold other values; the values are the current ones.

    A null key part is a value like any other, so a snapshot never differs from itself.
    Both sides are hashed on the full key, so the members of one huge group still spread
    over all tasks. Restrict both sides to the scope first.
    """
    keys = list(keys)
    new, dropped, changed = labels
    now = current.select(*keys, *values, F.lit(True).alias("_now"))
    was = previous.select(
        *(F.col(c).alias(f"_was_{c}") for c in (*keys, *values)), F.lit(True).alias("_was")
    )
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_was_{key}"))
    differs = F.lit(False)
    for value in values:
        differs = differs | ~F.col(value).eqNullSafe(F.col(f"_was_{value}"))
    change = (
        F.when(F.col("_was").isNull(), new)
        .when(F.col("_now").isNull(), dropped)
        .when(differs, changed)
    )
    return (
        now.join(was, same, "full_outer")
        .withColumn("change_type", change)
        .where(F.col("change_type").isNotNull())
        .select(
            *(F.when(F.col("_now"), F.col(k)).otherwise(F.col(f"_was_{k}")).alias(k) for k in keys),
            *values,
            "change_type",
        )
    )


def new_groups(current: DataFrame, previous: DataFrame, group: Sequence[str]) -> DataFrame:
    """Groups without a single row in the previous snapshot, each once.

    Rows with a null group part belong to no group. They are left out up front, which also
    lets two uses of the result in one plan share their shuffle.
    """
    group = list(group)
    named = F.lit(True)
    for part in group:
        named = named & F.col(part).isNotNull()
    return absent_keys(current.where(named), previous.where(named), group)


def without_new_groups(
    changes: DataFrame, groups: DataFrame, group: Sequence[str], label: str = NEW_COLUMN
) -> DataFrame:
    """Drop the new members of new groups, which are handled as a whole.

    ``groups`` is small beside ``changes``; a group with very many members skews only the
    changes side, which an anti join can split.
    """
    group = list(group)
    marked = groups.select(*group).withColumn("change_type", F.lit(label))
    return changes.join(marked, [*group, "change_type"], "left_anti")


def detect_changes(
    current: DataFrame,
    previous: DataFrame,
    group: Sequence[str],
    member: str,
    values: Sequence[str],
) -> DataFrame:
    """One run: member changes, plus one NEW_TABLE row per new group."""
    group = list(group)
    fresh = new_groups(current, previous, group)
    members = without_new_groups(
        snapshot_diff(current, previous, [*group, member], values), fresh, group
    )
    kinds = dict(current.dtypes)
    blanks = [F.lit(None).cast(kinds[c]).alias(c) for c in (member, *values)]
    whole = fresh.select(*group, *blanks, F.lit(NEW_TABLE).alias("change_type"))
    return members.unionByName(whole)


def stamp_run(changes: DataFrame, run_id: str, detected_ts: Column | None = None) -> DataFrame:
    """Add the run id and the detection time."""
    when = F.localtimestamp() if detected_ts is None else detected_ts
    return changes.select(F.lit(run_id).alias("run_id"), "*", when.alias("detected_ts"))


def refreshed(
    previous: DataFrame,
    current: DataFrame,
    rules: Sequence[ScopeRule] | Column,
    schema_col: str = "table_schema",
    table_col: str = "table_name",
) -> DataFrame:
    """The next baseline: in-scope rows replaced by the current state, others kept.

    ``current`` is taken as already restricted to the scope. No rows are matched, so this
    is a filter and a union.
    """
    scope = rules if isinstance(rules, Column) else scope_predicate(rules, schema_col, table_col)
    outside = ~F.coalesce(scope, F.lit(False))
    return previous.where(outside).unionByName(current.select(*previous.columns))


def members_per_group(snapshot: DataFrame, group: Sequence[str], out: str = "n") -> DataFrame:
    """Members of every group, in group order."""
    return snapshot.groupBy(*group).agg(F.count(F.lit(1)).alias(out)).orderBy(*group)


# ---------------------------------------------------------------- history


def changes_since(
    children: DataFrame,
    parents: DataFrame,
    parent_id: str,
    watermark: datetime | Column,
    keep: Sequence[str],
) -> DataFrame:
    """Members created or deleted after the watermark in parents that already existed.

    Both frames hold ``created`` and ``deleted``. Deletion is tested first; the limits are
    strict. Both sides are filtered before the join, and a parent with very many changed
    children only skews the child side, which an inner join can split.
    """
    since = _moment(watermark)
    gone = F.coalesce(F.col("deleted") > since, F.lit(False))
    change = F.when(gone, DROPPED_COLUMN).when(F.col("created") > since, NEW_COLUMN)
    touched = (
        children.withColumn("change_type", change)
        .where(F.col("change_type").isNotNull())
        .select(*dict.fromkeys([parent_id, *keep, "change_type"]))
    )
    live = parents.where(F.col("deleted").isNull() & (F.col("created") <= since))
    return touched.join(live.select(parent_id), parent_id).select(*keep, "change_type")


def new_since(
    parents: DataFrame, watermark: datetime | Column, keep: Sequence[str]
) -> DataFrame:
    """Live parents created after the watermark, each once."""
    fresh = parents.where(F.col("deleted").isNull() & (F.col("created") > _moment(watermark)))
    return fresh.select(*keep).distinct().withColumn("change_type", F.lit(NEW_TABLE))


def next_watermark(
    frames: Sequence[DataFrame], watermark: datetime | None = None, overlap_seconds: int = 0
) -> DataFrame:
    """One row: the largest time read, less an overlap, never before the old watermark.

    Advancing to a time that was read, and not to the clock, keeps late rows visible; rows
    seen twice through the overlap are caught by the content key of a proposal.
    """
    floor = F.lit(watermark or FIRST_WATERMARK).cast("timestamp_ntz")
    tops = [
        f.agg(F.greatest(F.max("created"), F.max("deleted")).cast("timestamp_ntz").alias("top"))
        for f in frames
    ]
    read = tops[0]
    for top in tops[1:]:
        read = read.unionByName(top)
    back = F.make_dt_interval(secs=F.lit(overlap_seconds))
    return read.agg(F.max("top").alias("top")).select(
        F.greatest(F.coalesce(F.col("top") - back, floor), floor).alias("last_run_ts")
    )


# ---------------------------------------------------------------- runs


def latest_run(changes: DataFrame) -> DataFrame:
    """One row: the run id with the newest detection time.

    A run without changes leaves no rows, so pass the run id on where it is known.
    """
    order = F.struct("detected_ts", "run_id")
    return changes.agg(F.max_by("run_id", order).alias("run_id"))


def run_summary(changes: DataFrame, run_id: str | None = None) -> DataFrame:
    """Number of changes of one run, or of the newest one, without reading rows twice."""
    if run_id is not None:
        counted = changes.where(F.col("run_id") == run_id)
        return counted.agg(F.count(F.lit(1)).alias("changes")).select(
            F.lit(run_id).alias("run_id"), "changes"
        )
    per_run = changes.groupBy("run_id").agg(
        F.max("detected_ts").alias("detected_ts"), F.count(F.lit(1)).alias("changes")
    )
    newest = F.max_by(F.struct("run_id", "changes"), F.struct("detected_ts", "run_id"))
    return per_run.agg(newest.alias("newest")).select("newest.*")


def _moment(watermark: datetime | Column) -> Column:
    if isinstance(watermark, Column):
        return watermark
    return F.lit(watermark).cast("timestamp_ntz")
