"""Keys and references found from the values alone, and sketches that rule out hopeless ones first.

Nothing here looks at names. Values are compared inside a class of types (:func:`value_class`)
and travel as 128 bits: whole numbers as they are, all others as two 64-bit hashes, so that a
long text costs no more than a number. Two values are taken as equal if these are.

What is collected is one row per column, candidate or pair of columns: metadata, not data.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.operators.graph import union_all
from weftgraph.operators.profile import KeyPair, profile_inclusion, profile_uniqueness
from weftgraph.session import local_rows

_BITS = 63
_WHOLE = "bigint"

#: Log of the number of cells of a distinct sketch, its relative standard error 1.04 / 2**(LG_K / 2)
#: (1.6 %), and by how much an estimate has to miss the number of rows to rule a key out (over six errors).
LG_K = 12
SPARE = 0.1


@dataclass(frozen=True)
class CompositeReference:
    """``child`` refers to all of ``parent``'s key by columns in the order of the key."""

    child: str
    child_cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.child}({','.join(self.child_cols)})->{self.parent}({','.join(self.parent_cols)})"


def value_class(data_type: T.DataType) -> str | None:
    """The type in which values are compared; ``None`` for those that are not (nested and binary ones)."""
    if isinstance(data_type, T.IntegralType):
        return _WHOLE
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(data_type, (T.StringType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
        return data_type.simpleString()
    return None


def compared_columns(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(table, column, class) of every column whose values are compared."""
    found = ((table, f.name, value_class(f.dataType)) for table in sorted(tables) for f in tables[table].schema.fields)
    return [(table, column, kind) for table, column, kind in found if kind]


def _digest(column: str, kind: str) -> tuple[Column, Column]:
    value = F.col(f"`{column}`").cast(kind)
    if kind == _WHOLE:
        return value, F.lit(0).cast("long")
    value = value + F.lit(0.0) if kind == "double" else value  # both zeros are one value
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def _index(rows: DataFrame, slots: Sequence[str], words: int) -> DataFrame:
    """Per set of members (and slots), how many values exactly these members hold.

    ``rows`` are (slots, a, b, w0, w1, ...), the words saying which members a row's value belongs to.
    Equal values are combined in each task first, so a value that fills a table is a row per task.
    """
    held = [f"w{i}" for i in range(words)]
    by_value = rows.groupBy(*slots, "a", "b").agg(*(F.bit_or(w).alias(w) for w in held))
    return by_value.groupBy(*slots, *held).agg(F.count(F.lit(1)).alias("n"))


def _whole_values(numbers: DataFrame, kind: int, words: int) -> DataFrame:
    """Rows for :func:`_index` of columns of whole numbers, named by their member: one row per value."""
    values = numbers.unpivot([], numbers.columns, "member", "a").where("a IS NOT NULL").withColumn("member", F.col("member").cast("int"))
    bit = F.expr(f"shiftleft(1L, member % {_BITS})")
    held = [F.when(F.floor(F.col("member") / F.lit(_BITS)) == i, bit).otherwise(F.lit(0).cast("long")).alias(f"w{i}") for i in range(words)]
    return values.select(F.lit(kind).alias("kind"), "a", F.lit(0).cast("long").alias("b"), *held)


def _words(member: int, words: int) -> list[Column]:
    return [F.lit(1 << member % _BITS if member // _BITS == i else 0).cast("long").alias(f"w{i}") for i in range(words)]


def _has(member: Column, words: int) -> Column:
    """Whether the set that the words hold has the member."""
    word = F.get(F.array(*(F.col(f"w{i}") for i in range(words))), F.floor(member / F.lit(_BITS)).cast("int"))
    return F.getbit(word, (member % F.lit(_BITS)).cast("int")) == 1


def _members(count: int, words: int) -> Column:
    """One row per member of the set that the words hold."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(count - 1)), lambda m: _has(m, words)))


def _common(sets: DataFrame, count: int, words: int) -> DataFrame:
    """Per member ``child`` its number of values and, as words, the members that hold all of them."""
    held = [F.bit_and(f"w{i}").alias(f"w{i}") for i in range(words)]
    return sets.withColumn("child", _members(count, words)).groupBy("child").agg(F.sum("n").alias("n_distinct"), *held)


def discover_inclusions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All pairs of columns of which one holds every value of the other.

    Output: child, child_col, parent, parent_col, n_distinct (of the child). Nulls are no values; a
    column without any is in no pair; a column is not paired with itself. Tables without any column
    that can be compared are refused.

    Pairs that set sketches disprove (:func:`undisproved`) are gone first, and with them the columns that are in
    no other. The rest are settled by one inverted index from value to the set of columns that hold it, built in
    one shuffle over all tables; a column's parents are the intersection of its values' sets.
    """
    compared = compared_columns(tables)
    if not compared:
        raise ValueError("no column whose values can be compared")
    spark = next(iter(tables.values())).sparkSession
    left = undisproved(tables, pairs_of_class(tables, [(t, c) for t, c, _ in compared]))
    if not left:
        return local_rows(spark, [], "child string, child_col string, parent string, parent_col string, n_distinct long")
    open_ = {end for p in left for end in ((p.child, p.child_col), (p.parent, p.parent_col))}
    columns = [(t, c, kind) for t, c, kind in compared if (t, c) in open_]
    words = -(-len(columns) // _BITS)
    kinds = {kind: i for i, kind in enumerate(sorted({kind for _, _, kind in columns}))}
    emitted = []
    for table in sorted({t for t, _, _ in columns}):
        entries, whole = [], []
        for number, (t, column, kind) in enumerate(columns):
            if t == table and kind == _WHOLE:
                whole.append(F.col(f"`{column}`").cast(kind).alias(str(number)))
            elif t == table:
                a, b = _digest(column, kind)
                entry = F.struct(F.lit(kinds[kind]).alias("kind"), a.alias("a"), b.alias("b"), *_words(number, words))
                entries.append(F.when(F.col(f"`{column}`").isNotNull(), entry))
        if whole:
            emitted.append(_whole_values(tables[table].select(*whole), kinds[_WHOLE], words))
        if entries:
            emitted.append(tables[table].select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*"))
    children = _common(_index(union_all(emitted), ["kind"], words), len(columns), words)
    pairs = children.select("child", "n_distinct", _members(len(columns), words).alias("parent")).where("child <> parent")
    names = local_rows(spark, [(i, t, c) for i, (t, c, _) in enumerate(columns)], "no int, table string, col string")
    for end in ("child", "parent"):
        side = names.select(F.col("no").alias(end), F.col("table").alias(f"_{end}"), F.col("col").alias(f"{end}_col"))
        pairs = pairs.join(side, end)
    return pairs.select(F.col("_child").alias("child"), "child_col", F.col("_parent").alias("parent"), "parent_col", "n_distinct")


def discover_composites(
    tables: Mapping[str, DataFrame], inclusions: DataFrame, keys: Iterable[tuple[str, Sequence[str]]]
) -> list[CompositeReference]:
    """The references to whole composite keys, level by level.

    A tuple of n columns of one table can only be included in the first n columns of a key if each
    column is included in its own (``inclusions``, collected) and the shorter tuple was found to be. Every
    level drops the tuples that set sketches disprove, and tests all others, of all tables, in one shuffle. A tuple with a null part is no value; a
    tuple without values refers to nothing; columns of a tuple are different, and a key does not refer to itself.
    """
    classes = {(t, c): kind for t, c, kind in compared_columns(tables)}
    into: dict[tuple[str, str], set[tuple[str, str]]] = {}
    for r in inclusions.select("child", "child_col", "parent", "parent_col").collect():
        into.setdefault((r.parent, r.parent_col), set()).add((r.child, r.child_col))
    found = []
    open_ = [(table, tuple(key), child, ()) for table, key in keys if len(key) > 1 for child in sorted(tables)]
    size = max((len(key) for _, key, _, _ in open_), default=0)
    for level in range(1, size + 1):
        grown = []
        for parent, key, child, cols in open_:
            own = {(parent, key[level - 1])} if parent == child else set()
            grown += [
                (parent, key, child, (*cols, c))
                for t, c in sorted(into.get((parent, key[level - 1]), set()) | own)
                if t == child and c not in cols
            ]
        if level > 1:
            grown = [g for g in grown if g[0] != g[2] or g[3] != g[1][:level]]
            grown = _undisproved_tuples(tables, grown, classes)
            grown = _included(tables, grown, classes) if grown else []
        found += [CompositeReference(child, cols, parent, key) for parent, key, child, cols in grown if len(key) == level > 1]
        open_ = [g for g in grown if len(g[1]) > level]
    return found


def _tuple(cols: Sequence[str], kinds: Sequence[str]) -> tuple[Column, list[Column]]:
    """Whether a tuple has no null part, and what its digests are made of."""
    complete = F.lit(True)
    for c in cols:
        complete &= F.col(f"`{c}`").isNotNull()
    return complete, [x for c, kind in zip(cols, kinds) for x in _digest(c, kind)]


def _sides(tuples: list[tuple], classes: Mapping[tuple[str, str], str]) -> tuple[dict[tuple, int], list[tuple[int, int]]]:
    """The different (table, columns, classes) of the (parent, key, child, columns), numbered, and the numbers of
    each one's (child, parent). Columns are put in the order of the key's names on both sides, which changes no
    verdict, so that a tuple is one side however many keys ask for it."""
    sides: dict[tuple, int] = {}
    asked = []
    for parent, key, child, cols in tuples:
        order = sorted(range(len(cols)), key=lambda i: key[i])
        kinds = tuple(classes[parent, key[i]] for i in order)
        ends = (child, tuple(cols[i] for i in order), kinds), (parent, tuple(key[i] for i in order), kinds)
        asked.append(tuple(sides.setdefault(end, len(sides)) for end in ends))
    return sides, asked


def _undisproved_tuples(tables: Mapping[str, DataFrame], tuples: list[tuple], classes: Mapping[tuple[str, str], str]) -> list[tuple]:
    """Those of the (parent, key, child, columns) that set sketches do not disprove; no true inclusion is lost."""
    sides, asked = _sides(tuples, classes)
    hashes = []
    for table, cols, kinds in sides:
        complete, parts = _tuple(cols, kinds)
        hashes.append((table, F.when(complete, F.xxhash64(*parts))))
    kept = _not_lacking(tables, hashes, asked)
    return [t for i, t in enumerate(tuples) if i in kept]


def _included(tables: Mapping[str, DataFrame], tuples: list[tuple], classes: Mapping[tuple[str, str], str]) -> list[tuple]:
    """Those of the (parent, key, child, columns) whose values all occur in as many columns of the key."""
    sides, asked = _sides(tuples, classes)
    words = -(-len(sides) // _BITS)
    by_table: dict[str, list[Column]] = {}
    for (table, cols, kinds), number in sides.items():
        complete, parts = _tuple(cols, kinds)
        digest = [F.xxhash64(F.lit(n), *parts).alias(name) for n, name in enumerate("ab")]
        by_table.setdefault(table, []).append(F.when(complete, F.struct(*digest, *_words(number, words))))
    emitted = [tables[t].select(F.explode(F.array_compact(F.array(*e))).alias("e")).select("e.*") for t, e in by_table.items()]
    rows = _common(_index(union_all(emitted), [], words), len(sides), words).collect()
    held = {r.child: [r[f"w{i}"] for i in range(words)] for r in rows}
    return [t for t, (child, parent) in zip(tuples, asked) if child in held and held[child][parent // _BITS] >> parent % _BITS & 1]


def reference_rows(spark, references: Iterable[CompositeReference], schema: str) -> DataFrame:
    """Composite references in the declared form, a row per column, with the ``ref_name`` they share."""
    rows = [(schema, r.child, c, schema, r.parent, p, r.name) for r in references for c, p in zip(r.child_cols, r.parent_cols)]
    names = ("table_schema", "table_name", "column_name", "ref_table_schema", "ref_table_name", "ref_column_name", "ref_name")
    return local_rows(spark, rows, ", ".join(f"{n} string" for n in names))


def screened_uniqueness(tables: Mapping[str, DataFrame], candidates: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """As ``profile_uniqueness``, but only candidates that a distinct sketch leaves open are counted.

    One pass over each table estimates all its candidates by mergeable sketches, of which nothing but
    the sketches is shuffled. A candidate with null parts, or whose estimate stays below its rows by more
    than ``SPARE``, is no key: its n_distinct is null and ``ruled_out`` true. A true key is ruled out with a
    chance below one in 10**8. The others have the exact counts.
    """
    spark = next(iter(tables.values())).sparkSession
    by_table: dict[str, list[int]] = {}
    for i, (table, _) in enumerate(candidates):
        by_table.setdefault(table, []).append(i)
    parts = []
    for table, numbers in by_table.items():
        aggregates = []
        for i in numbers:
            cols = [F.col(f"`{c}`") for c in candidates[i][1]]
            complete = F.lit(True)
            for c in cols:
                complete &= c.isNotNull()
            digest = F.when(complete, F.xxhash64(*cols))
            aggregates.append(
                F.struct(
                    F.lit(i).alias("no"),
                    F.count(F.lit(1)).alias("n_rows"),
                    F.count(F.when(~complete, 1)).alias("n_null"),
                    F.hll_sketch_estimate(F.hll_sketch_agg(digest, LG_K)).alias("estimate"),
                )
            )
        parts.append(_stacked(tables[table], aggregates))
    seen = {r["no"]: r for r in union_all(parts).collect()}
    hopeless = {i for i, r in seen.items() if r.n_null > 0 or r.estimate * (1 + SPARE) < r.n_rows}
    schema = "table_name string, key_columns string, key_parts array<string>, n_rows long, n_distinct long, n_null long, is_unique boolean, ruled_out boolean"
    gone = [
        (candidates[i][0], ",".join(candidates[i][1]), list(candidates[i][1]), seen[i].n_rows, None, seen[i].n_null, False, True) for i in sorted(hopeless)
    ]
    ruled_out = local_rows(spark, gone, schema)
    left = [c for i, c in enumerate(candidates) if i not in hopeless]
    if not left:
        return ruled_out
    exact = profile_uniqueness({t: tables[t] for t, _ in left}, left).withColumn("ruled_out", F.lit(False))
    return exact.unionByName(ruled_out)


def _stacked(table: DataFrame, aggregates: list[Column]) -> DataFrame:
    """One row per aggregate struct."""
    return table.agg(F.array(*aggregates).alias("all")).select(F.explode("all").alias("s")).select("s.*")


def undisproved(tables: Mapping[str, DataFrame], pairs: Sequence[KeyPair]) -> list[KeyPair]:
    """The pairs that set sketches do not disprove: all true inclusions, and few others.

    Each column that occurs is read once into a theta sketch of its values' hashes. A sketch keeps every hash below
    its own threshold, so a hash of the child that is below both thresholds and not in the parent's sketch is
    a value the parent lacks: the pair is dropped for certain, and no true inclusion ever is. Pairs of columns
    of different classes are dropped too; a child without values stays, as all of none are included.
    """
    classes = {(t, c): kind for t, c, kind in compared_columns(tables)}
    comparable = [p for p in pairs if classes.get((p.child, p.child_col), "") == classes.get((p.parent, p.parent_col))]
    if not comparable:
        return []
    wanted = sorted({end for p in comparable for end in ((p.child, p.child_col), (p.parent, p.parent_col))})
    number = {end: i for i, end in enumerate(wanted)}
    hashes = [(t, F.when(F.col(f"`{c}`").isNotNull(), _hashed(c, classes[t, c]))) for t, c in wanted]
    kept = _not_lacking(tables, hashes, [(number[p.child, p.child_col], number[p.parent, p.parent_col]) for p in comparable])
    return [p for i, p in enumerate(comparable) if i in kept]


def _not_lacking(tables: Mapping[str, DataFrame], hashes: Sequence[tuple[str, Column]], pairs: Sequence[tuple[int, int]]) -> set[int]:
    """The places of the (child, parent) pairs of ``hashes`` whose sketches show no hash that the parent lacks.

    ``hashes`` are (table, hash of a row's value, null for none). One pass over each table.
    """
    if not pairs:
        return set()
    parts = []
    for table in sorted({t for t, _ in hashes}):
        own = [F.struct(F.lit(i).alias("no"), F.theta_sketch_agg(h).alias("sketch")) for i, (t, h) in enumerate(hashes) if t == table]
        parts.append(_stacked(tables[table], own))
    sketches = union_all(parts)
    asked = local_rows(sketches.sparkSession, [(i, *pair) for i, pair in enumerate(pairs)], "pair int, child int, parent int")
    both = asked.join(sketches.toDF("child", "mine"), "child").join(sketches.toDF("parent", "theirs"), "parent")
    lacking = F.theta_sketch_estimate(F.theta_difference("mine", "theirs"))
    return {r["pair"] for r in both.where(lacking == 0).select("pair").collect()}


def _hashed(column: str, kind: str) -> Column:
    value = F.col(f"`{column}`").cast(kind)
    return F.xxhash64(value + F.lit(0.0) if kind == "double" else value)


def screened_inclusion(tables: Mapping[str, DataFrame], pairs: Sequence[KeyPair]) -> DataFrame:
    """``profile_inclusion`` of the pairs left by :func:`undisproved`, whose values alone are shuffled."""
    left = undisproved(tables, pairs)
    if left:
        return profile_inclusion(tables, left)
    spark = next(iter(tables.values())).sparkSession
    schema = "child string, child_col string, parent string, parent_col string, n_rows long, n_distinct long, n_missing_rows long, n_missing long, inclusion double"
    return local_rows(spark, [], schema)


def pairs_of_class(tables: Mapping[str, DataFrame], parents: Iterable[tuple[str, str]]) -> list[KeyPair]:
    """Every column against every parent column of its class, names aside."""
    columns = compared_columns(tables)
    kinds = {(t, c): kind for t, c, kind in columns}
    return [
        KeyPair(t, c, parent, column)
        for (t, c, kind), (parent, column) in itertools.product(columns, parents)
        if kind == kinds.get((parent, column)) and (t, c) != (parent, column)
    ]
