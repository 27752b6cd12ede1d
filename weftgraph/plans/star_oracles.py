"""ANSI SQL for the star-schema queries, written from the tables alone.

None of it follows the way the operators work: existence is a correlated EXISTS, decisions
are replayed one after the other by recursion, profiles are counted pair by pair.
"""

from __future__ import annotations

from weftgraph.functions.text import DESCRIPTION_SLOT
from weftgraph.operators import decide, draft
from weftgraph.operators.review import PROMPT_INTRO, PROMPT_TASK

# (node type, table, key, properties) of the six node types.
_NODES = [
    ("REGION", "region", "r_regionkey", ["r_name"]),
    ("NATION", "nation", "n_nationkey", ["n_name", "n_regionkey"]),
    ("CUSTOMER", "customer", "c_custkey", ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    ("SUPPLIER", "supplier", "s_suppkey", ["s_name", "s_nationkey", "s_acctbal"]),
    ("PART", "part", "p_partkey", ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]),
    (
        "ORDERS",
        "orders",
        "o_orderkey",
        ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    ),
]
# (edge type, from type, table, key, reference, to type, target table, target key)
_EDGES = [
    ("NATION_IN_REGION", "NATION", "nation", "n_nationkey", "n_regionkey", "REGION", "region", "r_regionkey"),
    ("CUSTOMER_HAS_NATION", "CUSTOMER", "customer", "c_custkey", "c_nationkey", "NATION", "nation", "n_nationkey"),
    ("SUPPLIER_HAS_NATION", "SUPPLIER", "supplier", "s_suppkey", "s_nationkey", "NATION", "nation", "n_nationkey"),
    ("ORDER_HAS_CUSTOMER", "ORDERS", "orders", "o_orderkey", "o_custkey", "CUSTOMER", "customer", "c_custkey"),
]


def _text(column: str) -> str:
    return f"{column}::VARCHAR"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_KG_NODES = _union(
    [
        f"SELECT '{t}' AS node_type, {key}::VARCHAR AS node_id, 'src.{table}' AS source_object, "
        f"({' + '.join(f'({p} IS NOT NULL)::BIGINT' for p in props)})::BIGINT AS n_props FROM {table}"
        for t, table, key, props in _NODES
    ]
)
_KG_NODE_SK = _union(
    [
        f"SELECT '{t}' AS node_type, {key}::VARCHAR AS node_id, "
        f"sha256('{t}:' || {key}::VARCHAR) AS node_sk FROM {table}"
        for t, table, key, _ in _NODES
    ]
)
_KG_FK_EDGES = _union(
    [
        f"SELECT '{e}' AS edge_type, s.{key}::VARCHAR AS src_id, s.{ref}::VARCHAR AS dst_id "
        f"FROM {table} s JOIN {target} t ON t.{tkey} = s.{ref}"
        for e, _, table, key, ref, _, target, tkey in _EDGES
    ]
)
_ATTRIBUTE_TRIPLES = _union(
    [
        f"SELECT '{t}:' || {key}::VARCHAR AS subject, '{p}' AS predicate, {_text(p)} AS object, "
        f"'ATTRIBUTE' AS triple_kind FROM {table} WHERE {p} IS NOT NULL"
        for t, table, key, props in _NODES
        for p in props
    ]
)
_EDGE_TRIPLES = _union(
    [
        f"SELECT '{ft}:' || s.{key}::VARCHAR AS subject, '{e}' AS predicate, "
        f"'{tt}:' || t.{tkey}::VARCHAR AS object, 'EDGE' AS triple_kind "
        f"FROM {table} s JOIN {target} t ON t.{tkey} = s.{ref}"
        for e, ft, table, key, ref, tt, target, tkey in _EDGES
    ]
)
_PAIRS = "SELECT l_partkey, l_suppkey, sum(l_quantity)::BIGINT AS quantity FROM lineitem GROUP BY 1, 2"
_BROKEN = f"""
WITH pairs AS ({_PAIRS})
SELECT l_partkey::VARCHAR AS src_id, l_suppkey::VARCHAR AS dst_id FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = p.l_partkey AND p_size <= 25)
   OR NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = p.l_suppkey)
"""
_TYPE_COUNTS = _union(
    [
        f"SELECT '{t}' AS type_name, NULL::VARCHAR AS from_type, NULL::VARCHAR AS to_type, "
        f"count(*) AS n FROM {table}"
        for t, table, _, _ in _NODES
    ]
    + [
        f"SELECT '{e}', '{ft}', '{tt}', count(*) FROM {table} s JOIN {target} t ON t.{tkey} = s.{ref}"
        for e, ft, table, _, ref, tt, target, tkey in _EDGES
    ]
)

# ---------------------------------------------------------------- detection

_NOW = "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 11 <> 0"
_WAS = (
    "SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END "
    "AS o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0"
)
_SNAPSHOT_DIFF = f"""
WITH now AS ({_NOW}), was AS ({_WAS})
SELECT n.o_custkey, n.o_orderkey, n.o_orderstatus, 'NEW_COLUMN' AS change_type FROM now n
WHERE NOT EXISTS (SELECT 1 FROM was w WHERE w.o_orderkey = n.o_orderkey AND w.o_custkey = n.o_custkey)
UNION ALL
SELECT w.o_custkey, w.o_orderkey, NULL, 'DROPPED_COLUMN' FROM was w
WHERE NOT EXISTS (SELECT 1 FROM now n WHERE w.o_orderkey = n.o_orderkey AND w.o_custkey = n.o_custkey)
UNION ALL
SELECT n.o_custkey, n.o_orderkey, n.o_orderstatus, 'TYPE_CHANGED' FROM now n
JOIN was w ON w.o_orderkey = n.o_orderkey AND w.o_custkey = n.o_custkey
WHERE n.o_orderstatus <> w.o_orderstatus
"""
_OLD_GROUPS = "SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'"
_DIFF_DEMOTED = f"""
SELECT o_custkey, o_orderkey, o_orderstatus, 'NEW_COLUMN' AS change_type FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_custkey IN ({_OLD_GROUPS})
UNION ALL
SELECT DISTINCT o_custkey, NULL::BIGINT, NULL, 'NEW_TABLE' FROM orders
WHERE o_custkey NOT IN ({_OLD_GROUPS})
"""
_CHILDREN = """
SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus, o.o_orderdate AS created,
       CASE WHEN o.o_orderstatus = 'F' THEN
         (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o.o_orderkey) END AS deleted
FROM orders o
"""
_CHANGES_SINCE = f"""
WITH c AS ({_CHILDREN}),
p AS (SELECT o_custkey FROM orders GROUP BY 1 HAVING min(o_orderdate) <= TIMESTAMP '1996-01-01')
SELECT c.o_custkey, c.o_orderkey, c.o_orderstatus,
       CASE WHEN c.deleted > TIMESTAMP '1996-01-01' THEN 'DROPPED_COLUMN' ELSE 'NEW_COLUMN' END
         AS change_type
FROM c JOIN p USING (o_custkey)
WHERE c.created > TIMESTAMP '1996-01-01' OR c.deleted > TIMESTAMP '1996-01-01'
"""

# ---------------------------------------------------------------- keys

_KEYS = [
    ("region", ["r_regionkey"]),
    ("nation", ["n_nationkey"]),
    ("customer", ["c_custkey"]),
    ("supplier", ["s_suppkey"]),
    ("part", ["p_partkey"]),
    ("orders", ["o_orderkey"]),
    ("events", ["event_id"]),
    ("documents", ["doc_id"]),
    ("labels", ["doc_id"]),
    ("embeddings", ["vec_id"]),
    ("pages", ["page_id"]),
    ("benchmark", ["item_id"]),
    ("conversations", ["conv_id", "turn"]),
    ("lineitem", ["l_orderkey", "l_linenumber"]),
]
_MORE_KEYS = [
    ("lineitem", ["l_partkey", "l_suppkey"]),
    ("orders", ["o_custkey"]),
    ("customer", ["c_name"]),
]
# (child, column, parent, column): same name stem, plus one pair given by hand.
# The compared columns of each table by class: whole numbers, texts, doubles and times.
_CLASSES = {
    "region": {"i": "r_regionkey", "s": "r_name"},
    "nation": {"i": "n_nationkey n_regionkey", "s": "n_name"},
    "customer": {"i": "c_custkey c_nationkey", "s": "c_name c_mktsegment", "d": "c_acctbal"},
    "supplier": {"i": "s_suppkey s_nationkey", "s": "s_name", "d": "s_acctbal"},
    "part": {"i": "p_partkey p_size", "s": "p_name p_brand p_type", "d": "p_retailprice"},
    "orders": {"i": "o_orderkey o_custkey", "s": "o_orderstatus o_orderpriority", "d": "o_totalprice", "t": "o_orderdate"},
    "lineitem": {
        "i": "l_orderkey l_partkey l_suppkey l_linenumber",
        "s": "l_returnflag l_linestatus",
        "d": "l_quantity l_extendedprice l_discount l_tax",
        "t": "l_shipdate",
    },
    "events": {"i": "event_id user_id", "s": "event_type props", "d": "value", "t": "ts"},
    "documents": {"i": "doc_id n_chars", "s": "text lang source"},
    "embeddings": {"i": "vec_id label"},
    "pages": {"i": "page_id", "s": "url html"},
    "benchmark": {"i": "item_id", "s": "text"},
    "labels": {"i": "doc_id quality toxic"},
    "conversations": {"i": "conv_id turn", "s": "role text"},
}
_REFS = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("events", "user_id", "customer", "c_custkey"),
]


def _distinct(table: str, key: list[str]) -> str:
    held = " AND ".join(f"{c} IS NOT NULL" for c in key)
    return f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(key)} FROM {table} WHERE {held}))"


_UNIQUENESS = _union(
    [
        f"SELECT '{t}' AS table_name, '{','.join(key)}' AS key_columns, count(*) AS n_rows, "
        f"{_distinct(t, key)} AS n_distinct, "
        f"count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in key)}) AS n_null, "
        f"count(*) = {_distinct(t, key)} AS is_unique FROM {t}"
        for t, key in _KEYS + _MORE_KEYS
    ]
)


def _inclusion(child: str, col: str, parent: str, pcol: str) -> str:
    lost = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})"
    return (
        f"SELECT '{child}' AS child, '{col}' AS child_col, '{parent}' AS parent, "
        f"'{pcol}' AS parent_col, count({col}) AS n_rows, count(DISTINCT {col}) AS n_distinct, "
        f"count({col}) FILTER (WHERE lost) AS n_missing_rows, "
        f"count(DISTINCT {col}) FILTER (WHERE lost) AS n_missing, "
        f"count(DISTINCT {col}) FILTER (WHERE NOT lost) / count(DISTINCT {col}) AS inclusion "
        f"FROM (SELECT {col}, {lost} AS lost FROM {child} c)"
    )


_INCLUSION = _union([_inclusion(*ref) for ref in _REFS])

_DERIVED = f"""
part_supplier AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
part_supplier_stats AS (
  SELECT l_partkey, l_suppkey, sum(l_quantity) AS quantity, count(*) AS n_lines,
         min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1, 2),
order_line AS (
  SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey
  FROM lineitem GROUP BY 1, 2)
"""
_DERIVED_KEYS = [
    ("part_supplier", ["l_partkey", "l_suppkey"]),
    ("part_supplier_stats", ["l_partkey", "l_suppkey"]),
    ("order_line", ["l_linenumber", "l_orderkey"]),
]
_DERIVED_REFS = [
    ("part_supplier", "l_partkey", "part", "p_partkey"),
    ("part_supplier", "l_suppkey", "supplier", "s_suppkey"),
    ("part_supplier_stats", "l_partkey", "part", "p_partkey"),
    ("part_supplier_stats", "l_suppkey", "supplier", "s_suppkey"),
    ("order_line", "l_orderkey", "orders", "o_orderkey"),
    ("order_line", "l_partkey", "part", "p_partkey"),
    ("order_line", "l_suppkey", "supplier", "s_suppkey"),
]
# Columns per table.
_WIDTH = {
    "region": 2,
    "nation": 3,
    "customer": 5,
    "supplier": 4,
    "part": 6,
    "orders": 6,
    "lineitem": 11,
    "events": 6,
    "documents": 5,
    "embeddings": 3,
    "pages": 3,
    "benchmark": 2,
    "labels": 3,
    "conversations": 4,
    "part_supplier": 2,
    "part_supplier_stats": 5,
    "order_line": 4,
}


def _fk_rows(refs: list[tuple[str, str, str, str]]) -> str:
    """Declared-style references that hold in the data and point at a unique column."""
    return _union(
        [
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{p}' AS ref_table "
            f"WHERE NOT EXISTS (SELECT 1 FROM {t} x WHERE x.{c} IS NOT NULL AND x.{c} NOT IN "
            f"(SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)) "
            f"AND EXISTS (SELECT 1 FROM {t} WHERE {c} IS NOT NULL) "
            f"AND NOT EXISTS (SELECT 1 FROM {p} GROUP BY {pc} HAVING count(*) > 1)"
            for t, c, p, pc in refs
        ]
    )


def _pk_rows(keys: list[tuple[str, list[str]]]) -> str:
    """One row per column of every key that is unique and complete."""
    return _union(
        [
            f"SELECT '{t}' AS table_name, unnest({key!r}) AS column_name "
            f"WHERE NOT EXISTS (SELECT 1 FROM {t} GROUP BY {', '.join(key)} HAVING count(*) > 1) "
            f"AND NOT EXISTS (SELECT 1 FROM {t} WHERE {' OR '.join(f'{c} IS NULL' for c in key)})"
            for t, key in keys
        ]
    )


_SHAPES = f"""
{_DERIVED},
fk AS ({_fk_rows(_REFS + _DERIVED_REFS)}),
pk AS ({_pk_rows(_KEYS + _DERIVED_KEYS)}),
wide(table_name, total_columns) AS (
  VALUES {', '.join(f"('{t}', {n}::BIGINT)" for t, n in _WIDTH.items())}),
shape AS (
  SELECT w.table_name,
    (SELECT count(DISTINCT column_name) FROM fk WHERE fk.table_name = w.table_name) AS fk_count,
    (SELECT count(*) FROM pk WHERE pk.table_name = w.table_name) AS pk_count,
    (SELECT count(*) FROM pk WHERE pk.table_name = w.table_name AND EXISTS (
       SELECT 1 FROM fk WHERE fk.table_name = pk.table_name AND fk.column_name = pk.column_name))
      AS fk_in_pk,
    w.total_columns
  FROM wide w),
judged AS (
  SELECT *, CASE WHEN fk_count < 2 THEN 'FEW_FKS'
                 WHEN fk_in_pk < pk_count THEN 'FKS_NOT_IDENTITY'
                 WHEN total_columns - pk_count <= 1 THEN 'PURE_JUNCTION'
                 ELSE 'REIFIED_ENTITY?' END AS rule_applied
  FROM shape)
"""
_KIND = (
    "CASE rule_applied WHEN 'PURE_JUNCTION' THEN 'EDGE_TYPE' WHEN 'REIFIED_ENTITY?' THEN 'FLAGGED' "
    "ELSE 'NODE_TYPE' END"
)


def _nth_type(n: int) -> str:
    return (
        "CASE WHEN rule_applied IN ('PURE_JUNCTION', 'REIFIED_ENTITY?') THEN "
        "(SELECT upper(ref_table) FROM (SELECT ref_table, row_number() OVER (ORDER BY column_name) "
        f"AS n FROM fk WHERE fk.table_name = judged.table_name) WHERE n = {n} AND ref_table IN "
        "('region','nation','customer','supplier','part','orders')) END"
    )


_CLASSIFY_TABLES = f"""
WITH {_SHAPES}
SELECT table_name, {_KIND} AS object_kind, rule_applied,
       CASE WHEN starts_with(table_name, 'part_') THEN substr(table_name, 6) ELSE table_name END
         AS proposed_name,
       {_nth_type(1)} AS edge_from, {_nth_type(2)} AS edge_to
FROM judged
"""

_ALL_COLUMNS = [(t, c) for t, kinds in _CLASSES.items() for cols in kinds.values() for c in cols.split()] + [("embeddings", "embedding")]
_NEW_COLUMNS = (
    "col(table_name, column_name) AS (VALUES "
    + ", ".join(f"('{t}', '{c}')" for t, c in _ALL_COLUMNS)
    + ")"
)
_KNOWN = "('region','nation','customer','supplier','part','orders')"
_CLASSIFY_COLUMNS = f"""
WITH fk AS ({_fk_rows(_REFS)}), {_NEW_COLUMNS}
SELECT table_name, column_name, 'ATTRIBUTE' AS object_kind, 'COLUMN_TO_ATTRIBUTE' AS rule_applied,
       lower(column_name) AS proposed_name, NULL::VARCHAR AS edge_from, NULL::VARCHAR AS edge_to
FROM col WHERE NOT EXISTS (
  SELECT 1 FROM fk WHERE fk.table_name = col.table_name AND fk.column_name = col.column_name)
UNION ALL
SELECT table_name, column_name, 'EDGE_TYPE', 'FK_TO_EDGE',
       CASE WHEN ends_with(column_name, 'key') THEN left(column_name, length(column_name) - 3)
            ELSE column_name END,
       upper(table_name), upper(ref_table)
FROM col JOIN fk USING (table_name, column_name)
WHERE table_name IN {_KNOWN} AND ref_table IN {_KNOWN}
"""
_UNRESOLVED = f"""
WITH fk AS ({_fk_rows(_REFS)}), {_NEW_COLUMNS}
SELECT table_name, column_name, ref_table AS ref_table_name,
       CASE WHEN table_name NOT IN {_KNOWN} AND ref_table NOT IN {_KNOWN} THEN 'BOTH_UNKNOWN'
            WHEN table_name NOT IN {_KNOWN} THEN 'SOURCE_UNKNOWN' ELSE 'TARGET_UNKNOWN' END AS reason
FROM col JOIN fk USING (table_name, column_name)
WHERE table_name NOT IN {_KNOWN} OR ref_table NOT IN {_KNOWN}
"""


def _score(child: str, col: str, parent: str, pcol: str) -> str:
    return (
        f"SELECT '{child}' AS table_name, '{col}' AS column_name, '{parent}.{pcol}' AS edge_to, "
        f"(SELECT count(DISTINCT {col}) FROM {child} WHERE {col} IN (SELECT {pcol} FROM {parent})) "
        f"/ (SELECT count(DISTINCT {col}) FROM {child}) "
        f"* ((SELECT count(DISTINCT {pcol}) FROM {parent}) / (SELECT count(*) FROM {parent})) AS x"
    )


_REVIEW_SCORES = f"""
WITH s AS ({_union([_score(*r) for r in [*_REFS, ("events", "user_id", "orders", "o_custkey")]])})
SELECT table_name, column_name, edge_to,
       CASE WHEN x >= 0.5 THEN 'EDGE_TYPE' ELSE 'ATTRIBUTE' END AS ai_recommended_kind,
       x >= 0.5 AS ai_agrees_with_rule, round(x, 6) AS confidence,
       CASE WHEN x >= 0.85 THEN 'EXPLICIT' WHEN x >= 0.5 THEN 'INFERRED' ELSE 'SPECULATIVE' END AS band
FROM s
"""

# ---------------------------------------------------------------- keys and references from values alone

_COMPARED = [(t, c, k) for t, kinds in _CLASSES.items() for k, cols in kinds.items() for c in cols.split()]
_SINGLE = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
    "orders": "o_orderkey", "events": "event_id", "documents": "doc_id", "labels": "doc_id", "embeddings": "vec_id",
    "pages": "page_id", "benchmark": "item_id",
}


def _held(kind: str) -> str:
    cast = {"i": "BIGINT", "s": "VARCHAR", "d": "DOUBLE", "t": "TIMESTAMP"}[kind]
    return _union(
        [
            f"SELECT '{t}' AS t, '{c}' AS c, {c}::{cast} AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"
            for t, c, k in _COMPARED
            if k == kind
        ]
    )


def _included_pairs(kind: str) -> str:
    return f"""
SELECT a.t AS child, a.c AS child_col, b.t AS parent, b.c AS parent_col, any_value(s.n_rows) AS n_rows, any_value(s.n_distinct) AS n_distinct
FROM held_{kind} a JOIN held_{kind} b ON a.v = b.v AND (a.t, a.c) <> (b.t, b.c)
JOIN (SELECT t, c, sum(n)::BIGINT AS n_rows, count(*) AS n_distinct FROM held_{kind} GROUP BY t, c) s ON s.t = a.t AND s.c = a.c
GROUP BY a.t, a.c, b.t, b.c HAVING count(*) = any_value(s.n_distinct)"""


_ALL_INCLUDED = (
    "WITH " + ", ".join(f"held_{k} AS ({_held(k)})" for k in "isdt") + f", included AS ({_union([_included_pairs(k) for k in 'isdt'])})"
)
_FOUND_INCLUSIONS = f"{_ALL_INCLUDED} SELECT child, child_col, parent, parent_col, n_distinct FROM included"
_SCREENED_REFERENCES = f"""{_ALL_INCLUDED}
SELECT * FROM included WHERE (parent, parent_col) IN ({", ".join(f"('{t}', '{c}')" for t, c in _SINGLE.items())})"""

_COMPOSITE_KEYS = [
    ("conversations", ("conv_id", "turn")),
    ("lineitem", ("l_orderkey", "l_linenumber")),
    ("part_supplier", ("l_partkey", "l_suppkey")),
    ("order_line", ("l_linenumber", "l_orderkey")),
]


def _composite(child: str, cols: tuple[str, str], parent: str, key: tuple[str, str]) -> str:
    (x, y), (k, m) = cols, key
    listed = f"{x},{y}" if k < m else f"{y},{x}"
    return (
        f"SELECT '{child}' AS table_name, '{listed}' AS columns, '{parent}' AS ref_table_name, "
        f"'{child}({x},{y})->{parent}({k},{m})' AS ref_name "
        f"WHERE EXISTS (SELECT 1 FROM {child} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) "
        f"AND NOT EXISTS (SELECT 1 FROM {child} a WHERE {x} IS NOT NULL AND {y} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} b WHERE b.{k} = a.{x} AND b.{m} = a.{y}))"
    )


_WITH_PAIRS = {t: kinds["i"].split() for t, kinds in _CLASSES.items()} | {
    "part_supplier": ["l_partkey", "l_suppkey"],
    "order_line": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
}
_COMPOSITE_REFERENCES = (
    "WITH part_supplier AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem), order_line AS (SELECT l_orderkey, l_linenumber, "
    "max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey, l_linenumber) "
    + _union(
        [
            _composite(child, (x, y), parent, key)
            for parent, key in _COMPOSITE_KEYS
            for child, columns in _WITH_PAIRS.items()
            for x in columns
            for y in columns
            if x != y and (child, (x, y)) != (parent, key)
        ]
    )
)


def _is_key(table: str, cols: tuple[str, ...]) -> str:
    null = " OR ".join(f"{c} IS NULL" for c in cols)
    return (
        f"SELECT '{table}' AS table_name, '{','.join(cols)}' AS key_columns, count(*) AS n_rows, count(*) FILTER (WHERE {null}) AS n_null, "
        f"count(*) = (SELECT count(*) FROM (SELECT DISTINCT {', '.join(cols)} FROM {table} WHERE NOT ({null}))) AS is_unique FROM {table}"
    )


_SCREENED_KEYS = _union(
    [_is_key(t, (c,)) for t, c, _ in _COMPARED]
    + [_is_key(*k) for k in [*_COMPOSITE_KEYS[:2], ("lineitem", ("l_partkey", "l_suppkey")), ("orders", ("o_custkey", "o_orderdate"))]]
)

# ---------------------------------------------------------------- review and proposals

_KIND_OF_ORDER = (
    "CASE o_orderkey % 4 WHEN 0 THEN 'ATTRIBUTE' WHEN 1 THEN 'EDGE_TYPE' WHEN 2 THEN 'NODE_TYPE' "
    "ELSE 'FLAGGED' END"
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PROMPT = f"""concat_ws(chr(10),
  {_quoted(PROMPT_INTRO)},
  'Domain: wholesale',
  'Source: ' || o_orderpriority || '.c' || o_custkey || '.o' || o_orderkey,
  'Proposed kind: ' || {_KIND_OF_ORDER},
  'Rule: FK_TO_EDGE',
  'Proposed name: ORDER_' || o_orderstatus,
  'From: ORDERS',
  'To: ' || CASE WHEN o_orderkey % 5 = 0 THEN 'none' ELSE 'CUSTOMER' END,
  'Details: none',
  'Table comment: ' || coalesce('segment ' || c_mktsegment, 'none'),
  'Column comment: ' || CASE WHEN o_orderkey % 3 = 0 THEN 'status ' || o_orderstatus ELSE 'none' END,
  {_quoted(PROMPT_TASK)})"""
_PROMPTED = "FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND o_orderpriority = '5-LOW'"
_REVIEW_PROMPTS = f"SELECT o_orderkey::VARCHAR AS candidate_id, sha256({_PROMPT}) AS prompt_hash {_PROMPTED}"
_HOOK_ANSWERS = f"""
SELECT o_orderkey::VARCHAR AS candidate_id,
  length({_PROMPT}) % 2 = 0 AS ai_agrees_with_rule, 'EDGE_TYPE' AS ai_recommended_kind,
  (length({_PROMPT}) % 128) / 128.0::DOUBLE AS ai_confidence, 'prompt of ' || length({_PROMPT}) || ' characters' AS ai_rationale
{_PROMPTED}
"""
_K = "json_extract_string(props, '$.k')::INTEGER / 64.0::DOUBLE"
_VALID = f"event_type <> 'error' AND {_K} BETWEEN 0 AND 1 AND event_id % 13 <> 0"
_EVENT_KIND = (
    "CASE event_type WHEN 'click' THEN 'ATTRIBUTE' WHEN 'view' THEN 'EDGE_TYPE' "
    "WHEN 'purchase' THEN 'NODE_TYPE' WHEN 'signup' THEN 'FLAGGED' END"
)
_REVIEW_PARSE = f"""
SELECT event_id::VARCHAR AS candidate_id,
  CASE WHEN event_id % 5 = 0 THEN true WHEN {_VALID} THEN event_id % 2 = 0 END AS ai_agrees_with_rule,
  CASE WHEN event_id % 5 = 0 THEN 'ATTRIBUTE' WHEN {_VALID} THEN {_EVENT_KIND} END AS ai_recommended_kind,
  CASE WHEN event_id % 5 = 0 THEN 0.25::DOUBLE WHEN {_VALID} THEN {_K} END AS ai_confidence,
  CASE WHEN event_id % 5 = 0 THEN 'earlier' WHEN {_VALID} THEN event_type END AS ai_rationale
FROM events
"""
_REVIEW_REJECTS = f"""
WITH r AS (
  SELECT event_id,
    '{{"agrees_with_rule":' || (event_id % 2 = 0)::VARCHAR || ',"recommended_object_kind":"' ||
    coalesce({_EVENT_KIND}, 'OTHER') || '","confidence":' || ({_K})::VARCHAR ||
    ',"rationale":"' || event_type || '","industry_note":""}}' AS response
  FROM events WHERE NOT ({_VALID}))
SELECT event_id::VARCHAR AS candidate_id,
  CASE WHEN event_id % 13 = 0 THEN 20 ELSE length(response) END::BIGINT AS n_chars FROM r
"""
_PRINT = "sha256(o_orderpriority || '.c' || o_custkey || '.o' || o_orderkey)"
_PERSIST_DEDUP = f"""
SELECT {_PRINT} AS fingerprint_key, o_orderkey::VARCHAR AS candidate_id,
  {_KIND_OF_ORDER} AS object_kind,
  CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE {_KIND_OF_ORDER} END AS final_object_kind,
  'ORDER_' || o_orderstatus AS final_name, 'PENDING' AS status, o_orderdate AS detected_ts
FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 4 <> 3)
"""
_FINAL_KIND = f"CASE WHEN o_orderkey % 4 = 3 THEN 'NODE_TYPE' ELSE {_KIND_OF_ORDER} END"
_EDGE_TO = "CASE WHEN o_orderkey % 5 <> 0 THEN 'CUSTOMER' END"
_PENDING_QUEUE = f"""
SELECT o_orderpriority AS table_schema, 'c' || o_custkey AS table_name, 'o' || o_orderkey AS column_name,
  'ORDER_' || o_orderstatus AS final_name, {_FINAL_KIND} AS final_object_kind,
  {_KIND_OF_ORDER} AS rule_object_kind, 'ORDERS' AS edge_from, {_EDGE_TO} AS edge_to,
  o_orderdate AS detected_ts
FROM orders WHERE o_orderkey % 4 IN (2, 3)
"""

# ---------------------------------------------------------------- decisions: replayed in order

_REPLAY = f"""
WITH RECURSIVE proposal AS (
  SELECT o_orderkey, o_orderkey::VARCHAR AS proposal_id,
    ['PENDING','PENDING','DEFERRED','APPROVED','PENDING',NULL][(o_orderkey % 6 + 1)::INT] AS status,
    'name_' || o_orderstatus AS name,
    ['EDGE_TYPE','FLAGGED','ATTRIBUTE',NULL][(o_orderkey % 4 + 1)::INT] AS kind
  FROM orders),
decision AS (
  SELECT o_orderkey, seq::BIGINT AS seq,
    (CASE WHEN o_orderkey % 50 = 0 THEN 'none-' ELSE '' END) || o_orderkey AS proposal_id,
    upper(['deferred','APPROVED','Deferred','DEFERRED','rejected','MAYBE','APPROVED',NULL]
      [(((o_orderkey * 3 + seq * 5) // 2) % 8 + 1)::INT]) AS status,
    'reason ' || seq AS rationale,
    CASE WHEN (o_orderkey * 3 + seq * 5) % 4 = 1 THEN 'renamed_' || seq END AS name,
    upper([NULL,'edge_type',NULL,'FLAGGED',NULL,'node_type',NULL]
      [((o_orderkey * 3 + seq * 5) % 7 + 1)::INT]) AS kind,
    o_orderdate + seq * INTERVAL 1 HOUR AS decided_ts,
    o_orderkey % 50 <> 0 AS found,
    o_orderkey % 9 = 0 AS drafted
  FROM orders, (VALUES (1), (2), (3)) AS n(seq)),
step AS (
  SELECT o_orderkey, 0::BIGINT AS seq, status, name, kind, NULL::VARCHAR AS rationale,
    NULL::TIMESTAMP AS decided_ts, NULL::VARCHAR AS decided_by, NULL::VARCHAR AS result
  FROM proposal
  UNION ALL
  SELECT s.o_orderkey, d.seq,
    CASE WHEN r.result = 'OK' THEN d.status ELSE s.status END,
    CASE WHEN r.result = 'OK' THEN coalesce(d.name, s.name) ELSE s.name END,
    CASE WHEN r.result = 'OK' THEN coalesce(d.kind, s.kind) ELSE s.kind END,
    CASE WHEN r.result = 'OK' THEN d.rationale ELSE s.rationale END,
    CASE WHEN r.result = 'OK' THEN d.decided_ts ELSE s.decided_ts END,
    CASE WHEN r.result = 'OK' THEN 'reviewer' ELSE s.decided_by END,
    r.result
  FROM step s JOIN decision d ON d.o_orderkey = s.o_orderkey AND d.seq = s.seq + 1,
  LATERAL (SELECT CASE
    WHEN d.status IS NULL OR d.status NOT IN ('APPROVED','REJECTED','DEFERRED') THEN '{decide.BAD_STATUS}'
    WHEN NOT d.found THEN '{decide.NOT_FOUND}'
    WHEN s.status IS NULL OR s.status NOT IN ('PENDING','DEFERRED') THEN '{decide.CLOSED}'
    WHEN d.drafted AND (d.name IS NOT NULL OR d.kind IS NOT NULL) THEN '{decide.DRAFTED}'
    WHEN d.status = 'APPROVED' AND coalesce(d.kind, s.kind, '') NOT IN
      ('ATTRIBUTE','NODE_TYPE','EDGE_TYPE') THEN '{decide.NOT_ACTIONABLE}'
    ELSE 'OK' END AS result) r)
"""
_JUDGE = f"""{_REPLAY}
SELECT d.proposal_id, s.seq AS decision_seq, s.result
FROM step s JOIN decision d ON d.o_orderkey = s.o_orderkey AND d.seq = s.seq
"""
_APPLIED = """
SELECT p.proposal_id, s.status, s.name AS final_name, s.kind AS final_object_kind,
  s.decided_by, s.decided_ts, s.rationale
FROM step s JOIN proposal p USING (o_orderkey) WHERE s.seq = 3
"""
_AUDIT = f"""{_REPLAY}
SELECT sha256(strlen(d.proposal_id) || ':' || d.proposal_id || strlen(d.seq::VARCHAR) || ':' || d.seq || strlen(d.decided_ts::VARCHAR) || ':' || d.decided_ts) AS log_id,
  d.proposal_id, d.status, 'reviewer' AS decided_by, d.decided_ts, d.rationale
FROM step s JOIN decision d ON d.o_orderkey = s.o_orderkey AND d.seq = s.seq WHERE s.result = 'OK'
"""

# ---------------------------------------------------------------- drafting

_WORK = f"""
work AS (
  SELECT o_orderkey::VARCHAR AS proposal_id,
    CASE WHEN o_orderkey % 10 <> 0 THEN {_FINAL_KIND} END AS kind,
    'new_order_' || lower(o_orderstatus) AS name, 'ORDERS' AS edge_from, {_EDGE_TO} AS edge_to,
    o_orderpriority AS sch, o_custkey, 'c' || o_custkey AS tab,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'o' || o_orderkey END AS col
  FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 8 <> 1),
reasoned AS (
  SELECT *, CASE
    WHEN kind = 'ATTRIBUTE' AND col IS NULL THEN 'attribute without a column'
    WHEN kind = 'NODE_TYPE' AND col IS NOT NULL THEN 'single column as a node type'
    WHEN kind = 'EDGE_TYPE' AND (edge_from IS NULL OR edge_to IS NULL) THEN 'edge without both end points'
    WHEN kind IS NULL OR kind NOT IN ('ATTRIBUTE','NODE_TYPE','EDGE_TYPE') THEN 'kind cannot be built'
    END AS skip_reason
  FROM work)
"""
_EDGE_PARTS = "(VALUES ('EDGE_TYPE_DDL'), ('VIEW_DDL'), ('POPULATION_SCRIPT')) a(artifact_type)"
_NODE_PARTS = "(VALUES ('NODE_TYPE_DDL'), ('VIEW_DDL'), ('POPULATION_SCRIPT')) a(artifact_type)"


def _shown(name: str) -> str:
    """Every word capitalised, the rest in lower case."""
    return (
        f"list_aggregate(list_transform(string_split({name}, '_'), "
        "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), 'string_agg', ' ')"
    )


_PLAN = f"""
WITH {_WORK},
placed AS (
  SELECT w.* EXCLUDE skip_reason, skip_reason AS own_reason, sch || '.' || tab AS src,
    CASE WHEN sch = '5-LOW' THEN 'a_id,k' || c_nationkey END AS keys,
    CASE WHEN sch = '5-LOW' AND o_custkey % 2 = 0 THEN 'C' || o_custkey END AS owner,
    sch = '5-LOW' AS has_refs,
    CASE WHEN sch = '5-LOW' AND c_nationkey < 20 THEN c_nationkey END AS nation
  FROM reasoned w JOIN customer ON c_custkey = o_custkey),
r AS (
  SELECT *, CASE
    WHEN own_reason IS NOT NULL THEN own_reason
    WHEN keys IS NULL AND (kind = 'NODE_TYPE' OR kind = 'EDGE_TYPE' AND col IS NOT NULL) THEN 'table without a key'
    WHEN kind = 'EDGE_TYPE' AND col IS NULL AND NOT has_refs THEN 'table without two references'
    END AS skip_reason
  FROM placed)
SELECT proposal_id, 'DICTIONARY_ENTRY' AS artifact_type, 'MANUAL' AS object_kind, name AS type_name,
  {_shown('name')} AS display_name, NULL AS owner_type, NULL AS from_type, NULL AS to_type,
  keys AS key_columns, NULL AS src_column, NULL AS dst_column, src AS source_object, col AS source_column,
  skip_reason
FROM r WHERE skip_reason IS NOT NULL
UNION ALL
SELECT proposal_id, 'DICTIONARY_ENTRY', 'ATTRIBUTE', name, {_shown('name')}, owner, NULL, NULL, keys,
  NULL, NULL, src, col, NULL
FROM r WHERE skip_reason IS NULL AND kind = 'ATTRIBUTE'
UNION ALL
SELECT proposal_id, artifact_type, 'EDGE_TYPE', name, {_shown('name')}, NULL, edge_from, edge_to, keys,
  CASE WHEN col IS NULL THEN 'market_CODE' END, CASE WHEN col IS NOT NULL THEN col ELSE 'nation_ID' END, src, col, NULL
FROM r, {_EDGE_PARTS} WHERE skip_reason IS NULL AND kind = 'EDGE_TYPE'
UNION ALL
SELECT proposal_id, artifact_type, 'NODE_TYPE', name, {_shown('name')}, NULL, NULL, NULL, keys,
  NULL, NULL, src, col, NULL
FROM r, {_NODE_PARTS} WHERE skip_reason IS NULL AND kind = 'NODE_TYPE'
UNION ALL
SELECT proposal_id, artifact_type, 'EDGE_TYPE', name || '_nation', {_shown("(name || '_nation')")},
  NULL, name, 'NATION_' || nation, keys, NULL, 'nation_ID', src, col, NULL
FROM r, {_EDGE_PARTS} WHERE skip_reason IS NULL AND kind = 'NODE_TYPE' AND nation IS NOT NULL
"""
_ID_TEXT = (
    "list_aggregate(list_transform(string_split(key_columns, ','), lambda c: 'cast(' || c || ' as string)'), "
    "'string_agg', ' || ''_'' || ')"
)
_DRAFT_TEXT = f"""
SELECT proposal_id, artifact_type, type_name, sha256('-- draft' || chr(10) || chr(10) || CASE
  WHEN object_kind = 'MANUAL' THEN '-- By hand: ' || skip_reason
  WHEN artifact_type = 'DICTIONARY_ENTRY' THEN concat_ws(chr(10),
    '-- Attribute ' || type_name || ' of ' || coalesce(owner_type, '<missing>'),
    '-- read from ' || source_object || '.' || source_column || '; kept in props, no load needed',
    '-- {DESCRIPTION_SLOT}')
  WHEN artifact_type = 'NODE_TYPE_DDL' THEN concat_ws(chr(10),
    'INSERT INTO node_types (node_type, display_name, description, source_object)',
    'VALUES (''' || type_name || ''', ''' || display_name || ''', ''{DESCRIPTION_SLOT}'', ''' || source_object || ''');')
  WHEN artifact_type = 'EDGE_TYPE_DDL' THEN concat_ws(chr(10),
    'INSERT INTO edge_types',
    '  (edge_type, display_name, description, from_node_type, to_node_type, source_object)',
    'VALUES (''' || type_name || ''', ''' || display_name || ''', ''{DESCRIPTION_SLOT}'', ''' ||
    from_type || ''', ''' || to_type || ''', ''' || source_object || ''');')
  WHEN artifact_type = 'VIEW_DDL' THEN
    'CREATE OR REPLACE VIEW v_' || lower(type_name) || ' COMMENT ''' ||
    CASE object_kind WHEN 'NODE_TYPE' THEN 'Nodes' ELSE 'Edges' END || ' of type ' || type_name || '.'' AS' || chr(10) ||
    CASE object_kind WHEN 'NODE_TYPE' THEN 'SELECT node_sk, node_id, props FROM nodes WHERE node_type = '''
      ELSE 'SELECT edge_sk, src_id, dst_id, props FROM edges WHERE edge_type = ''' END || type_name || ''';'
  WHEN object_kind = 'NODE_TYPE' THEN concat_ws(chr(10),
    'INSERT INTO nodes (node_id, node_type, props, source_object)',
    'SELECT ' || {_ID_TEXT} || ', ''' || type_name || ''',',
    '  to_json(struct(* EXCEPT (' || replace(key_columns, ',', ', ') || '))), ''' || source_object || '''',
    'FROM ' || source_object || ';')
  WHEN src_column IS NULL THEN concat_ws(chr(10),
    'INSERT INTO edges (edge_type, src_type, src_id, dst_type, dst_id, source_object)',
    'SELECT ''' || type_name || ''', ''' || from_type || ''', ' || {_ID_TEXT} || ',',
    '  ''' || to_type || ''', cast(' || dst_column || ' as string), ''' || source_object || '''',
    'FROM ' || source_object || ' WHERE ' || dst_column || ' IS NOT NULL;')
  ELSE concat_ws(chr(10),
    '-- Check that ' || src_column || ' names a ' || from_type || ' and ' || dst_column || ' a ' || to_type || '.',
    'INSERT INTO edges (edge_type, src_type, src_id, dst_type, dst_id, props, source_object)',
    'SELECT ''' || type_name || ''', ''' || from_type || ''', cast(' || src_column || ' as string),',
    '  ''' || to_type || ''', cast(' || dst_column || ' as string),',
    '  to_json(struct(* EXCEPT (' || src_column || ', ' || dst_column || '))), ''' || source_object || '''',
    'FROM ' || source_object || ';')
  END) AS text_hash
FROM ({_PLAN})
"""
_SENTENCE = (
    "(CASE WHEN o_orderkey % 2 = 0 THEN 'Nodes' ELSE 'Edges' END) || ' of type T' || o_orderkey || '.'"
)
_DESCRIPTION = "'it''''s $1 \\2 for ' || o_orderpriority || ' ' || o_orderstatus"
_ATTACH = f"""
SELECT o_orderkey::VARCHAR AS artifact_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 'done before'
       WHEN o_orderkey % 3 = 1 THEN 'INSERT'
       WHEN o_orderkey % 7 = 0 THEN NULL
       WHEN o_orderkey % 3 = 0 THEN 'VIEW ''' || {_DESCRIPTION} || ''' AS SELECT'
       ELSE 'VALUES (''' || {_DESCRIPTION} || ''')' END AS ai_refined_sql,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL
       WHEN o_orderkey % 3 = 1 THEN 'load copied unchanged'
       WHEN o_orderkey % 7 = 0 THEN NULL
       ELSE 'description filled in' END AS ai_notes
FROM orders
"""

_CYCLE = f"""
WITH early AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
o AS (
  SELECT o_custkey, o_orderkey, o_orderdate, 'c' || o_custkey AS tab, 'o' || o_orderkey AS col,
    o_orderkey % 4 = 0 AS is_fk, o_custkey IN (SELECT o_custkey FROM early) AS old,
    'C' || (o_custkey - o_custkey % 2) AS target,
    CASE WHEN o_custkey % 2 = 0 THEN 'C' || o_custkey END AS own
  FROM orders WHERE NOT starts_with(o_custkey::VARCHAR, '1')),
single AS (SELECT * FROM o WHERE old AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderkey % 9 <> 0),
whole AS (
  SELECT tab, count(*) FILTER (WHERE is_fk) AS fks, count(*) AS cols,
    list(target ORDER BY col) FILTER (WHERE is_fk) AS targets
  FROM o WHERE NOT old GROUP BY tab)
SELECT tab AS table_name, col AS column_name, 'ATTRIBUTE' AS object_kind,
  'COLUMN_TO_ATTRIBUTE' AS rule_applied, 'ATTRIBUTE' AS final_object_kind, col AS proposed_name,
  NULL AS edge_from, NULL AS edge_to, 'PENDING' AS status
FROM single WHERE NOT is_fk
UNION ALL
SELECT tab, col, 'EDGE_TYPE', 'FK_TO_EDGE', 'EDGE_TYPE', col, own, target, 'PENDING'
FROM single WHERE is_fk AND own IS NOT NULL
UNION ALL
SELECT tab, NULL, CASE WHEN fks < 2 THEN 'NODE_TYPE' ELSE 'FLAGGED' END,
  CASE WHEN fks < 2 THEN 'FEW_FKS' ELSE 'REIFIED_ENTITY?' END,
  CASE WHEN fks < 2 THEN 'NODE_TYPE' END, tab,
  CASE WHEN fks >= 2 THEN targets[1] END, CASE WHEN fks >= 2 THEN targets[2] END, 'PENDING'
FROM whole
"""

ORACLES: dict[str, str] = {
    "observed_changes": """
SELECT DISTINCT event_type, NULL::VARCHAR AS json_key, NULL::VARCHAR AS json_type,
  'NEW_TABLE' AS change_type
FROM events WHERE event_type IN ('error', 'click') AND len(json_keys(props)) > 0""",
    "refresh_cycle": _CYCLE,
    "scope_rules": """
WITH rule AS (
  SELECT s_suppkey % 3 = 0 AS excludes,
    'src' || (s_suppkey % 13) || CASE WHEN s_suppkey % 2 = 0 THEN '%' ELSE '_' END AS sp,
    CASE WHEN s_suppkey % 3 = 0 THEN '_r' ELSE '%' END AS tp FROM supplier)
SELECT doc_id, source, lang FROM documents
WHERE EXISTS (SELECT 1 FROM rule WHERE NOT excludes AND source LIKE sp AND lang LIKE tp)
  AND NOT EXISTS (SELECT 1 FROM rule WHERE excludes AND source LIKE sp AND lang LIKE tp)""",
    "scope_inner_rules": """
WITH rule AS (
  SELECT s_suppkey % 4 = 0 AS excludes,
    CASE WHEN s_suppkey % 5 = 0 THEN '%' || right(s_name, 1) || '%' WHEN s_suppkey % 9 = 1 THEN '%UIL%' ELSE '%' END AS sp,
    CASE WHEN s_suppkey % 3 = 0 THEN '%' || s_suppkey || '_' ELSE '%0' || s_suppkey || '%' END AS tp FROM supplier)
SELECT c_custkey, c_mktsegment, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM rule WHERE NOT excludes AND c_mktsegment LIKE sp AND c_name LIKE tp)
  AND NOT EXISTS (SELECT 1 FROM rule WHERE excludes AND c_mktsegment LIKE sp AND c_name LIKE tp)""",
    "review_listing": f"""
SELECT 'c' || o_custkey AS table_name, 'o' || o_orderkey AS column_name, {_KIND_OF_ORDER} AS rule_kind,
  CASE WHEN o_orderkey % 2 = 0 THEN 'NODE_TYPE' END AS ai_recommended_kind,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 3 = 0 END AS ai_agrees_with_rule,
  CASE WHEN o_orderkey % 2 = 0 THEN 0.75::DOUBLE END AS ai_confidence,
  CASE WHEN o_orderkey % 2 = 0 THEN 'c' || o_custkey END AS ai_rationale,
  CASE WHEN o_orderkey % 2 = 0 THEN 'none' END AS ai_industry_note
FROM orders""",
    "confidence_bands": f"""
SELECT CASE WHEN {_K} >= 0.85 THEN 'EXPLICIT' WHEN {_K} >= 0.5 THEN 'INFERRED' ELSE 'SPECULATIVE' END
  AS band, count(*) AS n FROM events WHERE {_VALID} GROUP BY 1""",
    "work_count": "SELECT count(*) AS proposals FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 8 <> 1",
    "description_prompts": f"""
SELECT o_orderkey::VARCHAR AS artifact_id, sha256(concat_ws(chr(10),
  {_quoted(draft.PROMPT_INTRO)}, 'Domain: wholesale', 'Artifact: ' || o_orderpriority, 'Kind: NODE_TYPE',
  'Name: ' || c_name, 'From: none', 'To: none', 'Source: ' || c_mktsegment || '.' || c_name,
  'Table comment: ' || CASE WHEN c_custkey % 2 = 0 THEN 'nation ' || c_nationkey ELSE 'none' END,
  'Column comment: none',
  'Draft, for reference only: say "' || o_orderstatus || '"' || chr(10),
  {_quoted(draft.PROMPT_TASK)})) AS prompt_hash
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 2 <> 0""",
    "description_answers": """
SELECT event_id::VARCHAR AS artifact_id, event_type AS description FROM events
WHERE event_id % 3 <> 0 AND event_id % 5 <> 0""",
    "kg_nodes": _KG_NODES,
    "kg_node_sk": _KG_NODE_SK,
    "kg_fk_edges": _KG_FK_EDGES,
    "kg_junction_edges": f"""
WITH pairs AS ({_PAIRS})
SELECT 'PART_FROM_SUPPLIER' AS edge_type, l_partkey::VARCHAR AS src_id, l_suppkey::VARCHAR AS dst_id,
       quantity::VARCHAR AS quantity
FROM pairs JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
    "kg_self_edges": """
SELECT 'CUSTOMER_REFERRED_BY' AS edge_type, 'CUSTOMER' AS src_type, a.c_custkey::VARCHAR AS src_id,
       'CUSTOMER' AS dst_type, b.c_custkey::VARCHAR AS dst_id
FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey - 1""",
    "kg_reified_nodes": """
SELECT l_partkey || '_' || l_suppkey AS node_id, sum(l_quantity)::BIGINT AS quantity,
       count(*) AS n_lines, min(l_shipdate)::DATE AS first_ship
FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "kg_bundled_edges": f"""
WITH pairs AS ({_PAIRS})
SELECT 'SUPPLY_l_part' AS edge_type, l_partkey || '_' || l_suppkey AS src_id, 'PART' AS dst_type,
       p_partkey::VARCHAR AS dst_id FROM pairs JOIN part ON p_partkey = l_partkey
UNION ALL
SELECT 'SUPPLY_l_supp', l_partkey || '_' || l_suppkey, 'SUPPLIER', s_suppkey::VARCHAR
FROM pairs JOIN supplier ON s_suppkey = l_suppkey""",
    "kg_attribute_triples": _ATTRIBUTE_TRIPLES,
    "kg_triples": _union([_ATTRIBUTE_TRIPLES, _EDGE_TRIPLES]),
    "kg_node_view": "SELECT c_custkey::VARCHAR AS customer_id, c_name, c_mktsegment, c_nationkey FROM customer",
    "kg_edge_view": """
SELECT o_orderkey::VARCHAR AS order_id, c_custkey::VARCHAR AS customer_id
FROM orders JOIN customer ON c_custkey = o_custkey""",
    "kg_edge_view_by_key": """
SELECT c_custkey::VARCHAR AS customer_id, n_nationkey::VARCHAR AS nation_id
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "kg_orders_per_nation": """
SELECT n_nationkey::VARCHAR AS nation_id, count(*) AS orders
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
GROUP BY n_nationkey""",
    "kg_type_counts": _TYPE_COUNTS,
    "kg_orphans": f"SELECT count(*) AS orphans FROM ({_BROKEN})",
    "kg_orphan_edges": _BROKEN,
    "kg_duplicate_keys": """
SELECT 'LINE' AS node_type, l_linenumber || '_' || l_orderkey AS node_id, count(*) AS n
FROM lineitem GROUP BY l_linenumber, l_orderkey HAVING count(*) > 1""",
    "kept_orphans": """
SELECT 'CUSTOMER' AS node_type, o_custkey::VARCHAR AS node_id, count(*) AS n FROM orders
WHERE o_orderkey % 7 <> 0 AND (o_custkey % 10 = 3 OR o_custkey NOT IN (SELECT c_custkey FROM customer)) GROUP BY o_custkey""",
    "insert_missing": """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN 'existing' ELSE 'new' END AS origin
FROM customer""",
    "scope_filter": "SELECT doc_id, source, lang FROM documents WHERE source LIKE 'src1%' AND lang <> 'fr'",
    "snapshot_diff": _SNAPSHOT_DIFF,
    "stored_changes": """
SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN o_orderstatus END AS o_orderstatus,
       CASE o_orderkey % 3 WHEN 0 THEN 'NEW_COLUMN' WHEN 1 THEN 'TYPE_CHANGED' ELSE 'DROPPED_COLUMN' END AS change_type
FROM orders WHERE o_custkey % 40 = 0 AND (o_orderkey % 3 <> 1 OR o_orderstatus <> 'X')""",
    "new_groups": f"SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN ({_OLD_GROUPS})",
    "diff_demoted": _DIFF_DEMOTED,
    "fingerprint_refresh": f"""
SELECT * FROM ({_WAS}) WHERE o_custkey % 2 <> 0
UNION ALL
SELECT * FROM ({_NOW}) WHERE o_custkey % 2 = 0""",
    "changes_since": _CHANGES_SINCE,
    "new_since": """
SELECT o_custkey, 'NEW_TABLE' AS change_type FROM orders GROUP BY 1
HAVING min(o_orderdate) > TIMESTAMP '1996-01-01'""",
    "next_watermark": f"""
WITH c AS ({_CHILDREN})
SELECT greatest(greatest(max(created), max(deleted)) - INTERVAL 1 HOUR, TIMESTAMP '1996-01-01')
  AS last_run_ts FROM c""",
    "latest_run": """
SELECT strftime(ts, '%Y-%m-%d') AS run_id, count(*) AS changes FROM events
WHERE ts::DATE = (SELECT max(ts)::DATE FROM events) GROUP BY 1""",
    "catalog_columns": _union(
        [
            f"SELECT '{t}' AS table_name, {n}::BIGINT AS n_columns, count(*) AS n_rows FROM {t}"
            for t, n in _WIDTH.items()
            if t not in ("part_supplier", "part_supplier_stats", "order_line")
        ]
    ),
    "observed_catalog": """
WITH k AS (SELECT event_type, props, unnest(json_keys(props)) AS json_key FROM events)
SELECT event_type, json_key,
  CASE json_type(json_extract(props, '$."' || json_key || '"'))
    WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object'
    WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' ELSE 'number' END AS json_type,
  count(*) AS n_rows
FROM k GROUP BY ALL""",
    "key_uniqueness": _UNIQUENESS,
    "key_inclusion": _INCLUSION,
    "found_inclusions": _FOUND_INCLUSIONS,
    "composite_references": _COMPOSITE_REFERENCES,
    "screened_keys": _SCREENED_KEYS,
    "screened_references": _SCREENED_REFERENCES,
    "classify_columns": _CLASSIFY_COLUMNS,
    "unresolved_references": _UNRESOLVED,
    "table_shapes": f"""
WITH {_SHAPES}
SELECT table_name, fk_count, pk_count, fk_in_pk, total_columns, total_columns - pk_count AS attr_count
FROM shape""",
    "classify_tables": _CLASSIFY_TABLES,
    "candidate_summary": f"""
WITH {_SHAPES}
SELECT {_KIND} AS object_kind, rule_applied, count(*) AS candidates FROM judged GROUP BY ALL""",
    "review_prompts": _REVIEW_PROMPTS,
    "hook_answers": _HOOK_ANSWERS,
    "review_scores": _REVIEW_SCORES,
    "review_parse": _REVIEW_PARSE,
    "review_rejects": _REVIEW_REJECTS,
    "fingerprints": """
SELECT o_orderkey, sha256(o_orderpriority || '.' || o_custkey || '.' || o_orderkey) AS fingerprint_key
FROM orders""",
    "persist_dedup": _PERSIST_DEDUP,
    "pending_queue": _PENDING_QUEUE,
    "judge_decisions": _JUDGE,
    "apply_decisions": f"{_REPLAY}{_APPLIED}",
    "decision_audit": _AUDIT,
    "recent_decisions": f"""{_REPLAY}
SELECT proposal_id, status, decided_ts FROM ({_APPLIED})
ORDER BY decided_ts DESC NULLS LAST, proposal_id LIMIT 10""",
    "plan_work": f"""
WITH {_WORK}
SELECT proposal_id, kind AS final_object_kind, col AS column_name, skip_reason FROM reasoned""",
    "plan_changes": _PLAN,
    "draft_text": _DRAFT_TEXT,
    "attach_descriptions": _ATTACH,
    "artifact_listing": """
SELECT o_custkey::VARCHAR AS proposal_id, c_name AS final_name, o_orderkey::VARCHAR AS artifact_id,
  o_orderpriority AS artifact_type,
  CASE WHEN o_orderkey % 2 = 0 THEN 'refined' END AS ai_refined_sql, o_orderdate AS generated_ts,
  max(o_orderdate) OVER (PARTITION BY o_custkey) AS proposal_latest_ts
FROM orders JOIN customer ON c_custkey = o_custkey""",
    "export_json": """
SELECT o_custkey::VARCHAR AS proposal_id, c_name AS final_name, 'NODE_TYPE' AS final_object_kind, NULL::VARCHAR AS edge_from,
  NULL::VARCHAR AS edge_to, c_mktsegment AS table_schema, c_name AS table_name, NULL::VARCHAR AS column_name,
  o_orderkey::VARCHAR AS artifact_id, o_orderpriority AS artifact_type, 'DRAFT' AS dev_status, NULL::VARCHAR AS ai_notes,
  'say "' || o_orderstatus || '"' || chr(10) AS template_sql,
  CASE WHEN o_orderkey % 2 = 0 THEN 'refined' END AS ai_refined_sql
FROM orders JOIN customer ON c_custkey = o_custkey""",
    "stream_first_seen": """
SELECT event_type, json_key, user_id, min(ts) AS first_seen, count(*) AS rows_in_batch, batch::INTEGER AS batch
FROM (SELECT *, min(batch) OVER (PARTITION BY event_type, json_key, user_id) AS first_batch
      FROM (SELECT event_type, user_id, ts, event_id % 4 AS batch, unnest(json_keys(props)) AS json_key FROM events))
WHERE batch = first_batch GROUP BY event_type, json_key, user_id, batch""",
}
