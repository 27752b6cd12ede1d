"""An invented harbour office: its tables, and the next release of its schema.

Covers a composite key that is also a composite reference, null references, a column that
references two tables, a reference to an unknown table, a keyless table, a dropped column, a
dropped table, a changed type, and a table that the scope excludes.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from weftgraph.session import local_rows
from weftgraph.specs import FkEdgeSpec, JunctionEdgeSpec, NodeSpec, ScopeRule

SCOPE = [ScopeRule("INCLUDE", "SRC", "SRC_%"), ScopeRule("EXCLUDE", "%", "SRC_TMP%")]

BEFORE = {
    "SRC_PORT": (
        "PORT_CODE string, PORT_TITLE string, DEPTH_M double, UTC_SHIFT int",
        [
            ("AA", "Anchor Bay", 12.5, 1),
            ("BB", "Bell Cove", 9.0, None),
            ("CC", "Cliff End", 15.25, 0),
            ("DD", "Dune Head", None, None),
            ("EE", "East Quay", 20.0, 2),
        ],
    ),
    "SRC_VESSEL": (
        "VESSEL_NO long, VESSEL_NAME string, HOME_PORT_CODE string, TONNES double, BUILT date, FLAG_STATE string",
        [
            (7, "Heron", "AA", 310.0, date(1998, 5, 1), "N"),
            (11, "Ibis", None, 95.5, None, "N"),
            (13, "Jay", "CC", 1200.0, date(2004, 2, 9), None),
            (17, "Kite", "CC", 45.0, date(2011, 7, 30), "S"),
            (19, "Lark", None, 801.0, date(2015, 1, 2), None),
            (23, "Merle", "EE", 77.0, date(2019, 11, 11), "W"),
        ],
    ),
    "SRC_BERTH": (
        "PORT_CODE string, BERTH_NO int, LENGTH_M double",
        [("AA", 1, 80.0), ("AA", 2, None), ("BB", 1, 60.0), ("CC", 1, 200.0), ("CC", 2, 150.0), ("CC", 3, None), ("EE", 1, 90.0)],
    ),
    "SRC_TUG": (
        "TUG_NO long, CALL_SIGN string, PORT_CODE string, PULL_T double",
        [(7, "Ox", "AA", 30.0), (8, "Mule", "CC", 42.5), (9, "Yak", "CC", 18.0)],
    ),
    "SRC_CALL": (
        "VESSEL_NO long, PORT_CODE string, VISITS int",
        [(7, "AA", 4), (7, "BB", 1), (11, "CC", 9), (13, "CC", 2), (17, "AA", None), (17, "EE", 3), (23, "DD", 1), (23, "EE", 6)],
    ),
    "SRC_OLD_LIGHT": ("LIGHT_ID long, COLOUR string", [(1, "red")]),
}
ADDED = {
    "SRC_PILOTAGE": (
        "VESSEL_NO long, PORT_CODE string, GRADE string",
        [(7, "BB", "I"), (11, "CC", None), (13, "AA", "II"), (19, "EE", "I"), (23, "CC", "III")],
    ),
    "SRC_MOORING": (
        "VESSEL_NO long, PORT_CODE string, BERTH_NO int, SINCE date, LINES int, FEE decimal(9,2), POWERED boolean",
        [
            (7, "AA", 1, date(2023, 3, 1), 4, Decimal("12.50"), True),
            (13, "CC", 1, date(2023, 4, 1), 6, None, None),
            (17, "CC", 3, None, 2, Decimal("3.00"), False),
            (23, "EE", 1, date(2023, 6, 1), None, Decimal("0.00"), True),
        ],
    ),
    "SRC_SIGHTING": (
        "VESSEL_NO long, PORT_CODE string, SEEN timestamp_ntz",
        [(7, "CC", datetime(2023, 1, 1, 6)), (7, "CC", datetime(2023, 1, 1, 6)), (19, None, datetime(2023, 1, 2))],
    ),
    "SRC_TARIFF": ("TARIFF_ID long, LABEL string, RATE double", [(1, "day", 10.0), (2, "week", 55.0)]),
    "SRC_TMP_LOAD": ("LINE int", [(1,)]),
}
NODES = [
    NodeSpec("PORT", "SRC.SRC_PORT", ("PORT_CODE",)),
    NodeSpec("VESSEL", "SRC.SRC_VESSEL", ("VESSEL_NO",)),
    NodeSpec("BERTH", "SRC.SRC_BERTH", ("PORT_CODE", "BERTH_NO")),
    NodeSpec("TUG", "SRC.SRC_TUG", ("TUG_NO",)),
]
FK_EDGES = [
    FkEdgeSpec("HOME_PORT", "SRC.SRC_VESSEL", "VESSEL", ("VESSEL_NO",), "HOME_PORT_CODE", "PORT"),
    FkEdgeSpec("BERTH_IN", "SRC.SRC_BERTH", "BERTH", ("PORT_CODE", "BERTH_NO"), "PORT_CODE", "PORT"),
    FkEdgeSpec("TUG_BASE", "SRC.SRC_TUG", "TUG", ("TUG_NO",), "PORT_CODE", "PORT"),
]
JUNCTIONS = [JunctionEdgeSpec("CALLS_AT", "SRC.SRC_CALL", "VESSEL", "VESSEL_NO", "PORT", "PORT_CODE")]

# table: {column: referenced tables}, after the change.
REFERENCES = {
    "SRC_VESSEL": {"HOME_PORT_CODE": ["SRC_PORT"], "SISTER_VESSEL_NO": ["SRC_VESSEL"]},
    "SRC_BERTH": {"PORT_CODE": ["SRC_PORT"]},
    "SRC_TUG": {"PORT_CODE": ["SRC_PORT"], "ASSIST_NO": ["SRC_VESSEL", "SRC_TUG"]},
    "SRC_PORT": {"CARGO_CODE": ["SRC_CARGO"]},
    "SRC_CALL": {"VESSEL_NO": ["SRC_VESSEL"], "PORT_CODE": ["SRC_PORT"]},
    "SRC_PILOTAGE": {"VESSEL_NO": ["SRC_VESSEL"], "PORT_CODE": ["SRC_PORT"]},
    "SRC_MOORING": {"VESSEL_NO": ["SRC_VESSEL"], "PORT_CODE": ["SRC_BERTH"], "BERTH_NO": ["SRC_BERTH"]},
    "SRC_SIGHTING": {"VESSEL_NO": ["SRC_VESSEL"], "PORT_CODE": ["SRC_PORT"]},
}
KEYS = {
    "SRC_PORT": ["PORT_CODE"],
    "SRC_VESSEL": ["VESSEL_NO"],
    "SRC_BERTH": ["PORT_CODE", "BERTH_NO"],
    "SRC_TUG": ["TUG_NO"],
    "SRC_CALL": ["VESSEL_NO", "PORT_CODE"],
    "SRC_PILOTAGE": ["VESSEL_NO", "PORT_CODE"],
    "SRC_MOORING": ["VESSEL_NO", "PORT_CODE", "BERTH_NO"],
    "SRC_TARIFF": ["TARIFF_ID"],
}


def before(spark):
    return {name: local_rows(spark, rows, schema) for name, (schema, rows) in BEFORE.items()}


def after(spark):
    """FLAG_STATE and the old lights are gone, TONNES is exact, six columns or tables are new."""
    tables = before(spark)
    del tables["SRC_OLD_LIGHT"]
    sisters = {11: 19, 19: 11}
    ships = BEFORE["SRC_VESSEL"][1]
    tables["SRC_VESSEL"] = local_rows(
        spark,
        [(no, name, port, Decimal(str(t)), built, None, sisters.get(no)) for no, name, port, t, built, _ in ships],
        "VESSEL_NO long, VESSEL_NAME string, HOME_PORT_CODE string, TONNES decimal(12,2), BUILT date, SCRAPPED date, SISTER_VESSEL_NO long",
    )
    schema, rows = BEFORE["SRC_TUG"]
    tables["SRC_TUG"] = local_rows(spark, [(*row, 7 if row[0] > 7 else None) for row in rows], f"{schema}, ASSIST_NO long")
    schema, rows = BEFORE["SRC_PORT"]
    tables["SRC_PORT"] = local_rows(spark, [(*row, None) for row in rows], f"{schema}, CARGO_CODE string")
    return tables | {name: local_rows(spark, rows, schema) for name, (schema, rows) in ADDED.items()}


def foreign_keys(spark):
    rows = [("SRC", t, c, "SRC", r) for t, columns in REFERENCES.items() for c, found in columns.items() for r in found]
    return local_rows(
        spark, rows, "table_schema string, table_name string, column_name string, ref_table_schema string, ref_table_name string"
    )


def primary_keys(spark):
    rows = [("SRC", t, c) for t, columns in KEYS.items() for c in columns]
    return local_rows(spark, rows, "table_schema string, table_name string, column_name string")
