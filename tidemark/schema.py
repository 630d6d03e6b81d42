"""Target schemas (name, type) for the flat result layer.

The reference conforms one nested instrument-log record to a fixed list of
typed columns. Our test inputs are the TPC-H-style tables, nested as
order envelope (``module``) + customer (``customerInfo``) + line items
(``data``), so the spec below lists those leaves with the types the flat
layer stores. Specs are data: ``conform`` turns any such list into one
projection, so a 129-column spec needs no 129 hand-written casts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


# Envelope struct (``module.*``): one per landed record.
MODULE_SPEC = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]

# Second envelope struct (``customerInfo.*``).
CUSTOMER_SPEC = [
    ("c_custkey", "bigint"),
    ("c_name", "string"),
    ("c_nationkey", "bigint"),
    ("c_acctbal", "double"),
    ("c_mktsegment", "string"),
]

# Array elements (``data.*``): one flat row per element.
RESULT_ITEM_SPEC = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "bigint"),
    ("l_quantity", "bigint"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]

LINEAGE_SPEC = [("file_path", "string")]

RESULT_SPEC = MODULE_SPEC + CUSTOMER_SPEC + RESULT_ITEM_SPEC + LINEAGE_SPEC

# Event time of a flat row: its calendar day is the output partition.
EVENT_TIME_COLUMN = "l_shipdate"
PARTITION_COLUMN = "transaction_date"

# Business key of a flat result row (plus the partition column).
RESULT_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", PARTITION_COLUMN]



@dataclass(frozen=True)
class RecordShape:
    """What a nested record holds and what its flat rows become.

    ``envelope`` structs and ``keep`` top-level columns repeat on every element
    of ``array_col``; ``spec`` lists the flat columns with their types;
    ``event_time`` gives the day ``part_col``; ``keys`` (with ``part_col``) say
    which rows are the same. ``on_collision``: error | prefix | first;
    ``missing``: error | null; ``id_mode``: content | random; ``unit`` of
    numeric times: s | ms | us.
    """

    spec: Sequence[tuple[str, str]]
    keys: Sequence[str]
    event_time: str
    part_col: str = PARTITION_COLUMN
    envelope: Sequence[str] = ("module", "customerInfo")
    keep: Sequence[str] = ()
    array_col: str = "data"
    on_collision: str = "error"
    missing: str = "error"
    id_mode: str = "content"
    unit: str = "s"


RESULT_SHAPE = RecordShape(RESULT_SPEC, RESULT_KEYS, EVENT_TIME_COLUMN)

# Spec for the events table when it is conformed to the stored layer.
EVENT_SPEC = [
    ("event_id", "bigint"),
    ("ts", "timestamp_ntz"),
    ("user_id", "bigint"),
    ("event_type", "string"),
    ("value", "double"),
    ("props", "string"),
]
