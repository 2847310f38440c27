"""Declared schemas of the input tables and of the scoring record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_INT, _LONG, _DOUBLE, _TEXT = IntegerType(), LongType(), DoubleType(), StringType()

_LINES = _struct(
    order_id=_LONG, product_id=_LONG, add_to_cart_order=_INT, reordered=_INT
)

# Ids are longs: at scale an order or line id outgrows 32 bits.
TABLES: dict[str, StructType] = {
    "orders": _struct(
        order_id=_LONG,
        user_id=_LONG,
        eval_set=_TEXT,
        order_number=_INT,
        order_dow=_INT,
        order_hour_of_day=_INT,
        days_since_prior_order=_DOUBLE,
    ),
    "order_products_prior": _LINES,
    "order_products_train": _LINES,
    "products": _struct(
        product_id=_LONG, product_name=_TEXT, aisle_id=_INT, department_id=_INT
    ),
    "aisles": _struct(aisle_id=_INT, aisle=_TEXT),
    "departments": _struct(department_id=_INT, department=_TEXT),
}


@dataclass(frozen=True)
class RecordField:
    """A required field of a scoring record and its inclusive bounds."""

    name: str
    whole: bool
    low: float | None = None
    high: float | None = None


# --- fixed values: the scoring record ---
RECORD_FIELDS = (
    RecordField("order_number", whole=True),
    RecordField("order_dow", whole=True, low=0, high=6),
    RecordField("order_hour_of_day", whole=True, low=0, high=23),
    RecordField("days_since_prior_order", whole=False, low=0),
    RecordField("add_to_cart_order", whole=True, low=1),
    RecordField("user_order_count", whole=True, low=0),
    RecordField("product_order_count", whole=True, low=0),
    RecordField("product_reorder_rate", whole=False, low=0, high=1),
    RecordField("aisle_id", whole=True, low=1),
    RecordField("department_id", whole=True, low=1),
)
# --- end of fixed values ---

RECORD = StructType(
    [StructField(f.name, LongType() if f.whole else DoubleType()) for f in RECORD_FIELDS]
)

# JSON is read as text first, so that "3", 3 and 3.0 are all the whole number 3
# and 3.5 is reported as a violation instead of silently becoming null.
RECORD_TEXT = StructType([StructField(f.name, StringType()) for f in RECORD_FIELDS])
