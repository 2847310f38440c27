"""Checks of a scoring record as column expressions.

The checks look at the type a column already has: a whole-number column needs
no test for fractions, and short expressions are what the JVM compiles well.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, NumericType, StructType

from rebasket.schemas import RECORD_FIELDS, RecordField


def within(value: Column, low: float | None, high: float | None) -> Column:
    """Whether a number keeps its inclusive bounds; Spark sorts NaN above all numbers."""
    inside = F.lit(True)
    if low is not None:
        inside = value >= low
    if high is not None:
        inside = inside & (value <= high)
    elif low is not None:
        inside = inside & ~F.isnan(value)
    return inside


def _number(field: RecordField, kind: DataType) -> Column:
    column = F.col(field.name)
    if isinstance(kind, IntegralType):
        return column
    return column.cast("double") if isinstance(kind, NumericType) else column.try_cast("double")


def _well_typed(field: RecordField, kind: DataType) -> Column | None:
    """Whether a non-null value has the declared type; ``None`` if it always has."""
    if isinstance(kind, IntegralType):
        return None
    number = _number(field, kind)
    if not field.whole:
        return None if isinstance(kind, NumericType) else number.isNotNull()
    # NaN and the infinities differ from themselves or lie outside; text may be null.
    return F.coalesce((F.abs(number) < 2.0**63) & (number == F.floor(number)), F.lit(False))


def _in_bounds(field: RecordField, kind: DataType) -> Column | None:
    if field.low is None and field.high is None:
        return None
    number = _number(field, kind)
    if isinstance(kind, IntegralType):
        return number.between(field.low, field.high) if field.high is not None else number >= field.low
    return within(number, field.low, field.high)


def typed(field: RecordField, kind: DataType) -> Column:
    """The value in its declared type; meant for valid records."""
    number = _number(field, kind)
    if not field.whole:
        return number.cast("double")
    if isinstance(kind, NumericType):
        return number.cast("long")
    return F.coalesce(F.col(field.name).try_cast("long"), number.try_cast("long"))


def _bounds_text(field: RecordField) -> str:
    if field.high is None:
        return f"must be at least {field.low:g}"
    return f"must lie between {field.low:g} and {field.high:g}"


def _error(field: RecordField, kind: DataType) -> Column:
    def report(message: str) -> Column:
        return F.struct(F.lit(field.name).alias("field"), F.lit(message).alias("message"))

    error = F.when(F.col(field.name).isNull(), report("is required"))
    well_typed, in_bounds = _well_typed(field, kind), _in_bounds(field, kind)
    if well_typed is not None:
        noun = "whole number" if field.whole else "number"
        error = error.when(~well_typed, report(f"must be a {noun}"))
    if in_bounds is not None:
        error = error.when(~in_bounds, report(_bounds_text(field)))
    return error


def is_valid(schema: StructType) -> Column:
    """Whether a record has all fields, well typed and within their bounds."""
    checks = []
    for field in RECORD_FIELDS:
        kind = schema[field.name].dataType
        found = [_well_typed(field, kind), _in_bounds(field, kind)]
        checks += [F.col(field.name).isNotNull(), *[c for c in found if c is not None]]
    return F.coalesce(reduce(and_, checks), F.lit(False))


def record_errors(schema: StructType) -> Column:
    """An array of ``{field, message}``, one entry per violated field."""
    errors = [_error(field, schema[field.name].dataType) for field in RECORD_FIELDS]
    return F.array_compact(F.array(*errors))


def _type_error(field: RecordField, kind: DataType) -> Column:
    fits, noun = _well_typed(field, kind), "whole number" if field.whole else "number"
    wrong = F.lit(False) if fits is None else F.col(field.name).isNotNull() & ~fits
    return F.when(wrong, F.struct(F.lit(field.name).alias("field"), F.lit(f"must be a {noun}").alias("message")))


def type_errors(schema: StructType) -> Column:
    """Like ``record_errors`` for values of the wrong kind only; absent values and bounds are no errors."""
    return F.array_compact(F.array(*[_type_error(f, schema[f.name].dataType) for f in RECORD_FIELDS]))
