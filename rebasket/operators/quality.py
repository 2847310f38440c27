"""Validation of scoring records: typing, error report, quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.functions.validation import is_valid, record_errors, type_errors, typed
from rebasket.schemas import RECORD_FIELDS


class InvalidRecords(ValueError):
    """A strict check met a bad record or no record at all."""


def validate(records: DataFrame) -> DataFrame:
    """Add ``errors``: an array of ``{field, message}``, empty for a valid record."""
    return records.withColumn("errors", record_errors(records.schema))


def as_declared(records: DataFrame) -> DataFrame:
    """Cast the record fields to their declared types; call it on valid records."""
    kinds = records.schema
    return records.withColumns(
        {field.name: typed(field, kinds[field.name].dataType) for field in RECORD_FIELDS}
    )


def valid_records(records: DataFrame) -> DataFrame:
    return records.filter(is_valid(records.schema))


def invalid_records(records: DataFrame) -> DataFrame:
    return records.filter(~is_valid(records.schema))


def violations(records: DataFrame, identity: Sequence[str]) -> DataFrame:
    """One row per violated field, with the identity of its record."""
    errors = F.explode(record_errors(records.schema)).alias("e")
    return records.select(*identity, errors).select(*identity, "e.field", "e.message")


def split_valid(records: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The valid records in their declared types, and the others with ``errors``.

    ``strict=True`` raises if any record is bad or there is no record at all.
    """
    bad = validate(invalid_records(records))
    if strict:
        example = bad.select("errors").take(1)
        if example:
            raise InvalidRecords(f"invalid record: {example[0]['errors']}")
        if not records.take(1):
            raise InvalidRecords("no records")
    return as_declared(valid_records(records)), bad


def split_scorable(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records a model can score, in their declared types, and the others with ``errors``.

    A model fills absent values and takes any category, so only a value of the
    wrong kind keeps a record out.
    """
    checked = records.withColumn("errors", type_errors(records.schema))
    return as_declared(checked.filter("size(errors) = 0").drop("errors")), checked.filter("size(errors) > 0")
