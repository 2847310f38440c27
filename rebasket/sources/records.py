"""Scoring records in, predictions out, both as JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from rebasket.schemas import RECORD_TEXT
from rebasket.sources.tables import MissingTable, _unless_absent


def read_records(
    spark: SparkSession, path: str, array: bool = False, identity: Sequence[str] = ()
) -> DataFrame:
    """Scoring records as text columns, to be typed by ``operators.quality``.

    The default is one JSON object per line, which Spark splits across tasks.
    ``array=True`` reads files that hold one JSON list each; such a file is a
    single task, so large inputs of that form should come as many files.
    ``identity`` names further fields to carry along, as text.
    """
    further = [StructField(name, StringType()) for name in identity]
    reader = spark.read.schema(StructType([*further, *RECORD_TEXT.fields])).option("multiLine", array)
    records = _unless_absent(lambda: reader.json(path))
    if records is None:
        raise MissingTable(f"missing scoring records: {path}")
    return records


def write_json(df: DataFrame, path: str, compression: str = "none") -> str:
    """Replace a folder of JSON lines, one object per row."""
    df.write.mode("overwrite").json(path, compression=compression)
    return path
