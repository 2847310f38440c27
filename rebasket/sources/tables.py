"""CSV and Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rebasket.schemas import TABLES

# --- fixed values: raw file name -> table name ---
RAW_FILES = {
    "orders.csv": "orders",
    "order_products__prior.csv": "order_products_prior",
    "order_products__train.csv": "order_products_train",
    "products.csv": "products",
    "aisles.csv": "aisles",
    "departments.csv": "departments",
}
RAW_SUBFOLDERS = ("", "archive")
# --- end of fixed values ---


class MissingTable(FileNotFoundError):
    """A table that a job needs is not there."""


def _unless_absent(load: Callable[[], DataFrame]) -> DataFrame | None:
    # Spark resolves the path on any Hadoop file system when it analyses the
    # read, so asking for the data is the portable way to ask whether it exists.
    try:
        return load()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """A CSV file with a header row, or ``None`` if there is no such file.

    With a schema, columns are matched by header name and cast (a value that
    does not fit stops the job); columns the schema does not list stay text.
    Without one, types are inferred, which costs an extra pass over the file.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return _unless_absent(lambda: reader.option("inferSchema", True).csv(path))
    text = _unless_absent(lambda: reader.csv(path))
    if text is None:
        return None
    kinds = {field.name: field.dataType for field in schema}
    return text.select(
        [F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in text.columns]
    )


_DAMAGED = "_damaged_line"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame] | None:
    """The good rows of a CSV file with a header row, and its damaged lines as (file, line).

    A line is damaged if it has more or fewer fields than the header, or a value
    that does not fit its column.  ``line`` is its text.  Every line but the header
    and empty ones is in exactly one of both.  ``None`` if there is no such file.
    """
    header = _unless_absent(lambda: spark.read.option("header", True).csv(path))
    if header is None:
        return None
    lines = spark.read.text(path)
    first = lines.first()
    kinds = {field.name: field.dataType.simpleString() for field in schema}
    columns = ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in [*header.columns, _DAMAGED])
    # Lines are parsed whole, whichever columns are read later: damage in any of them counts.
    row = F.from_csv("value", columns, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _DAMAGED})
    parsed = lines.filter(F.col("value") != (first["value"] if first else "")).filter("trim(value) <> ''")
    parsed = parsed.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), row.alias("row"))
    damaged = F.col(f"row.{_DAMAGED}").isNotNull()
    return parsed.filter(~damaged).select("row.*").drop(_DAMAGED), parsed.filter(damaged).select("file", "line")


def read_raw_checked(spark: SparkSession, raw: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The good rows of the raw tables that are present, and the damaged lines of all as (table, file, line)."""
    found, damaged = {}, []
    for file_name, table in RAW_FILES.items():
        for root in search_roots(raw):
            both = read_csv_checked(spark, f"{root}/{file_name}", TABLES[table])
            if both is not None:
                found[table] = both[0]
                damaged.append(both[1].select(F.lit(table).alias("table"), "file", "line"))
                break
    if not found:
        raise MissingTable(f"no raw CSV file in any of {search_roots(raw)}")
    return found, reduce(DataFrame.unionByName, damaged)


def search_roots(raw: str) -> tuple[str, ...]:
    """The folders a raw file may lie in, in order of preference."""
    base = raw.rstrip("/")
    return tuple(f"{base}/{sub}".rstrip("/") for sub in RAW_SUBFOLDERS)


def read_first(
    spark: SparkSession, roots: Iterable[str], file_name: str, schema: StructType | None = None
) -> DataFrame | None:
    """The file from the first root that holds it."""
    for root in roots:
        found = read_csv(spark, f"{root}/{file_name}", schema)
        if found is not None:
            return found
    return None


def read_raw_tables(
    spark: SparkSession, raw: str, infer: bool = False
) -> dict[str, DataFrame]:
    """The raw tables that are present; raises only when none is."""
    found = {}
    for file_name, table in RAW_FILES.items():
        frame = read_first(
            spark, search_roots(raw), file_name, None if infer else TABLES[table]
        )
        if frame is not None:
            found[table] = frame
    if not found:
        raise MissingTable(f"no raw CSV file in any of {search_roots(raw)}")
    return found


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; raises ``MissingTable`` when it is absent."""
    table = _unless_absent(lambda: spark.read.parquet(path))
    if table is None:
        raise MissingTable(f"missing table: {path}")
    return table


def write_table(df: DataFrame, path: str) -> str:
    """Replace a Parquet table."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int = 200) -> DataFrame:
    """Stores ``df`` at ``path`` as the catalog table ``name``, dealt by ``key`` into sorted buckets.

    Grouping by the key and joining back on it then read the same layout and
    shuffle nothing.  The rows are dealt before they are written, so a bucket is
    one file.  ``buckets`` should be as many as a shuffle of this table would have.
    """
    dealt = df.repartition(buckets, key)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> str:
    """Replace a CSV table; each part file carries the header."""
    df.write.mode("overwrite").option("header", True).csv(path, compression=compression)
    return path
