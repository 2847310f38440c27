"""Scoring of records as they arrive: validate, score, write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rebasket.functions.rules import score_with_rules
from rebasket.functions.validation import is_valid, record_errors, typed
from rebasket.operators.quality import split_valid
from rebasket.schemas import RECORD_FIELDS
from rebasket.sources.files import names_in
from rebasket.sources.tables import read_table


def read_stream(
    spark: SparkSession, folder: str, schema: StructType, file_format: str = "parquet",
    files_per_trigger: int = 1000,
) -> DataFrame:
    """Records from the files of a folder, a bounded number of files per batch."""
    return (
        spark.readStream.schema(schema)
        .format(file_format)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(folder)
    )


def score_stream(
    records: DataFrame,
    sink: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame] = score_with_rules,
    quarantine: bool = False,
) -> StreamingQuery:
    """Score what has arrived, then stop; start again to go on from there.

    Each record is judged on its own, so no state is kept.  The file sink and
    the checkpoint together write every record exactly once.  With
    ``quarantine`` the rejected records are written instead of the scores.
    """
    good, bad = split_valid(records)
    return (
        (bad if quarantine else score(good))
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def routed_records(records: DataFrame, score: Callable[[DataFrame], DataFrame] = score_with_rules) -> DataFrame:
    """All records in one pass: ``accepted`` ones typed and scored, the others with ``errors`` and ``record``.

    ``record`` is the rejected record as JSON text; its typed fields and its
    scores are null.
    """
    kinds = records.schema
    checked = records.withColumns({"accepted": is_valid(kinds), "errors": record_errors(kinds)})
    accepted = F.col("accepted")
    kept = checked.withColumn("record", F.when(~accepted, F.to_json(F.struct(*records.columns))))
    ready = kept.withColumns(
        {f.name: F.when(accepted, typed(f, kinds[f.name].dataType)) for f in RECORD_FIELDS}
    )
    scored = score(ready)
    made = [c for c in scored.columns if c not in ready.columns]
    return scored.withColumns({c: F.when(accepted, F.col(c)) for c in made})


def write_batch(routed: DataFrame, sink: str, batch: int) -> bool:
    """Writes both kinds of records of a batch in one job, unless the batch is there already."""
    path = f"{sink}/batch={batch}"
    if "_SUCCESS" in names_in(routed.sparkSession, path):
        return False
    routed.write.mode("overwrite").partitionBy("accepted").parquet(path)
    return True


def route_stream(
    records: DataFrame, sink: str, checkpoint: str, score: Callable[[DataFrame], DataFrame] = score_with_rules
) -> StreamingQuery:
    """Score what has arrived and set the rest aside, reading the source once, then stop.

    A batch is written below its number and counts once it is complete, so one
    that is repeated after a failure, or replayed, changes nothing.
    """
    return (
        routed_records(records, score)
        .writeStream.foreachBatch(lambda batch, number: write_batch(batch, sink, number) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_routed(spark: SparkSession, sink: str) -> tuple[DataFrame, DataFrame]:
    """The scores, and the records set aside with their errors, of all batches."""
    routed = read_table(spark, sink)
    aside = routed.filter(~F.col("accepted").cast("boolean"))
    scores = routed.filter(F.col("accepted").cast("boolean")).drop("errors", "record", "accepted", "batch")
    return scores, aside.drop("accepted", "batch")
