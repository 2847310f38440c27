"""An inverted index of texts, written once and searched by any number of question sets.

The index is two tables.  ``terms`` has a row per term: in how many documents it
is, its weight, and ``cut``, the smallest contribution in its head.  ``postings``
has a row per term and document with the ``impact``, the share of the document's
vector that the term makes up; the ``HEAD`` postings of a term with the highest
impact lie in a partition of their own, and rows are in impact order per term.

A search reads the heads first: the k-th best sum of head contributions is a
score that the answer cannot fall below.  Then the postings of the terms that are
asked for are dealt by document, so that whole scores are summed where a document
lies.  Neither a pair of question and document nor a contribution to it is
shuffled, and pairs below the floor are not ranked.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rebasket.operators.similarity import TERM, term_counts
from rebasket.session import hand_over
from rebasket.sources.tables import read_table

HEAD = 64
SHARDS = 64
ROUNDING = 1e-8  # scores are compared after rounding to nine digits
SENT_ROWS = 100_000  # of counted terms at once


@dataclass(frozen=True)
class TextIndex:
    """Where an index lies."""

    path: str

    def terms(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, f"{self.path}/terms")

    def postings(self, spark: SparkSession) -> DataFrame:
        kind = self.terms(spark).schema["cut_id"].dataType.simpleString()
        columns = f"term string, id {kind}, impact double, head boolean, shard int"
        return spark.read.schema(columns).parquet(f"{self.path}/postings")


def _shard(term: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(shards)).cast("int")


def _counted(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``term_counts`` of ``documents``, where an id stands on one row without shuffling anything."""
    texts = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    repeated = hand_over(texts.groupBy("id").count().filter("count > 1").select("id"), "index-repeated")
    repeated = repeated.read(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
        term = re.compile(TERM)
        for batch in batches:
            rows, terms, counts = [], [], []
            for row, text in enumerate(batch.column("text")):
                found = Counter(term.findall((text.as_py() or b"").decode("utf-8", "replace").translate(lower)))
                rows += [row] * len(found)
                terms += found.keys()
                counts += found.values()
                if len(rows) >= SENT_ROWS or row + 1 == batch.num_rows:
                    ids = batch.column("id").take(pa.array(rows, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(terms, pa.string()), pa.array(counts, pa.int64())], ["id", "term", "n"]
                    )
                    rows, terms, counts = [], [], []

    kind = texts.schema["id"].dataType.simpleString()
    single = texts.filter("id is not null").join(repeated, "id", "left_anti")
    single = single.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"id {kind}, term string, n long"
    )
    others = texts.join(repeated, "id", "left_semi").unionByName(texts.filter("id is null"))
    return single.unionByName(term_counts(others, "id"))


def build_text_index(
    documents: DataFrame, path: str, id_column: str, text_column: str = "text", head: int = HEAD, shards: int = SHARDS
) -> TextIndex:
    """Writes the index of ``documents`` (unique ids) below ``path``.

    A term weighs its count times ln((documents + 1) / (documents with it + 1)).
    Documents without a term of any weight are in no posting.  Terms are
    counted where a text lies.  Only terms of more than ``head`` documents are
    ranked, with partial results before anything is shuffled; the postings of a
    frequent term are dealt over tasks by document.
    """
    spark = documents.sparkSession
    counts = hand_over(_counted(documents, id_column, text_column), "index-counts").read(spark)
    total = documents.count()
    rarity = F.log((F.lit(total) + 1.0) / (F.col("holding") + 1.0))
    terms = counts.groupBy("term").agg(F.count("*").alias("holding"), F.count("id").alias("named"))
    terms = terms.withColumn("rarity", rarity).filter("rarity > 0 and named > 0").drop("named")
    terms = hand_over(terms, "index-terms").read(spark)
    weighed = counts.filter("id is not null").join(terms, "term").withColumn("w", F.col("n") * F.col("rarity"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    impacts = weighed.select("id", "term", "w").select("term", "id", (F.col("w") / length).alias("impact"))
    impacts = hand_over(impacts, "index-impacts").read(spark)
    best = Window.partitionBy("term").orderBy(F.desc("impact"), "id")
    common = hand_over(terms.filter(F.col("holding") > head).select("term"), "index-common").read(spark)
    # A small rank limit: each map task keeps only its own best rows per term.
    heads = (
        impacts.join(common, "term", "left_semi")
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= head)
    )
    cuts = heads.groupBy("term").agg(
        F.min("impact").alias("cut"), F.max_by("id", "place").alias("cut_id"), F.count("*").alias("in_head")
    )
    known = hand_over(cuts, "index-cuts").read(spark)
    # The other terms are in their heads whole.
    described = terms.join(known, "term", "left").withColumns(
        {
            "cut": F.coalesce("cut", F.lit(0.0)),
            "in_head": F.coalesce("in_head", "holding"),
            "shard": _shard("term", shards),
            "documents": F.lit(total),
        }
    )
    described.write.mode("overwrite").parquet(f"{path}/terms")
    in_head = (
        F.col("cut").isNull()
        | (F.col("impact") > F.col("cut"))
        | ((F.col("impact") == F.col("cut")) & (F.col("id") <= F.col("cut_id")))
    )
    (
        impacts.join(known.drop("in_head"), "term", "left")
        .select("term", "id", "impact", in_head.alias("head"), _shard("term", shards).alias("shard"))
        .repartition("head", "shard", F.pmod(F.xxhash64("id"), F.lit(8)))
        .sortWithinPartitions("head", "shard", "term", F.desc("impact"))
        .write.mode("overwrite")
        .partitionBy("head", "shard")
        .parquet(f"{path}/postings")
    )
    return TextIndex(path)


def _asked(index: TextIndex, questions: DataFrame, question_id: str, text_column: str) -> DataFrame:
    """(query_id, term, shard, v): the terms of each question that the index has.

    ``v`` is the term's share of the question's vector, terms the index lacks
    counted in.
    """
    spark = questions.sparkSession
    known = index.terms(spark)
    first = known.select("documents").take(1)
    total = first[0]["documents"] if first else 0
    counts = term_counts(questions, question_id, text_column)
    rarity = F.coalesce(F.col("rarity"), F.log(F.lit(total) + 1.0))
    found = counts.join(known, "term", "left").withColumn("w", F.col("n") * rarity).filter("w > 0")
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    shares = found.withColumn("v", F.col("w") / length).filter("cut IS NOT NULL")
    return shares.select(F.col("id").alias("query_id"), "term", "shard", "v")


def _scores(asked: DataFrame, postings: DataFrame) -> DataFrame:
    """Sums of the contributions of ``postings`` to (query_id, doc_id)."""
    pairs = asked.join(postings, ["shard", "term"])
    return pairs.groupBy("query_id", F.col("id").alias("doc_id")).agg(F.sum(F.col("v") * F.col("impact")).alias("dot"))


def search_index(
    index: TextIndex, questions: DataFrame, question_id: str, k: int = 4, digits: int = 9, text_column: str = "text"
) -> DataFrame:
    """(query_id, doc_id, rank, score): the ``k`` documents closest to each question, exactly.

    The score is the cosine of the weights, rounded to ``digits``; ties go to the
    smaller id, and documents without any weighty term of the question are no
    answer.  Questions without terms, null texts and empty tables give no rows.
    """
    spark = questions.sparkSession
    asked = hand_over(_asked(index, questions, question_id, text_column), "asked").read(spark)
    postings = index.postings(spark)
    in_heads = _scores(asked, postings.filter("head").drop("head"))
    best = Window.partitionBy("query_id").orderBy(F.desc("dot"), "doc_id")
    kth = (
        in_heads.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
        .groupBy("query_id")
        .agg(F.when(F.count("*") == k, F.min("dot")).otherwise(0.0).alias("floor"))
    )
    kth = hand_over(kth, "floors").read(spark)
    held = postings.drop("head").join(asked.select("shard", "term").distinct(), ["shard", "term"], "left_semi")
    whole = _scores(asked, held.repartition("id")).join(kth, "query_id", "left")
    scores = whole.filter(F.col("dot") + ROUNDING >= F.coalesce("floor", F.lit(0.0)))
    scored = scores.select("query_id", "doc_id", F.round("dot", digits).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "doc_id", F.col("rank").cast("int").alias("rank"), "score")
