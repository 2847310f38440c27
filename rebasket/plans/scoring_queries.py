"""Queries over validation, rule scores, metrics, drift, streaming and retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.functions.rules import (
    BUSINESS_NOTE,
    DEFAULT_DAYS,
    DEFAULT_ORDERS,
    DEFAULT_POSITION,
    DEFAULT_RATE,
    GENERIC_ANSWER,
    SIGNALS,
    add_signals,
    class_label,
    explanation,
    or_default,
    score_with_rules,
)
from rebasket.functions.validation import within
from rebasket.operators.drift import drift_history, flag_drift
from rebasket.operators.quality import split_valid, validate, violations
from rebasket.operators.similarity import centroids, text_top_k, top_k_similar
from rebasket.operators.statistics import accuracy, roc_auc
from rebasket.operators.text_index import search_index
from rebasket.operators.vector_index import probes_for, search_cells
from rebasket.plans.catalog import RECORD_KEY, Workbench, query
from rebasket.schemas import RECORD_FIELDS
from rebasket.session import spread_rows
from rebasket.sources.runs import latest_metrics
from rebasket.streaming.scoring import read_routed, read_stream, route_stream, score_stream

_KEY = "user_id, order_number, product_id"


# --- validation ---


@query(
    f"""SELECT {_KEY}, CAST(count(v.field) AS INTEGER) AS errors, count(v.field) = 0 AS valid
    FROM d_rough LEFT JOIN d_violations v USING ({_KEY}) GROUP BY {_KEY}"""
)
def validate_records(bench: Workbench) -> DataFrame:
    count = F.size("errors")
    return validate(bench.rough_records).select(
        *RECORD_KEY, count.alias("errors"), (count == 0).alias("valid")
    )


@query(f"SELECT {_KEY}, field FROM d_violations")
def validation_report(bench: Workbench) -> DataFrame:
    return violations(bench.rough_records, RECORD_KEY).select(*RECORD_KEY, "field")


@query(
    f"""SELECT count(*) FILTER (WHERE valid) AS valid,
      count(*) FILTER (WHERE NOT valid) AS quarantined
    FROM (SELECT count(v.field) = 0 AS valid
      FROM d_rough LEFT JOIN d_violations v USING ({_KEY}) GROUP BY {_KEY})"""
)
def valid_quarantine_counts(bench: Workbench) -> DataFrame:
    good, bad = split_valid(bench.rough_records)
    return (
        good.agg(F.count("*").alias("valid"), F.lit(0).cast("long").alias("quarantined"))
        .unionAll(bad.agg(F.lit(0).cast("long"), F.count("*")))
        .agg(F.sum("valid").alias("valid"), F.sum("quarantined").alias("quarantined"))
    )


@query(
    f"""SELECT {_KEY}, order_dow BETWEEN 0 AND 6 AS order_dow_ok,
      order_hour_of_day BETWEEN 0 AND 23 AS order_hour_of_day_ok,
      days_since_prior_order >= 0 AS days_since_prior_order_ok,
      add_to_cart_order >= 1 AS add_to_cart_order_ok, user_order_count >= 0 AS user_order_count_ok,
      product_order_count >= 0 AS product_order_count_ok,
      product_reorder_rate BETWEEN 0 AND 1 AS product_reorder_rate_ok,
      aisle_id >= 1 AS aisle_id_ok, department_id >= 1 AS department_id_ok FROM d_rough"""
)
def range_predicates(bench: Workbench) -> DataFrame:
    bounded = [f for f in RECORD_FIELDS if f.low is not None]
    return bench.rough_records.select(
        *RECORD_KEY,
        *[within(F.col(f.name), f.low, f.high).alias(f"{f.name}_ok") for f in bounded],
    )


# --- rules ---


@query(
    f"""SELECT {_KEY}, product_reorder_rate AS rate, CAST(user_order_count AS DOUBLE) AS orders,
      CASE WHEN days_since_prior_order = 0 THEN 999.0E0 ELSE days_since_prior_order END AS days,
      CAST(add_to_cart_order AS DOUBLE) AS position FROM d_features"""
)
def falsy_defaults(bench: Workbench) -> DataFrame:
    return bench.features.select(
        *RECORD_KEY,
        or_default(F.col("product_reorder_rate"), DEFAULT_RATE).alias("rate"),
        or_default(F.col("user_order_count"), DEFAULT_ORDERS).alias("orders"),
        or_default(F.col("days_since_prior_order"), DEFAULT_DAYS).alias("days"),
        or_default(F.col("add_to_cart_order"), DEFAULT_POSITION).alias("position"),
    )


@query(f"SELECT {_KEY}, {', '.join(SIGNALS)} FROM d_signals")
def rule_signals(bench: Workbench) -> DataFrame:
    return add_signals(bench.features).select(*RECORD_KEY, *SIGNALS)


@query(f"SELECT {_KEY}, prediction FROM d_scored")
def rule_score(bench: Workbench) -> DataFrame:
    return score_with_rules(bench.features).select(*RECORD_KEY, "prediction")


@query(f"SELECT {_KEY}, reason FROM d_results")
def rule_reasons(bench: Workbench) -> DataFrame:
    return score_with_rules(bench.features).select(*RECORD_KEY, "reason")


@query(f"SELECT {_KEY}, confidence_hint FROM d_results")
def rule_confidence_hint(bench: Workbench) -> DataFrame:
    return score_with_rules(bench.features).select(*RECORD_KEY, "confidence_hint")


@query(
    f"""SELECT {_KEY}, CASE reordered WHEN 1 THEN 'likely_reordered'
      ELSE 'not_likely_reordered' END AS label FROM d_features"""
)
def class_label_text(bench: Workbench) -> DataFrame:
    return bench.features.select(*RECORD_KEY, class_label(F.col("reordered")).alias("label"))


@query(
    f"""SELECT {_KEY}, CASE WHEN order_number > 1 THEN
      'Question: Why product ' || product_id || '?' || chr(10)
      || 'Prediction: ' || label || ' (' || prediction || ').' || chr(10)
      || 'Reason: ' || reason || '.' || chr(10)
      || 'Business interpretation: this helps a retailer decide which products to recommend, '
      || 'prioritize, or monitor for reorder behavior. In a production version, this answer '
      || 'can be generated with RAG over feature definitions, MLflow metrics, model cards, '
      || 'and monitoring reports.'
      ELSE 'This project predicts basket-style product reorders using a modular ML pipeline. '
      || 'GenAI is useful as an assistant layer: it can explain predictions, summarize '
      || 'monitoring results, answer questions about features, and help a business user '
      || 'understand why retraining may be needed.' END AS answer FROM d_results"""
)
def explanation_text(bench: Workbench) -> DataFrame:
    """A question per row; first orders stand for questions without context."""
    question = F.concat(F.lit("Why product "), F.col("product_id").cast("string"), F.lit("?"))
    answer = explanation(question, F.col("order_number") > 1)
    return score_with_rules(bench.features).select(*RECORD_KEY, answer.alias("answer"))


# --- metrics and drift ---


@query(
    """SELECT avg(CASE WHEN prediction = reordered THEN 1.0E0 ELSE 0.0E0 END) AS accuracy
    FROM d_scored"""
)
def accuracy_rule_scorer(bench: Workbench) -> DataFrame:
    return accuracy(score_with_rules(bench.features), "prediction", "reordered")


_AUC_SQL = """, by_score AS (
      SELECT product_reorder_rate AS s, count(*) FILTER (WHERE reordered = 1) AS p,
        count(*) FILTER (WHERE reordered <> 1) AS q FROM d_features GROUP BY 1
    ), below AS (
      SELECT p, q, coalesce(sum(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING), 0) AS lower FROM by_score
    )
    SELECT round(sum(p * (lower + 0.5E0 * q)) / (CAST(sum(p) AS DOUBLE) * sum(q)), 9)
      AS roc_auc FROM below"""


@query(_AUC_SQL)
def roc_auc_reorder_rate(bench: Workbench) -> DataFrame:
    area = roc_auc(bench.features, "product_reorder_rate", "reordered")
    return area.select(F.round("roc_auc", 9).alias("roc_auc"))


@query(
    """, by_score AS (
      SELECT l_extendedprice * 1.0E6 AS s, count(*) FILTER (WHERE l_quantity > 25) AS p,
        count(*) FILTER (WHERE l_quantity <= 25) AS q FROM lineitem GROUP BY 1
    ), below AS (
      SELECT p, q, coalesce(sum(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING), 0) AS lower FROM by_score
    )
    SELECT round(sum(p * (lower + 0.5E0 * q)) / (CAST(sum(p) AS DOUBLE) * sum(q)), 9)
      AS roc_auc FROM below"""
)
def roc_auc_unbounded_score(bench: Workbench) -> DataFrame:
    """Scores in the millions and all different: a price as a score for a large quantity."""
    lines = bench.raw("lineitem").select(
        (F.col("l_extendedprice") * 1e6).alias("s"), (F.col("l_quantity") > 25).cast("int").alias("y")
    )
    return roc_auc(lines, "s", "y").select(F.round("roc_auc", 9).alias("roc_auc"))


def _metrics_by(bench: Workbench, column: str) -> DataFrame:
    """Accuracy and positive rate of the rule scorer, one run per value of a column."""
    hit = (F.col("prediction") == F.col("reordered")).cast("double")
    runs = (
        score_with_rules(bench.features)
        .groupBy(F.col(column).alias("ts"))
        .agg(F.avg(hit).alias("accuracy"), F.avg("prediction").alias("positive_rate"))
        .withColumn("run_id", F.concat(F.lit("run-"), F.col("ts").cast("string")))
    )
    return runs.unpivot(["run_id", "ts"], ["accuracy", "positive_rate"], "metric", "value")


@query(
    """SELECT 'run-' || order_dow AS run_id, value, value < 0.5E0 AS drift,
      CASE WHEN value < 0.5E0 THEN 'retraining recommended' ELSE 'model stable' END AS status
    FROM (SELECT order_dow, avg(CASE WHEN prediction = reordered THEN 1.0E0 ELSE 0.0E0 END)
      AS value FROM d_scored GROUP BY order_dow)"""
)
def drift_status(bench: Workbench) -> DataFrame:
    """One run per weekday, held against a threshold that some weekdays miss."""
    flagged = flag_drift(_metrics_by(bench, "order_dow"), "accuracy", 0.5)
    return flagged.select("run_id", "value", "drift", "status")


@query(
    """, runs AS (
      SELECT order_number AS ts, avg(CASE WHEN prediction = reordered THEN 1.0E0 ELSE 0.0E0 END) AS value
      FROM d_scored GROUP BY order_number
    ), flagged AS (
      SELECT *, value < 0.5E0 AS drift, value - lag(value) OVER (ORDER BY ts) AS change FROM runs
    ), streaks AS (
      SELECT *, count(*) FILTER (WHERE NOT drift) OVER (ORDER BY ts) AS sound FROM flagged
    ), counted AS (
      SELECT *, count(*) FILTER (WHERE drift) OVER (PARTITION BY sound ORDER BY ts) AS breaches FROM streaks
    )
    SELECT 'run-' || ts AS run_id, value, change, drift, breaches, breaches >= 2 AS retrain FROM counted"""
)
def drift_over_runs(bench: Workbench) -> DataFrame:
    """One run per order number: breaches in a row, and whether two of them ask for a training."""
    found = drift_history(_metrics_by(bench, "order_number"), "accuracy", 0.5, patience=2)
    return found.drop("ts")


@query(
    """, last AS (SELECT * FROM d_scored WHERE order_number = (SELECT max(order_number)
      FROM d_scored))
    SELECT 'accuracy' AS metric,
      avg(CASE WHEN prediction = reordered THEN 1.0E0 ELSE 0.0E0 END) AS value FROM last
    UNION ALL SELECT 'positive_rate', avg(prediction) FROM last"""
)
def latest_run_metrics(bench: Workbench) -> DataFrame:
    """The metrics of the newest run of a history, here one run per order number."""
    return latest_metrics(_metrics_by(bench, "order_number"))


# --- streaming ---


_STREAM_SQL = f"""SELECT r.*, v.field IS NULL AS accepted,
      CASE WHEN v.field IS NULL THEN CAST(coalesce(add_to_cart_order <= 5, false)
        OR (product_reorder_rate >= 0.5E0 AND user_order_count >= 5 AND days > 0 AND days <= 14)
        AS INTEGER) END AS prediction
    FROM (SELECT {_KEY} FROM d_rough) r
    JOIN (SELECT {_KEY}, add_to_cart_order, product_reorder_rate, user_order_count,
      days_since_prior_order AS days FROM d_rough) d USING ({_KEY})
    LEFT JOIN (SELECT {_KEY}, min(field) AS field FROM d_violations GROUP BY ALL) v
      USING ({_KEY})"""


@query(_STREAM_SQL)
def streaming_rule_score(bench: Workbench) -> DataFrame:
    """Rough records as a stream: the scores of the good ones, and those set aside."""
    source = bench.scratch("stream-records")
    bench.rough_records.write.parquet(source)
    schema = bench.rough_records.schema
    sinks = []
    for quarantine in (False, True):
        records = read_stream(bench.spark, source, schema)
        sinks.append(bench.scratch("stream-scores"))
        score_stream(
            records, sinks[-1], bench.scratch("stream-checkpoint"), quarantine=quarantine
        ).awaitTermination()
    scores, aside = (bench.spark.read.parquet(sink) for sink in sinks)
    kept = F.col("order_number").cast("int").alias("order_number")
    return scores.select(
        "user_id", kept, "product_id", F.lit(True).alias("accepted"), "prediction"
    ).unionAll(aside.select("user_id", kept, "product_id", F.lit(False), F.lit(None).cast("int")))


@query(_STREAM_SQL)
def streaming_routed_score(bench: Workbench) -> DataFrame:
    """The same in one stream that reads its source once; a replayed batch is not written again."""
    source, sink = bench.scratch("stream-records"), bench.scratch("stream-routed")
    bench.rough_records.write.parquet(source)
    for checkpoint in ("stream-checkpoint", "stream-replay"):  # the second run repeats batch 0
        records = read_stream(bench.spark, source, bench.rough_records.schema)
        route_stream(records, sink, bench.scratch(checkpoint)).awaitTermination()
    scores, aside = read_routed(bench.spark, sink)
    kept = F.col("order_number").cast("int").alias("order_number")
    own = F.get_json_object("record", "$.order_number").cast("int")
    return scores.select("user_id", kept, "product_id", F.lit(True).alias("accepted"), "prediction").unionAll(
        aside.select("user_id", own, "product_id", F.lit(False), F.lit(None).cast("int"))
    )


# --- retrieval ---

_WIDTH = 64
_MEANS = ", ".join(f"round(avg(CAST(embedding[{i}] AS DOUBLE)), 6)" for i in range(1, _WIDTH + 1))


@query(
    f""", centre AS (
      SELECT label AS query_id, [{_MEANS}] AS vector FROM embeddings GROUP BY label
    ), ranked AS (
      SELECT query_id, vec_id AS doc_id, row_number() OVER (PARTITION BY query_id
        ORDER BY list_sum(list_transform(range(1, {_WIDTH + 1}),
          lambda i: (CAST(embedding[i] AS DOUBLE) - vector[i])
            * (CAST(embedding[i] AS DOUBLE) - vector[i]))), vec_id) AS rank
      FROM embeddings, centre
    )
    SELECT query_id, doc_id, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 4"""
)
def topk_similar(bench: Workbench) -> DataFrame:
    """The four vectors nearest to the centre of each label."""
    stored = bench.raw("embeddings")
    centres = centroids(
        stored.select("label", F.col("embedding").alias("vector")), "label", _WIDTH
    ).select("id", F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))
    corpus = stored.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return top_k_similar(corpus, centres).select("query_id", "doc_id", "rank")


@query(
    f""", pairs AS (
      SELECT q.vec_id AS query_id, d.vec_id AS doc_id,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY
          list_sum(list_transform(range(1, {_WIDTH + 1}),
            lambda i: (CAST(d.embedding[i] AS DOUBLE) - q.embedding[i])
              * (CAST(d.embedding[i] AS DOUBLE) - q.embedding[i]))), d.vec_id) AS rank
      FROM embeddings q, embeddings d WHERE q.vec_id <> d.vec_id
    )
    SELECT query_id, doc_id, CAST(rank AS INTEGER) AS rank FROM pairs WHERE rank <= 4"""
)
def topk_self_join(bench: Workbench) -> DataFrame:
    """The four nearest other vectors of every vector, by the cells of the stored index."""
    found = search_cells(bench.vector_index, bench.vectors, skip_self=True)
    return found.select("query_id", "doc_id", "rank")


@query("SELECT count(*) AS queries, true AS enough FROM embeddings")
def topk_indexed_recall(bench: Workbench) -> DataFrame:
    """Whether visiting only the nearest cells finds 90 % of the exact neighbours."""
    index, vectors = bench.vector_index, bench.vectors
    probes = probes_for(index, vectors, skip_self=True)
    near = search_cells(index, vectors, skip_self=True, first=probes, exact=False).select("query_id", "doc_id")
    exact = search_cells(index, vectors, skip_self=True).select("query_id", "doc_id")
    hits = exact.join(near.withColumn("hit", F.lit(1)), ["query_id", "doc_id"], "left")
    share = F.avg(F.coalesce("hit", F.lit(0)))
    return hits.agg(F.countDistinct("query_id").alias("queries"), (share >= 0.9).alias("enough"))


_TERMS = r"""SELECT {id} AS id, unnest(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM {table}"""


_TEXT_TOPK = f""", doc_terms AS (
      SELECT id, term, count(*) AS n FROM ({_TERMS.format(id="doc_id", table="documents")}) GROUP BY ALL
    ), holding AS (
      SELECT term, count(*) AS holding FROM doc_terms GROUP BY term
    ), doc_weights AS (
      SELECT id, term, n * ln(((SELECT count(*) FROM documents) + 1.0E0) / (holding + 1.0E0)) AS w
      FROM doc_terms JOIN holding USING (term)
    ), question_weights AS (
      SELECT id, term, n * ln(((SELECT count(*) FROM documents) + 1.0E0) / (coalesce(holding, 0) + 1.0E0)) AS w
      FROM (SELECT id, term, count(*) AS n
        FROM ({_TERMS.format(id="item_id", table="benchmark")}) GROUP BY ALL)
      LEFT JOIN holding USING (term)
    ), scored AS (
      SELECT q.id AS query_id, d.id AS doc_id, sum(q.w * d.w) AS dot
      FROM question_weights q JOIN doc_weights d ON d.term = q.term GROUP BY ALL
    ), cosines AS (
      SELECT query_id, doc_id, round(dot / (
        (SELECT sqrt(sum(w * w)) FROM doc_weights WHERE id = doc_id)
        * (SELECT sqrt(sum(w * w)) FROM question_weights WHERE id = query_id)), 9) AS score
      FROM scored WHERE dot > 0
    )
    SELECT * FROM (
      SELECT query_id, doc_id,
        CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM cosines) WHERE rank <= 4"""


@query(_TEXT_TOPK)
def text_topk(bench: Workbench) -> DataFrame:
    """The four documents nearest to each benchmark passage, by the terms of whole texts."""
    documents = spread_rows(bench.raw("documents").select("doc_id", "text"))
    found = text_top_k(documents, bench.raw("benchmark"), "doc_id", "item_id")
    return found.select("query_id", "doc_id", "rank")


@query(_TEXT_TOPK)
def text_index_topk(bench: Workbench) -> DataFrame:
    """The same neighbours out of the stored index, which every question set can use."""
    found = search_index(bench.text_index, bench.raw("benchmark"), "item_id")
    return found.select("query_id", "doc_id", "rank")
