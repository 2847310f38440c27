from __future__ import annotations

import json
from dataclasses import replace

import pytest
from conftest import EDGE
from pyspark.sql import functions as F

from rebasket.config import DEFAULT_STAGES, DEMO_TRAINING, FULL_TRAINING, STAGES, ModelConfig, TrainingConfig
from rebasket.functions.rules import score_with_rules
from rebasket.operators.quality import InvalidRecords
from rebasket.plans.pipeline import STAGE_JOBS, Job, evaluate, retrain_if_drifted, run, score_batch
from rebasket.schemas import RECORD, RECORD_FIELDS, RECORD_TEXT, TABLES
from rebasket.session import new_path, shared_folder
from rebasket.sources.records import read_records, write_json
from rebasket.sources.runs import (
    METRICS,
    RUNS,
    latest_metrics,
    latest_model_path,
    log_metrics,
    read_history,
    read_latest_metrics,
    read_metrics_document,
)
from rebasket.sources.tables import MissingTable, RAW_FILES, read_csv, read_raw_tables, read_table
from rebasket.streaming.scoring import read_stream, score_stream

GOOD = (3, 1, 10, 7.0, 1, 5, 100, 0.6, 24, 4)


def write_raw(folder, tables=None):
    folder.mkdir(parents=True, exist_ok=True)
    for file_name, table in RAW_FILES.items():
        if tables is not None and table not in tables:
            continue
        rows = [",".join(TABLES[table].fieldNames())]
        rows += [",".join("" if v is None else str(v) for v in row) for row in EDGE[table]]
        (folder / file_name).write_text("\n".join(rows) + "\n")
    return str(folder)


@pytest.fixture
def job(tmp_path):
    """The edge tables, with many copies of the orders so that a split makes sense."""
    raw = tmp_path / "raw"
    raw.mkdir()
    for file_name, table in RAW_FILES.items():
        rows = [",".join(TABLES[table].fieldNames())]
        copies = range(20) if "order" in table else range(1)
        for copy in copies:
            for row in EDGE[table]:
                row = list(row)
                if "order" in table:
                    row[0] += 100 * copy
                if table == "orders":
                    row[1] += 100 * copy
                rows.append(",".join("" if v is None else str(v) for v in row))
        (raw / file_name).write_text("\n".join(rows) + "\n")
    return Job(
        raw=str(raw),
        root=str(tmp_path / "out"),
        model=ModelConfig(params={"n_estimators": 3, "max_depth": 3, "random_state": 1}),
        training=TrainingConfig(min_metric=0.0),
    )


def test_raw_files_are_found_in_the_archive_and_missing_ones_skipped(spark, tmp_path):
    write_raw(tmp_path / "raw" / "archive", {"orders", "products"})
    write_raw(tmp_path / "raw", {"aisles"})
    found = read_raw_tables(spark, str(tmp_path / "raw"))
    assert set(found) == {"orders", "products", "aisles"}
    assert found["orders"].schema == TABLES["orders"]
    assert sorted(map(tuple, found["orders"].collect()), key=repr) == sorted(EDGE["orders"], key=repr)


def test_no_raw_file_is_an_error(spark, tmp_path):
    with pytest.raises(MissingTable):
        read_raw_tables(spark, str(tmp_path))
    with pytest.raises(MissingTable):
        read_table(spark, str(tmp_path / "nothing"))
    with pytest.raises(MissingTable):
        read_records(spark, str(tmp_path / "nothing.json"))


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("department_id,extra,product_id\n4,x,7\n")
    frame = read_csv(spark, str(path), TABLES["products"])
    assert frame.dtypes == [("department_id", "int"), ("extra", "string"), ("product_id", "bigint")]
    assert tuple(frame.first()) == (4, "x", 7)
    assert dict(read_csv(spark, str(path)).dtypes)["product_id"] == "int"


def test_stage_names():
    assert set(STAGE_JOBS) == {
        "ingestion",
        "processing",
        "feature_engineering",
        "training",
        "evaluation",
        "deployment",
    }
    assert DEFAULT_STAGES == STAGES[:5]
    assert (FULL_TRAINING.max_rows, DEMO_TRAINING.max_rows) == (100_000, 1_000)


def test_unknown_stage_stops_before_anything_runs(spark, job, tmp_path):
    with pytest.raises(ValueError, match="unknown"):
        run(spark, replace(job, stages=("ingestion", "cleaning")))
    assert not (tmp_path / "out").exists()


def test_pipeline_end_to_end(spark, job, tmp_path):
    results = run(spark, job)
    assert list(results) == list(DEFAULT_STAGES)
    assert results["evaluation"] == "model stable"
    assert read_table(spark, job.table("joined")).count() == 140
    assert read_table(spark, job.table("features")).count() == 140
    validation = read_csv(spark, f"{job.predictions}/validation")
    assert validation.columns == ["prediction", "actual"] and validation.count() == 28

    logged = read_history(spark, f"{job.root}/runs", RUNS).collect()
    assert len(logged) == 1 and logged[0].params["n_estimators"] == "3"
    assert dict(map(tuple, read_latest_metrics(spark, job.root).collect())) == logged[0].metrics
    assert "/version=1-" in latest_model_path(spark, job.root, "reorder_model")

    # a drifted model is trained again, a stable one is not
    assert retrain_if_drifted(spark, job) is False
    strict = replace(job, training=replace(job.training, min_metric=1.1))
    assert evaluate(spark, strict) == "retraining recommended"
    assert retrain_if_drifted(spark, strict) is True
    assert "/version=2-" in latest_model_path(spark, job.root, "reorder_model")
    assert read_history(spark, f"{job.root}/metrics", METRICS).select("run_id").distinct().count() == 2

    # batch scoring from a JSON list and from JSON lines
    records = [dict(zip(RECORD.fieldNames(), GOOD)), dict(zip(RECORD.fieldNames(), GOOD))]
    (tmp_path / "list.json").write_text(json.dumps(records))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records)))
    for name, array in (("list.json", True), ("lines.json", False)):
        deploy = replace(
            job, records=str(tmp_path / name), records_are_arrays=array, stages=("deployment",)
        )
        written = spark.read.json(run(spark, deploy)["deployment"])
        assert written.count() == 2
        assert {r.confidence_hint for r in written.collect()} == {"model_score"}
    # what the model can fill is scored with its ids, a value of the wrong kind is set aside
    odd = [
        {**records[0], "order_dow": 7, "aisle_id": 0, "id": "x1"},
        {k: v for k, v in {**records[0], "id": "x2"}.items() if k != "days_since_prior_order"},
        {**records[0], "order_number": "three", "id": "x3"},
    ]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, odd)))
    named = replace(deploy, record_identity=("id",))
    written = spark.read.json(run(spark, named)["deployment"])
    assert {r.id for r in written.collect()} == {"x1", "x2"}
    aside = spark.read.json(f"{job.predictions}/quarantine").collect()
    assert [(r.id, r.errors[0].field) for r in aside] == [("x3", "order_number")]
    with pytest.raises(InvalidRecords):
        score_batch(spark, named, strict=True)


def test_first_run_without_metrics_trains(spark, job):
    assert retrain_if_drifted(spark, replace(job, stages=("ingestion",))) is True


def test_metrics_of_the_last_run(spark, tmp_path):
    log_metrics(spark, str(tmp_path), "a", {"accuracy": 0.9, "roc_auc": 0.8})
    log_metrics(spark, str(tmp_path), "b", {"accuracy": 0.5})
    history = read_history(spark, f"{tmp_path}/metrics", METRICS)
    assert [tuple(r) for r in latest_metrics(history).collect()] == [("accuracy", 0.5)]
    with pytest.raises(MissingTable):
        read_latest_metrics(spark, str(tmp_path / "none"))


def test_metrics_document(spark, tmp_path):
    path = tmp_path / "metrics.json"
    path.write_text(json.dumps({"accuracy": 0.8, "roc_auc": None, "n": 1}, indent=2))
    rows = {r.metric: r.value for r in read_metrics_document(spark, str(path)).collect()}
    assert rows == {"accuracy": 0.8, "roc_auc": None, "n": 1.0}


def test_stream_equals_batch_and_goes_on(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    quarantined = str(tmp_path / "bad")

    def arrive(*rows):
        frame = spark.createDataFrame(list(rows), RECORD).coalesce(1)
        frame.write.mode("append").json(source)

    def drain():
        stream = read_stream(spark, source, RECORD_TEXT, "json", files_per_trigger=1)
        score_stream(stream, sink, checkpoint).awaitTermination()
        score_stream(
            stream, quarantined, checkpoint + "-bad", quarantine=True
        ).awaitTermination()

    arrive(GOOD, (*GOOD[:1], 9, *GOOD[2:]))
    drain()
    assert spark.read.parquet(sink).count() == 1
    arrive((*GOOD[:4], 9, *GOOD[5:]), GOOD)
    drain()
    drain()  # nothing new, nothing twice
    columns = [*RECORD.fieldNames(), "prediction", "label", "confidence_hint", "reason"]
    streamed = spark.read.parquet(sink).select(columns).collect()
    batch = score_with_rules(
        spark.createDataFrame([GOOD, (*GOOD[:4], 9, *GOOD[5:]), GOOD], RECORD)
    ).select(columns)
    assert sorted(map(repr, streamed)) == sorted(map(repr, batch.collect()))
    bad = spark.read.parquet(quarantined).select(F.explode("errors.field")).collect()
    assert [r[0] for r in bad] == ["order_dow"]


def test_json_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([GOOD], RECORD)
    text = read_records(spark, write_json(frame, str(tmp_path / "records")))
    assert text.schema == RECORD_TEXT
    assert len(RECORD_FIELDS) == 10


def test_every_run_writes_to_paths_of_its_own(spark):
    assert new_path(spark, "t").startswith(shared_folder(spark) + "/")
    assert new_path(spark, "t") != new_path(spark, "t")


def test_stream_scored_by_a_model(spark, job, tmp_path):
    from rebasket.operators.model import model_result, predict
    from rebasket.sources.runs import load_model

    run(spark, replace(job, stages=DEFAULT_STAGES[:4]))
    model = load_model(spark, job.root, "reorder_model")
    spark.createDataFrame([GOOD, GOOD], RECORD).write.json(str(tmp_path / "in"))
    records = read_stream(spark, str(tmp_path / "in"), RECORD_TEXT, "json")
    score_stream(
        records,
        str(tmp_path / "scores"),
        str(tmp_path / "check"),
        score=lambda good: model_result(predict(model, good)),
    ).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "scores")).collect()
    assert [r.confidence_hint for r in rows] == ["model_score"] * 2


def test_command_line_makes_a_job():
    from rebasket.__main__ import job_of, parse

    made = job_of(parse(["--raw", "a", "--root", "b", "--demo", "--stages", "training"]))
    assert (made.raw, made.root, made.stages) == ("a", "b", ("training",))
    assert made.training == DEMO_TRAINING
    assert job_of(parse(["--raw", "a", "--root", "b"])).training.max_rows is None
    with pytest.raises(SystemExit):
        parse(["--raw", "a", "--root", "b", "--stages", "cleaning"])


def test_runs_at_the_same_time_get_different_versions(spark, tmp_path, monkeypatch):
    """A second run that looks before the first has published."""
    from pyspark.ml import PipelineModel

    from rebasket.sources import runs

    root, model = str(tmp_path), PipelineModel([])
    inner = []

    class Slow:
        def save(self, path):
            if not inner:
                inner.append(runs.save_model(spark, root, "m", model, "second"))
            model.save(path)

    first = runs.save_model(spark, root, "m", Slow(), "first")
    assert "version=1-first" in first and "version=2-second" in inner[0]
    assert latest_model_path(spark, root, "m") == inner[0]
    versions = read_history(spark, f"{root}/versions", runs.VERSIONS)
    assert sorted(r.version for r in versions.collect()) == [1, 2]
    assert "version=3-" in runs.save_model(spark, root, "m", model, "third")
    assert "version=1-" in runs.save_model(spark, root, "other", model, "x")


def test_one_noisy_run_does_not_retrain(spark, job):
    patient = replace(job, training=TrainingConfig(min_metric=0.75, patience=2), stages=("ingestion",))
    for run_id, value in (("a", 0.9), ("b", 0.6)):
        log_metrics(spark, job.root, run_id, {"accuracy": value})
    assert retrain_if_drifted(spark, patient) is False
    assert evaluate(spark, replace(patient, training=TrainingConfig(min_metric=0.75))) == "retraining recommended"
    log_metrics(spark, job.root, "c", {"accuracy": 0.5})
    assert retrain_if_drifted(spark, patient) is True


def test_history_of_a_metric(spark):
    from rebasket.operators.drift import check_history, drift_history

    values = [0.9, 0.5, 0.4, 0.8, None, 0.1, 0.75]
    rows = [(f"r{k}", "accuracy", v, k) for k, v in enumerate(values)] + [("r0", "roc_auc", 0.1, 0)]
    history = spark.createDataFrame(rows, "run_id string, metric string, value double, ts int")
    found = drift_history(history, patience=2).orderBy("ts").collect()
    assert [r.breaches for r in found] == [0, 1, 2, 0, 1, 0]
    assert [r.retrain for r in found] == [False, False, True, False, False, False]
    assert found[0].change is None and found[1].change == pytest.approx(-0.4)
    assert check_history(history.filter("ts <= 2"), patience=2) and not check_history(history)
    with pytest.raises(ValueError):
        check_history(history, "f1")


def test_damaged_lines_are_set_aside(spark, job, tmp_path):
    from rebasket.plans.pipeline import ingest

    path = tmp_path / "raw" / "products.csv"
    lines = path.read_text().splitlines()
    bad = ["x1,p,1,1", "7,p,1,1,more", "8,p", "9,p,1.5,1"]
    path.write_text("\n".join([*lines[:2], *bad, *lines[2:], "10,,,"]) + "\n")
    written = ingest(spark, replace(job, set_aside=True))
    rejected = read_table(spark, written["rejected"])
    assert sorted((r.table, r.line) for r in rejected.collect()) == sorted(("products", b) for b in bad)
    assert rejected.first().file.endswith("products.csv")
    products = read_table(spark, written["products"])
    assert products.schema == TABLES["products"] and products.count() == len(EDGE["products"]) + 1
    assert products.filter("product_id = 10 AND product_name IS NULL AND aisle_id IS NULL").count() == 1
    with pytest.raises(Exception):
        ingest(spark, replace(job, root=str(tmp_path / "other")))


def test_routed_stream_reads_once_and_repeats_nothing(spark, tmp_path):
    from rebasket.streaming.scoring import read_routed, route_stream, routed_records, write_batch

    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = [GOOD, (*GOOD[:1], 9, *GOOD[2:]), (*GOOD[:4], 9, *GOOD[5:])]

    def drain(place):
        stream = read_stream(spark, source, RECORD_TEXT, "json", files_per_trigger=1)
        query = route_stream(stream, sink, place)
        query.awaitTermination()
        return query

    def counts():
        return tuple(frame.count() for frame in read_routed(spark, sink))

    spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").json(source)
    first = drain(checkpoint)
    assert counts() == (2, 1)
    drain(str(tmp_path / "lost"))  # the checkpoint was lost: batch 0 comes again
    assert counts() == (2, 1)
    (tmp_path / "in" / "part-odd.json").write_text(json.dumps({"order_number": "three", "aisle_id": "NaN"}) + "\n")
    assert drain(checkpoint).id == first.id  # one query
    assert counts() == (2, 2)
    scores, aside = read_routed(spark, sink)
    columns = ["prediction", "label", "confidence_hint", "reason"]
    batch = score_with_rules(spark.createDataFrame([rows[0], rows[2]], RECORD)).select(columns)
    assert sorted(map(repr, scores.select(columns).collect())) == sorted(map(repr, batch.collect()))
    odd = {json.loads(r.record).get("order_number"): {e.field for e in r.errors} for r in aside.collect()}
    assert "order_number" in odd["three"] and odd["3"] == {"order_dow"}
    # A batch that stopped half-way is written over.
    (tmp_path / "out" / "batch=7" / "accepted=true").mkdir(parents=True)
    frame = routed_records(spark.createDataFrame(rows, RECORD))
    assert write_batch(frame, sink, 7) is True and write_batch(frame, sink, 7) is False
    assert counts() == (4, 3)


def test_a_broken_run_goes_on_where_it_stopped(spark, job, monkeypatch):
    from rebasket.plans import pipeline

    calls = []
    for stage in STAGES[:3]:
        work = STAGE_JOBS[stage]

        def counted(spark, job, stage=stage, work=work):
            calls.append(stage)
            if len(calls) == 3:
                raise RuntimeError("lost")
            return work(spark, job)

        monkeypatch.setitem(pipeline.STAGE_JOBS, stage, counted)
    three = replace(job, stages=STAGES[:3])
    with pytest.raises(RuntimeError):
        run(spark, three)
    assert list(run(spark, three, resume=True).values())[:2] == [None, None]
    assert calls == [*STAGES[:3], STAGES[2]]
    del calls[:]
    calls.append("x")
    assert set(run(spark, three, resume=True).values()) == {None} and calls == ["x"]
    # Another raw file or setting: everything after it runs again.
    fewer = replace(three, features=replace(job.features, numeric=("order_number",)))
    assert [s for s, r in run(spark, fewer, resume=True).items() if r is not None] == [STAGES[2]]
    calls.extend(["x"] * 5)
    with open(f"{job.raw}/products.csv", "a") as file:
        file.write("900,p900,1,1\n")
    assert None not in run(spark, fewer, resume=True).values()


def test_scratch_is_empty_after_a_clean_run(spark, job):
    from rebasket.sources.files import names_in

    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    before = names_in(spark, folder)
    run(spark, replace(job, stages=DEFAULT_STAGES), clean=True)
    assert names_in(spark, folder) == before
    assert read_csv(spark, f"{job.predictions}/validation").count() == 28
    with pytest.raises(MissingTable):
        run(spark, replace(job, root=job.root + "-none", stages=("processing",)), clean=True)
