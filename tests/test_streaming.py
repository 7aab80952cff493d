"""Streams answer like the batch functions."""

import json

import pytest
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import candidates, drift, scoring
from claimloom.operators.candidates import Sizes, as_pipeline
from claimloom.plans import training
from claimloom.streaming import drift as stream_drift
from claimloom.streaming import scoring as stream_scoring

TINY = Sizes(tree_leaf=2, tree_depth=3)
GOOD = dict(zip(S.FEATURES, ("B100", "N210", "U", 2, 11, 48250.5)))
BAD = [
    {S.FLAG_COLUMN: "maybe"}, {"Number_of_Claims_out": -4}, {S.INCOME: -0.5},
    {"Number_of_Claims_inp": "several"}, {S.CODE_COLUMNS[1]: None},
]


@pytest.fixture(scope="module")
def bundle(modeling):
    train, _ = training.split(modeling)
    tier = as_pipeline(candidates.classifiers(TINY)["decision_tree"]).fit(train)
    charge = as_pipeline(candidates.regressors(300)["linear_regression"]).fit(train)
    return scoring.Bundle(tier, charge, {"classifier": "decision_tree", "regressor": "linear_regression"})


def requests():
    rows = [{"request_id": f"g{i}", **GOOD, "Number_of_Claims_inp": i} for i in range(8)]
    rows += [{"request_id": f"b{i}", **GOOD, **bad} for i, bad in enumerate(BAD)]
    rows.append({"request_id": "missing", S.CODE_COLUMNS[0]: "B100"})
    return rows


def test_stream_scores_equal_batch_scores(spark, bundle, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    rows = requests()
    for i in range(0, len(rows), 5):
        (folder / f"{i}.json").write_text("\n".join(map(json.dumps, rows[i : i + 5])))
    stream = stream_scoring.read_requests(spark, str(folder), maxFilesPerTrigger=1)
    query = stream_scoring.start_scoring(stream, bundle, out, str(tmp_path / "cp"), explain=False)
    query.awaitTermination(180)
    assert query.exception() is None
    streamed = spark.read.parquet(f"{out}/scores")
    rejected = spark.read.parquet(f"{out}/rejected").collect()
    accepted, _ = stream_scoring.check_requests(
        spark.read.schema(stream_scoring.INPUT_SCHEMA).json(str(folder))
    )
    batch = stream_scoring.score_requests(bundle, accepted, explain=False)
    pick = ["request_id", "tier", "confidence", "predicted_charge", "tier_model", "charge_model"]
    a, b = (sorted(map(str, f.select(*pick).collect())) for f in (streamed, batch))
    assert a == b and len(a) == 8
    assert len(rejected) == len(BAD) + 1 and all(r.errors for r in rejected)
    assert len([r for r in rejected if r.request_id == "missing"][0].errors) == 5
    # One file per micro-batch; the last one holds rejected rows only.
    batches = {r.batch_id for r in rejected} | {r.batch_id for r in streamed.collect()}
    assert batches == {0, 1, 2}


def test_stream_drift_equals_batch_drift(spark, modeling, tmp_path):
    reference = modeling.filter("BENE_ID <= 20").select(*S.FEATURES)
    current = modeling.filter("BENE_ID > 20").select(*S.FEATURES)
    current.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(current.schema).parquet(str(tmp_path / "in"))
    query = stream_drift.start_batch_drift(
        stream, reference, [S.FLAG_COLUMN], [S.INCOME], str(tmp_path / "out"), str(tmp_path / "cp")
    )
    query.awaitTermination(180)
    got = {r.column_name: r.jensen_shannon for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    flag = drift.categorical_drift(reference, current, [S.FLAG_COLUMN]).first()
    assert got[S.FLAG_COLUMN] == pytest.approx(flag.jensen_shannon)
    assert set(got) == {S.FLAG_COLUMN, S.INCOME}


def test_window_counts_give_window_drift(spark, tmp_path):
    events = spark.createDataFrame(
        [(f"2024-01-{1 + i // 20:02d} 10:{i % 20:02d}:00", "ab"[i % 2 if i < 40 else 0]) for i in range(100)],
        "at string, kind string",
    ).select(F.col("at").cast("timestamp").alias("ts"), "kind")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    counts = stream_drift.window_counts(stream, "ts", ["kind"], "1 day", "0 seconds")
    query = stream_drift.start_window_counts(counts, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(180)
    closed = spark.read.parquet(str(tmp_path / "out"))
    # The last window stays open until a later row arrives.
    assert closed.agg(F.sum("rows")).first()[0] == 80
    scores = stream_drift.window_drift(closed, events.filter("ts < '2024-01-03'"), ["kind"]).collect()
    by_day = {str(r.window_start)[:10]: r.jensen_shannon for r in scores}
    assert by_day["2024-01-01"] == pytest.approx(0.0, abs=1e-6) and by_day["2024-01-04"] > 0.5
