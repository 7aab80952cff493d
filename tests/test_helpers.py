"""Skew-safe joins and distributed order statistics against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.functions import ranks, skew, storage


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, some keys are null."""
    draw = random.Random(3)
    rows = [(i, 7 if draw.random() < 0.34 else draw.randint(8, 400)) for i in range(3000)]
    rows += [(3000 + i, None) for i in range(50)]
    return spark.createDataFrame(rows, "id long, k int").cache()


@pytest.fixture
def small_partitions(spark):
    """Adaptive execution with limits that the small tables exceed, and no broadcast."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "100k",
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest_task(joined):
    """Rows in the fullest partition of a join's result."""
    counted = joined.groupBy(F.spark_partition_id()).agg(F.count("text").alias("rows"), F.max("text"))
    return max(r.rows for r in counted.collect())


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_equals_plain_join(spark, skewed, how):
    table = spark.createDataFrame([(k, k * 10) for k in range(0, 300)], "k int, v int")
    plain = skewed.join(table, "k", how)
    ours = skew.lookup_join(skewed, table, ["k"], how).select(*plain.columns)
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def scans(frame):
    """Scans of stored tables in the physical plan."""
    return frame._jdf.queryExecution().executedPlan().toString().count("FileScan")


@pytest.fixture(scope="module")
def stored_hot(spark, tmp_path_factory):
    """20,000 rows in 8 files, nine tenths of them on one key."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    rows = spark.range(0, 20_000, 1, 8).select(
        "id", F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id") % 300).cast("int").alias("k"), F.uuid().alias("text")
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_rows_of_a_hot_key_go_to_many_tasks(spark, stored_hot, small_partitions):
    table = spark.range(300).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    joined = skew.lookup_join(stored_hot, table, ["k"], "left")
    assert scans(joined) == 1
    assert joined.count() == 20_000 and joined.filter("k = 7 AND v = 70").count() >= 18_000
    assert largest_task(joined) < 6_000


def test_one_left_row_against_many(spark, stored_hot, small_partitions):
    left = spark.createDataFrame([(7, "a"), (8, "b")], "k int, a string")
    joined = skew.fan_out_join(left, stored_hot, "k")
    assert joined.filter("k = 7").count() >= 18_000 and largest_task(joined) < 6_000


def test_fan_out_join_equals_plain_join(spark):
    left = spark.createDataFrame(
        [(1, i) for i in range(300)] + [(k, k) for k in range(2, 50)], "k int, a int"
    )
    right = spark.createDataFrame(
        [(1, i) for i in range(40)] + [(k, -k) for k in range(2, 60) for _ in range(2)], "k int, b int"
    )
    plain = left.join(right, "k")
    ours = skew.fan_out_join(left, right, "k").select(*plain.columns)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_broadcast_only_when_small(spark):
    table = spark.range(100)
    assert skew.broadcast_if_small(table, 100) is not table
    assert skew.broadcast_if_small(table, 99) is table
    texts = table.select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert skew.broadcast_if_small(texts, 100, 50_000) is texts
    assert skew.broadcast_if_small(texts, 100, 200_000) is not texts


def test_hash_cuts_take_exactly_the_share(spark):
    keys = spark.range(1000).select(
        ranks.hash_of(F.col("id").cast("string"), seed=1).alias("h"), F.lit(1).alias("w"),
        (F.col("id") % 3).alias("s"),
    ).cache()
    cut = ranks.hash_cuts(keys, "h", "w", lambda n: [F.ceil(n * 0.3), F.ceil(n * 0.8)])[None]
    assert [keys.filter(F.col("h") <= c).count() for c in cut] == [300, 800]
    by = ranks.hash_cuts(keys, "h", "w", lambda n: [F.ceil(n * 0.5)], "s")
    for s, (c,) in by.items():
        mine = keys.filter(F.col("s") == s)
        assert mine.filter(F.col("h") <= c).count() == math.ceil(mine.count() * 0.5)


@pytest.fixture(params=["one task", "buckets"])
def both_sizes(request, monkeypatch):
    if request.param == "buckets":
        monkeypatch.setattr(ranks, "WINDOW_ROWS", 10)
        monkeypatch.setattr(ranks, "BUCKETS", 16)


def test_running_totals_equal_plain_cumulation(spark, both_sizes):
    draw = random.Random(5)
    data = {(g, round(draw.random() ** 3, 3)): draw.randint(1, 5) for g in "ab" for _ in range(400)}
    frame = spark.createDataFrame([(g, v, n) for (g, v), n in data.items()], "g string, v double, n int")
    got = {(r.g, r.v): r for r in ranks.running_totals(frame, ["g"], "v", ["n"]).collect()}
    for g in "ab":
        values, before = sorted(v for k, v in data if k == g), 0
        for i, v in enumerate(values):
            row = got[g, v]
            assert row.before_n == before
            assert row.next_value == (values[i + 1] if i + 1 < len(values) else None)
            before += data[g, v]
        assert got[g, values[0]].total_n == before
    assert len(got) == len(data)


def test_values_without_an_order_take_no_part(spark, both_sizes):
    rows = [("a", float(v), 1) for v in range(100)] + [("a", None, 50), ("a", math.nan, 70)]
    frame = spark.createDataFrame(rows, "g string, v double, n int")
    got = ranks.running_totals(frame, ["g"], "v", ["n"]).collect()
    assert sorted(r.before_n for r in got) == list(range(100)) and {r.total_n for r in got} == {100}


def test_exact_quantiles_equal_numpy(spark, both_sizes):
    draw = random.Random(6)
    numbers = [draw.choice([1.0, 2.0, 2.0, draw.uniform(0, 100)]) for _ in range(997)]
    frame = spark.createDataFrame([("x", v) for v in numbers] + [("x", None), ("x", math.nan)], "c string, v double")
    row = ranks.exact_quantiles(frame, ["c"], "v", {"a": 0.25, "b": 0.5, "d": 0.9}).first()
    assert [row.a, row.b, row.d] == pytest.approx(list(np.quantile(numbers, [0.25, 0.5, 0.9])))


def test_copies_are_numbered_apart(spark):
    frame = spark.createDataFrame([("a",)] * 25 + [("b",)] * 3, "x string")
    rows = ranks.number_copies(frame, ["x"], chunk=4).collect()
    assert sorted((r.x, r.copy_no) for r in rows) == [("a", i) for i in range(1, 26)] + [
        ("b", i) for i in (1, 2, 3)
    ]


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stored_tables_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_folder", lambda _: str(tmp_path))
    table = storage.as_table(spark.range(10).coalesce(1), "rows", split=True)
    assert table.count() == 10 and table.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert len(list((tmp_path / spark.sparkContext.applicationId).iterdir())) == 1
    storage.remove_tables(spark)
    assert not list(tmp_path.iterdir())


def test_spread_splits_small_stored_tables(spark):
    stored = storage.cut(spark.range(10).coalesce(1))
    assert storage.spread(stored).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
