"""Roll-up of raw extracts against a plain Python computation."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest

from claimloom import settings as S
from claimloom.operators import enrich, profile, rollup
from claimloom.sources import tables

RAW = (
    "BENE_ID long, CLM_ID long, PRVDR_STATE_CD int, PRVDR_NUM string, PRNCPAL_DGNS_CD string, "
    "CLM_TOT_CHRG_AMT decimal(18,2), CLM_E_POA_IND_SW1 string, EXTRA int"
)


def raw_rows(n, people, seed):
    draw = random.Random(seed)
    return [
        (
            -draw.randint(1, people) if draw.random() > 0.3 else -1, -i, 5, "P1",
            draw.choice(["A10", "B20", "C30", None]), Decimal(draw.randint(1, 10**6)) / 100,
            draw.choice(["Y", "U", None]), 1,
        )
        for i in range(1, n + 1)
    ]


@pytest.fixture(scope="module")
def raw(spark):
    inp, out = raw_rows(200, 12, 1), raw_rows(400, 20, 2)
    return inp, out, spark.createDataFrame(inp, RAW), spark.createDataFrame(out, RAW)


def expected(inp, out):
    i, o = defaultdict(list), defaultdict(list)
    for b, _, s, _, c, amount, poa, _ in inp:
        if c and poa:
            i[-b, c, poa, s].append(amount)
    for b, _, s, _, c, amount, _, _ in out:
        if c:
            o[-b, c, s].append(amount)
    return sorted(
        (b, c, p, s, len(x), sum(x), c2, s2, len(y), sum(y))
        for (b, c, p, s), x in i.items() for (b2, c2, s2), y in o.items() if b == b2
    )


def test_merged_claims(raw):
    inp, out, inp_frame, out_frame = raw
    merged = rollup.merged_claims(inp_frame, out_frame)
    assert merged.schema.simpleString() == S.CLAIMS_SCHEMA.simpleString()
    assert sorted(map(tuple, merged.collect())) == expected(inp, out)


def test_group_sizes_count_non_null_charges(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("b", None)], "k string, x double")
    sizes = rollup.group_sizes(rows, ["k"], "x", "n").collect()
    assert sorted((r.k, r.n) for r in sizes) == [("a", 2), ("a", 2), ("a", 2), ("b", 0)]


def test_group_without_charge_sums_to_zero(spark):
    rows = spark.createDataFrame([("a", None), (None, Decimal("1.00"))], "k string, c decimal(18,2)")
    row, = rollup.roll_up(rows, ["k"], "c").collect()
    assert (row.k, row.Number_of_Claims, row.c) == ("a", 0, Decimal("0.00"))


def test_semi_join(raw):
    inp, out, inp_frame, out_frame = raw
    kept = rollup.with_inpatient_stay(rollup.prepare(out_frame, 0), rollup.prepare(inp_frame, 1))
    people = {r[0] for r in inp}
    assert kept.count() == sum(r[0] in people for r in out)
    assert set(kept.columns) == {*S.RAW_COLUMNS, "PATIENT_TYPE"}


def test_income_join_keeps_unmatched_rows(claims, income):
    short = income.filter("PRVDR_STATE_CD <> 5")
    joined = enrich.merge_income(claims, short)
    assert joined.count() == claims.count()
    missing = joined.filter("Median_Income IS NULL").count()
    report = enrich.unmatched_keys(claims, short, S.STATE_INP, S.STATE_KEY).collect()
    assert [r.rows for r in report if r[S.STATE_INP] == 5] == ([missing] if missing else [])
    assert sum(r.rows for r in report) == missing


def test_raw_csv_and_merged_table_round_trip(spark, raw, tmp_path):
    _, _, inp_frame, out_frame = raw
    inp_frame.write.csv(str(tmp_path / "inp.csv"), header=True)
    back = tables.load_raw_extract(spark, str(tmp_path / "inp.csv"))
    assert set(back.columns) == set(S.RAW_COLUMNS)
    merged = rollup.merged_claims(back, out_frame)
    tables.write_claims(merged, str(tmp_path / "claims.parquet"))
    tables.write_claims(merged, str(tmp_path / "claims.parquet"))
    stored = tables.load_claims(spark, str(tmp_path / "claims.parquet"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, merged.collect()))
    stored.write.csv(str(tmp_path / "claims.csv"), header=True)
    from_csv = tables.load_claims(spark, str(tmp_path / "claims.csv"))
    assert sorted(map(tuple, from_csv.collect())) == sorted(map(tuple, stored.collect()))


def test_current_batch_by_suffix(spark, claims, tmp_path):
    assert tables.load_current(spark, None) is None
    features = claims.limit(5)
    features.write.parquet(str(tmp_path / "a.PQ"))
    features.write.csv(str(tmp_path / "a.CSV"), header=True)
    assert tables.load_current(spark, str(tmp_path / "a.PQ")).count() == 5
    read = tables.load_current(spark, str(tmp_path / "a.CSV"))
    assert read.count() == 5 and dict(read.dtypes)["Number_of_Claims_inp"] == "bigint"
    with pytest.raises(ValueError, match="Unsupported"):
        tables.load_current(spark, "batch.json")


def test_columns_are_found_by_name(spark, claims, tmp_path):
    claims.select(*sorted(claims.columns)).write.csv(str(tmp_path / "claims.csv"), header=True)
    found = tables.load_claims(spark, str(tmp_path / "claims.csv"))
    assert found.schema.simpleString() == S.CLAIMS_SCHEMA.simpleString()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, claims.collect()))
    claims.drop(S.STATE_OUT).write.csv(str(tmp_path / "short.csv"), header=True)
    with pytest.raises(ValueError, match=S.STATE_OUT):
        tables.load_claims(spark, str(tmp_path / "short.csv"))


def test_unreadable_cells_are_rejected_or_end_the_job(spark, tmp_path):
    rows = [("-1", "7", "5", "P", "A10", "$1,000.00", "Y"), ("x", "8", "5", "P", "A10", "10", "Y"),
            ("2", "9", "5", "P", "A10", "ten", "Y"), ("3", "10", "5", "P", "A10", None, "Y")]
    path, rejects = str(tmp_path / "raw.csv"), str(tmp_path / "rejects")
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in S.RAW_COLUMNS)).write.csv(path, header=True)
    kept = tables.load_raw_extract(spark, path, rejects).collect()
    assert sorted((r.BENE_ID, r.CLM_TOT_CHRG_AMT) for r in kept) == [(-1, Decimal("1000.00")), (3, None)]
    assert sorted(r.errors for r in spark.read.parquet(rejects).collect()) == [["BENE_ID: x"], ["CLM_TOT_CHRG_AMT: ten"]]
    with pytest.raises(Exception, match="unreadable cells"):
        tables.load_raw_extract(spark, path).collect()


def test_income_file_with_currency_text(spark, tmp_path):
    spark.createDataFrame(
        [(1, "A", "50000"), (2, "B", "$60,510 ")], S.INCOME_SCHEMA
    ).write.csv(str(tmp_path / "income.csv"), header=True)
    rows = tables.load_income(spark, str(tmp_path / "income.csv")).collect()
    assert sorted((r.PRVDR_STATE_CD, r.Median_Income) for r in rows) == [(1, 50000.0), (2, 60510.0)]


def test_missing_background_is_none(spark, tmp_path):
    assert tables.load_background(spark, str(tmp_path / "none")) is None


def test_report_tables(spark, claims, tmp_path):
    tables.write_report({"rows": profile.value_counts(claims, "CLM_E_POA_IND_SW1")}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 2


def test_profile_of_claims(claims):
    nulls = {r.column_name: r.nulls for r in profile.null_counts(claims).collect()}
    assert set(nulls) == set(claims.columns) and not any(nulls.values())
    shape = profile.group_multiplicity(claims, S.GROUP_KEY).first()
    assert shape["keys"] <= 45 and shape.mean_rows * shape["keys"] == pytest.approx(claims.count())
    exact = profile.distinct_count(claims, S.GROUP_KEY).first()[0]
    near = profile.distinct_count(claims, S.GROUP_KEY, approximate=True).first()[0]
    assert abs(exact - near) <= 0.1 * exact
