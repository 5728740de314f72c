import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fraudlake.functions import expressions as X
from fraudlake.operators import audit, encoding, entity, impute, lookup, velocity
from fraudlake.plans import engineer


def by_id(df, *columns):
    return {r["TransactionID"]: tuple(r[c] for c in columns) for r in df.collect()}


def brute_velocity(rows, window):
    """rows: (id, key, time); the count of earlier rows of the key inside the window."""
    counts = {}
    for i, key, time in rows:
        counts[i] = sum(
            1
            for j, other, earlier in rows
            if key is not None
            and other == key
            and earlier >= time - window
            and (earlier < time or (earlier == time and j < i))
        )
    return counts


def velocity_of(spark, rows, windows):
    df = spark.createDataFrame(rows, "TransactionID long, card1 long, TransactionDT long")
    return by_id(velocity.with_velocity(df, windows=windows), *windows)


def test_velocity_ties_bounds_and_null_key(spark):
    rows = [(1, 7, 100), (2, 7, 100), (3, 7, 100), (4, 7, 3700), (5, None, 100), (6, None, 100)]
    got = velocity_of(spark, rows, {"h": 3600})
    assert got == {1: (0,), 2: (1,), 3: (2,), 4: (3,), 5: (0,), 6: (0,)}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 900)), min_size=1, max_size=60
    )
)
def test_velocity_equals_brute_force(spark, events):
    rows = [(i, key, time) for i, (key, time) in enumerate(events)]
    got = velocity_of(spark, rows, {"short": 10, "long": 60})
    assert {i: v[0] for i, v in got.items()} == brute_velocity(rows, 10)
    assert {i: v[1] for i, v in got.items()} == brute_velocity(rows, 60)


def test_velocity_across_blocks_and_id_chunks(spark):
    rng = random.Random(5)
    ids = [rng.getrandbits(63) - (1 << 62) for _ in range(360)]  # as hashed ids are: in no order of time
    rows = [(i, rng.choice([1, 1, 1, 2]), rng.randrange(0, 400)) for i in ids[:300]]
    rows += [(i, 1, 77) for i in ids[300:]]
    got = velocity_of(spark, rows, {"w": 30})
    assert {i: v[0] for i, v in got.items()} == brute_velocity(rows, 30)


def test_velocity_has_no_window_over_a_whole_key(spark):
    df = spark.range(100).selectExpr(
        "id AS TransactionID", "id % 3 AS card1", "id * 60 AS TransactionDT"
    )
    plan = velocity.trailing_counts(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" in plan and "windowspecdefinition(card1" in plan
    for line in plan.splitlines():
        if "windowspecdefinition(card1" in line:
            assert "_block" in line or "_chunk" in line


def test_velocity_splits_a_second_that_has_most_rows(spark):
    df = spark.range(20_000).selectExpr(
        "xxhash64(id) AS TransactionID", "1L AS card1", "IF(id % 3 = 0, id, 50L) AS TransactionDT"
    )
    plan = velocity.trailing_counts(df, windows={"w": 10})
    assert plan.agg(F.max("w")).first()[0] >= 13_333 - 1
    cells = df.repartitionByRange(4, "TransactionID").withColumn("c", F.spark_partition_id())
    assert cells.where("TransactionDT = 50").groupBy("c").count().agg(F.max("count")).first()[0] < 20_000 / 2


@pytest.mark.parametrize("seen", [True, False])
def test_heavy_keys_unknown_to_the_statistics_are_spread(spark, seen):
    df = spark.range(3000).selectExpr("id AS TransactionID", "IF(id % 3 = 0, id, -1L) AS k")
    fit = df if seen else df.where("k >= 0")
    got = by_id(entity.with_group_count(df, ["k"], "n", fit_on=fit), "k", "n")
    assert len(got) == 3000
    assert all(n == (1 if k >= 0 else 2000 if seen else 0) for k, n in got.values())


@pytest.mark.parametrize("hot_keys", [1, 256])
def test_attach_by_key_is_exact_for_hot_cold_and_missing_keys(spark, monkeypatch, hot_keys):
    monkeypatch.setattr(lookup, "HOT_KEYS", hot_keys)
    df = spark.range(3000).select(
        F.col("id").alias("TransactionID"),
        F.when(F.col("id") < 1500, 1).when(F.col("id") < 1600, None).otherwise(F.col("id") % 50 + 2)
        .cast("long").alias("k"),
    )
    got = by_id(entity.with_group_count(df, ["k"], "n"), "k", "n")
    sizes = {}
    for k, _ in got.values():
        sizes[k] = sizes.get(k, 0) + 1
    assert len(got) == 3000
    assert all(n == (0 if k is None else sizes[k]) for k, n in got.values())


def test_hot_rows_are_spread_by_the_join_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).selectExpr("id AS TransactionID", "id % 3 AS k")
        plan = entity.with_group_count(df, ["k"], "n")._jdf.queryExecution().executedPlan()
        exchanges = [x for x in plan.toString().splitlines() if "Exchange hashpartitioning" in x]
        assert any("_lane" in x for x in exchanges)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_deviation_single_row_and_missing_key(spark):
    df = spark.createDataFrame(
        [(1, 5, 10.0), (2, 6, 10.0), (3, 6, 20.0), (4, None, 3.0)],
        "TransactionID long, card1 long, TransactionAmt double",
    )
    got = by_id(entity.with_amount_deviation(df), "amt_vs_card1_mean", "amt_vs_card1_zscore")
    assert got[1] == (0.0, 0.0)
    assert got[4] == (None, None)
    assert got[3][0] == 5.0 and got[3][1] == pytest.approx(5 / 50**0.5, rel=1e-6)


def test_pair_count_needs_both_keys(spark):
    df = spark.createDataFrame(
        [(1, 5, 1.0), (2, 5, 1.0), (3, 5, None), (4, None, 1.0)],
        "TransactionID long, card1 long, addr1 double",
    )
    assert by_id(entity.with_pair_count(df), "card1_addr1_count") == {
        1: (2,), 2: (2,), 3: (0,), 4: (0,),
    }


def test_frequencies_sum_to_one_and_unknown_values_get_zero(spark):
    df = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, "b"), (4, None)], "TransactionID long, DeviceInfo string"
    )
    got = by_id(entity.with_frequencies(df), "DeviceInfo", "DeviceInfo_freq")
    assert sum({k: f for k, f in got.values() if k}.values()) == pytest.approx(1.0)
    assert got[4] == (None, 0.0)
    learned = entity.with_frequencies(df, fit_on=df.where("TransactionID <= 2"))
    assert by_id(learned, "DeviceInfo_freq")[3] == (0.0,)


def test_amount_buckets_at_the_edges(spark):
    df = spark.createDataFrame(
        [(1, 10.0), (2, 1000.0), (3, -1.0), (4, None), (5, 9.99)],
        "TransactionID long, TransactionAmt double",
    ).select(
        "TransactionID",
        X.report_amount_range(F.col("TransactionAmt")).alias("r"),
        X.feature_amount_bucket(F.col("TransactionAmt")).alias("f"),
    )
    assert by_id(df, "r", "f") == {
        1: ("$10-$50", "10-50"),
        2: (">$1000", ">1000"),
        3: ("<$10", "nan"),
        4: (">$1000", "nan"),
        5: ("<$10", "<10"),
    }


def test_time_features_use_floor(spark):
    df = spark.createDataFrame([(1, -1), (2, 86400 * 31 + 3600)], "TransactionID long, TransactionDT long")
    got = by_id(engineer.with_time_features(df), "tx_hour", "tx_dow", "tx_dom")
    assert got == {1: (23, 6, 30), 2: (1, 3, 2)}


def test_flags_as_text_and_as_boolean(spark):
    text = spark.createDataFrame([(1, "T"), (2, "F"), (3, None), (4, "M0")], "TransactionID long, M1 string")
    flags = spark.createDataFrame([(1, True), (2, False), (3, None)], "TransactionID long, M1 boolean")
    assert by_id(encoding.with_flag_codes(text), "M1_enc") == {1: (1,), 2: (0,), 3: (-1,), 4: (-1,)}
    assert by_id(encoding.with_flag_codes(flags), "M1_enc") == {1: (1,), 2: (0,), 3: (-1,)}


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_label_codes_are_ranks_in_code_point_order(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    df = spark.createDataFrame(
        [(1, "visa", "x"), (2, None, "x"), (3, "Amex", "x"), (4, "visa", "x")],
        "TransactionID long, card4 string, card6 string",
    )
    coded = encoding.with_label_codes(df)
    assert coded.columns == df.columns
    assert by_id(coded, "card4", "card6") == {1: (2, 0), 2: (1, 0), 3: (0, 0), 4: (2, 0)}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_label_codes_of_many_values_and_of_an_empty_dictionary(spark):
    df = spark.range(3000).selectExpr("id AS TransactionID", "CAST(id % 1500 AS STRING) AS card4")
    coded = by_id(encoding.with_label_codes(df), "card4")
    order = {v: i for i, v in enumerate(sorted(map(str, range(1500))))}
    assert all(code == order[str(i % 1500)] for i, (code,) in coded.items())
    unknown = encoding.with_label_codes(df, fit_on=df.limit(0))
    assert unknown.dtypes[1] == ("card4", "bigint") and unknown.select("card4").distinct().collect() == [(-1,)]


def test_sparse_threshold_is_strict(spark):
    df = spark.range(10).selectExpr(
        "id AS TransactionID", "IF(id < 2, id, NULL) AS V1", "IF(id < 1, id, NULL) AS V2",
        "IF(id < 1, id, NULL) AS D1",
    )
    assert audit.drop_sparse_columns(df).columns == ["TransactionID", "V1", "D1"]


def test_audit_of_an_empty_table_has_no_rate(spark):
    empty = spark.createDataFrame([], "a long, b string")
    assert [tuple(r) for r in audit.null_rate_audit(empty).collect()] == [
        ("a", 0, 0, None), ("b", 0, 0, None),
    ]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "TransactionID long, D1 double")
    assert by_id(audit.nan_to_null(df), "D1") == {1: (None,), 2: (1.5,)}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.integers(-5, 5).map(float),
            st.floats(-1e12, 1e12, allow_nan=False),
        ),
        min_size=1,
        max_size=80,
    )
)
def test_medians_equal_the_sorted_middle(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    n = len(known)
    want = None if not n else (known[(n - 1) // 2] + known[n // 2]) / 2
    assert impute.exact_medians(df, ["v"])["v"] == want


@pytest.mark.parametrize(
    "values, want",
    [
        ([1.0, float("inf")], float("inf")),
        ([float("-inf"), 1.0, 2.0], 1.0),
        ([float("-inf"), -1.0, 3.0, float("inf")], 1.0),
        ([-1.7e308, 1.7e308, 5.0, 6.0], 5.5),
        ([1.7e308, 1.7e308, 1.6e308], 1.7e308),
        ([0.0, 5e-324, 1e-323], 5e-324),
    ],
)
def test_medians_of_extreme_values(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert impute.exact_medians(df, ["v"])["v"] == want


@pytest.mark.parametrize("ids", [[1, 1, 2], [1, None, 2]])
def test_features_refuse_missing_and_repeated_ids(spark, ids):
    rows = [(i, 0, 100, 5.0, 7) for i in ids]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud long, TransactionDT long, TransactionAmt double, card1 long")
    with pytest.raises(ValueError, match="1 rows without|1 ids that occur again"):
        engineer.engineer_features(df)


def test_medians_of_many_columns_with_outliers(spark):
    df = spark.range(2001).selectExpr(
        *[f"CAST(pow(id, {1 + i % 4}) + {i} AS DOUBLE) AS c{i}" for i in range(70)]
    )
    got = impute.exact_medians(df, df.columns)
    assert got == {f"c{i}": float(1000 ** (1 + i % 4) + i) for i in range(70)}


def test_impute_rules(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0, None, None), (2, 2.0, 3.0, None, 5.0), (3, 2.0, None, None, 6.0)],
        "TransactionID long, C1 double, D1 double, V7 double, other double",
    )
    assert by_id(impute.impute(df), "C1", "D1", "V7", "other") == {
        1: (0.0, 1.0, None, None), 2: (2.0, 3.0, None, 5.0), 3: (2.0, 2.0, None, 6.0),
    }


def test_features_learned_on_training_rows_only(spark):
    df = spark.createDataFrame(
        [(1, 0, 10, 5.0, 1, "a"), (2, 1, 20, 9.0, 1, "a"), (3, 0, 30, 100.0, 1, "zz")],
        "TransactionID long, isFraud long, TransactionDT long, TransactionAmt double, "
        "card1 long, card4 string",
    )
    out = engineer.engineer_features(df, fit_on=df.where("TransactionID < 3"))
    got = by_id(out, "amt_vs_card1_mean", "card4", "tx_count_card1_1h")
    assert got[3] == (93.0, -1, 2)


def test_medians_take_four_passes_and_leave_out_nan(spark, monkeypatch):
    scans = []
    counted = impute._digit_counts
    monkeypatch.setattr(impute, "_digit_counts", lambda *a: scans.append(1) or counted(*a))
    rng = np.random.default_rng(9)
    x = rng.normal(size=(301, 365)) * 10.0 ** rng.integers(-300, 300, 365)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7], x[:, 8], x[:3, 9], x[3:, 9] = np.nan, -0.0, 4.0, np.nan
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{i}" for i in range(365)]))
    got = impute.exact_medians(df, df.columns)
    assert len(scans) == 4 and got["c7"] is None and got["c8"] == 0.0 and got["c9"] == 4.0
    want = np.nanmedian(np.delete(x, 7, axis=1), axis=0)
    assert [got[c] for c in df.columns if c != "c7"] == want.tolist()


@pytest.mark.parametrize("light_rows", [1, 12, 1 << 16])
def test_velocity_of_keys_with_few_and_with_many_rows_in_a_block(spark, monkeypatch, light_rows):
    monkeypatch.setattr(velocity, "LIGHT_ROWS", light_rows)
    rng = random.Random(7)
    times = [rng.randrange(-300, 600) for _ in range(300)]
    rows = [(rng.getrandbits(62), rng.choice([1, 1, 1, 1, 2, 3, None]), t) for t in times + times[:60]]
    got = velocity_of(spark, rows, {"short": 9, "long": 30})
    assert {i: v[0] for i, v in got.items()} == brute_velocity(rows, 9)
    assert {i: v[1] for i, v in got.items()} == brute_velocity(rows, 30)


def test_velocity_of_light_keys_takes_one_shuffle_and_no_moving_sums(spark):
    df = spark.range(1000).selectExpr("id AS TransactionID", "id % 30 AS card1", "id * 60 AS TransactionDT")
    plan = velocity.trailing_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    # A frame that moves at both ends is summed anew for each row.
    frames = [x.split(",")[1].strip() for x in plan.split("specifiedwindowframe(RangeFrame")[1:]]
    assert frames and set(frames) == {"unboundedpreceding$()"}
