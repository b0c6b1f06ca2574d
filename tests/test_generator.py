from pyspark.sql import functions as F

from closecast.operators import contracts as C
from closecast.schema import ALL_COLUMNS, TARGET
from closecast.sources.generator import GeneratorConfig, generate_snapshots

TEST_PROFILE = GeneratorConfig(seed=7, n_facilities=3, n_months=18, snapshot_days=[10, 15, 20],
                               missing_rate=0.02, outlier_rate=0.0)


def test_shape_and_columns(spark):
    df = generate_snapshots(spark, TEST_PROFILE)
    assert df.columns == ALL_COLUMNS
    assert df.count() == 3 * 18 * 3
    assert df.where(~F.col("facility_id").rlike(r"^FAC-\d{3}$")).isEmpty()
    assert df.where(F.col(TARGET) <= 0).isEmpty()


def test_deterministic_and_partition_free(spark):
    a = generate_snapshots(spark, TEST_PROFILE)
    b = generate_snapshots(spark, TEST_PROFILE).repartition(7)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    other = generate_snapshots(spark, GeneratorConfig(**{**TEST_PROFILE.__dict__, "seed": 8}))
    assert not a.exceptAll(other).isEmpty()


def test_contract_and_leakage_pass(spark):
    df = generate_snapshots(spark, TEST_PROFILE)
    C.validate_raw_snapshots(df)
    C.validate_leakage_rules(df)


def test_target_constant_and_history_length(spark):
    df = generate_snapshots(spark, TEST_PROFILE)
    per = df.groupBy("facility_id", "accounting_month").agg(F.countDistinct(TARGET).alias("k"))
    assert per.where("k > 1").isEmpty()
    first = df.where(F.col("accounting_month") == "2023-01")
    assert first.where(F.col("prior_month_net_revenue").isNotNull()).isEmpty()
    assert df.where((F.col("accounting_month") >= "2024-01") & F.col("prior_year_same_month_net_revenue").isNull()).isEmpty()


def test_equal_under_1_7_64_partitions(spark):
    frames = [generate_snapshots(spark, GeneratorConfig(**{**TEST_PROFILE.__dict__, "num_partitions": n}))
              for n in (1, 7, 64)]
    for other in frames[1:]:
        assert frames[0].exceptAll(other).isEmpty() and other.exceptAll(frames[0]).isEmpty()
